"""DataFrame-in / DataFrame-out building blocks for extract-load-transform work on Spark."""
