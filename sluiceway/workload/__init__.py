"""The registered queries: each operator run over whole given tables, with its SQL twin."""
