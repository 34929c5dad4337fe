"""Which objects are used together, and what a node depends on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluiceway.runtime import new_dir, settle, settle_counted, shuffles_dropped


def co_access(log: DataFrame, query: str, item: str, target, limit: int | None = None) -> DataFrame:
    """Objects used in the same queries as ``target``, most used first.

    ``log_rows`` counts each log row of such a query once; ``pair_rows`` counts it once per
    log row of the target in that query. The target's rows are filtered at the scan and counted per
    query; that small table, one row per query, meets the log, so no pairs are formed, and its known
    size lets Spark broadcast it instead of shuffling the log.
    """
    hits = (
        log.filter(F.col(item) == F.lit(target))
        .groupBy(F.col(query).alias("_q"))
        .agg(F.count(F.lit(1)).alias("_hits"))
    )
    others = log.filter(F.col(item) != F.lit(target)).select(
        F.col(query).alias("_q"), F.col(item).alias("object")
    )
    counted = (
        others.join(settle(hits, "co-access"), "_q")
        .groupBy("object")
        .agg(F.count(F.lit(1)).alias("log_rows"), F.sum("_hits").alias("pair_rows"))
        .orderBy(F.desc("log_rows"), "object")
    )
    return counted.limit(limit) if limit else counted


def lineage_closure(
    edges: DataFrame, node, direction: str = "upstream", max_depth: int | None = None
) -> DataFrame:
    """All nodes reachable from ``node`` with their depth: (node, depth).

    ``edges`` has ``parent`` and ``child``; upstream walks from child to parent. The distinct edges
    are settled once. Each round joins only the newly found nodes and drops known ones; its
    result joins the nodes seen so far as one more folder of the same table, which keeps plans
    flat and survives lost executors.
    """
    start, reach = ("child", "parent") if direction == "upstream" else ("parent", "child")
    spark = edges.sparkSession
    steps = settle(
        edges.select(F.col(start).alias("node"), F.col(reach).alias("next")).distinct(), "edges"
    )
    kind = steps.schema["node"].dataType.simpleString()
    path = new_dir(spark, "closure")

    def found(depth: int | None = None) -> DataFrame:
        reader = spark.read.schema(f"node {kind}, depth int").option("basePath", path)
        return reader.parquet(path if depth is None else f"{path}/depth={depth}")

    first = spark.range(1).select(F.lit(node).cast(kind).alias("node"))
    first.write.parquet(f"{path}/depth=0")
    depth = 0
    while max_depth is None or depth < max_depth:
        new = (
            steps.join(found(depth).select("node"), "node", "left_semi")
            .select(F.col("next").alias("node"))
            .distinct()
            .join(found().select("node"), "node", "left_anti")
        )
        depth += 1
        new.write.parquet(f"{path}/depth={depth}")
        if found(depth).isEmpty():
            break
    return found().filter("depth > 0")


# Up to so many sources are sent to all tasks.
_FEW = 100_000


def closure_of_all(edges: DataFrame, direction: str = "downstream", sources: DataFrame | None = None) -> DataFrame:
    """(source, node, depth): everything reachable from every node, with the length of the shortest way.

    Path doubling: after k rounds all ways of up to 2**k steps are known, so a chain of a thousand nodes
    takes ten rounds. A longer shortest way begins with exactly 2**k steps, so only pairs at that
    distance are carried on, joined with all that is known, and what is new joins the table as one more
    folder. Every pair tells whether a step leads on from its end: others aren't carried on, and when none is left the last
    round has been. Where few sources are carried on, only their known pairs are compared with the new ones. Cycles end by themselves, as a node that is known already is not found again; a node on a cycle reaches itself.
    ``sources`` (a column ``source``) keeps the pairs that begin there. The result has a row per pair,
    which is what grows; nothing of it reaches the driver.
    """
    start, reach = ("child", "parent") if direction == "upstream" else ("parent", "child")
    spark = edges.sparkSession
    path = new_dir(spark, "pairs")
    steps = edges.select(F.col(start).alias("source"), F.col(reach).alias("node"))
    steps = settle(steps.where("source IS NOT NULL AND node IS NOT NULL").distinct(), "steps")
    starts = settle(steps.select(F.col("source").alias("node")).distinct(), "starts").withColumn("more", F.lit(True))
    steps = steps.join(starts, "node", "left").select(
        "source", "node", F.lit(1).cast("long").alias("depth"), F.coalesce("more", F.lit(False)).alias("more")
    )
    counted = Observation()
    with shuffles_dropped(spark):
        steps.observe(counted, F.count_if("more").alias("far")).write.parquet(f"{path}/round=0")
    reader = spark.read.schema(f"{steps.schema.simpleString()[7:-1].replace(':', ' ')}, round int").option("basePath", path)
    k = 0
    while counted.get["far"]:
        known, counted = reader.parquet(path), Observation()
        half = 2**k
        far = reader.parquet(f"{path}/round={k}").where((F.col("depth") == half) & F.col("more"))
        carried, n = settle_counted(far.select("source").distinct(), "carried")
        far = far.select("source", F.col("node").alias("over"))
        onward = known.select(F.col("source").alias("over"), "node", (F.col("depth") + half).alias("depth"), "more")
        old = known if n > _FEW else known.join(F.broadcast(carried), "source", "left_semi")
        # Known pairs are nearer than any new one, so the nearest of all says which are new, without a join.
        longer = (
            far.join(onward, "over")
            .select("source", "node", "depth", "more")
            .unionByName(old.select("source", "node", "depth", "more"))
            .groupBy("source", "node")
            .agg(F.min("depth").alias("depth"), F.first("more").alias("more"))
            .where(F.col("depth") > half)
        )
        k += 1
        reached = F.count_if((F.col("depth") == 2 * half) & F.col("more")).alias("far")
        with shuffles_dropped(spark):
            longer.observe(counted, reached).write.parquet(f"{path}/round={k}")
    pairs = reader.parquet(path).select("source", "node", "depth")
    return pairs if sources is None else pairs.join(sources.select("source").distinct(), "source", "left_semi")
