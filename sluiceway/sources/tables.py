"""Loading, copying and measuring parquet tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.conflict import first_rows
from sluiceway.operators.joins import join_same, key_side
from sluiceway.runtime import settle
from sluiceway.sources import storage


class TooManyRejects(RuntimeError):
    """An append was refused because more rows failed than the load allows."""


def load_replace(df: DataFrame, path: str, backup: bool = True) -> None:
    """Full load: keep the old table as ``<path>_bkp`` (by moving it), then put ``df`` in place."""
    storage.swap_in(df, path, f"{path.rstrip('/')}_bkp" if backup else None)


def load_append(
    checked: DataFrame,
    path: str,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    error_limit: int = 100,
) -> dict[str, int]:
    """Append the good rows of a checked load; bad rows go to ``_et`` and ``_uv`` beside it.

    ``checked`` comes from ``cast_to_schema``. Rows that did not convert land in ``<path>_et``;
    rows that repeat a key (all but the first by ``order``), or whose key the table already holds, in
    ``<path>_uv``. With keys the casts are made once: numbered rows are settled, and the winners'
    numbers join them. Good rows are written beside the table while all outcomes are counted, failed
    ones in a second pass if there are any; good rows are moved in only if no more than
    ``error_limit`` rows failed.
    """
    spark, table = checked.sparkSession, path.rstrip("/")
    bad = F.size("_errors") > 0
    rows = checked
    outcome = F.when(bad, "et").otherwise("good")
    if keys:
        data = [c for c in checked.columns if c not in ("_errors", "_raw")]
        rows = settle(checked.withColumn("_row", F.monotonically_increasing_id()), "load")
        first = first_rows(rows.filter(~bad), checked.select(*data), keys, order or keys)
        if storage.exists(spark, table):
            known = spark.read.parquet(table)
            first = join_same(first, key_side(known, keys), keys, "left_anti")
        winners = first.select(F.col("_row").alias("_winner"))
        rows = rows.join(winners, F.col("_row") == F.col("_winner"), "left")
        outcome = F.when(bad, "et").when(F.col("_winner").isNull(), "uv").otherwise("good")
    rows = rows.withColumn("_outcome", outcome).drop("_row", "_winner")
    outcomes, counted = ("good", "et", "uv"), Observation()
    staged = f"{table}__load_{uuid.uuid4().hex}"
    (
        rows.observe(counted, *[F.count_if(F.col("_outcome") == o).alias(o) for o in outcomes])
        .filter("_outcome = 'good'")
        .drop("_errors", "_raw", "_outcome")
        .write.parquet(staged)
    )
    result = {o: int(counted.get[o]) for o in outcomes}
    failed = result["et"] + result["uv"]
    if failed:
        apart = f"{staged}_failed"
        rows.filter("_outcome <> 'good'").write.partitionBy("_outcome").parquet(apart)
        for part in ("et", "uv"):
            if result[part]:
                storage.publish_files(spark, f"{apart}/_outcome={part}", f"{table}_{part}")
        storage.remove(spark, apart)
    if failed > error_limit:
        storage.remove(spark, staged)
        raise TooManyRejects(f"{failed} rows failed, limit {error_limit}")
    storage.publish_files(spark, staged, table)
    return result


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    """Equal names (case-blind) and types, in order."""
    left = [(f.name.lower(), f.dataType) for f in a.schema.fields]
    return left == [(f.name.lower(), f.dataType) for f in b.schema.fields]


def transfer(df: DataFrame, path: str) -> str:
    """Copy a table or query result: create, append, or back up and recreate on other columns."""
    spark = df.sparkSession
    if not storage.exists(spark, path):
        df.write.parquet(path)
        return "created"
    if same_columns(df, spark.read.parquet(path)):
        df.write.mode("append").parquet(path)
        return "appended"
    storage.swap_in(df, path, f"{path.rstrip('/')}_bkp")
    return "recreated"


def transfer_table(df: DataFrame, path: str, columns: list[str] | None = None) -> str:
    return transfer(df.select(*columns) if columns else df, path)


def transfer_query(spark: SparkSession, sql: str, path: str, **frames: DataFrame) -> str:
    return transfer(spark.sql(sql, **frames), path)


def create_like(df: DataFrame, path: str) -> DataFrame:
    """A table with the columns of ``df`` and no rows."""
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.parquet(path)
    return spark.read.parquet(path)


def write_distributed(
    df: DataFrame, table: str, buckets: int, key: str | None = None, path: str | None = None
) -> None:
    """Save as a table bucketed by its first column, so joins on it need no shuffle.

    Rows are dealt to tasks by bucket and share of the input, so a hot key is many files of one
    bucket rather than one task's work.
    """
    key = key or df.columns[0]
    dealt = df.repartition(F.pmod(F.hash(key), F.lit(buckets)), F.spark_partition_id())
    writer = dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def run_sql(spark: SparkSession, sql: str, params: list | None = None, **frames: DataFrame) -> DataFrame:
    """Any SQL text with ``?`` parameters and ``{name}`` frames."""
    return spark.sql(sql, args=params, **frames) if params else spark.sql(sql, **frames)


def table_size(spark: SparkSession, path: str) -> DataFrame:
    """One row: bytes on disk, MB and GB to two decimals, row count (from file footers)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    size = files.filter(~F.col("path").rlike(r"/[_.][^/]*$")).agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
    return size.select(
        "bytes",
        F.round(F.col("bytes") / 1024**2, 2).alias("size_mb"),
        F.round(F.col("bytes") / 1024**3, 2).alias("size_gb"),
        rows.scalar().alias("row_count"),
    )
