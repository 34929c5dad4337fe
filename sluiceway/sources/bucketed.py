"""Tables kept in buckets of their keys, so that a merge rewrites only buckets that a batch touches.

A table is a folder partitioned by ``_bucket_of_<n>``, a hash of its keys; the column's name tells how many
buckets there are. Spark prunes the partitions that a batch has no key in, and dynamic partition overwrite replaces
the others alone. A batch that is applied again after a failure half way leaves the same table, as each
bucket is replaced by its own merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.keys import bucket_of
from sluiceway.operators.merge import check_cursor, delete_insert, evolve, merge_rows, newest_per_key, rows_after
from sluiceway.runtime import settle
from sluiceway.sources import storage

_PREFIX = "_bucket_of_"
STRATEGIES = ("merge", "delete+insert", "deduped")


def bucket_column(df: DataFrame) -> str:
    """The column of a bucketed table that holds its buckets."""
    found = [c for c in df.columns if c.startswith(_PREFIX)]
    if len(found) != 1:
        raise ValueError("not a bucketed table")
    return found[0]


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write ``df`` as a new table in ``buckets`` buckets of ``keys``."""
    name = f"{_PREFIX}{buckets}"
    _dealt(df.withColumn(name, bucket_of(df, keys, buckets)), name).write.partitionBy(name).parquet(path)


def read_bucketed(spark: SparkSession, path: str, with_bucket: bool = False) -> DataFrame:
    """The table at ``path``; columns that later batches brought are null in older buckets."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df if with_bucket else df.drop(bucket_column(df))


def _dealt(df: DataFrame, name: str) -> DataFrame:
    # Few files per bucket; adaptive execution splits a bucket that is much larger than others.
    return df.hint("rebalance", name)


def merge_into(
    batch: DataFrame,
    path: str,
    keys: list[str],
    strategy: str = "merge",
    cursor: str | None = None,
    tiebreak: list[str] = (),
    on_schema_change: str = "fail",
    buckets: int = 256,
) -> int:
    """Apply ``batch`` to the bucketed table at ``path``; return how many buckets were written.

    ``merge``: matching keys are replaced, new ones inserted, the newest row per key of the batch wins;
    ``delete+insert``: rows whose key is in the batch go, the whole batch comes; ``deduped``: of old and
    new rows together the newest per key stays, so a row older than the table's changes nothing.
    Rows with a null key match nothing and all stay. A missing table is made with ``buckets`` buckets.
    Columns may be added (``append_new_columns``), not dropped, as untouched buckets stay as they are. The
    driver holds the numbers of touched buckets.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    if on_schema_change == "sync_all_columns":
        raise ValueError("dropping columns would rewrite every bucket")
    spark = batch.sparkSession
    if not storage.exists(spark, path):
        first = batch if strategy == "delete+insert" else newest_per_key(batch, keys, cursor, tiebreak)
        write_bucketed(first, path, keys, buckets)
        return buckets
    table = read_bucketed(spark, path, with_bucket=True)
    name = bucket_column(table)
    # The batch in the table's types, so that equal keys share a bucket.
    _, new = evolve(table.drop(name), batch, on_schema_change)
    retyped = [f.name for f in new.schema.fields if f.name in table.columns and table.schema[f.name].dataType != f.dataType]
    if retyped:
        raise ValueError(f"other types of {retyped} would rewrite every bucket")
    placed = settle(new.withColumn(name, bucket_of(new, keys, int(name.removeprefix(_PREFIX)))), "batch")
    touched = sorted(r[0] for r in placed.select(name).distinct().collect())
    if not touched:
        return 0
    came = {f.name: F.lit(None).cast(f.dataType) for f in new.schema.fields if f.name not in table.columns}
    near = table.where(F.col(name).isin(touched)).withColumns(came).select(*placed.columns)
    if strategy == "merge":
        state = merge_rows(near, placed, keys, cursor)
    elif strategy == "delete+insert":
        state = delete_insert(near, placed, keys)
    else:
        state = newest_per_key(near.unionByName(placed), keys, check_cursor(new, cursor), tiebreak)
    # Every row keeps the bucket it was given, so no bucket but the touched ones is written.
    writer = _dealt(state, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(name).parquet(path)
    return len(touched)


def sync_bucketed(
    src: DataFrame, path: str, keys: list[str], cursor: str, tiebreak: list[str] = (), buckets: int = 256
) -> int:
    """One deduplicating sync: source rows beyond the table's last cursor, merged bucket by bucket."""
    spark = src.sparkSession
    new = rows_after(src, read_bucketed(spark, path), cursor) if storage.exists(spark, path) else src
    return merge_into(new, path, keys, "deduped", cursor, tiebreak, buckets=buckets)
