"""Whole jobs: synchronise, stage, model, test."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators.merge import rows_after, sync_rows
from sluiceway.operators.quality import verdict
from sluiceway.sources import storage


def sync(
    src: DataFrame,
    path: str,
    mode: str,
    cursor: str | None = None,
    keys: list[str] | None = None,
    tiebreak: list[str] = (),
    target_is_deduped: bool = False,
) -> DataFrame:
    """Bring the table at ``path`` up to date with ``src`` and return it.

    Append modes only add files; the other modes write the new state beside the table and
    swap it in.
    """
    spark = src.sparkSession
    old = spark.read.parquet(path) if storage.exists(spark, path) else None
    if old is not None and mode in ("full_refresh_append", "incremental_append"):
        new = src if mode == "full_refresh_append" else rows_after(src, old, cursor)
        new.write.mode("append").parquet(path)
    else:
        storage.swap_in(sync_rows(src, old, mode, cursor, keys, tiebreak, target_is_deduped), path)
    return spark.read.parquet(path)


def transformation(spark: SparkSession, sql: str, *bases: DataFrame) -> DataFrame:
    """User SQL over upstream frames: ``{base}`` for one, ``{base_0}``, ``{base_1}``… for more."""
    if len(bases) == 1:
        return spark.sql(sql, base=bases[0])
    return spark.sql(sql, **{f"base_{i}": b for i, b in enumerate(bases)})


class TestsFailed(RuntimeError):
    """The tests of a job did not pass, so its result was not published."""


def elt_job(
    sources: dict[str, DataFrame],
    landing: str,
    stage: dict[str, Callable[[DataFrame], DataFrame]],
    model: Callable[[dict[str, DataFrame]], DataFrame],
    tests: Callable[[DataFrame], DataFrame],
    out_path: str,
    syncs: dict[str, dict] | None = None,
) -> DataFrame:
    """Synchronise every source, stage it, build the model, test it, publish it if it passes.

    The model is written once under a name of its own, tested where it lies, and moved into place
    only then. The old result is kept as ``<out_path>_bkp``; between the two moves there is no
    table at ``out_path``, as with any pair of renames.
    """
    spark = next(iter(sources.values())).sparkSession
    staged = {}
    for name, df in sources.items():
        how = (syncs or {}).get(name, {"mode": "full_refresh_overwrite"})
        landed = sync(df, f"{landing}/{name}", **how)
        staged[name] = stage.get(name, lambda d: d)(landed)
    candidate = f"{out_path.rstrip('/')}__candidate_{uuid.uuid4().hex}"
    model(staged).write.parquet(candidate)
    result = verdict(tests(spark.read.parquet(candidate))).first()
    if not result["valid"]:
        storage.remove(spark, candidate)
        raise TestsFailed(f"{result['failed']} of {result['tests']} tests failed")
    if storage.exists(spark, out_path):
        storage.remove(spark, f"{out_path}_bkp")
        storage.move(spark, out_path, f"{out_path}_bkp")
    storage.move(spark, candidate, out_path)
    return spark.read.parquet(out_path)
