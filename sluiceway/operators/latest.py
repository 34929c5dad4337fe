"""Newest rows per key.

All functions filter on ``row_number``, which lets Spark cut every key down to its first
rows inside each map task (WindowGroupLimit) before the shuffle: a key that holds a third
of the table sends a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def placed_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key with their ``_place``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n)


def newest_first(cursor: str, tiebreak: list[str] = ()) -> list[Column]:
    return [F.desc_nulls_last(c) for c in (cursor, *tiebreak)]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    return placed_per_key(df, keys, order, n).drop("_place")


def keep_latest(df: DataFrame, keys: list[str], cursor: str, tiebreak: list[str] = ()) -> DataFrame:
    """One row per key: the newest by ``cursor``, then by ``tiebreak`` (highest wins)."""
    return first_per_key(df, keys, newest_first(cursor, tiebreak))


def newest_n(
    df: DataFrame, keys: list[str], cursor: str, n: int, tiebreak: list[str] = ()
) -> DataFrame:
    return first_per_key(df, keys, newest_first(cursor, tiebreak), n)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows themselves; a repeated key (nulls count as equal) is an error."""
    two = placed_per_key(df, keys, [F.lit(1)], 2)
    refused = F.raise_error(F.lit(f"a key of {keys} is repeated")).cast("boolean")
    once = F.when(F.col("_place") > 1, refused).otherwise(F.lit(True))
    return two.filter(once).drop("_place")
