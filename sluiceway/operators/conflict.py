"""Duplicates and conflicting records from several sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import row_hash
from sluiceway.operators.joins import join_same
from sluiceway.operators.latest import first_per_key, keep_latest
from sluiceway.runtime import settle

def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def resolve_latest(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str] = ()) -> DataFrame:
    return keep_latest(df, keys, ts, tiebreak)


def resolve_source_priority(
    df: DataFrame, keys: list[str], source: str, priority: list[str], tiebreak: list[str] = ()
) -> DataFrame:
    """Keep the record of the best-ranked source; unknown sources come last."""
    known = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(source))
    rank = F.when(known > 0, known).otherwise(F.lit(len(priority) + 1))
    return first_per_key(df, keys, [rank.asc(), *[F.asc(t) for t in (source, *tiebreak)]])


def merge_coalesce(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key and column the first non-null value in ``order``; merged before the shuffle."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), _rank(df, order, c))).alias(c) for c in values]
    )


def _rank(df: DataFrame, order: list[str], value: str) -> Column:
    """The order columns, ties broken by the value itself."""
    sortable = not isinstance(df.schema[value].dataType, (T.MapType, T.VariantType))
    return F.struct(*order, *([value] if sortable and value not in order else []))


def resolve_rules(df: DataFrame, keys: list[str], rules: list[dict]) -> DataFrame:
    """Per-field rules: ``{"field", "strategy", "order_by"}``.

    Strategies: ``max_by``/``min_by`` take the value at the largest/smallest ``order_by``
    (a column or list of columns), ``max``/``min`` the extreme value itself.
    """
    out = []
    for rule in rules:
        field, strategy = rule["field"], rule["strategy"]
        if strategy in ("max", "min"):
            out.append(getattr(F, strategy)(field).alias(field))
            continue
        by = rule["order_by"]
        rank = _rank(df, by if isinstance(by, list) else [by], field)
        if strategy not in ("max_by", "min_by"):
            raise ValueError(f"unknown strategy {strategy}")
        out.append(getattr(F, strategy)(F.col(field), rank).alias(field))
    return df.groupBy(*keys).agg(*out)


def mark_unique_violations(
    df: DataFrame, keys: list[str], order: list[str], among: Column | None = None
) -> DataFrame:
    """Add ``_repeat``: true for all but the first row of each key (nulls count as equal).

    Keys are counted first, with map-side combine. Rows of keys that occur once pass through; only those of
    repeated keys are settled, with a number each. The first row per key is a minimum over the order, a
    hash of the row and its number, combined before the shuffle; what comes back to the rows is
    the set of winning numbers, joined by number, so no key's size matters. Ties are broken by all
    columns, so any row chosen among the rest is an equal copy. ``df`` is read three times.
    """
    chosen = df.filter(among) if among is not None else df
    counts = chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    repeated = settle(counts, "repeated-keys")
    once = join_same(df, repeated, keys, "left_anti").withColumn("_repeat", F.lit(False))
    several = join_same(df, repeated, keys, "left_semi").withColumn("_row", F.monotonically_increasing_id())
    rows = settle(several, "numbered")
    picked = rows.filter(among) if among is not None else rows
    winners = first_rows(picked, df, keys, order).select(F.col("_row").alias("_winner"))
    marked = rows.join(winners, F.col("_row") == F.col("_winner"), "left")
    considered = F.coalesce(among, F.lit(False)) if among is not None else F.lit(True)
    marked = marked.withColumn("_repeat", considered & F.col("_winner").isNull()).drop("_row", "_winner")
    return once.unionByName(marked)


def first_rows(rows: DataFrame, df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, _row) of the first row per key among numbered ``rows`` of ``df``'s columns."""
    by_order = [part for c in order for part in (F.col(c).isNull(), F.col(c))]
    place = F.struct(
        *[v.alias(f"o{i}") for i, v in enumerate(by_order)], row_hash(df).alias("h"), F.col("_row").alias("r")
    )
    first = rows.groupBy(*keys).agg(F.min(place).alias("_first"))
    return first.select(*keys, F.col("_first.r").alias("_row"))


def _total_order(df: DataFrame, order: list[str]) -> list[Column]:
    return [*[F.col(c).asc_nulls_last() for c in order], row_hash(df).asc()]


def split_unique_violations(
    df: DataFrame, keys: list[str], order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(first row per key, the repeats)."""
    repeats = mark_unique_violations(df, keys, order).filter("_repeat").drop("_repeat")
    return without_violations(df, keys, order), repeats


def without_violations(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key; it needs no ranking of the losers, so keys are cut down in the map tasks."""
    return first_per_key(df, keys, _total_order(df, order))


def conflict_log(
    df: DataFrame, table: str, keys: list[str], strategy: str, as_of: dt.datetime
) -> DataFrame:
    """Audit rows for every duplicated key."""
    return find_duplicates(df, keys).select(
        F.lit(table).alias("table_name"),
        F.lit("duplicate").alias("conflict_type"),
        F.to_json(F.struct(*keys)).alias("record_keys"),
        F.lit(strategy).alias("resolution_strategy"),
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("resolved_at"),
    )
