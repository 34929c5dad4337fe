"""Type-2 history: a new version per change, the old one closed."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.joins import key_side
from sluiceway.operators.latest import first_per_key, newest_first, one_per_key

OPEN = ("valid_from", "valid_to")


def snapshot(
    current: DataFrame,
    history: DataFrame | None,
    key: list[str],
    strategy: str = "timestamp",
    updated_at: str | None = None,
    check_cols: list[str] | None = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """History after comparing it with the current rows (one per key; a repeated key is refused).

    ``timestamp`` makes a version when ``updated_at`` is newer, ``check`` when any of
    ``check_cols`` (default all) differs, null-safe, dated ``as_of``. Unchanged keys keep
    their version and keys missing from ``current`` stay open, so a replay changes nothing.
    Versions already closed pass through without a shuffle; open ones meet the current rows in one exchange.
    """
    start = _start(strategy, updated_at, as_of)
    if history is None:
        return _dated(one_per_key(current, key), start)
    data = current.columns
    closed = history.filter(F.col("valid_to").isNotNull())
    row = F.struct(*data, *OPEN)
    names = [f"_key{i}" for i in range(len(key))]
    own = [F.col(k).alias(n) for k, n in zip(key, names)]
    alive = history.filter(F.col("valid_to").isNull()).select(*own, row.alias("old"), F.lit(None).alias("new"))
    came = _dated(current, start).select(*own, F.lit(None).alias("old"), row.alias("new"))
    # Both sides of a key in one exchange; nulls group as equal keys.
    both = alive.union(came).groupBy(*names).agg(
        F.first("old", ignorenulls=True).alias("old"),
        F.first("new", ignorenulls=True).alias("new"),
        F.count("new").alias("n"),
    )
    if strategy == "timestamp":
        newer = F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}")
        changed = F.coalesce(newer, F.lit(False))
    else:
        watched = [c for c in (check_cols or data) if c not in key]
        differs = [~F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in watched]
        changed = reduce(lambda a, b: a | b, differs, F.lit(False))
    old, new = F.col("old"), F.col("new")
    ended = old.withField("valid_to", F.col("new.valid_from"))
    versions = (
        F.when(F.col("n") > 1, F.raise_error(F.lit(f"a key of {key} is repeated")))
        .when(new.isNull(), F.array(old))
        .when(old.isNull(), F.array(new))
        .when(changed, F.array(ended, new))
        .otherwise(F.array(old))
    )
    return closed.select(*data, *OPEN).unionByName(both.select(F.inline(versions)))


def _dated(current: DataFrame, start: Column) -> DataFrame:
    return current.select("*", start.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def _start(strategy: str, updated_at: str | None, as_of: dt.datetime | None) -> Column:
    if strategy == "timestamp":
        if not updated_at:
            raise ValueError("the timestamp strategy needs updated_at")
        return F.col(updated_at).cast("timestamp_ntz")
    if strategy == "check":
        if as_of is None:
            raise ValueError("the check strategy needs as_of")
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    raise ValueError(f"unknown strategy {strategy}")


def version_id(key: list[str]) -> Column:
    """Stable id of a version: digest over key and start, which no other key can spell."""
    named = F.struct(*[F.col(k) for k in key], "valid_from")
    return F.md5(F.to_json(named, {"ignoreNullFields": "false"}))


def as_of_time(history: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at a moment."""
    return history.filter(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    )


def apply_changes(
    changes: DataFrame, history: DataFrame | None, key: list[str], updated_at: str
) -> DataFrame:
    """History after changes that may come in any order, several per key, older ones included.

    Every distinct (key, ``updated_at``) is a version, valid until the key's next one: a change older than
    the newest version splits the closed interval it falls into. So batches of changes give the same
    history in whatever order they are applied, and a replay changes nothing. Of rows with equal key and
    time the one with the largest values stays. Keys without a change pass through unranked. A
    key's versions are read in order, never held together.
    """
    data = changes.columns
    start = F.col(updated_at).cast("timestamp_ntz").alias("valid_from")
    rows = changes.select(*data, start)
    untouched = None
    if history is not None:
        renamed = {k: f"_k{i}" for i, k in enumerate(key)}
        came = key_side(changes, key).withColumnsRenamed(renamed)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in renamed.items()])
        untouched = history.select(*data, *OPEN).join(came, same, "left_anti")
        rows = rows.unionByName(history.join(came, same, "left_semi").select(*data, "valid_from"))
    rest = [c for c in data if c not in key and not isinstance(changes.schema[c].dataType, (T.MapType, T.VariantType))]
    once = first_per_key(rows, [*key, "valid_from"], newest_first(updated_at, rest))
    following = F.lead("valid_from").over(Window.partitionBy(*key).orderBy("valid_from"))
    # A row without a time says nothing about when it held.
    versions = once.where(F.col("valid_from").isNotNull()).withColumn("valid_to", following).select(*data, *OPEN)
    return versions if untouched is None else untouched.unionByName(versions)
