"""Incremental loads: each function returns the new full state of the target."""

from __future__ import annotations

import datetime as dt
import decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.text import request_id
from sluiceway.operators.joins import key_side
from sluiceway.operators.latest import keep_latest, one_per_key
from sluiceway.operators.schema import least_common_type

STRATEGIES = ("append", "merge", "delete+insert")
SYNC_MODES = (
    "full_refresh_overwrite",
    "full_refresh_append",
    "incremental_append",
    "incremental_deduped_history",
)

# What a source and a destination mode mean together; "*" is any other mode.
SYNC_MODE_OF = {
    ("incremental", "append_dedup"): "incremental_deduped_history",
    ("incremental", "deduped_history"): "incremental_deduped_history",
    ("incremental", "overwrite_dedup"): "incremental_deduped_history",
    ("incremental", "*"): "incremental_append",
    ("*", "append"): "full_refresh_append",
    ("*", "*"): "full_refresh_overwrite",
}


def resolve_sync_mode(source_mode: str | None, dest_mode: str | None) -> str:
    """The sync mode of a pair of modes in any case; missing ones are full refresh and append."""
    pair = (source_mode or "full_refresh").lower(), (dest_mode or "append").lower()
    known = [s for s, _ in SYNC_MODE_OF]
    source = pair[0] if pair[0] in known else "*"
    return SYNC_MODE_OF.get((source, pair[1]), SYNC_MODE_OF[source, "*"])


class CursorError(ValueError):
    """An incremental sync without a usable cursor column."""


def check_cursor(df: DataFrame, cursor: str | None) -> str:
    """The cursor's real column name (found case-blind), or an error naming the choices."""
    names = {c.lower(): c for c in df.columns}
    if not cursor or cursor.lower() not in names:
        state = "missing" if not cursor else f"unknown: {cursor}"
        raise CursorError(f"cursor {state}; columns are {sorted(df.columns)}")
    return names[cursor.lower()]


def _mark(column: Column, kind: T.DataType) -> Column:
    """The cursor as a value that reaches the driver unchanged in every time zone."""
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else column


def literal_of(value, kind: T.DataType) -> Column:
    """The constant of type ``kind`` that ``_mark`` gave."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.TimestampNTZType):
        seconds = decimal.Decimal(value.second * 10**6 + value.microsecond).scaleb(-6)
        parts = (value.year, value.month, value.day, value.hour, value.minute)
        return F.make_timestamp_ntz(*map(F.lit, parts), F.lit(seconds).cast("decimal(16,6)"))
    return F.lit(value).cast(kind)


def high_water_mark(tgt: DataFrame, cursor: str, kind: T.DataType):
    """Largest cursor in the target, one value brought to the driver; timestamps as microseconds.

    As a literal it prunes partitions and parquet row groups of the source.
    """
    return tgt.agg(F.max(_mark(F.col(cursor).cast(kind), kind))).first()[0]


def rows_after(
    src: DataFrame, tgt: DataFrame, cursor: str, lookback: dt.timedelta | float | None = None
) -> DataFrame:
    """Source rows beyond the target's last cursor; all rows if the target holds none.

    Strictly beyond, so a replay adds nothing. ``lookback`` reads a stretch again to catch
    late rows; use it with a merge, which absorbs the repeats. The result does not depend on the
    time zone of the session or of the process.
    """
    cursor = check_cursor(src, cursor)
    kind = src.schema[cursor].dataType
    last = high_water_mark(tgt, cursor, kind)
    if last is None:
        return src
    if lookback is not None:
        if isinstance(kind, T.TimestampType):
            lookback = lookback // dt.timedelta(microseconds=1)
        last = last - lookback
    return src.filter(F.col(cursor) > literal_of(last, kind))


def evolve(tgt: DataFrame, new: DataFrame, on_schema_change: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Align target and batch: ``fail``, ``ignore``, ``append_new_columns`` or ``sync_all_columns``.

    Types never get narrower. ``append_new_columns`` widens a retyped column to the least type that holds
    the values of both sides; ``ignore`` keeps the target's types and ``sync_all_columns`` takes the
    batch's, if these hold the values of both. Where values could be lost, the change is refused.
    """
    known = {f.name.lower(): f for f in tgt.schema.fields}
    came = {f.name.lower(): f for f in new.schema.fields}
    added = [came[n] for n in came if n not in known]
    gone = [known[n] for n in known if n not in came]
    changed = [n for n in known if n in came and known[n].dataType != came[n].dataType]
    if on_schema_change == "fail":
        if added or gone or changed:
            raise ValueError(
                f"schema changed: added {[f.name for f in added]}, "
                f"removed {[f.name for f in gone]}, retyped {changed}"
            )
        return tgt, new.select(*tgt.columns)
    if on_schema_change not in ("ignore", "append_new_columns", "sync_all_columns"):
        raise ValueError(f"unknown on_schema_change {on_schema_change}")
    if on_schema_change == "ignore":
        fields = list(known.values())
    elif on_schema_change == "append_new_columns":
        fields = [*known.values(), *added]
    else:
        fields = list(came.values())
    kinds, lost = {}, []
    for n in changed:
        common = least_common_type(known[n].dataType, came[n].dataType)
        fixed = {"ignore": known, "sync_all_columns": came}.get(on_schema_change)
        kinds[n] = fixed[n].dataType if fixed else common.type
        if not common.lossless or kinds[n] != common.type:
            lost.append(
                f"{known[n].name}: {known[n].dataType.simpleString()} and {came[n].dataType.simpleString()} "
                f"as {kinds[n].simpleString()}"
            )
    if lost:
        raise ValueError(f"values could be lost: {', '.join(lost)}")

    def shaped(df: DataFrame, has: dict) -> DataFrame:
        return df.select(
            *[
                (F.col(f"`{f.name}`") if f.name.lower() in has else F.lit(None))
                .cast(kinds.get(f.name.lower(), f.dataType))
                .alias(f.name)
                for f in fields
            ]
        )

    return shaped(tgt, known), shaped(new, came)


def newest_per_key(
    df: DataFrame, keys: list[str], cursor: str | None, tiebreak: list[str] = ()
) -> DataFrame:
    """The newest row per key; rows with a null in their key match nothing, so all of them stay.

    Such rows are dealt out by a number of their own, so they never meet in one task. Without a
    cursor nothing says which of two rows is newer: a repeated key is an error then.
    """
    incomplete = reduce(or_, [F.col(k).isNull() for k in keys])
    alone = df.withColumn("_alone", F.when(incomplete, F.monotonically_increasing_id()))
    if cursor is not None:
        return keep_latest(alone, [*keys, "_alone"], cursor, tiebreak).drop("_alone")
    return one_per_key(alone, [*keys, "_alone"]).drop("_alone")


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def merge_rows(
    tgt: DataFrame, batch: DataFrame, keys: list[str], cursor: str | None = None
) -> DataFrame:
    """Update matching keys, insert new ones; one row per key of the batch wins.

    Only the batch is ranked. Rows with a null key match nothing: they are inserted. Ties of the
    cursor go to the largest other values.
    """
    rest = [c for c in batch.columns if c not in keys and c != cursor]
    fresh = newest_per_key(
        batch, keys, cursor, [c for c in rest if _orderable(batch.schema[c].dataType)]
    )
    kept = tgt.join(key_side(batch, keys), keys, "left_anti")
    return kept.unionByName(fresh)


def delete_insert(tgt: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Drop target rows whose key is in the batch, add the whole batch, repeats included."""
    kept = tgt.join(key_side(batch, keys), keys, "left_anti")
    return kept.unionByName(batch)


def incremental(
    src: DataFrame,
    tgt: DataFrame,
    strategy: str = "append",
    cursor: str | None = None,
    unique_key: list[str] | None = None,
    lookback: dt.timedelta | float | None = None,
    on_schema_change: str = "fail",
) -> DataFrame:
    """New state of an incremental model: new source rows by cursor, combined by strategy."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    if strategy != "append" and not unique_key:
        raise ValueError(f"{strategy} needs a unique_key")
    batch = rows_after(src, tgt, cursor, lookback) if cursor else src
    old, batch = evolve(tgt, batch, on_schema_change)
    if strategy == "append":
        return old.unionByName(batch)
    if strategy == "merge":
        return merge_rows(old, batch, unique_key, cursor)
    return delete_insert(old, batch, unique_key)


def sync_rows(
    src: DataFrame,
    tgt: DataFrame | None,
    mode: str,
    cursor: str | None = None,
    keys: list[str] | None = None,
    tiebreak: list[str] = (),
    target_is_deduped: bool = False,
) -> DataFrame:
    """Target state after one sync run in the given mode (see ``resolve_sync_mode``).

    ``target_is_deduped`` says that deduplicating syncs alone have written the target. Then
    only the new rows are ranked. Rows with a null key match nothing and all stay, as in a merge.
    """
    if mode not in SYNC_MODES:
        raise ValueError(f"the sync mode is one of {SYNC_MODES}")
    dedup = mode == "incremental_deduped_history"
    if dedup and not keys:
        raise ValueError("deduplication needs keys")
    if mode == "full_refresh_overwrite" or tgt is None:
        return newest_per_key(src, keys, check_cursor(src, cursor), tiebreak) if dedup else src
    if mode == "full_refresh_append":
        return tgt.unionByName(src)
    new = rows_after(src, tgt, cursor)
    if not dedup:
        return tgt.unionByName(new)
    if not target_is_deduped:
        return newest_per_key(tgt.unionByName(new), keys, cursor, tiebreak)
    newest = newest_per_key(new, keys, cursor, tiebreak)
    return tgt.join(key_side(new, keys), keys, "left_anti").unionByName(newest)


def upsert_log(log: DataFrame, new: DataFrame, keys: list[str], written: str) -> DataFrame:
    """INSERT OR REPLACE: for equal keys the record written last stays."""
    both = log.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)))
    return keep_latest(both, keys, "_turn", [written]).drop("_turn")


def is_expired(timestamp: Column, ttl_seconds: Column, as_of: dt.datetime) -> Column:
    """Older than its time to live; no or zero time to live never expires."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = now - timestamp.cast("timestamp_ntz")
    allowed = F.make_dt_interval(secs=ttl_seconds.cast("decimal(18,6)"))
    return F.coalesce((ttl_seconds > 0) & (age > allowed), F.lit(False))


def drop_expired(
    df: DataFrame, as_of: dt.datetime, timestamp: str = "timestamp", ttl: str = "ttl_seconds"
) -> DataFrame:
    return df.filter(~is_expired(F.col(timestamp), F.col(ttl), as_of))


def idempotent_append(
    batch: DataFrame, tgt: DataFrame, name: str, key: str, id_column: str = "request_id"
) -> DataFrame:
    """Rows of the batch whose deterministic id the target does not hold yet, one per id."""
    ident = batch.withColumn(id_column, request_id(F.col(name), F.col(key).cast("string")))
    rest = [c for c in batch.columns if c not in (name, key)]
    once = keep_latest(ident, [id_column], key, rest)
    return once.join(tgt.select(id_column), id_column, "left_anti")
