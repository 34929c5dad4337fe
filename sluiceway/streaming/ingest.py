"""Incremental synchronisation as Structured Streaming over a file source."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sluiceway.operators.latest import keep_latest
from sluiceway.sources import storage

_BATCH = "_batch_id"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived since the last run; each row exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def stream_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    cursor: str,
    tiebreak: list[str] = (),
) -> StreamingQuery:
    """Deduplicated history: each batch adds its newest row per key under its batch number.

    A repeated batch overwrites its own folder, so nothing is applied twice, and the cost of
    a batch does not depend on the size of the table. ``latest_rows`` reads the current
    state; ``compact`` folds the history when it has grown. A null key is a key like any other
    here, so that a repeated batch changes nothing.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        newest = keep_latest(batch, keys, cursor, tiebreak)
        newest.write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_rows(
    spark: SparkSession, path: str, keys: list[str], cursor: str, tiebreak: list[str] = ()
) -> DataFrame:
    """Current state of an upsert table."""
    return keep_latest(spark.read.parquet(path), keys, cursor, tiebreak).drop(_BATCH)


def compact(
    spark: SparkSession, path: str, keys: list[str], cursor: str, tiebreak: list[str] = ()
) -> None:
    """Fold the batches that are there now into one, filed under a negative number of its own.

    Just these are folded and then removed, so a batch that arrives meanwhile stays. Until they are
    gone both are read, which changes no result, since the newest row per key wins; nor does a
    batch that is repeated after the fold. One fold at a time.
    """
    path, mark = path.rstrip("/"), f"{_BATCH}="
    found = [f for f in storage.folders(spark, path) if f.startswith(mark)]
    if len(found) < 2:
        return
    folded = min(0, *(int(f.removeprefix(mark)) for f in found)) - 1
    state = spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in found])
    staged = f"{path}__compact_{uuid.uuid4().hex}"
    keep_latest(state, keys, cursor, tiebreak).drop(_BATCH).write.parquet(staged)
    storage.move(spark, staged, f"{path}/{mark}{folded}")
    for f in found:
        storage.remove(spark, f"{path}/{f}")


def stream_dedup(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of the first; state stays bounded.

    Rows older than the newest seen by more than ``delay`` when their batch begins are too late:
    they are dropped. A null key is a key like any other.
    """
    event_time = F.col(ts)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        event_time = F.to_utc_timestamp(ts, "UTC")
    return (
        stream.withColumn("_event_time", event_time)
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_event_time")
    )


def stream_quality(
    stream: DataFrame, rules: dict[str, Column], path: str, checkpoint: str
) -> StreamingQuery:
    """Split each batch by rules (true for a good row) into ``good`` and ``rejected``.

    Rejected rows carry the names of the rules they broke. Both sides are written in one
    pass over the batch, and a repeated batch overwrites its own folders.
    """
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(n)) for n, rule in rules.items()])
    )

    def split(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn("broken_rules", broken)
        side = F.when(F.size("broken_rules") == 0, "good").otherwise("rejected")
        judged.withColumn("outcome", side).write.mode("overwrite").partitionBy("outcome").parquet(
            f"{path}/{_BATCH}={batch_id}"
        )

    return (
        stream.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_GONE, _TIME, _EXPIRES = "_gone", "_event_time", "_expires"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestUntilExpired(StatefulProcessor):
    """Passes on rows newer than what their key has had, and forgets a key when its newest row expires.

    The state of a key is the place of its newest row in the order. An expired key leaves a row
    marked as gone, which holds the key and the place alone, and no state.
    """

    def __init__(self, keys: list[str], order: list[str], columns: list[str], place: T.StructType):
        self.keys, self.order, self.columns, self.place = keys, order, columns, place

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.place)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = max(rows, key=lambda row: _nulls_first(row[c] for c in self.order), default=None)
        if best is None:
            return
        place = [best[c] for c in self.order]
        if self.newest.exists() and _nulls_first(self.newest.get()) >= _nulls_first(place):
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if best[_EXPIRES] is not None:
            self.handle.registerTimer(best[_EXPIRES])
        self.newest.update(tuple(place))
        yield Row(**{c: best[c] for c in self.columns}, **{_GONE: False})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists():
            known = dict(zip([*self.order, *self.keys], [*self.newest.get(), *key]))
            self.newest.clear()
            yield Row(**{c: known.get(c) for c in self.columns}, **{_GONE: True})


def _nulls_first(values) -> list[tuple]:
    return [(v is not None, v) for v in values]


def stream_upsert_expiring(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    cursor: str,
    ttl: str,
    delay: str,
    tiebreak: list[str] = (),
) -> StreamingQuery:
    """Upserts whose rows expire ``ttl`` seconds (a column; null or 0: never) after their ``cursor``, a time.

    Keyed state in RocksDB holds one place per living key: a batch adds only rows newer than what their
    key has had, and when event time (the newest cursor less ``delay``) passes a row's end, its key is marked as
    gone and forgotten. So state and additions are bounded by living keys and by changes, whatever the history.
    Rows more than ``delay`` late when their batch begins are dropped. A repeated batch overwrites its own
    folder. ``living_rows`` reads the table.
    """
    spark = stream.sparkSession
    columns, order = stream.columns, [cursor, *tiebreak]
    event_time = F.col(cursor)
    if isinstance(stream.schema[cursor].dataType, T.TimestampNTZType):
        event_time = F.to_utc_timestamp(cursor, "UTC")
    ends = F.when(F.col(ttl) > 0, F.unix_millis(_TIME) + F.ceil(F.col(ttl) * 1000).cast("long"))
    timed = stream.withColumn(_TIME, event_time).withWatermark(_TIME, delay).withColumn(_EXPIRES, ends)
    place = T.StructType([T.StructField(c, stream.schema[c].dataType) for c in order])
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in stream.schema], T.StructField(_GONE, T.BooleanType())])
    changes = timed.groupBy(*keys).transformWithState(
        NewestUntilExpired(keys, order, columns, place), out, "Update", "EventTime"
    )

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")

    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return (
            changes.writeStream.foreachBatch(add)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def living_rows(
    spark: SparkSession, path: str, keys: list[str], cursor: str, tiebreak: list[str] = ()
) -> DataFrame:
    """Current state of an expiring upsert table: the newest row per key, unless it is gone."""
    newest = keep_latest(spark.read.parquet(path), keys, cursor, [*tiebreak, _GONE])
    return newest.where(f"NOT {_GONE}").drop(_BATCH, _GONE)
