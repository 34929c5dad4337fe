"""Streams over files of events; each result equals that of the batch operator."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from sluiceway.operators.merge import drop_expired
from sluiceway.runtime import new_dir
from sluiceway.streaming import ingest as g
from sluiceway.workload.registry import Tables, query


def event_files(t: Tables):
    """The events as files in order of time, delivered one per batch."""
    path = new_dir(t.spark, "arrivals")
    t.events.repartitionByRange(4, "ts").write.parquet(path)
    return g.file_stream(t.spark, path, t.events.schema, max_files=1)


def _finish(stream_query):
    stream_query.awaitTermination()
    if stream_query.exception():
        raise stream_query.exception()


@query("SELECT * FROM events")
def streamed_append(t: Tables):
    path = new_dir(t.spark, "appended")
    _finish(g.stream_append(event_files(t), path, new_dir(t.spark, "checkpoint")))
    return t.spark.read.schema(t.events.schema).parquet(path)


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def streamed_upsert(t: Tables):
    path, args = new_dir(t.spark, "upserted"), (["user_id"], "ts", ["event_id"])
    _finish(g.stream_upsert(event_files(t), path, new_dir(t.spark, "checkpoint"), *args))
    return g.latest_rows(t.spark, path, *args)


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def streamed_upsert_compacted(t: Tables):
    path, args = new_dir(t.spark, "upserted"), (["user_id"], "ts", ["event_id"])
    _finish(g.stream_upsert(event_files(t), path, new_dir(t.spark, "checkpoint"), *args))
    g.compact(t.spark, path, *args)
    return g.latest_rows(t.spark, path, *args)


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def streamed_upsert_compacted_between(t: Tables):
    """Folded between two runs of the stream, and once more after them."""
    source, path = new_dir(t.spark, "arrivals"), new_dir(t.spark, "upserted")
    args, checkpoint = (["user_id"], "ts", ["event_id"]), new_dir(t.spark, "checkpoint")
    for half in (0, 1):
        t.events.filter(F.col("event_id") % 2 == half).repartition(2).write.mode("append").parquet(source)
        stream = g.file_stream(t.spark, source, t.events.schema, max_files=1)
        _finish(g.stream_upsert(stream, path, checkpoint, *args))
        g.compact(t.spark, path, *args)
    return g.latest_rows(t.spark, path, *args)


@query(
    """SELECT * FROM events WHERE ts > (SELECT date_trunc('milliseconds', max(ts)) FROM events)
       - INTERVAL 12 DAY"""
)
def streamed_late_rows_dropped(t: Tables):
    """The newest ten days arrive twice; of what comes then, rows older than twelve days are too late.

    A batch drops late rows by the watermark that the batch before it had, hence the second arrival.
    """
    path, newest = new_dir(t.spark, "late"), t.events.agg(F.max("ts")).scalar()
    recent = F.col("ts") > newest - F.expr("INTERVAL 10 DAYS")
    for part in (recent, recent, ~recent):
        t.events.filter(part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # files are taken in the order of their times
    stream = g.file_stream(t.spark, path, t.events.schema, max_files=1)
    once = g.stream_dedup(stream, ["event_id"], "ts", "12 days")
    out = new_dir(t.spark, "in-time")
    _finish(g.stream_append(once, out, new_dir(t.spark, "checkpoint")))
    return t.spark.read.schema(t.events.schema).parquet(out)


@query("SELECT * FROM events")
def streamed_dedup(t: Tables):
    """Every event arrives twice; one of each stays."""
    twice = new_dir(t.spark, "twice")
    t.events.repartitionByRange(2, "ts").write.parquet(twice)
    t.events.repartitionByRange(2, "ts").write.mode("append").parquet(twice)
    stream = g.file_stream(t.spark, twice, t.events.schema, max_files=1)
    once = g.stream_dedup(stream, ["event_id"], "ts", "60 days")
    path = new_dir(t.spark, "deduped")
    _finish(g.stream_append(once, path, new_dir(t.spark, "checkpoint")))
    return t.spark.read.schema(t.events.schema).parquet(path)


@query(
    """SELECT CASE WHEN value >= 5 AND event_type <> 'error' THEN 'good' ELSE 'rejected' END AS outcome,
       CASE WHEN value >= 5 AND event_type <> 'error' THEN '' WHEN value >= 5 THEN 'no_error'
            WHEN event_type <> 'error' THEN 'worth' ELSE 'worth,no_error' END AS broken_rules,
       count(*) AS row_count FROM events GROUP BY 1, 2"""
)
def streamed_quality(t: Tables):
    path = new_dir(t.spark, "judged")
    rules = {"worth": F.col("value") >= 5, "no_error": F.col("event_type") != "error"}
    _finish(g.stream_quality(event_files(t), rules, path, new_dir(t.spark, "checkpoint")))
    judged = t.spark.read.parquet(path)
    return judged.groupBy("outcome", F.array_join("broken_rules", ",").alias("broken_rules")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


_TTL = "(user_id % 5) * 86400 * 4"


@query(
    f"""SELECT *, CAST({_TTL} AS BIGINT) AS ttl_seconds FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
          AND (user_id % 5 = 0 OR TIMESTAMP '2024-02-05 00:00:00' - ts <= to_seconds(({_TTL})::BIGINT))"""
)
def streamed_upsert_with_time_to_live(t: Tables):
    """Two runs and one without anything new: equal to dropping expired rows from the newest per key."""
    path, state = new_dir(t.spark, "expiring"), new_dir(t.spark, "checkpoint")
    arrivals = new_dir(t.spark, "arrivals")
    rows = t.events.withColumn("ttl_seconds", F.expr(_TTL).cast("long"))
    half = rows.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    for part in (half, rows.where("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'"), None):
        if part is not None:
            part.repartitionByRange(2, "ts").write.mode("append").parquet(arrivals)
        stream = g.file_stream(t.spark, arrivals, rows.schema)
        _finish(g.stream_upsert_expiring(stream, path, state, ["user_id"], "ts", "ttl_seconds", "1 day", ["event_id"]))
    living = g.living_rows(t.spark, path, ["user_id"], "ts", ["event_id"])
    return drop_expired(living, dt.datetime(2024, 2, 5), "ts", "ttl_seconds")
