"""Sync modes, incremental models, history, run-log upkeep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluiceway.functions.text import request_id
from sluiceway.operators import merge as m
from sluiceway.operators.history import apply_changes, snapshot
from sluiceway.operators.latest import keep_latest, newest_n
from sluiceway.plans.elt import elt_job, sync
from sluiceway.operators import quality as q
from sluiceway.runtime import new_dir, settle
from sluiceway.sources import bucketed
from sluiceway.workload.registry import Tables, query, ts

CUT = "2024-01-15 00:00:00"
_OLD = f"(SELECT * FROM events WHERE ts <= TIMESTAMP '{CUT}')"


def loaded_events(t: Tables):
    return t.events.filter(F.col("ts") <= ts(CUT))


@query("SELECT * FROM events")
def sync_full_overwrite(t: Tables):
    return m.sync_rows(t.events, loaded_events(t), m.resolve_sync_mode("full_refresh", "overwrite"))


@query(f"SELECT * FROM events UNION ALL SELECT * FROM {_OLD}")
def sync_full_append(t: Tables):
    return m.sync_rows(t.events, loaded_events(t), m.resolve_sync_mode("full_refresh", "append"))


@query("SELECT * FROM events")
def sync_incremental_append(t: Tables):
    mode = m.resolve_sync_mode("incremental", "append")
    return m.sync_rows(t.events, loaded_events(t), mode, cursor="ts")


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def sync_incremental_deduped(t: Tables):
    mode = m.resolve_sync_mode("incremental", "append_dedup")
    return m.sync_rows(
        t.events, loaded_events(t), mode, cursor="ts", keys=["user_id"], tiebreak=["event_id"]
    )


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def sync_into_deduped_target(t: Tables):
    old = keep_latest(loaded_events(t), ["user_id"], "ts", ["event_id"])
    mode = m.resolve_sync_mode("incremental", "overwrite_dedup")
    return m.sync_rows(
        t.events, old, mode, "ts", ["user_id"], ["event_id"], target_is_deduped=True
    )


@query(f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM {_OLD})")
def new_events_by_cursor(t: Tables):
    return m.rows_after(t.events, loaded_events(t), "TS")


@query(f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM {_OLD})")
def new_events_by_instant(t: Tables):
    """The same cursor as an instant, whose clock time depends on the session's zone."""
    now, old = (df.withColumn("ts", F.col("ts").cast("timestamp")) for df in (t.events, loaded_events(t)))
    return m.rows_after(now, old, "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM {_OLD}) - INTERVAL 6 HOUR"
)
def new_events_with_lookback(t: Tables):
    return m.rows_after(t.events, loaded_events(t), "ts", dt.timedelta(hours=6))


@query("SELECT * FROM events")
def first_load_into_empty_target(t: Tables):
    return m.incremental(t.events, t.events.filter("event_type = 'none'"), "append", cursor="ts")


# Target: customers with zero balance; batch: customers above 3000, some repeated and newer.
_TARGET = "(SELECT c_custkey, 0.0::DOUBLE AS c_acctbal, 1 AS version FROM customer WHERE c_mktsegment <> 'BUILDING')"
_BATCH = """(SELECT c_custkey, c_acctbal, 2 AS version FROM customer WHERE c_acctbal > 3000
    UNION ALL SELECT c_custkey, c_acctbal + 1, 3 FROM customer WHERE c_acctbal > 6000)"""


def target_and_batch(t: Tables):
    target = t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", F.lit(0.0).alias("c_acctbal"), F.lit(1).alias("version")
    )
    batch = t.customer.filter("c_acctbal > 3000").select(
        "c_custkey", "c_acctbal", F.lit(2).alias("version")
    )
    newer = t.customer.filter("c_acctbal > 6000").select(
        "c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit(3).alias("version")
    )
    return target, batch.unionByName(newer)


@query(
    f"""SELECT * FROM {_TARGET} WHERE c_custkey NOT IN (SELECT c_custkey FROM {_BATCH})
        UNION ALL SELECT * FROM {_BATCH} QUALIFY row_number() OVER
        (PARTITION BY c_custkey ORDER BY version DESC) = 1"""
)
def merge_customers(t: Tables):
    target, batch = target_and_batch(t)
    return m.incremental(batch, target, "merge", cursor="version", unique_key=["c_custkey"])


@query(
    f"""SELECT * FROM {_TARGET} WHERE c_custkey NOT IN (SELECT c_custkey FROM {_BATCH})
        UNION ALL SELECT * FROM {_BATCH}"""
)
def delete_insert_customers(t: Tables):
    target, batch = target_and_batch(t)
    return m.incremental(batch, target, "delete+insert", unique_key=["c_custkey"])


@query(
    """SELECT c_custkey, c_name, c_acctbal, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_acctbal <= 3000
       UNION ALL SELECT c_custkey, NULL, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 3000"""
)
def append_with_new_columns(t: Tables):
    old = t.customer.filter("c_acctbal <= 3000").select("c_custkey", "c_name", "c_acctbal")
    new = t.customer.filter("c_acctbal > 3000").select("c_custkey", "c_acctbal", "c_mktsegment")
    return m.incremental(new, old, "append", on_schema_change="append_new_columns")


@query(
    """SELECT c_custkey, c_acctbal, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_acctbal <= 3000
       UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 3000"""
)
def append_with_synced_columns(t: Tables):
    old = t.customer.filter("c_acctbal <= 3000").select("c_custkey", "c_name", "c_acctbal")
    new = t.customer.filter("c_acctbal > 3000").select("c_custkey", "c_acctbal", "c_mktsegment")
    return m.incremental(new, old, "append", on_schema_change="sync_all_columns")


@query(
    """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal <= 3000
       UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer WHERE c_acctbal > 3000"""
)
def append_ignoring_new_columns(t: Tables):
    old = t.customer.filter("c_acctbal <= 3000").select("c_custkey", "c_name", "c_acctbal")
    new = t.customer.filter("c_acctbal > 3000").select("c_custkey", "c_acctbal", "c_mktsegment")
    return m.incremental(new, old, "append", on_schema_change="ignore")


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_event_per_user_and_type(t: Tables):
    return keep_latest(t.events, ["user_id", "event_type"], "ts", ["event_id"])


@query(
    """SELECT * FROM orders QUALIFY row_number() OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 3"""
)
def newest_three_orders_per_customer(t: Tables):
    return newest_n(t.orders, ["o_custkey"], "o_orderdate", 3, ["o_orderkey"])


# Three states of the orders: as first seen; later with status F paid off; later still with
# urgent orders raised and those of priority 5-LOW gone.
_STATE_1 = """(SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price,
    TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM orders WHERE o_orderstatus <> 'P')"""
_STATE_2 = """(SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE o_orderstatus END AS status,
    o_totalprice AS price, CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '2024-01-01 00:00:00'
    ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at FROM orders)"""
_STATE_3 = """(SELECT o_orderkey, status,
    CASE WHEN o_orderpriority = '1-URGENT' THEN price + 1 ELSE price END AS price,
    CASE WHEN o_orderpriority = '1-URGENT' THEN TIMESTAMP '2024-03-01 00:00:00' ELSE updated_at END AS updated_at
    FROM (SELECT s.*, o_orderpriority FROM %s s JOIN orders USING (o_orderkey))
    WHERE o_orderpriority <> '5-LOW')""" % _STATE_2


def order_states(t: Tables):
    first, second = ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00")
    base = t.orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        first.alias("updated_at"),
        "o_orderpriority",
    )
    one = base.filter("status <> 'P'")
    two = base.withColumn(
        "updated_at", F.when(F.col("status") == "O", first).otherwise(second)
    ).withColumn("status", F.when(F.col("status") == "F", "D").otherwise(F.col("status")))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    three = two.filter("o_orderpriority <> '5-LOW'").withColumns(
        {
            "price": F.when(urgent, F.col("price") + 1).otherwise(F.col("price")),
            "updated_at": F.when(urgent, ts("2024-03-01 00:00:00")).otherwise(F.col("updated_at")),
        }
    )
    return [s.drop("o_orderpriority") for s in (one, two, three)]


_VERSIONS = f"""SELECT DISTINCT * FROM (SELECT * FROM {_STATE_1} UNION ALL SELECT * FROM {_STATE_2}
                UNION ALL SELECT * FROM {_STATE_3})"""


@query(
    f"""SELECT *, updated_at AS valid_from,
        lead(updated_at) OVER (PARTITION BY o_orderkey ORDER BY updated_at) AS valid_to FROM ({_VERSIONS})"""
)
def order_history_by_timestamp(t: Tables):
    """Three snapshots in turn, the last one twice: the replay adds nothing."""
    one, two, three = order_states(t)
    history = None
    for state in (one, two, three, three):
        # As in production, each run reads the history that the last one wrote.
        history = settle(
            snapshot(state, history, ["o_orderkey"], "timestamp", updated_at="updated_at"), "history"
        )
    return history


@query(
    f"""SELECT o_orderkey, status, price, valid_from,
        lead(valid_from) OVER (PARTITION BY o_orderkey ORDER BY valid_from) AS valid_to FROM
        (SELECT o_orderkey, status, price, min(seen) AS valid_from FROM
          (SELECT o_orderkey, status, price, TIMESTAMP '2024-01-05 00:00:00' AS seen FROM {_STATE_1}
           UNION ALL SELECT o_orderkey, status, price, TIMESTAMP '2024-02-05 00:00:00' FROM {_STATE_2}
           UNION ALL SELECT o_orderkey, status, price, TIMESTAMP '2024-03-05 00:00:00' FROM {_STATE_3})
         GROUP BY 1, 2, 3)"""
)
def order_history_by_check(t: Tables):
    history = None
    for month, state in enumerate(order_states(t), 1):
        made = snapshot(
            state.drop("updated_at"),
            history,
            ["o_orderkey"],
            "check",
            check_cols=["status", "price"],
            as_of=dt.datetime(2024, month, 5),
        )
        history = settle(made, "history")
    return history


# Events as a run log and as cache entries.
@query(
    """SELECT * FROM (SELECT user_id AS execution_id, event_type AS status, ts AS written, 'new' AS turn
         FROM events WHERE value > 100
       UNION ALL SELECT user_id, event_type, ts, 'old' FROM events WHERE value <= 100)
       QUALIFY row_number() OVER (PARTITION BY execution_id ORDER BY turn, written DESC) = 1"""
)
def upsert_run_log(t: Tables):
    runs = t.events.select(
        F.col("user_id").alias("execution_id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("written"),
        F.when(F.col("value") > 100, "new").otherwise("old").alias("turn"),
    )
    return m.upsert_log(
        runs.filter("turn = 'old'"), runs.filter("turn = 'new'"), ["execution_id"], "written"
    )


_ENTRIES = """(SELECT event_id, ts AS timestamp, CASE WHEN event_type = 'view' THEN NULL
    WHEN event_type = 'click' THEN 0 ELSE CAST(floor(value * 10000) AS INTEGER) END AS ttl_seconds FROM events)"""


@query(
    f"""SELECT * FROM {_ENTRIES} WHERE ttl_seconds IS NULL OR ttl_seconds = 0
        OR timestamp + to_seconds(ttl_seconds) >= TIMESTAMP '2024-02-01 00:00:00'"""
)
def entries_not_expired(t: Tables):
    entries = t.events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "view", None)
        .when(F.col("event_type") == "click", 0)
        .otherwise(F.floor(F.col("value") * 10000).cast("int"))
        .alias("ttl_seconds"),
    )
    return m.drop_expired(entries, dt.datetime(2024, 2, 1))


@query(
    """SELECT substr(sha256(event_type || ':' || user_id), 1, 16) AS request_id, event_type, user_id
       FROM (SELECT DISTINCT event_type, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00')
       WHERE (event_type, user_id) NOT IN
         (SELECT (event_type, user_id) FROM events WHERE ts <= TIMESTAMP '2024-01-03 00:00:00')"""
)
def idempotent_requests(t: Tables):
    known = t.events.filter(F.col("ts") <= ts("2024-01-03 00:00:00")).select(
        request_id(F.col("event_type"), F.col("user_id").cast("string")).alias("request_id")
    )
    batch = t.events.filter(F.col("ts") > ts(CUT)).select("event_type", "user_id")
    return m.idempotent_append(batch, known, "event_type", "user_id")


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def sync_table_twice(t: Tables):
    """First run creates the table, the second brings the rest and swaps the new state in."""
    path = new_dir(t.spark, "synced")
    how = {"cursor": "ts", "keys": ["user_id"], "tiebreak": ["event_id"]}
    sync(loaded_events(t), path, "incremental_deduped_history", **how)
    return sync(t.events, path, "incremental_deduped_history", **how)


@query(
    """SELECT c_mktsegment, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def segment_revenue_job(t: Tables):
    """Sync, stage, model, test and publish in one go."""
    home = new_dir(t.spark, "job")

    def model(staged):
        return (
            staged["orders"]
            .join(staged["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_mktsegment")
            .agg(
                F.count("o_orderkey").alias("order_count"),
                F.round(F.sum("o_totalprice"), 2).alias("revenue"),
            )
        )

    return elt_job(
        {"orders": t.orders, "customer": t.customer},
        f"{home}/landing",
        {"customer": lambda d: d.select("c_custkey", "c_mktsegment")},
        model,
        lambda d: q.validate_table(
            d, [q.not_null("c_mktsegment"), q.in_range("order_count", 1)], unique=["c_mktsegment"]
        ),
        f"{home}/segment_revenue",
    )


_FEW = "(SELECT * FROM %s WHERE c_custkey %% 100 = 3)" % _BATCH


def bucketed_target(t: Tables):
    """(path of the target in 64 buckets, a batch of a hundredth of the keys)."""
    target, batch = target_and_batch(t)
    path = new_dir(t.spark, "bucketed")
    bucketed.write_bucketed(target, path, ["c_custkey"], 64)
    return path, batch.filter("c_custkey % 100 = 3")


@query(
    f"""SELECT * FROM {_TARGET} WHERE c_custkey NOT IN (SELECT c_custkey FROM {_FEW})
        UNION ALL SELECT * FROM {_FEW} QUALIFY row_number() OVER
        (PARTITION BY c_custkey ORDER BY version DESC) = 1"""
)
def merge_into_touched_buckets(t: Tables):
    """Only buckets with a key of the batch are read and rewritten; a replay changes nothing."""
    path, batch = bucketed_target(t)
    for _ in range(2):
        bucketed.merge_into(batch, path, ["c_custkey"], "merge", "version")
    return bucketed.read_bucketed(t.spark, path)


@query(
    f"""SELECT * FROM {_TARGET} WHERE c_custkey NOT IN (SELECT c_custkey FROM {_FEW})
        UNION ALL SELECT * FROM {_FEW}"""
)
def delete_insert_touched_buckets(t: Tables):
    path, batch = bucketed_target(t)
    bucketed.merge_into(batch, path, ["c_custkey"], "delete+insert")
    return bucketed.read_bucketed(t.spark, path)


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def sync_into_buckets(t: Tables):
    """Two deduplicating syncs; the second reads and writes only buckets of users with new events."""
    path = new_dir(t.spark, "bucketed")
    for src in (loaded_events(t), t.events):
        bucketed.sync_bucketed(src, path, ["user_id"], "ts", ["event_id"], buckets=32)
    return bucketed.read_bucketed(t.spark, path)


@query(
    f"""SELECT *, updated_at AS valid_from,
        lead(updated_at) OVER (PARTITION BY o_orderkey ORDER BY updated_at) AS valid_to FROM ({_VERSIONS})"""
)
def order_history_from_late_changes(t: Tables):
    """The states in the wrong order, one of them twice: older changes split the intervals they fall into."""
    one, two, three = order_states(t)
    history = None
    for state in (three, one, two, one):
        history = settle(apply_changes(state, history, ["o_orderkey"], "updated_at"), "history")
    return history


@query(
    """SELECT c_custkey::BIGINT AS c_custkey, c_nationkey::BIGINT AS c_nationkey, c_acctbal FROM customer WHERE c_acctbal <= 3000
       UNION ALL SELECT c_custkey + 5000000000, c_nationkey + 5000000000, c_acctbal FROM customer WHERE c_acctbal > 3000"""
)
def append_with_wider_types(t: Tables):
    """A batch of great keys widens the target's columns; nothing is cut off."""
    shape = ("c_custkey", "c_nationkey", "c_acctbal")
    old = t.customer.filter("c_acctbal <= 3000").select(
        F.col("c_custkey").cast("int"), F.col("c_nationkey").cast("smallint"), "c_acctbal"
    )
    great = F.lit(5000000000)
    new = t.customer.filter("c_acctbal > 3000").select(
        (F.col("c_custkey") + great).alias("c_custkey"), (F.col("c_nationkey") + great).alias("c_nationkey"),
        "c_acctbal",
    )
    return m.incremental(new, old, "append", on_schema_change="append_new_columns").select(*shape)
