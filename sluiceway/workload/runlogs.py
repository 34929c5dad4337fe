"""Events read as a run log; lineage over order lines and over the table graph."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluiceway.operators import lineage as li
from sluiceway.operators import runs as r
from sluiceway.workload.registry import Tables, query

_RUNS = """(SELECT event_id AS execution_id, 'load_' || (user_id % 7) AS pipeline_name,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status,
    CASE WHEN event_type = 'signup' AND value > 100 THEN NULL ELSE ts END AS start_time, value AS seconds FROM events)"""


def run_log(t: Tables):
    return t.events.select(
        F.col("event_id").alias("execution_id"),
        F.concat(F.lit("load_"), F.col("user_id") % 7).alias("pipeline_name"),
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "view", "running")
        .otherwise("success")
        .alias("status"),
        F.when(
            ~((F.col("event_type") == "signup") & (F.col("value") > 100)), F.col("ts")
        ).alias("start_time"),
        F.col("value").alias("seconds"),
    )


@query(
    f"""SELECT * FROM {_RUNS} WHERE pipeline_name = 'load_3' AND status = 'failed'
        AND start_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'
        ORDER BY start_time DESC, execution_id LIMIT 100"""
)
def filtered_runs(t: Tables):
    return r.filter_runs(
        run_log(t), "load_3", "failed", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 25), limit=100
    )


@query(f"SELECT pipeline_name, status, count(*) AS row_count FROM {_RUNS} GROUP BY 1, 2")
def run_states(t: Tables):
    return r.state_counts(run_log(t), ["pipeline_name"], "status")


@query(
    f"""SELECT pipeline_name, count(*) FILTER (status = 'success') AS success,
        count(*) FILTER (status = 'failed') AS failed, count(*) AS total FROM {_RUNS} GROUP BY 1"""
)
def run_state_table(t: Tables):
    return r.state_table(run_log(t), ["pipeline_name"], "status", ["success", "failed"])


@query(
    f"""SELECT pipeline_name, count(*) AS total_runs, count(*) FILTER (status = 'success') AS success,
        count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'running') AS running,
        round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 1) AS success_rate,
        round(avg(seconds), 4) AS average_duration
        FROM {_RUNS} WHERE start_time IS NULL OR start_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 14 DAY
        GROUP BY 1"""
)
def success_rates(t: Tables):
    out = r.success_rate(
        run_log(t), ["pipeline_name"], dt.datetime(2024, 1, 31), days=14, duration="seconds"
    )
    return out.withColumn("average_duration", F.round("average_duration", 4))


@query(
    """SELECT user_id, total_syncs, count(*) AS recent_syncs, count(*) FILTER (state = 'succeeded') AS succeeded,
       count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'running') AS running,
       count(*) FILTER (state = 'cancelled') AS cancelled,
       round(count(*) FILTER (state = 'succeeded') * 100.0::DOUBLE / count(*), 2) AS success_rate FROM
       (SELECT *, count(*) OVER (PARTITION BY user_id) AS total_syncs,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place,
               CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' WHEN 'signup' THEN 'cancelled'
                    ELSE 'succeeded' END AS state FROM events)
       WHERE place <= 10 GROUP BY 1, 2"""
)
def recent_syncs(t: Tables):
    jobs = t.events.withColumn(
        "state",
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "view", "Running")
        .when(F.col("event_type") == "signup", "cancelled")
        .otherwise("succeeded"),
    )
    return r.recent_sync_stats(jobs, ["user_id"], "ts", "state", 10, ["event_id"])


@query(
    """WITH newest AS (SELECT * FROM events QUALIFY row_number() OVER
         (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50),
       placed AS (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY value) AS up,
         row_number() OVER (w ORDER BY ts, event_id) AS turn FROM newest WINDOW w AS (PARTITION BY user_id)),
       stats AS (SELECT user_id, any_value(n) AS n, avg(value) AS mean, median(value) AS mid, min(value) AS lo,
         max(value) AS hi, min(CASE WHEN up = least(floor(n * 0.95::DOUBLE) + 1, n) THEN value END) AS p95,
         max(ts) AS last_run, arg_max(event_type, turn) AS last_status,
         avg(CASE WHEN turn <= n // 2 THEN value END) AS early, avg(CASE WHEN turn > n // 2 THEN value END) AS late
         FROM placed GROUP BY 1)
       SELECT user_id AS model_name, round(mean, 5) AS average_seconds, round(mid, 5) AS median_seconds,
         round(lo, 5) AS min_seconds, round(hi, 5) AS max_seconds, round(p95, 5) AS p95_seconds, n AS run_count,
         last_run, last_status, CASE WHEN n < 4 OR early <= 0 THEN 'stable'
           WHEN (late - early) / early > 0.15 THEN 'degrading' WHEN (late - early) / early < -0.15 THEN 'improving'
           ELSE 'stable' END AS trend FROM stats"""
)
def runtimes_per_user(t: Tables):
    return r.runtime_stats(t.events, "user_id", "ts", "value", "event_type", 50, ["event_id"], digits=5)


@query(
    f"""SELECT count(*) AS total_executions, count(*) FILTER (status = 'success') AS successful_executions,
        count(*) FILTER (status = 'failed') AS failed_executions FROM {_RUNS}"""
)
def run_log_totals(t: Tables):
    return r.run_log_summary(run_log(t))


@query(
    """WITH hits AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_suppkey = 7 GROUP BY 1)
       SELECT l_suppkey AS object, count(*) AS log_rows, sum(n)::BIGINT AS pair_rows
       FROM lineitem JOIN hits USING (l_orderkey) WHERE l_suppkey <> 7
       GROUP BY 1 ORDER BY log_rows DESC, object LIMIT 50"""
)
def suppliers_used_together(t: Tables):
    """Order lines as an access log: which suppliers share orders with supplier 7."""
    return li.co_access(t.lineitem, "l_orderkey", "l_suppkey", 7, limit=50)


@query(
    """SELECT l2.l_partkey AS object, count(*) AS pair_rows FROM lineitem l1 JOIN lineitem l2
       ON l1.l_orderkey = l2.l_orderkey WHERE l1.l_partkey = 42 AND l2.l_partkey <> 42 GROUP BY 1"""
)
def parts_used_together(t: Tables):
    return li.co_access(t.lineitem, "l_orderkey", "l_partkey", 42).drop("log_rows")


_EDGES = """(SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation
    UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
    UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders
    UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem)"""


def table_graph(t: Tables):
    def edges(df, p, parent, c, child):
        return df.select(
            F.concat(F.lit(p), F.col(parent)).alias("parent"),
            F.concat(F.lit(c), F.col(child)).alias("child"),
        )

    return (
        edges(t.nation, "r", "n_regionkey", "n", "n_nationkey")
        .union(edges(t.customer, "n", "c_nationkey", "c", "c_custkey"))
        .union(edges(t.orders, "c", "o_custkey", "o", "o_orderkey"))
        .union(edges(t.lineitem, "o", "l_orderkey", "p", "l_partkey"))
    )


@query(
    f"""WITH RECURSIVE walk(node, depth) AS (SELECT 'r2', 0 UNION
          SELECT e.child, w.depth + 1 FROM walk w JOIN {_EDGES} e ON e.parent = w.node)
        SELECT node, min(depth) AS depth FROM walk WHERE depth > 0 GROUP BY 1"""
)
def lineage_downstream(t: Tables):
    return li.lineage_closure(table_graph(t), "r2", "downstream")


@query(
    f"""WITH RECURSIVE walk(node, depth) AS (SELECT 'p42', 0 UNION
          SELECT e.parent, w.depth + 1 FROM walk w JOIN {_EDGES} e ON e.child = w.node)
        SELECT node, min(depth) AS depth FROM walk WHERE depth > 0 GROUP BY 1"""
)
def lineage_upstream(t: Tables):
    return li.lineage_closure(table_graph(t), "p42", "upstream")


@query(
    f"""WITH RECURSIVE walk(source, node, depth) AS (SELECT parent, child, 1 FROM {_EDGES} UNION
          SELECT w.source, e.child, w.depth + 1 FROM walk w JOIN {_EDGES} e ON e.parent = w.node)
        SELECT source, count(DISTINCT node) AS nodes, max(depth)::BIGINT AS deepest FROM walk GROUP BY 1"""
)
def lineage_of_every_node(t: Tables):
    """How much hangs on every node of the graph, all of them at once."""
    pairs = li.closure_of_all(table_graph(t), "downstream")
    return pairs.groupBy("source").agg(F.count("node").alias("nodes"), F.max("depth").alias("deepest"))


@query(
    """SELECT event_id AS source, count(*) OVER later - 1 AS nodes, count(*) OVER later - 1 AS deepest
       FROM events WHERE user_id % 3 = 0 WINDOW later AS
         (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
       QUALIFY count(*) OVER later > 1"""
)
def events_that_follow(t: Tables):
    """Long chains: an event leads to the user's next one; every event's followers by doubling."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    steps = t.events.filter("user_id % 3 = 0").select(
        F.col("event_id").alias("parent"), F.lead("event_id").over(order).alias("child")
    )
    pairs = li.closure_of_all(steps, "downstream")
    return pairs.groupBy("source").agg(F.count("node").alias("nodes"), F.max("depth").alias("deepest"))
