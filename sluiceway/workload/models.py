"""Staging, joins, facts, dimensions, unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluiceway.functions.keys import hash_key
from sluiceway.functions.text import normalize_name, safe_cast_ts
from sluiceway.operators import joins as j
from sluiceway.operators import marts
from sluiceway.operators import staging as st
from sluiceway.operators.history import snapshot
from sluiceway.plans.elt import transformation
from sluiceway.runtime import settle
from sluiceway.sources.tables import run_sql
from sluiceway.workload.registry import Tables, query

LOADED_AT = dt.datetime(2024, 6, 1)


def staged_customers(t: Tables):
    return st.stage(
        t.customer,
        ["c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal"],
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"},
    )


def staged_orders(t: Tables):
    return st.stage(
        t.orders,
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status"},
    )


@query(
    """SELECT c.segment, o.status, count(o.order_id) AS order_count,
              count(DISTINCT c.customer_id) AS customer_count,
              round(sum(o.o_totalprice), 2) AS total_spent
       FROM (SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer) c
       LEFT JOIN (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
                         o_totalprice FROM orders) o ON c.customer_id = o.customer_id
       GROUP BY 1, 2"""
)
def customer_orders_fact(t: Tables):
    """Orders are folded per customer and status first, so a customer with many costs no task more."""
    folded = marts.fact(
        staged_orders(t),
        ["customer_id", "status"],
        {"orders": "count(order_id)", "spent": "sum(o_totalprice)"},
    )
    joined = j.join_chain(
        staged_customers(t),
        "c",
        [j.Join(folded, "o", "c.customer_id = o.customer_id")],
        ["c.customer_id", "c.segment", "o.status", "o.orders", "o.spent"],
    )
    return marts.fact(
        joined,
        ["segment", "status"],
        {
            "order_count": "coalesce(sum(orders), 0)",
            "customer_count": "count(distinct customer_id)",
            "total_spent": "round(sum(spent), 2)",
        },
    )


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice,
              year(o_orderdate) AS order_year,
              CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS order_size
       FROM orders"""
)
def stage_orders(t: Tables):
    return st.stage(
        t.orders,
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
        {"o_orderkey": "order_id", "o_custkey": "customer_id"},
        {
            "order_year": F.year("o_orderdate").cast("bigint"),
            "order_size": "CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END",
        },
    )


@query(
    """SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, upper(c_mktsegment) AS c_mktsegment,
              lower(trim(email)) AS email
       FROM (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS c_custkey,
                    '  ' || c_name || ' ' AS c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment,
                    ' ' || c_name || '@Example.COM ' AS email
             FROM customer) WHERE c_custkey IS NOT NULL"""
)
def stage_clean_customers(t: Tables):
    dirty = t.customer.select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("c_custkey"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
        F.lower("c_mktsegment").alias("c_mktsegment"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.COM ")).alias("email"),
    )
    return st.stage_clean(dirty, ["c_custkey"], ["c_name"], ["email"], ["c_mktsegment"])


@query("SELECT p_partkey, p_brand, p_retailprice FROM part")
def select_columns_any_case(t: Tables):
    picked, _unknown = st.select_ci(t.part, ["P_PARTKEY", "P_Brand", "no_such", "p_RetailPrice"])
    return picked


@query(
    """SELECT event_id, user_id, event_type, TIMESTAMP '2024-06-01 00:00:00' AS loaded_at
       FROM events WHERE event_type <> 'view' AND value > 10"""
)
def stage_events_stamped(t: Tables):
    return st.stage(
        t.events,
        ["event_id", "user_id", "event_type"],
        where="event_type <> 'view' AND value > 10",
        loaded_at=LOADED_AT,
    )


@query(
    """SELECT p_partkey, regexp_replace(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '_', 'g'),
              '^_+|_+$', '', 'g') AS clean_name FROM part"""
)
def normalize_part_names(t: Tables):
    return t.part.select(
        "p_partkey", normalize_name(F.concat_ws(" ", "p_brand", "p_name")).alias("clean_name")
    )


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def distinct_line_keys(t: Tables):
    """Whole rows, each of them given twice."""
    return st.distinct_rows(t.lineitem.unionByName(t.lineitem))


@query(
    """SELECT p_type, count(DISTINCT (p_brand, p_name)) AS keys, count(*) AS row_count
       FROM part GROUP BY 1"""
)
def surrogate_keys_of_parts(t: Tables):
    keyed = t.part.withColumn("key", hash_key(F.col("p_brand"), F.col("p_name")))
    return marts.fact(keyed, ["p_type"], {"keys": "count(distinct key)", "row_count": "count(1)"})


@query(
    """SELECT event_type, count(*) AS row_count,
              count(CASE WHEN value >= 10 THEN ts END) AS converted, max(CASE WHEN value >= 10 THEN ts END) AS newest
       FROM events GROUP BY 1"""
)
def safe_timestamp_cast(t: Tables):
    text = F.when(F.col("value") >= 10, F.col("ts").cast("string")).otherwise(
        F.concat(F.lit("bad "), F.col("ts").cast("string"))
    )
    cast = t.events.select("event_type", safe_cast_ts(text).cast("timestamp_ntz").alias("parsed"))
    return cast.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("parsed").alias("converted"),
        F.max("parsed").alias("newest"),
    )


@query(
    """SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name, o.o_totalprice
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       INNER JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey AND r.r_regionkey < n.n_nationkey
       WHERE o.o_totalprice > 1000"""
)
def join_chain_orders(t: Tables):
    return j.join_chain(
        t.orders,
        "o",
        [
            j.Join(t.customer, "c", "o.o_custkey = c.c_custkey"),
            j.Join(t.nation, "n", "c.c_nationkey = n.n_nationkey", "inner"),
            j.Join(
                t.region, "r", "n.n_regionkey = r.r_regionkey AND r.r_regionkey < n.n_nationkey", "left"
            ),
        ],
        ["o.o_orderkey", "c.c_name", "n.n_name", "r.r_name", "o.o_totalprice"],
        where="o.o_totalprice > 1000",
    )


@query(
    """SELECT n.n_name AS n_name, r.r_name AS r_name, count(o.o_orderkey) AS order_count,
              round(sum(o.o_totalprice), 2) AS revenue
       FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey
       INNER JOIN nation n ON c.c_nationkey = n.n_nationkey
       INNER JOIN region r ON n.n_regionkey = r.r_regionkey
       GROUP BY 1, 2"""
)
def join_chain_grouped(t: Tables):
    return j.join_chain(
        t.orders,
        "o",
        [
            j.Join(t.customer, "c", "o.o_custkey = c.c_custkey", "inner"),
            j.Join(t.nation, "n", "c.c_nationkey = n.n_nationkey", "inner"),
            j.Join(t.region, "r", "n.n_regionkey = r.r_regionkey", "inner"),
        ],
        [
            "n.n_name",
            "r.r_name",
            "count(o.o_orderkey) AS order_count",
            "round(sum(o.o_totalprice), 2) AS revenue",
        ],
        group_by=["n.n_name", "r.r_name"],
    )


@query(
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
       JOIN orders ON c_custkey = o_custkey"""
)
def inner_join_orders(t: Tables):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice"
    )


@query(
    """SELECT c_custkey, c_name, count(o_orderkey) AS order_count,
              round(coalesce(sum(o_totalprice), 0), 2) AS total_spent
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
       GROUP BY 1, 2"""
)
def customer_360(t: Tables):
    """Orders are summed per customer before the join, so hot customers shuffle few rows."""
    spent = (
        t.orders.filter("o_orderstatus = 'F'")
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("s"))
    )
    return t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey",
        "c_name",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"),
        F.round(F.coalesce("s", F.lit(0.0)), 2).alias("total_spent"),
    )


@query(
    """SELECT (SELECT count(*) FROM customer) AS customer_count, (SELECT count(*) FROM orders) AS order_count,
              (SELECT count(*) FROM part) AS product_count"""
)
def one_row_of_counts(t: Tables):
    def rows(df):
        return df.agg(F.count(F.lit(1)))

    return j.one_row(
        customer_count=rows(t.customer), order_count=rows(t.orders), product_count=rows(t.part)
    )


@query(
    """SELECT c_custkey, o_orderkey, p_name, p_retailprice FROM customer
       JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
       JOIN part ON l_partkey = p_partkey WHERE p_size > 25"""
)
def customers_orders_products(t: Tables):
    return j.join_chain(
        t.lineitem,
        "l",
        [
            j.Join(t.part, "p", "l.l_partkey = p.p_partkey", "inner"),
            j.Join(t.orders, "o", "o.o_orderkey = l.l_orderkey", "inner"),
            j.Join(t.customer, "c", "c.c_custkey = o.o_custkey", "inner"),
        ],
        ["c.c_custkey", "o.o_orderkey", "p.p_name", "p.p_retailprice"],
        where="p.p_size > 25",
    )


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def semi_join_orders(t: Tables):
    wanted = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return j.keep_matching(t.orders, wanted, ["o_custkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    """SELECT l_partkey AS key, count(*) AS row_count FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45) GROUP BY 1"""
)
def orphaned_part_keys(t: Tables):
    return j.orphan_keys(t.lineitem, "l_partkey", t.part.filter("p_size <= 45"), "p_partkey")


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
       (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""
)
def orphaned_orders(t: Tables):
    parent = t.customer.filter("c_acctbal > 0")
    return j.orphan_rows(t.orders, "o_custkey", parent, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


@query(
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
              round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS line_count,
              round(avg(l_discount), 6) AS avg_discount FROM lineitem GROUP BY 1, 2"""
)
def sales_fact(t: Tables):
    return marts.fact(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "sum_qty": "sum(l_quantity)",
            "revenue": "round(sum(l_extendedprice * (1 - l_discount)), 2)",
            "line_count": "count(1)",
            "avg_discount": "round(avg(l_discount), 6)",
        },
    )


@query(
    """SELECT count(*) AS line_count, round(sum(l_extendedprice), 2) AS revenue,
              max(l_shipdate) AS last_ship FROM lineitem"""
)
def global_fact(t: Tables):
    return marts.fact(
        t.lineitem,
        None,
        {
            "line_count": "count(1)",
            "revenue": "round(sum(l_extendedprice), 2)",
            "last_ship": "max(l_shipdate)",
        },
    )


@query("SELECT DISTINCT p_brand, p_type FROM part")
def product_dimension(t: Tables):
    return marts.dimension(t.part, ["p_brand", "p_type"])


@query(
    """SELECT o_orderstatus, count(*) AS row_count, count(DISTINCT o_custkey) AS unique_count
       FROM orders GROUP BY 1"""
)
def status_summary(t: Tables):
    return marts.summary(t.orders, "o_orderstatus", "o_custkey")


@query(
    """SELECT source, key_count, CAST(sum(key_count) OVER () AS BIGINT) AS total_keys FROM
       (SELECT 'customer' AS source, count(DISTINCT c_custkey) AS key_count FROM customer
        UNION ALL SELECT 'orders', count(DISTINCT o_custkey) FROM orders
        UNION ALL SELECT 'events', count(DISTINCT user_id) FROM events)"""
)
def keys_per_source(t: Tables):
    counts = marts.distinct_per_source(
        {"customer": F.col("c_custkey"), "orders": F.col("o_custkey"), "events": F.col("user_id")},
        {"customer": t.customer, "orders": t.orders, "events": t.events},
    )
    return marts.with_grand_total(counts, "key_count", "total_keys")


@query(
    """SELECT c_custkey AS party_id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 'crm' AS source
       FROM customer UNION ALL
       SELECT s_suppkey, s_name, s_acctbal, NULL, 'purchasing' FROM supplier"""
)
def unified_parties(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("party_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return marts.unify_sources({"crm": customers, "purchasing": suppliers})


@query(
    """WITH base_0 AS (SELECT * FROM orders), base_1 AS (SELECT * FROM customer)
       SELECT c_mktsegment, count(*) AS order_count, round(avg(o_totalprice), 4) AS avg_price
       FROM base_0 JOIN base_1 ON o_custkey = c_custkey GROUP BY 1"""
)
def transformation_over_bases(t: Tables):
    sql = """SELECT c_mktsegment, count(*) AS order_count, round(avg(o_totalprice), 4) AS avg_price
             FROM {base_0} JOIN {base_1} ON o_custkey = c_custkey GROUP BY 1"""
    return transformation(t.spark, sql, t.orders, t.customer)


@query(
    """SELECT o_orderpriority, count(*) AS order_count FROM orders
       WHERE o_totalprice > 100000 AND o_orderstatus <> 'P' GROUP BY 1"""
)
def parameterized_sql(t: Tables):
    sql = """SELECT o_orderpriority, count(*) AS order_count FROM {orders}
             WHERE o_totalprice > ? AND o_orderstatus <> ? GROUP BY 1"""
    return run_sql(t.spark, sql, [100000, "P"], orders=t.orders)


_BANDS = "(SELECT s_suppkey, s_acctbal AS low, CASE WHEN s_suppkey % 11 <> 0 THEN s_acctbal + s_suppkey % 40 * 10 END AS high FROM supplier)"


@query(
    f"""SELECT s_suppkey, count(c_custkey) AS customers, count(DISTINCT c_nationkey) AS nations
        FROM customer JOIN {_BANDS} ON c_acctbal >= low AND (high IS NULL OR c_acctbal < high) GROUP BY 1"""
)
def customers_within_bands(t: Tables):
    """Bands of balances, some open at the top, some empty: a join without any equality."""
    high = F.when(F.col("s_suppkey") % 11 != 0, F.col("s_acctbal") + F.col("s_suppkey") % 40 * 10)
    bands = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("low"), high.alias("high"))
    return j.join_chain(
        t.customer,
        "c",
        [j.Join(bands, "b", how="inner", within=("c.c_acctbal", "b.low", "b.high"))],
        ["b.s_suppkey", "count(c.c_custkey) AS customers", "count(DISTINCT c.c_nationkey) AS nations"],
        group_by=["b.s_suppkey"],
    )


_ORDER_VERSIONS = """(SELECT o_orderkey, o_orderstatus AS status, valid_from,
    lead(valid_from) OVER (PARTITION BY o_orderkey ORDER BY valid_from) AS valid_to FROM (
      SELECT o_orderkey, o_orderstatus, TIMESTAMP '2024-01-02 00:00:00' + to_hours(CAST(o_custkey % 200 AS INTEGER)) AS valid_from
      FROM orders WHERE o_orderkey % 50 = 0
      UNION ALL SELECT o_orderkey, 'D', TIMESTAMP '2024-01-12 00:00:00' + to_minutes(CAST(o_custkey % 3000 AS INTEGER))
      FROM orders WHERE o_orderkey % 50 = 0 AND o_orderstatus = 'F'))"""


def order_versions(t: Tables):
    """A history of orders: a second version for those of status F."""
    some = t.orders.filter("o_orderkey % 50 = 0")
    hours = F.make_dt_interval(hours=(F.col("o_custkey") % 200).cast("int"))
    minutes = F.make_dt_interval(mins=(F.col("o_custkey") % 3000).cast("int"))
    started = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz") + hours
    closed = F.lit("2024-01-12 00:00:00").cast("timestamp_ntz") + minutes
    first = some.select("o_orderkey", F.col("o_orderstatus").alias("status"), started.alias("updated_at"))
    second = some.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("D").alias("status"), closed.alias("updated_at"))
    history = None
    for state in (first, second):
        history = settle(snapshot(state, history, ["o_orderkey"], "timestamp", updated_at="updated_at"), "history")
    return history.drop("updated_at")


@query(
    f"""SELECT e.event_type, h.status, count(*) AS n, count(DISTINCT e.event_id) AS events
        FROM events e LEFT JOIN {_ORDER_VERSIONS} h
          ON e.value < 2 AND e.ts >= h.valid_from AND (h.valid_to IS NULL OR e.ts < h.valid_to)
        GROUP BY 1, 2"""
)
def events_with_valid_versions(t: Tables):
    """Events with the versions valid when they happened; events without one stay."""
    return j.join_chain(
        t.events,
        "e",
        [j.Join(order_versions(t), "h", "e.value < 2", within=("e.ts", "h.valid_from", "h.valid_to"))],
        ["e.event_type", "h.status", "count(*) AS n", "count(DISTINCT e.event_id) AS events"],
        group_by=["e.event_type", "h.status"],
    )
