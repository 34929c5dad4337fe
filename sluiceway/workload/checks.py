"""Data tests, reconciliation, duplicates, conflicts. Faults are planted by the data's own values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluiceway.operators import conflict as k
from sluiceway.operators import quality as q
from sluiceway.runtime import metadata_frame
from sluiceway.workload.registry import Tables, query, ts

# Orders with planted faults: no status on urgent ones, no customer above 400 000,
# every order of priority 5-LOW twice.
_FAULTY_SQL = """(SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderpriority, o_orderdate FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, -o_totalprice, o_orderpriority, o_orderdate
    FROM orders WHERE o_orderpriority = '5-LOW')"""


def faulty_orders(t: Tables):
    orders = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") <= 400000, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")).alias(
            "o_orderstatus"
        ),
        "o_totalprice",
        "o_orderpriority",
        "o_orderdate",
    )
    twice = t.orders.filter("o_orderpriority = '5-LOW'").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    return orders.unionByName(twice.select(*orders.columns))


def _tests_sql(rows: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{test}' AS test, '{col}' AS column_name, ({n}) AS failures, ({n}) = 0 AS passed"
        for test, col, n in rows
    )


_NULLS = [
    ("not_null", c, f"SELECT count(*) FROM {_FAULTY_SQL} WHERE {c} IS NULL")
    for c in ("o_orderkey", "o_custkey", "o_orderstatus")
]
_UNIQUES = [
    (
        "unique",
        c,
        f"SELECT count(*) FROM (SELECT {c} FROM {_FAULTY_SQL} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    )
    for c in ("o_orderkey", "o_totalprice")
]
_ORPHANS = (
    "relationships",
    "o_custkey",
    f"""SELECT count(*) FROM {_FAULTY_SQL} WHERE o_custkey IS NOT NULL AND o_custkey NOT IN
        (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
_RANGE = (
    "range",
    "o_totalprice",
    f"SELECT count(*) FROM {_FAULTY_SQL} WHERE o_totalprice < 0 OR o_totalprice > 450000",
)
_ACCEPTED = (
    "accepted_values",
    "o_orderstatus",
    f"SELECT count(*) FROM {_FAULTY_SQL} WHERE o_orderstatus NOT IN ('F', 'O')",
)


@query(_tests_sql(_NULLS))
def not_null_tests(t: Tables):
    return q.test_not_null(faulty_orders(t), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(_tests_sql(_UNIQUES))
def unique_tests(t: Tables):
    return q.test_unique(faulty_orders(t), ["o_orderkey", "o_totalprice"])


@query(
    """SELECT 'unique' AS test, 'l_orderkey,l_linenumber' AS column_name, count(*) AS failures,
       count(*) = 0 AS passed FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def unique_together_test(t: Tables):
    return q.test_unique_together(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(_tests_sql([_ORPHANS]))
def relationships_test(t: Tables):
    parent = t.customer.filter("c_acctbal >= 0")
    return q.test_relationships(faulty_orders(t), "o_custkey", parent, "c_custkey")


@query(
    """SELECT 'relationships' AS test, 'doc_id' AS column_name, count(*) AS failures, count(*) = 0 AS passed
       FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
)
def unlabelled_documents_test(t: Tables):
    return q.test_relationships(t.documents, "doc_id", t.labels, "doc_id")


@query(_tests_sql([_ACCEPTED]))
def accepted_values_test(t: Tables):
    return q.test_accepted_values(faulty_orders(t), "o_orderstatus", ["F", "O"])


@query(_tests_sql([_RANGE]))
def range_test(t: Tables):
    return q.test_range(faulty_orders(t), "o_totalprice", 0, 450000)


_MAIL_SQL = "CASE WHEN c_acctbal > 0 THEN replace(c_name, '#', '.') || '@example.com' ELSE c_name END"


@query(
    f"""SELECT 'pattern' AS test, 'email' AS column_name, count(*) AS failures, count(*) = 0 AS passed
        FROM (SELECT {_MAIL_SQL} AS email FROM customer)
        WHERE NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$')"""
)
def email_pattern_test(t: Tables):
    mail = F.when(
        F.col("c_acctbal") > 0, F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@example.com"))
    ).otherwise(F.col("c_name"))
    return q.test_pattern(t.customer.select(mail.alias("email")), "email")


@query(
    """SELECT 'price above 100' AS test, '' AS column_name, count(*) AS failures, count(*) = 0 AS passed
       FROM lineitem WHERE l_extendedprice / l_quantity < 100"""
)
def custom_sql_test(t: Tables):
    sql = "SELECT * FROM {lines} WHERE l_extendedprice / l_quantity < 100"
    return q.test_sql(t.spark, "price above 100", sql, lines=t.lineitem)


@query(
    f"""SELECT test, column_name, failures, passed,
        CASE WHEN column_name = 'o_orderkey' THEN 'error' WHEN test = 'unique' THEN 'warn' ELSE 'error' END AS severity,
        CASE WHEN passed THEN 'pass' WHEN column_name <> 'o_orderkey' AND test = 'unique' THEN 'warn' ELSE 'error' END
          AS status
        FROM ({_tests_sql(_NULLS + _UNIQUES)})"""
)
def test_severities(t: Tables):
    faulty = faulty_orders(t)
    results = q.test_not_null(faulty, ["o_orderkey", "o_custkey", "o_orderstatus"]).unionByName(
        q.test_unique(faulty, ["o_orderkey", "o_totalprice"])
    )
    return q.severity(results, {"unique": "warn", "not_null": "error"}, keys=["o_orderkey"])


_CATALOG = [
    ("orders", "o_orderkey", True, True, None, None),
    ("orders", "O_CUSTKEY", False, False, "customer", "c_custkey"),
    ("orders", "o_totalprice", False, True, None, None),
    ("customer", "c_custkey", True, False, None, None),
    ("customer", "c_mktsegment", False, False, None, None),
]


@query(
    f"""SELECT 'orders' AS table_name, * FROM ({_tests_sql([
        ("unique", "o_orderkey", _UNIQUES[0][2]), _NULLS[0], _NULLS[1],
        ("relationships", "o_custkey", f'''SELECT count(*) FROM {_FAULTY_SQL}
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)''')])})
        UNION ALL SELECT 'customer', * FROM ({_tests_sql([
        ("unique", "c_custkey", "SELECT count(*) - count(DISTINCT c_custkey) FROM customer"),
        ("not_null", "c_custkey", "SELECT count(*) - count(c_custkey) FROM customer"),
        ("not_null", "c_mktsegment", "SELECT count(*) - count(c_mktsegment) FROM customer")])})"""
)
def derived_tests(t: Tables):
    """Tests follow from the catalog, then run over the tables."""
    catalog = metadata_frame(
        t.spark,
        _CATALOG,
        "table_name string, column_name string, is_primary_key boolean, nullable boolean, "
        "ref_table string, ref_column string",
    )
    tables = {"orders": faulty_orders(t), "customer": t.customer}
    return q.run_derived_tests(q.derive_tests(catalog), tables)


@query(
    """SELECT newest, round(epoch(TIMESTAMP '2024-02-01 12:00:00' - newest) / 3600, 4) AS age_hours,
       CASE WHEN epoch(TIMESTAMP '2024-02-01 12:00:00' - newest) / 3600 > 48 THEN 'error'
            WHEN epoch(TIMESTAMP '2024-02-01 12:00:00' - newest) / 3600 > 24 THEN 'warn' ELSE 'pass' END AS status
       FROM (SELECT max(ts) AS newest FROM events)"""
)
def events_freshness(t: Tables):
    return q.freshness(t.events, "ts", dt.datetime(2024, 2, 1, 12))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total_rows,
            (count(*) - count({c}))::DOUBLE / count(*) AS null_rate,
            (count(*) - count({c}))::DOUBLE / count(*) <= 0.12 AS passed FROM {_FAULTY_SQL}"""
        for c in ("o_custkey", "o_orderstatus", "o_orderdate")
    )
)
def null_rates(t: Tables):
    return q.null_rate_check(faulty_orders(t), ["o_custkey", "o_orderstatus", "o_orderdate"], 0.12)


@query("SELECT count(*) AS row_count, count(*) BETWEEN 1 AND 1000000000 AS passed FROM lineitem")
def row_count_in_bounds(t: Tables):
    return q.row_count_check(t.lineitem, 1, 1_000_000_000)


@query(
    f"""SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS distinct_keys,
        round((count(*) - count(DISTINCT o_orderkey)) * 100.0::DOUBLE / count(*), 4) AS duplicate_pct,
        (count(*) - count(DISTINCT o_orderkey)) * 100.0 / count(*) <= 1.0 AS passed FROM {_FAULTY_SQL}"""
)
def duplicate_rate(t: Tables):
    return q.duplicate_rate_check(faulty_orders(t), ["o_orderkey"])


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(count({c}) * 100.0::DOUBLE / count(*), 4) AS completeness
            FROM {_FAULTY_SQL}"""
        for c in ("o_custkey", "o_orderstatus", "o_orderdate")
    )
)
def completeness_of_orders(t: Tables):
    return q.completeness(faulty_orders(t), ["o_custkey", "o_orderstatus", "o_orderdate"])


@query(
    """SELECT s.n AS source_rows, t.n AS target_rows, false AS matched FROM
       (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'P') t"""
)
def reconcile_counts(t: Tables):
    return q.reconcile(t.orders, t.orders.filter("o_orderstatus <> 'P'"))


@query(
    """SELECT count(*) AS source_rows,
              count(*) FILTER (o_orderstatus <> 'P') + (SELECT count(*) FROM supplier) AS target_rows,
              count(*) FILTER (o_orderstatus = 'P') AS missing_keys,
              (SELECT count(*) FROM supplier) AS extra_keys,
              count(*) FILTER (o_orderstatus = 'F') AS different_keys, false AS matched FROM orders"""
)
def reconcile_keyed(t: Tables):
    """The target lost status P, changed the price of status F, and gained foreign rows."""
    changed = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    target = t.orders.filter("o_orderstatus <> 'P'").withColumn("o_totalprice", changed)
    foreign = t.supplier.select(
        (-F.col("s_suppkey") - 1).alias("o_orderkey"),
        F.lit("X").alias("o_orderstatus"),
        F.col("s_acctbal").alias("o_totalprice"),
    )
    return q.reconcile(t.orders, target.unionByName(foreign, allowMissingColumns=True), ["o_orderkey"])


@query(
    """SELECT count(*) AS source_rows, count(*) AS target_rows, 0::BIGINT AS missing_keys, 0::BIGINT AS extra_keys,
       count(*) FILTER (planted AND o_custkey % 10 = 0) AS different_keys,
       count(*) FILTER (planted AND o_custkey % 10 = 0) = 0 AS matched, planted
       FROM orders, (VALUES (false), (true)) p(planted) GROUP BY planted"""
)
def reconcile_text_with_numbers(t: Tables):
    """A source of texts, as a text load delivers it, agrees with the typed table by value."""
    typed = t.orders
    text = typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])
    raised = F.when(F.col("o_custkey") % 10 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    changed = typed.withColumn("o_custkey", raised)
    parts = [
        q.reconcile(text, tgt, ["o_orderkey"]).withColumn("planted", F.lit(planted))
        for planted, tgt in ((False, typed), (True, changed))
    ]
    return parts[0].unionByName(parts[1])


@query(
    """SELECT count(*) AS row_count, count(*) FILTER (o_custkey IS NULL) AS null_keys,
       false AS passed FROM """
    + _FAULTY_SQL
)
def validate_load(t: Tables):
    faulty = faulty_orders(t)
    return q.load_validation(faulty, t.orders.count(), "o_custkey")


@query(
    """SELECT count(*) AS summary_rows, count(*) AS detail_rows, true AS passed FROM lineitem"""
)
def summary_adds_up(t: Tables):
    summary = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return q.aggregate_consistency(t.lineitem, summary, "n")


@query(_tests_sql([_NULLS[1], _RANGE, _ACCEPTED, _UNIQUES[0], _ORPHANS]))
def validate_orders(t: Tables):
    return q.validate_table(
        faulty_orders(t),
        [
            q.not_null("o_custkey"),
            q.in_range("o_totalprice", 0, 450000),
            q.accepted_values("o_orderstatus", ["F", "O"]),
        ],
        unique=["o_orderkey"],
        references=[("o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey")],
    )


@query(
    f"""SELECT count(*) AS tests, count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS valid
        FROM ({_tests_sql([_NULLS[0], _NULLS[1], _RANGE])})"""
)
def orders_verdict(t: Tables):
    checks = [q.not_null("o_orderkey"), q.not_null("o_custkey"), q.in_range("o_totalprice", 0, 450000)]
    return q.verdict(q.validate_table(faulty_orders(t), checks))


# Customers as two systems know them: sales lacks balances below 2000, billing lacks the
# segment of customers of nation 3 and writes names in capitals.
_TWO_SOURCES_SQL = """(SELECT c_custkey, c_name AS name, CASE WHEN c_acctbal >= 2000 THEN c_acctbal END AS balance,
      c_mktsegment AS segment, TIMESTAMP '2024-01-01 00:00:00' + to_days(c_nationkey) AS changed_at,
      'sales' AS source FROM customer
    UNION ALL SELECT c_custkey, upper(c_name), c_acctbal, CASE WHEN c_nationkey <> 3 THEN lower(c_mktsegment) END,
      TIMESTAMP '2024-01-13 00:00:00', 'billing' FROM customer WHERE c_mktsegment <> 'BUILDING')"""


def two_sources(t: Tables):
    c = t.customer
    sales = c.select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 2000, F.col("c_acctbal")).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        (ts("2024-01-01 00:00:00") + F.make_dt_interval(F.col("c_nationkey"))).alias("changed_at"),
        F.lit("sales").alias("source"),
    )
    billing = c.filter("c_mktsegment <> 'BUILDING'").select(
        "c_custkey",
        F.upper("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_nationkey") != 3, F.lower("c_mktsegment")).alias("segment"),
        ts("2024-01-13 00:00:00").alias("changed_at"),
        F.lit("billing").alias("source"),
    )
    return sales.unionByName(billing)


@query(f"SELECT c_custkey, count(*) AS row_count FROM {_TWO_SOURCES_SQL} GROUP BY 1 HAVING count(*) > 1")
def duplicated_customers(t: Tables):
    return k.find_duplicates(two_sources(t), ["c_custkey"])


@query(
    f"""SELECT * FROM {_TWO_SOURCES_SQL} QUALIFY row_number() OVER
        (PARTITION BY c_custkey ORDER BY changed_at DESC, source DESC) = 1"""
)
def latest_customers(t: Tables):
    return k.resolve_latest(two_sources(t), ["c_custkey"], "changed_at", ["source"])


@query(
    f"""SELECT * FROM {_TWO_SOURCES_SQL} QUALIFY row_number() OVER
        (PARTITION BY c_custkey ORDER BY CASE source WHEN 'billing' THEN 1 WHEN 'sales' THEN 2 ELSE 3 END) = 1"""
)
def customers_by_source_priority(t: Tables):
    return k.resolve_source_priority(two_sources(t), ["c_custkey"], "source", ["billing", "sales"])


@query(
    f"""SELECT c_custkey, arg_min(name, CASE WHEN name IS NOT NULL THEN source END) AS name,
        arg_min(balance, CASE WHEN balance IS NOT NULL THEN source END) AS balance,
        arg_min(segment, CASE WHEN segment IS NOT NULL THEN source END) AS segment,
        arg_min(changed_at, source) AS changed_at, min(source) AS source
        FROM {_TWO_SOURCES_SQL} GROUP BY 1"""
)
def coalesced_customers(t: Tables):
    return k.merge_coalesce(two_sources(t), ["c_custkey"], ["source"])


@query(
    f"""SELECT c_custkey, (array_agg(name ORDER BY changed_at DESC, source DESC))[1] AS name, max(balance) AS balance,
        (array_agg(source ORDER BY changed_at, source))[1] AS source FROM {_TWO_SOURCES_SQL} GROUP BY 1"""
)
def customers_by_rules(t: Tables):
    """Records that changed at the same moment are told apart by their source."""
    return k.resolve_rules(
        two_sources(t),
        ["c_custkey"],
        [
            {"field": "name", "strategy": "max_by", "order_by": ["changed_at", "source"]},
            {"field": "balance", "strategy": "max"},
            {"field": "source", "strategy": "min_by", "order_by": ["changed_at", "source"]},
        ],
    )


_LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query(
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) = 1"""
)
def lines_without_repeats(t: Tables):
    """Whole rows: the first per key by a full order."""
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax"]
    return k.without_violations(t.lineitem, _LINE_KEYS, order)


@query(
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) > 1"""
)
def unique_violations(t: Tables):
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax"]
    _, repeats = k.split_unique_violations(t.lineitem, _LINE_KEYS, order)
    return repeats


@query(
    f"""SELECT 'customers' AS table_name, 'duplicate' AS conflict_type,
        '{{"c_custkey":' || c_custkey || '}}' AS record_keys, 'latest' AS resolution_strategy,
        TIMESTAMP '2024-06-01 00:00:00' AS resolved_at
        FROM {_TWO_SOURCES_SQL} GROUP BY c_custkey HAVING count(*) > 1"""
)
def conflict_log_of_customers(t: Tables):
    return k.conflict_log(
        two_sources(t), "customers", ["c_custkey"], "latest", dt.datetime(2024, 6, 1)
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'missing' ELSE 'different' END AS state,
         1::BIGINT AS source_rows, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END::BIGINT AS target_rows
       FROM orders WHERE (o_orderstatus = 'P' AND o_custkey % 7 = 0) OR (o_orderstatus = 'F' AND o_custkey % 50 = 1)
       UNION ALL SELECT -s_suppkey - 1, 'extra', 0, 1 FROM supplier WHERE s_suppkey % 5 = 0"""
)
def keys_that_differ(t: Tables):
    """The same faults, found through digests of buckets: only differing buckets are folded per key."""
    raised = F.when(
        (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 50 == 1), F.col("o_totalprice") + 1
    ).otherwise(F.col("o_totalprice"))
    target = t.orders.filter("o_orderstatus <> 'P' OR o_custkey % 7 <> 0").withColumn("o_totalprice", raised)
    foreign = t.supplier.filter("s_suppkey % 5 = 0").select((-F.col("s_suppkey") - 1).alias("o_orderkey"))
    return q.differing_keys(t.orders, target.unionByName(foreign, allowMissingColumns=True), ["o_orderkey"])


@query(
    """SELECT count(*) AS source_rows, count(*) AS target_rows, 0::BIGINT AS missing_keys, 0::BIGINT AS extra_keys,
         count(*) FILTER (o_custkey % 10 = 0 OR o_orderkey % 9 = 0) AS different_keys,
         count(*) FILTER (o_custkey % 10 = 0 OR o_orderkey % 9 = 0) = 0 AS matched,
         count(*) FILTER (o_custkey % 10 = 0) AS unconverted_cells FROM orders"""
)
def reconcile_after_a_lossy_load(t: Tables):
    """Prices that are no numbers became null, and great whole numbers went through a double."""
    garbled = F.when(F.col("o_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    great = F.lit(2**53) + F.when(F.col("o_orderkey") % 9 == 0, 1).otherwise(2)
    source = t.orders.withColumns({"o_totalprice": garbled, "great": great})
    target = source.withColumns(
        {"o_totalprice": F.col("o_totalprice").try_cast("double"), "great": F.col("great").cast("double")}
    )
    return q.reconcile(source, target, ["o_orderkey"], unconverted=True)
