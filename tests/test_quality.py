import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import conflict as k
from sluiceway.operators import quality as q
from sluiceway.operators import schema as sc
from sluiceway.sources import catalog as cat
from sluiceway.sources.catalog import catalog_search, list_tables


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (1, "john@example.com", 30, "F"),
            (2, None, -5, "X"),
            (2, "broken", 200, None),
            (None, "a.b+c@x.co", None, "O"),
            (None, "john@example.com", 40, "F"),
        ],
        "id int, email string, age int, status string",
    )


def outcome(df):
    return {(r.test, r.column_name): (r.failures, r.passed) for r in df.collect()}


def test_row_checks_in_one_pass(people):
    got = outcome(
        q.run_checks(
            people,
            [
                q.not_null("id"),
                q.not_null("age"),
                q.accepted_values("status", ["F", "O"]),
                q.in_range("age", 0, 40),
                q.matches("email"),
                q.holds("adult", "age", "age >= 18"),
            ],
        )
    )
    assert got == {
        ("not_null", "id"): (2, False),
        ("not_null", "age"): (1, False),
        ("accepted_values", "status"): (1, False),
        ("range", "age"): (2, False),
        ("pattern", "email"): (1, False),
        ("adult", "age"): (1, False),
    }


def test_unique_ignores_nulls(people):
    got = outcome(q.test_unique(people, ["id", "email", "age"]))
    assert got == {
        ("unique", "id"): (1, False),
        ("unique", "email"): (1, False),
        ("unique", "age"): (0, True),
    }
    assert outcome(q.test_unique_together(people, ["id", "age"])) == {("unique", "id,age"): (0, True)}


def test_one_orphan(spark):
    orders = spark.createDataFrame([(1, 1), (2, 999), (3, None)], "order_id int, customer_id int")
    customers = spark.createDataFrame([(1,)], "customer_id int")
    got = q.test_relationships(orders, "customer_id", customers, "customer_id").collect()[0]
    assert (got.failures, got.passed) == (1, False)


def test_custom_sql(spark, people):
    got = q.test_sql(spark, "old", "SELECT * FROM {p} WHERE age > 100", p=people).collect()[0]
    assert (got.test, got.failures, got.passed) == ("old", 1, False)


def test_empty_tables(spark, people):
    none = people.filter("false")
    assert outcome(q.test_not_null(none, ["id"])) == {("not_null", "id"): (0, True)}
    assert outcome(q.test_unique(none, ["id"])) == {("unique", "id"): (0, True)}
    assert q.null_rate_check(none, ["id"]).collect()[0].passed is False
    assert q.completeness(none, ["id"]).collect()[0].completeness == 0
    assert q.duplicate_rate_check(none, ["id"]).collect()[0].duplicate_pct == 0
    fresh = q.freshness(none.withColumn("t", F.lit(None).cast("timestamp_ntz")), "t", dt.datetime(2024, 1, 1))
    assert fresh.collect()[0].status == "error"
    assert q.verdict(q.test_not_null(none, ["id"]).filter("false")).collect()[0].valid is True


def test_rates(people):
    rate = q.null_rate_check(people, ["id", "age"], 0.2).collect()
    assert [(r.null_rate, r.passed) for r in rate] == [(0.4, False), (0.2, True)]
    assert q.completeness(people, ["email"]).collect()[0].completeness == 80.0
    assert q.duplicate_rate_check(people, ["email"], 20).collect()[0].passed
    assert not q.duplicate_rate_check(people, ["email"]).collect()[0].passed


@pytest.mark.parametrize("hours, status", [(23, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    newest = dt.datetime(2024, 1, 1)
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t")
    assert q.freshness(df, "t", newest + dt.timedelta(hours=hours)).collect()[0].status == status


def test_row_counts(people):
    assert q.row_count_check(people, 5, 5).collect()[0].passed
    assert not q.row_count_check(people, 6).collect()[0].passed
    assert not q.row_count_check(people, 0, 4).collect()[0].passed


def test_reconcile_whole(people):
    same = q.reconcile(people, people.repartition(3).select("status", "age", "id", "email"))
    assert same.collect()[0].matched
    changed = people.withColumn("age", F.when(F.col("age") == 30, 31).otherwise(F.col("age")))
    assert not q.reconcile(people, changed).collect()[0].matched
    assert not q.reconcile(people, people.limit(4)).collect()[0].matched
    assert q.reconcile(people.filter("false"), people.filter("false")).collect()[0].matched


def test_reconcile_sees_moved_nulls(spark):
    ddl = "a int, b int, l array<int>"
    one = spark.createDataFrame([(None, 1, [1, None])], ddl)
    for other in [(1, None, [1, None]), (None, 1, [None, 1]), (None, 1, [1])]:
        assert not q.reconcile(one, spark.createDataFrame([other], ddl)).collect()[0].matched
    assert q.reconcile(one, one).collect()[0].matched


def test_reconcile_by_key(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "x"), (5, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (None, "n"), (5, "y"), (5, "x")], "k int, v string")
    got = q.reconcile(a, b, ["k"]).collect()[0]
    assert (got.source_rows, got.target_rows) == (6, 6)
    assert (got.missing_keys, got.extra_keys, got.different_keys, got.matched) == (1, 1, 1, False)


def test_load_validation_and_consistency(people):
    got = q.load_validation(people, 5, "id").collect()[0]
    assert (got.row_count, got.null_keys, got.passed) == (5, 2, False)
    assert q.load_validation(people.filter("id = 1"), 1, "id").collect()[0].passed
    assert not q.load_validation(people.filter("false"), 0, "id").collect()[0].passed
    counts = people.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    assert q.aggregate_consistency(people, counts, "n").collect()[0].passed
    assert not q.aggregate_consistency(people, counts.limit(1), "n").collect()[0].passed


def test_severities(people):
    results = q.test_not_null(people, ["id", "age"])
    got = {r.column_name: (r.severity, r.status) for r in q.severity(results, {"not_null": "warn"}, ["id"]).collect()}
    assert got == {"id": ("error", "error"), "age": ("warn", "warn")}


def test_derived_tests(spark, rows):
    ddl = "table_name string, column_name string, is_primary_key boolean, nullable boolean, ref_table string, ref_column string"
    catalog = spark.createDataFrame(
        [
            ("t", "ID", True, False, None, None),
            ("t", "ref", False, True, "u", "id"),
            ("t", "must", None, False, None, None),
            ("t", "may", False, None, None, None),
            ("t", " ", True, False, None, None),
        ],
        ddl,
    )
    assert rows(q.derive_tests(catalog, "warn")) == [
        ("t", "id", "not_null", "error", None, None),
        ("t", "id", "unique", "error", None, None),
        ("t", "must", "not_null", "warn", None, None),
        ("t", "ref", "relationships", "error", "u", "id"),
    ]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        [
            (1, "John", None, "postgres", "2025-01-01"),
            (1, None, "john@example.com", "salesforce", "2025-12-31"),
            (2, "Ann", "ann@x.com", "other", "2025-05-05"),
        ],
        "customer_id int, first_name string, email string, source string, updated_at string",
    )


def test_duplicates_and_latest(records, rows):
    assert rows(k.find_duplicates(records, ["customer_id"])) == [(1, 2)]
    assert rows(k.resolve_latest(records, ["customer_id"], "updated_at"), "source") == [("other",), ("salesforce",)]


def test_source_priority(records, rows):
    best = k.resolve_source_priority(records, ["customer_id"], "source", ["salesforce", "postgres"])
    assert rows(best, "customer_id", "email") == [(1, "john@example.com"), (2, "ann@x.com")]
    other = k.resolve_source_priority(records, ["customer_id"], "source", ["postgres"])
    assert rows(other, "customer_id", "source") == [(1, "postgres"), (2, "other")]


def test_coalesce_and_rules(records, rows):
    merged = k.merge_coalesce(records, ["customer_id"], ["source"])
    assert rows(merged, "first_name", "email") == [("Ann", "ann@x.com"), ("John", "john@example.com")]
    newest = k.resolve_rules(records, ["customer_id"], [{"field": "email", "strategy": "max_by", "order_by": "updated_at"}])
    assert rows(newest) == [(1, "john@example.com"), (2, "ann@x.com")]
    with pytest.raises(ValueError):
        k.resolve_rules(records, ["customer_id"], [{"field": "email", "strategy": "vote", "order_by": "source"}])


def test_equal_order_values_give_stable_results(spark, rows):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, None, 5)], "k int, v string, t int")
    for parts in (1, 3):
        spread = df.repartition(parts)
        assert rows(k.merge_coalesce(spread, ["k"], ["t"]), "v") == [("a",)]
        rules = [{"field": "v", "strategy": "max_by", "order_by": "t"}]
        assert rows(k.resolve_rules(spread, ["k"], rules), "v") == [("b",)]


def test_conflict_log(records):
    log = k.conflict_log(records, "customers", ["customer_id"], "latest", dt.datetime(2025, 1, 1)).collect()
    assert [(r.record_keys, r.resolution_strategy) for r in log] == [('{"customer_id":1}', "latest")]


def test_hot_key_of_equal_copies_leaves_one(spark):
    """A third of the rows are equal copies of one key: exactly one of them is kept."""
    df = spark.range(0, 30000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("v"),
    )
    kept, repeats = k.split_unique_violations(df, ["k"], ["v"])
    assert kept.count() == 20001 and kept.filter("k = -1").count() == 1
    assert repeats.count() == 9999 and repeats.distinct().count() == 1
    marked = k.mark_unique_violations(df, ["k"], ["v"])
    assert marked.filter("NOT _repeat").count() == 20001
    # rows meet the winners by their number, so the hot key is spread evenly
    text = marked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "_row" in text


def test_null_keys_count_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "k int, v int")
    marked = k.mark_unique_violations(df, ["k"], ["v"]).filter("_repeat").collect()
    assert [(r.k, r.v) for r in marked] == [(None, 2)]


COLUMNS = "table_name string, column_name string, data_type string, nullable boolean, length int"


@pytest.fixture(scope="module")
def versions(spark):
    one = [("t", "id", "int", False, None), ("t", "name", "varchar", True, 10), ("u", "x", "int", True, None)]
    two = [("t", "id", "bigint", False, None), ("t", "name", "varchar", False, 20), ("t", "phone", "varchar", True, 5)]
    return spark.createDataFrame(one, COLUMNS), spark.createDataFrame(two, COLUMNS)


def test_schema_diff(versions, rows):
    full = {(r.table_name, r.column_name): (r.change, r.changes) for r in sc.schema_diff(*versions).collect()}
    assert full == {
        ("t", "id"): ("modified", ["data_type: int -> bigint"]),
        ("t", "name"): ("modified", ["nullable: true -> false", "length: 10 -> 20"]),
        ("t", "phone"): ("added", None),
        ("u", "x"): ("removed", None),
    }
    light = sc.schema_diff(*versions, compare=["data_type"])
    assert rows(light, "column_name", "change") == [("id", "modified"), ("phone", "added"), ("x", "removed")]
    assert rows(sc.change_summary(light)) == [("t", 1, 0, 1), ("u", 0, 1, 0)]
    assert sc.schema_diff(versions[0], versions[0]).count() == 0


def test_backward_compatibility(spark, versions, rows):
    base = versions[0]
    more = base.union(spark.createDataFrame([("t", "email", "varchar", True, 5), ("u", "y", "int", False, None)], COLUMNS))
    assert rows(sc.is_backward_compatible(sc.schema_diff(base, more), more)) == [("t", True), ("u", False)]
    fewer = base.filter("column_name <> 'name'")
    assert rows(sc.is_backward_compatible(sc.schema_diff(base, fewer), fewer)) == [("t", False)]


def test_versions_in_order(versions, rows):
    history = sc.register_version(None, versions[0], 1, dt.datetime(2024, 1, 1))
    history = sc.register_version(history, versions[1], 2, dt.datetime(2024, 2, 1))
    again = sc.register_version(history, versions[1], 2, dt.datetime(2024, 3, 1))
    assert again.count() == history.count() == 6
    assert rows(sc.schema_history(again), "table_name", "version", "column_count") == [("t", 1, 2), ("t", 2, 3), ("u", 1, 1)]
    changes = rows(sc.version_changes(again), "version", "column_name", "change")
    assert changes == [(2, "id", "modified"), (2, "name", "modified"), (2, "phone", "added")]


def test_set_diff(spark, rows):
    a = spark.createDataFrame([("t", "pk1"), ("t", "pk2")], "table_name string, key string")
    b = spark.createDataFrame([("t", "pk2"), ("t", "pk3")], "table_name string, key string")
    assert rows(sc.set_diff(a, b, ["table_name"], "key")) == [("t", "pk1", "removed"), ("t", "pk3", "added")]


@pytest.mark.parametrize(
    "a, b, fits",
    [
        ("INTEGER", "decimal(15,2)", True),
        ("VARCHAR(50)", "char(3)", True),
        ("DATE", "DATE", True),
        ("DATE", "TIMESTAMP", False),
        ("VARCHAR(5)", "INTEGER", False),
        ("FLOAT", "byteint", True),
    ],
)
def test_type_families(spark, a, b, fits):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(sc.types_compatible(F.col("a"), F.col("b"))).collect()[0][0] is fits


def test_match_schema(spark, rows):
    ddl = "column_name string, data_type string"
    file = spark.createDataFrame([("ID", "INTEGER"), ("Name", "VARCHAR(50)"), ("extra", "DATE")], ddl)
    table = spark.createDataFrame([("id", "BIGINT"), ("name", "DATE"), ("gone", "INTEGER")], ddl)
    matched = sc.match_schema(file, table)
    assert rows(matched, "column_name", "status") == [
        ("extra", "extra"),
        ("gone", "missing"),
        ("id", "ok"),
        ("name", "type_mismatch"),
    ]
    assert sc.is_loadable(matched).collect()[0].compatible is False
    fine = sc.match_schema(file.filter("column_name <> 'Name'"), table.filter("column_name = 'id'"))
    assert sc.is_loadable(fine).collect()[0].compatible is True


def test_catalog_search_and_listing(spark, rows):
    tables = spark.createDataFrame(
        [
            ("db", "Orders", "T", "all orders"),
            ("db", "orders_old", "V", None),
            ("db2", "order_items", "O", "lines"),
            ("db2", "customers", "T", "who ORDERS"),
        ],
        "database_name string, table_name string, table_kind string, description string",
    )
    assert [r.table_name for r in catalog_search(tables, "ORDER").collect()] == ["Orders", "order_items"]
    assert [r.table_name for r in catalog_search(tables, "order", "comment").collect()] == ["Orders", "customers"]
    assert [r.table_name for r in catalog_search(tables, "o_d", database="db").collect()] == ["Orders"]
    assert [r.table_name for r in catalog_search(tables, "", limit=1).collect()] == ["Orders"]
    with pytest.raises(ValueError):
        catalog_search(tables, "x", "rows")
    assert rows(list_tables(tables, "order%"), "table_name") == [("order_items",), ("orders_old",)]
    assert rows(list_tables(tables, "_rders%", "V"), "table_name") == [("orders_old",)]


def test_describe_table(spark):
    df = spark.sql("SELECT cast(1.5 AS decimal(10,2)) AS unit_price, 'a' AS item, cast(null AS date) AS day")
    got = {r.column_name: r for r in cat.describe_table(df, "t", "db", ["item"], include_stats=True).collect()}
    price = got["unit_price"]
    assert (price.precision, price.scale, price.description, price.position) == (10, 2, "Unit Price (DECIMAL)", 1)
    assert got["item"].is_primary_key and not price.is_primary_key
    assert (got["day"].null_count, got["day"].distinct_count) == (1, 0)


def test_samples_do_not_depend_on_how_the_input_is_split(spark):
    from sluiceway.operators.sampling import sample_fraction, sample_rows

    df = spark.range(5000).withColumn("v", F.col("id") % 7)
    for draw in (lambda d: sample_rows(d, 100, 3), lambda d: sample_fraction(d, 0.1, 3)):
        one, two = (sorted(map(tuple, draw(d).collect())) for d in (df, df.repartition(9)))
        assert one == two
    assert sample_rows(df, 100, 3).count() == 100


def test_reconcile_compares_values_not_types(spark):
    from sluiceway.operators.quality import reconcile

    numbers = spark.createDataFrame([(1, 2.5), (2, None)], "k bigint, v double")
    texts = spark.createDataFrame([("2", None), ("1", "2.50")], "K string, v string")
    small = spark.createDataFrame([(1, "2.5"), (2, None)], "k int, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))
    for other in (texts, small):
        assert reconcile(numbers, other).first().matched
        assert reconcile(other, numbers, ["k"] if other is small else ["K"]).first().matched
    changed = texts.withColumn("v", F.lit("2.6"))
    assert not reconcile(numbers, changed).first().matched
    assert reconcile(numbers, changed, ["k"]).first().different_keys == 2
