import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import joins as j
from sluiceway.operators import marts, profiling, sampling
from sluiceway.operators import staging as st
from sluiceway.plans import elt
from sluiceway.operators import quality as q
from sluiceway.runtime import new_dir
from sluiceway.sources import storage


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [
            (1, " John ", " JOHN@EXAMPLE.COM ", "active"),
            (2, "Jane", None, "inactive"),
            (None, "Ghost", "ghost@x.com", "active"),
        ],
        "customer_id int, first_name string, email string, status string",
    )


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [(1, 1, 100.0), (2, 1, 50.0), (3, 999, 75.0), (4, None, 5.0)],
        "order_id int, customer_id int, amount double",
    )


def test_stage_renames_computes_filters_and_stamps(customers, rows):
    out = st.stage(
        customers,
        ["customer_id", "status"],
        {"customer_id": "id"},
        {"shout": "upper(status)"},
        where="email IS NOT NULL",
        loaded_at=dt.datetime(2024, 1, 1),
    )
    assert out.columns == ["id", "status", "shout", "loaded_at"]
    assert rows(out, "id", "shout") == [(None, "ACTIVE"), (1, "ACTIVE")]


def test_stage_all_names(customers):
    assert list(st.stage_all({"CUSTOMERS": customers})) == ["stg_customers"]


def test_stage_clean(customers, rows):
    out = st.stage_clean(customers, ["customer_id"], ["first_name"], ["email"], ["status"])
    assert rows(out) == [(1, "John", "john@example.com", "ACTIVE"), (2, "Jane", None, "INACTIVE")]


def test_select_ci(customers):
    df, dropped = st.select_ci(customers, ["EMAIL", "nope"])
    assert df.columns == ["email"] and dropped == ["nope"]
    df, dropped = st.select_ci(customers, ["nope"])
    assert df.columns == customers.columns and dropped == ["nope"]


def test_set_and_multiset(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "a int")
    assert st.distinct_rows(df).count() == 2
    assert st.distinct_rows(df, duplicates=True).count() == 4


def test_chain_defaults_to_left_join(customers, orders, rows):
    out = j.join_chain(
        customers,
        "c",
        [j.Join(orders, "o", "c.customer_id = o.customer_id")],
        ["c.customer_id", "o.order_id"],
    )
    assert rows(out) == [(None, None), (1, 1), (1, 2), (2, None)]


def test_chain_grouped_and_theta(customers, orders, rows):
    out = j.join_chain(
        customers,
        "c",
        [j.Join(orders, "o", "c.customer_id = o.customer_id AND o.amount > 60", "left")],
        ["c.status", "count(o.order_id) AS n", "coalesce(sum(o.amount), 0D) AS s"],
        where="c.customer_id IS NOT NULL",
        group_by=["c.status"],
    )
    assert rows(out) == [("active", 1, 100.0), ("inactive", 0, 0.0)]


def test_chain_refuses_joins_without_condition(customers, orders):
    with pytest.raises(ValueError):
        j.join_chain(customers, "c", [j.Join(orders, "o", "true", "cross")])


def test_orphans_leave_out_null_keys(orders, customers, rows):
    assert rows(j.orphan_keys(orders, "customer_id", customers, "customer_id")) == [(999, 1)]
    assert rows(j.orphan_rows(orders, "customer_id", customers, "customer_id"), "order_id") == [(3,)]


def test_semi_join(orders, customers, rows):
    assert rows(j.keep_matching(orders, customers, ["customer_id"]), "order_id") == [(1,), (2,)]


def test_one_row(orders, customers):
    def count(df):
        return df.agg(F.count(F.lit(1)))

    assert tuple(j.one_row(a=count(orders), b=count(customers)).collect()[0]) == (4, 3)


def test_fact_shapes(orders, rows):
    total = {"n": "count(1)", "s": "sum(amount)"}
    assert rows(marts.fact(orders, None, total)) == [(4, 230.0)]
    assert rows(marts.fact(orders, ["customer_id"], None)) == [(None,), (1,), (1,), (999,)]
    assert rows(marts.fact(orders, ["customer_id"], {"n": "count(1)"})) == [(None, 1), (1, 2), (999, 1)]


def test_dimension_summary_total(orders, customers, rows):
    assert rows(marts.dimension(customers, ["status"])) == [("active",), ("inactive",)]
    assert rows(marts.summary(customers, "status", "email")) == [("active", 2, 2), ("inactive", 1, 0)]
    totals = marts.with_grand_total(marts.summary(customers, "status", "email"), "row_count", "all")
    assert rows(totals, "status", "all") == [("active", 3), ("inactive", 3)]
    assert "SinglePartition" not in totals._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


def test_union_pads_missing_columns(orders, customers, rows):
    out = marts.unify_sources({"crm": customers.select("customer_id", "email"), "shop": orders.select("customer_id")})
    assert rows(out, "source", "customer_id", "email")[-1] == ("shop", 999, None)
    assert out.count() == 7


def test_statistics_with_nulls_nans_and_zeros(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 0.0D, 'a'), (1, -0.0D, null), (null, double('nan'), 'b'), (2, double('nan'), 'b') "
        "AS t(i, d, s)"
    )
    got = {r.column_name: r for r in profiling.column_statistics(df).collect()}
    assert (got["i"].total_rows, got["i"].non_null_count, got["i"].null_count) == (4, 3, 1)
    assert (got["i"].null_percentage, got["i"].distinct_count) == (25.0, 2)
    assert got["i"].cardinality_percentage == 50.0
    assert got["d"].distinct_count == 2 and got["s"].distinct_count == 2


def test_statistics_of_no_rows_are_zero(spark):
    df = spark.createDataFrame([], "a int")
    got = profiling.column_statistics(df).collect()[0]
    assert (got.total_rows, got.null_percentage, got.distinct_count, got.cardinality_percentage) == (0, 0, 0, 0)


def test_distinct_counts_of_every_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES "
        "(1Y, 1.5BD, 12345678901234567890.5BD, true, date'2024-01-01', X'01', array(1, null), named_struct('a', 1), map('k', 1)), "
        "(1Y, 1.5BD, 12345678901234567890.5BD, true, date'2024-01-01', X'01', array(1), named_struct('a', null), map('k', 1)), "
        "(2Y, 2.5BD, 12345678901234567891.5BD, false, date'2024-01-02', X'02', array(1, null), named_struct('a', 1), map('k', 2)) "
        "AS t(b, d, w, f, day, bin, arr, s, m)"
    )
    got = {r.column_name: r.distinct_count for r in profiling.distinct_counts(df).collect()}
    assert got == {c: 2 for c in df.columns}


def test_profile_by_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'a', date'2024-01-01', true), (3, 'abc', date'2024-02-01', null), "
        "(null, null, null, false) AS t(n, s, d, f)"
    )
    got = {r.column_name: r for r in profiling.profile_table(df).collect()}
    n, s, d, f = (got[c] for c in "nsdf")
    assert (n.min_value, n.max_value, n.avg_value, n.std_dev, n.distinct_count) == (1.0, 3.0, 2.0, 1.0, 2)
    assert (s.min_length, s.max_length, s.avg_length, s.non_null_count) == (1, 3, 2.0, 2)
    assert (d.min_time, d.max_time, d.min_value) == ("2024-01-01", "2024-02-01", None)
    assert (f.non_null_count, f.distinct_count, f.min_value, f.min_length) == (2, 2, None, None)


def test_samples(spark):
    df = spark.range(1000)
    drawn = sampling.sample_rows(df, 10, seed=3)
    assert drawn.distinct().count() == 10
    assert sorted(drawn.collect()) == sorted(sampling.sample_rows(df, 10, seed=3).collect())
    assert sampling.sample_rows(df, 5000).count() == 1000
    with pytest.raises(ValueError):
        sampling.sample_rows(df, 0)
    assert [r.id for r in sampling.preview(df, 3, order=["id"]).collect()] == [0, 1, 2]
    assert sampling.preview(df, 7, "sample").count() == 7
    with pytest.raises(ValueError):
        sampling.preview(df, 7, "middle")


def test_transformation_over_frames(spark, rows):
    one = elt.transformation(spark, "SELECT count(*) AS n FROM {base}", spark.range(3))
    two = elt.transformation(
        spark, "SELECT a.id FROM {base_0} a JOIN {base_1} b ON a.id = b.id", spark.range(3), spark.range(2)
    )
    assert rows(one) == [(3,)] and rows(two) == [(0,), (1,)]


def test_job_publishes_only_what_passes(spark, rows):
    home = new_dir(spark, "job")

    def run(source, low):
        return elt.elt_job(
            {"t": source},
            f"{home}/landing",
            {"t": lambda d: d.withColumnRenamed("id", "k")},
            lambda staged: staged["t"].agg(F.sum("k").alias("s")),
            lambda d: q.validate_table(d, [q.in_range("s", low)]),
            f"{home}/out",
        )

    assert rows(run(spark.range(4), 0)) == [(6,)]
    with pytest.raises(elt.TestsFailed):
        run(spark.range(5), 100)
    assert rows(spark.read.parquet(f"{home}/out")) == [(6,)]
    assert rows(run(spark.range(5), 0)) == [(10,)]
    assert rows(spark.read.parquet(f"{home}/out_bkp")) == [(6,)]


def test_sync_modes_on_disk(spark, rows):
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (2, 3, "c"), (3, 3, "d")], "k int, t int, v string")
    want = {
        "full_refresh_overwrite": 4,
        "full_refresh_append": 6,
        "incremental_append": 4,
        "incremental_deduped_history": 3,
    }
    for mode, count in want.items():
        path = new_dir(spark, mode)
        how = {"cursor": "t", "keys": ["k"], "tiebreak": ["v"]}
        elt.sync(old, path, mode, **how)
        assert elt.sync(new, path, mode, **how).count() == count, mode
    assert rows(spark.read.parquet(path)) == [(1, 1, "a"), (2, 3, "c"), (3, 3, "d")]


def test_moves(spark):
    a, b = new_dir(spark, "a"), new_dir(spark, "b")
    spark.range(1).write.parquet(a)
    storage.move(spark, a, b)
    assert storage.exists(spark, b) and not storage.exists(spark, a)
    with pytest.raises(Exception):
        storage.move(spark, a, b)
