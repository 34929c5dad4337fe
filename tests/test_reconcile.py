"""Reconciliation: lost values must differ, equal values of other types must not; keys found by digests."""

import datetime as dt
from decimal import Decimal

import pytest

from sluiceway.operators import quality as q
from sluiceway.sources import bucketed


def one(spark, source, target, **how):
    src = spark.createDataFrame([(1, source[0])], f"k int, v {source[1]}")
    tgt = spark.createDataFrame([(1, target[0])], f"k int, v {target[1]}")
    keyed = q.reconcile(src, tgt, ["k"], unconverted=True).first()
    whole = q.reconcile(src, tgt, unconverted=True).first()
    assert keyed.matched == whole.matched and keyed.different_keys == (not keyed.matched)
    assert keyed.unconverted_cells == whole.unconverted_cells
    return keyed.matched, keyed.unconverted_cells


DIFFERENT = [
    (("abc", "string"), (None, "int")),
    (("abc", "string"), (None, "double")),
    (("1.5", "string"), (1, "int")),
    (("0.105", "string"), (Decimal("0.11"), "decimal(15,2)")),
    (("2024-01-01 10:00:00", "string"), (dt.date(2024, 1, 1), "date")),
    (("not a day", "string"), (None, "date")),
    (("", "string"), (None, "int")),
    ((2**53 + 1, "bigint"), (float(2**53), "double")),
    ((1, "bigint"), (1.5, "double")),
    ((2**62, "bigint"), (float("inf"), "double")),
    ((0, "bigint"), (float("nan"), "double")),
    ((0.105, "double"), (Decimal("0.11"), "decimal(15,2)")),
    ((Decimal(2**53 + 1), "decimal(20,0)"), (float(2**53), "double")),
    ((10**18, "bigint"), (None, "decimal(38,30)")),
    ((300, "int"), (44, "tinyint")),
    (("x", "string"), (None, "string")),
]
EQUAL = [
    (("1", "string"), (1, "int")),
    ((" 12 ", "string"), (12, "bigint")),
    (("0.1", "string"), (0.1, "double")),
    (("0.10", "string"), (Decimal("0.1"), "decimal(15,2)")),
    (("2024-01-01", "string"), (dt.date(2024, 1, 1), "date")),
    (("2024-01-01 10:00:00", "string"), (dt.datetime(2024, 1, 1, 10), "timestamp_ntz")),
    ((2**53, "bigint"), (float(2**53), "double")),
    ((7, "tinyint"), (7, "bigint")),
    ((0.1, "double"), (Decimal("0.10"), "decimal(15,2)")),
    ((dt.date(2024, 1, 1), "date"), (dt.datetime(2024, 1, 1), "timestamp_ntz")),
    ((None, "string"), (None, "int")),
]


@pytest.mark.parametrize("source, target", DIFFERENT)
def test_lost_values_differ(spark, source, target):
    assert not one(spark, source, target)[0] and not one(spark, target, source)[0]


@pytest.mark.parametrize("source, target", EQUAL)
def test_equal_values_of_other_types_agree(spark, source, target):
    assert one(spark, source, target) == (True, 0) and one(spark, target, source) == (True, 0)


def test_cells_that_did_not_convert_are_counted(spark):
    src = spark.createDataFrame([("1", "abc"), ("2", "7"), ("x", None)], "k string, v string")
    tgt = spark.createDataFrame([(1, None), (2, 7), (None, None)], "k int, v int")
    found = q.reconcile(src, tgt, ["k"], unconverted=True).first()
    # The key "x" did not convert: it is missing, and the null key is extra.
    assert (found.missing_keys, found.extra_keys, found.different_keys) == (1, 1, 1)
    assert found.unconverted_cells == 2 and not found.matched
    same = q.reconcile(src, src, ["k"], unconverted=True).first()
    assert same.matched and same.unconverted_cells == 0


def faults(spark, n=600):
    src = spark.range(n).selectExpr("id AS k", "id % 9 AS v", "cast(id AS string) AS w")
    tgt = src.where("k % 100 <> 5").selectExpr("k", "CASE WHEN k % 150 = 1 THEN -1 ELSE v END AS v", "w")
    tgt = tgt.unionByName(spark.range(3).selectExpr("-1 - id AS k", "0 AS v", "'new' AS w"))
    tgt = tgt.unionByName(src.where("k = 17"))
    want = [(k, "missing", 1, 0) for k in range(5, n, 100)] + [(k, "different", 1, 1) for k in range(1, n, 150)]
    want += [(-1 - i, "extra", 0, 1) for i in range(3)] + [(17, "different", 1, 2)]
    return src, tgt, sorted(want)


@pytest.mark.parametrize("buckets, leaves", [(1, 1), (8, 4), (256, 64)])
def test_keys_that_differ(spark, buckets, leaves):
    src, tgt, want = faults(spark)
    assert sorted(map(tuple, q.differing_keys(src, tgt, ["k"], buckets, leaves).collect())) == want
    assert q.differing_keys(src, src, ["k"], buckets, leaves).isEmpty()


def test_keys_of_other_types_and_null_keys(spark):
    src = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), (None, "d")], "k string, v string")
    tgt = spark.createDataFrame([(1, "a"), (None, "c"), (None, "e")], "k int, v string")
    got = q.differing_keys(src, tgt, ["k"], 16, 4)
    assert got.columns == ["k", "k as text", "state", "source_rows", "target_rows"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        (None, "x", "missing", 1, 0),
        (None, None, "different", 1, 1),
    ]
    empty = src.limit(0)
    assert q.differing_keys(empty, empty, ["k"]).isEmpty()
    assert {r.state for r in q.differing_keys(src, empty, ["k"]).collect()} == {"missing"}


def test_only_differing_buckets_are_read_again(spark, tmp_path):
    src = spark.range(2000).selectExpr("id AS k", "id % 9 AS v")
    tgt = src.selectExpr("k", "CASE WHEN k = 77 THEN -1 ELSE v END AS v")
    for name, df in (("a", src), ("b", tgt)):
        bucketed.write_bucketed(df, f"{tmp_path}/{name}", ["k"], 32)
    kept = [bucketed.read_bucketed(spark, f"{tmp_path}/{name}", with_bucket=True) for name in "ab"]
    got = q.differing_keys(*kept, ["k"], leaves=8, bucket_column=bucketed.bucket_column(kept[0]))
    assert [tuple(r) for r in got.collect()] == [(77, "different", 1, 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "_bucket_of_32" in line and "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(_bucket_of_32" in line for line in scans)


def test_digests_add_up(spark):
    src, tgt, _ = faults(spark)
    rows = q.bucket_digests(src, ["k"], 8, 4).collect()
    assert len(rows) <= 32 and sum(r.n for r in rows) == src.count()
    again = q.bucket_digests(src.repartition(5), ["k"], 8, 4).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
