"""Operators meant for growing tables: closure by doubling, late changes, samples, sketches, wider types."""

import datetime as dt
import itertools
import math
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import row_hash
from sluiceway.operators import history as h
from sluiceway.operators import lineage as li
from sluiceway.operators import merge as m
from sluiceway.operators import sampling as s
from sluiceway.operators import sketches as sk
from sluiceway.operators.profiling import profile_table
from sluiceway.operators.schema import least_common_type


def breadth_first(edges):
    following = {}
    for a, b in edges:
        if a is not None and b is not None:
            following.setdefault(a, set()).add(b)
    out = set()
    for start in following:
        depth, layer, seen = 1, following[start], set()
        while layer:
            out |= {(start, n, depth) for n in layer}
            seen |= layer
            layer = {n for x in layer for n in following.get(x, ())} - seen
            depth += 1
    return out


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(37)],
        [(i, (i + 1) % 12) for i in range(12)] + [(3, 3), (5, 40)],
        [(i, i // 2) for i in range(1, 60)] + [(0, 59), (None, 1), (1, None), (7, 3), (7, 3)],
        [],
    ],
)
def test_closure_of_all(spark, edges):
    frame = spark.createDataFrame(edges, "parent int, child int")
    got = {tuple(r) for r in li.closure_of_all(frame).collect()}
    assert got == breadth_first(edges)
    up = {tuple(r) for r in li.closure_of_all(frame, "upstream").collect()}
    assert up == {(b, a, d) for a, b, d in got}
    one = spark.createDataFrame([(3,)], "source int")
    assert {tuple(r) for r in li.closure_of_all(frame, sources=one).collect()} == {r for r in got if r[0] == 3}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    new_dir = li.new_dir
    monkeypatch.setattr(li, "new_dir", lambda *a: rounds.append(new_dir(*a)) or rounds[-1])
    chain = spark.range(1000).selectExpr("id AS parent", "id + 1 AS child")
    pairs = li.closure_of_all(chain)
    assert pairs.count() == 1000 * 1001 // 2
    assert pairs.agg(F.max("depth")).first()[0] == 1000
    assert len([d for d in os.listdir(rounds[0]) if d.startswith("round=")]) <= 12


@pytest.mark.parametrize("few", [0, 100_000])
def test_ends_are_not_carried_on(spark, monkeypatch, few):
    """Three layers end after the round that finds the last pairs, with known pairs of few sources or all compared."""
    monkeypatch.setattr(li, "_FEW", few)
    rounds = []
    new_dir = li.new_dir
    monkeypatch.setattr(li, "new_dir", lambda *a: rounds.append(new_dir(*a)) or rounds[-1])
    edges = [(0, i) for i in range(1, 5)] + [(i, 10 * i + k) for i in range(1, 5) for k in range(5)] + [(0, 11), (11, 11)]
    pairs = li.closure_of_all(spark.createDataFrame(edges, "parent int, child int"))
    assert {tuple(r) for r in pairs.collect()} == breadth_first(edges)
    rounds.clear()
    pairs = li.closure_of_all(spark.createDataFrame(edges[:-2], "parent int, child int"))
    assert {tuple(r) for r in pairs.collect()} == breadth_first(edges[:-2])
    assert sorted(d for d in os.listdir(rounds[0]) if d.startswith("round=")) == ["round=0", "round=1"]


DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def test_changes_in_any_order_give_one_history(spark, rows):
    ddl = "k int, v string, at timestamp_ntz"
    batches = [
        [(1, "a", DAY[0]), (2, "x", DAY[1]), (None, "n", DAY[1])],
        [(1, "b", DAY[4]), (1, "c", DAY[2]), (3, "y", DAY[3]), (2, None, None)],
        [(1, "a", DAY[0]), (1, "d", DAY[3]), (1, "e", DAY[3]), (None, "m", DAY[2])],
    ]
    want = [
        (None, "m", DAY[2], DAY[2], None), (None, "n", DAY[1], DAY[1], DAY[2]),
        (1, "a", DAY[0], DAY[0], DAY[2]), (1, "b", DAY[4], DAY[4], None),
        (1, "c", DAY[2], DAY[2], DAY[3]), (1, "e", DAY[3], DAY[3], DAY[4]),
        (2, "x", DAY[1], DAY[1], None), (3, "y", DAY[3], DAY[3], None),
    ]
    frames = [spark.createDataFrame(b, ddl) for b in batches]
    for order in itertools.permutations(frames):
        history = None
        for batch in (*order, order[0]):
            history = h.apply_changes(batch, history, ["k"], "at")
        assert sorted(rows(history), key=str) == sorted(want, key=str)


def test_in_order_changes_are_snapshots(spark, rows):
    ddl = "k int, v string, at timestamp_ntz"
    states = [
        spark.createDataFrame([(1, "a", DAY[0]), (2, "b", DAY[0])], ddl),
        spark.createDataFrame([(1, "a", DAY[0]), (2, "c", DAY[3]), (3, "d", DAY[1])], ddl),
    ]
    taken = applied = None
    for state in states:
        taken = h.snapshot(state, taken, ["k"], "timestamp", updated_at="at")
        applied = h.apply_changes(state, applied, ["k"], "at")
    assert rows(taken) == rows(applied)


def hot_rows(spark, n=3000):
    """A third of the rows are copies of one."""
    return spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS a", "CAST(id % 3 AS string) AS b")


@pytest.mark.parametrize("n", [1, 10, 999, 1500, 2999, 3000, 9999])
def test_large_samples_are_those_of_ranking(spark, rows, n):
    df = hot_rows(spark)
    assert rows(s.sample_large(df, n, 3)) == rows(s.sample_rows(df, n, 3))


def test_no_step_gathers_a_large_sample(spark):
    plan = s.sample_large(hot_rows(spark), 1500, 3)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("SinglePartition", "TakeOrdered", "GlobalLimit", "CollectLimit"))
    with pytest.raises(ValueError):
        s.sample_large(hot_rows(spark), 0)
    assert s.sample_large(hot_rows(spark).limit(0), 5).count() == 0


@pytest.mark.parametrize("n", [11_000, 30_000, 59_999, 60_000, 70_000])
def test_ranked_samples_are_whole_and_not_gathered(spark, n):
    df = hot_rows(spark, 60_000)
    drawn = s.sample_rows(df, n, 3)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("SinglePartition", "TakeOrdered", "GlobalLimit", "CollectLimit"))
    order = sorted(df.select(F.xxhash64(F.lit(3), row_hash(df)), "a", "b").collect())
    assert sorted(map(tuple, drawn.collect())) == sorted((a, b) for _, a, b in order[:n])


@pytest.mark.parametrize("n", [1, 7, 400, 5000])
def test_samples_of_strata(spark, n):
    df = hot_rows(spark).unionByName(spark.sql("SELECT 5000 + id AS a, NULL AS b FROM range(20)"))
    drawn = s.sample_per_stratum(df, n, ["b"], seed=4)
    sizes = {r.b: r["count"] for r in df.groupBy("b").count().collect()}
    assert {r.b: r["count"] for r in drawn.groupBy("b").count().collect()} == {b: min(n, c) for b, c in sizes.items()}
    assert drawn.exceptAll(df).isEmpty()
    assert sorted(map(str, drawn.collect())) == sorted(map(str, s.sample_per_stratum(df.repartition(3), n, ["b"], seed=4).collect()))


def table_of_parts(spark, days):
    return spark.createDataFrame(
        [
            (d, i, None if i % 5 == 0 else float(i % 97) - 40, f"t{i % 300}", i % 2 == 0, DAY[i % 9])
            for d in days
            for i in range(d * 100, d * 100 + 500)
        ],
        "day int, i long, x double, t string, flag boolean, at timestamp_ntz",
    )


def test_refreshed_profile_reads_new_parts_only(spark, tmp_path):
    path, kept = f"{tmp_path}/t", f"{tmp_path}/kept"
    table_of_parts(spark, [1, 2]).write.partitionBy("day").parquet(path)
    sk.refresh_profile(spark.read.parquet(path), "day", kept)
    for day in (1, 2):
        folder = f"{path}/day={day}"
        for f in os.listdir(folder):
            os.truncate(f"{folder}/{f}", 0) if f.startswith("part") or f.startswith(".part") else None
    # Files of known days can't be read any more.
    table_of_parts(spark, [3]).write.mode("append").partitionBy("day").parquet(path)
    schema = spark.read.parquet(f"{path}/day=3").schema.add("day", T.IntegerType())
    grown = {r.column_name: r for r in sk.refresh_profile(spark.read.schema(schema).parquet(path), "day", kept).collect()}
    whole = table_of_parts(spark, [1, 2, 3])
    exact = {r.column_name: r for r in profile_table(whole).collect()}
    apart = {r.column_name: r for r in sk.profile_of_sketches(sk.sketch_parts(whole, F.lit(1))).collect()}
    for name in whole.columns:
        g, e = grown[name], exact[name]
        assert g.total_rows == 1500 and g.non_null_count == e.non_null_count
        for c in ("min_value", "max_value", "avg_value", "std_dev", "avg_length"):
            assert (g[c] is None) == (e[c] is None) and (g[c] is None or math.isclose(g[c], e[c], rel_tol=1e-9))
        assert (g.min_length, g.max_length, g.min_time, g.max_time) == (e.min_length, e.max_length, e.min_time, e.max_time)
        assert abs(g.distinct_count - e.distinct_count) <= 0.03 * e.distinct_count + 1
        # Sketched in parts or whole: the same distinct counts.
        assert g.distinct_count == apart[name].distinct_count
    assert abs(grown["i"].median - 449) < 30 and grown["t"].median is None
    again = sk.refresh_profile(spark.read.schema(schema).parquet(path), "day", kept)
    assert {r.column_name: r.total_rows for r in again.collect()}["i"] == 1500


def test_sketches_of_nulls_and_nothing(spark, tmp_path):
    nulls = spark.createDataFrame([(None, None), (1, None), (None, None)], "p int, x double")
    got = {r.column_name: r for r in sk.refresh_profile(nulls, "p", f"{tmp_path}/k").collect()}
    assert (got["x"].total_rows, got["x"].non_null_count, got["x"].distinct_count, got["x"].median) == (3, 0, 0, None)
    assert got["p"].non_null_count == 1 and got["p"].max_value == 1.0
    again = {r.column_name: r for r in sk.refresh_profile(nulls, "p", f"{tmp_path}/k").collect()}
    assert again["x"].total_rows == 3
    assert sk.profile_of_sketches(sk.sketch_parts(nulls.limit(0), F.col("p"))).count() == 0


@pytest.mark.parametrize(
    "a, b, kind, lossless",
    [
        ("int", "bigint", "bigint", True),
        ("tinyint", "smallint", "smallint", True),
        ("int", "double", "double", True),
        ("bigint", "double", "double", False),
        ("float", "double", "double", True),
        ("decimal(10,2)", "int", "decimal(12,2)", True),
        ("decimal(10,2)", "decimal(12,6)", "decimal(14,6)", True),
        ("decimal(38,0)", "decimal(20,10)", "decimal(38,0)", False),
        ("decimal(12,2)", "double", "double", True),
        ("decimal(30,2)", "double", "double", False),
        ("date", "timestamp_ntz", "timestamp_ntz", True),
        ("timestamp", "timestamp_ntz", "timestamp", False),
        ("int", "string", "string", True),
        ("boolean", "int", "string", True),
        ("binary", "string", "string", False),
        ("array<int>", "array<bigint>", "array<bigint>", True),
        ("struct<a:int>", "struct<a:string>", "struct<a:string>", True),
        ("struct<a:int>", "struct<b:int>", "string", False),
        ("map<string,int>", "map<string,double>", "map<string,double>", True),
        ("array<int>", "int", "string", False),
    ],
)
def test_least_common_types(a, b, kind, lossless):
    x, y = (T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b))
    for got in (least_common_type(x, y), least_common_type(y, x)):
        assert (got.type.simpleString(), got.lossless) == (kind, lossless)
    assert least_common_type(T.NullType(), x).type == x


def test_types_never_get_narrower(spark, rows):
    narrow, wide = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2**40,)], "k bigint")
    for how in ("append_new_columns", "sync_all_columns"):
        assert rows(m.incremental(wide, narrow, "append", on_schema_change=how)) == [(1,), (2**40,)]
    with pytest.raises(ValueError, match="could be lost"):
        m.incremental(wide, narrow, "append", on_schema_change="ignore")
    with pytest.raises(ValueError, match="could be lost"):
        m.incremental(narrow, wide, "append", on_schema_change="sync_all_columns")
    kept = m.incremental(narrow, wide, "append", on_schema_change="ignore")
    assert rows(kept) == [(1,), (2**40,)] and kept.dtypes == [("k", "bigint")]
    floats = spark.createDataFrame([(0.5,)], "k double")
    with pytest.raises(ValueError, match="bigint and double"):
        m.incremental(floats, wide, "append", on_schema_change="append_new_columns")
    texts = spark.createDataFrame([("x",)], "k string")
    assert rows(m.incremental(texts, narrow, "append", on_schema_change="append_new_columns")) == [("1",), ("x",)]
