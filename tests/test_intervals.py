"""Interval joins against comparing all pairs, and their plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import joins as j

NESTED = ("BroadcastNestedLoopJoin", "CartesianProduct")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute(points, intervals):
    return sorted(
        (p, i)
        for p, x in points
        for i, lo, hi in intervals
        if x is not None and (lo is None or x >= lo) and (hi is None or x < hi)
    )


def some(rng, n, scale):
    out = []
    for i in range(n):
        lo = rng.choice([None, rng.randint(-scale, scale)]) if rng.random() < 0.2 else rng.randint(-scale, scale)
        length = int(scale * 10 ** rng.uniform(-4, 0.3))
        hi = None if rng.random() < 0.15 else (lo or 0) + rng.choice([0, -3, length, length, length])
        out.append((i, lo, hi))
    return out


@pytest.mark.parametrize("scale", [5, 1000, 10**12])
def test_inner_and_left(spark, scale):
    rng = random.Random(scale)
    points = [(i, None if i % 17 == 0 else rng.randint(-2 * scale, 2 * scale)) for i in range(200)]
    intervals = some(rng, 80, scale)
    p = spark.createDataFrame(points, "p long, x long")
    i = spark.createDataFrame(intervals, "i long, lo long, hi long")
    met = j.interval_join(p, i, "x", "lo", "hi")
    want = brute(points, intervals)
    assert sorted((r.p, r.i) for r in met.collect()) == want
    assert met.columns == ["p", "x", "i", "lo", "hi"]
    assert not any(n in plan_of(met) for n in NESTED)
    left = j.interval_join(p, i, "x", "lo", "hi", how="left")
    alone = {p for p, _ in points} - {p for p, _ in want}
    got = sorted(((r.p, r.i) for r in left.collect()), key=str)
    assert got == sorted([*want, *((p, None) for p in alone)], key=str)


def test_further_conditions_fractions_and_times(spark):
    rng = random.Random(2)
    start = dt.datetime(2024, 3, 31)
    points = [(k, k % 3, start + dt.timedelta(seconds=rng.uniform(-9e5, 9e5)), rng.uniform(-1, 1)) for k in range(150)]
    spans = [(k, k % 3, start + dt.timedelta(hours=k), start + dt.timedelta(hours=k + k % 50), -0.5, k / 60) for k in range(60)]
    p = spark.createDataFrame(points, "p long, g long, at timestamp_ntz, x double")
    i = spark.createDataFrame(spans, "i long, h long, since timestamp_ntz, until timestamp_ntz, lo double, hi double")
    for kind in ("timestamp_ntz", "timestamp", "date"):
        a, b = p.withColumn("at", F.col("at").cast(kind)), i.withColumns({c: F.col(c).cast(kind) for c in ("since", "until")})
        got = j.interval_join(a, b, "at", "since", "until", on="g = h")
        want = a.crossJoin(b).where("g = h AND at >= since AND at < until")
        assert sorted((r.p, r.i) for r in got.collect()) == sorted((r.p, r.i) for r in want.collect())
    got = j.interval_join(p, i, "x", "lo", "hi", on=F.col("g") != F.col("h"))
    want = sorted((a[0], b[0]) for a in points for b in spans if a[1] != b[1] and b[4] <= a[3] < b[5])
    assert sorted((r.p, r.i) for r in got.collect()) == want


def test_no_rows_open_bounds_and_refusals(spark):
    p = spark.createDataFrame([(1, 5), (2, None)], "p int, x int")
    none = spark.createDataFrame([], "lo int, hi int")
    assert j.interval_join(p, none, "x", "lo", "hi").collect() == []
    assert [tuple(r) for r in j.interval_join(p, none, "x", "lo", "hi", how="left").orderBy("p").collect()] == [
        (1, 5, None, None),
        (2, None, None, None),
    ]
    everything = spark.createDataFrame([(None, None)], "lo int, hi int")
    assert j.interval_join(p, everything, "x", "lo", "hi").count() == 1
    same = spark.createDataFrame([(5, 6), (5, 5), (6, 5)], "lo int, hi int")
    assert j.interval_join(p, same, "x", "lo", "hi").count() == 1
    with pytest.raises(ValueError):
        j.interval_join(p, same, "x", "lo", "hi", how="full")
    with pytest.raises(ValueError):
        j.interval_join(p.withColumn("x", F.col("x").cast("string")), same, "x", "lo", "hi")


def test_in_a_chain(spark):
    """Frames with equal column names, an interval step between two plain ones."""
    orders = spark.createDataFrame([(1, 10, 3), (2, 20, 9), (3, 10, 50)], "id int, customer int, day int")
    prices = spark.createDataFrame([(1, 0, 5), (2, 5, 10), (3, 8, None)], "id int, day int, until int")
    names = spark.createDataFrame([(10, "ten")], "id int, name string")
    chain = [j.Join(prices, "p", within=("o.day", "p.day", "p.until")), j.Join(names, "n", "o.customer = n.id")]
    out = j.join_chain(orders, "o", chain, ["o.id", "p.id AS price", "n.name"])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 1, "ten"), (2, 2, None), (2, 3, None), (3, 3, "ten")]
    assert not any(n in plan_of(out) for n in NESTED)
    inner = [j.Join(prices.where("id = 1"), "p", how="inner", within=("o.day", "p.day", "p.until"))]
    assert j.join_chain(orders, "o", inner).collect()[0].asDict() is not None
    assert j.join_chain(orders, "o", inner, ["o.id"]).collect() == [(1,)]
    assert j.join_chain(orders, "o", inner, ["count(*) AS n"], group_by=["o.customer"]).collect() == [(10, 1)]


def test_long_intervals_take_few_rows(spark):
    """Candidates stay near the result, however different the lengths."""
    wide = spark.createDataFrame([(0, 10**9), (5, 6)], "lo long, hi long")
    points = spark.range(0, 10**9, 10**6).withColumnRenamed("id", "x")
    met = j.interval_join(points, wide, "x", "lo", "hi")
    assert met.count() == 1000
    assert "BroadcastNestedLoopJoin" not in plan_of(met)


def counted_by_pairs(points, intervals, how):
    """(t, status) -> (rows, rows with a v, different ids, different tags) over all pairs."""
    found = {}
    for t, x, v, n, ident in points:
        held = [(s, tag) for s, lo, hi, tag in intervals if n < 2 and x is not None and (lo is None or x >= lo) and (hi is None or x < hi)]
        for s, tag in held or ([(None, None)] if how == "left" else []):
            found.setdefault((t, s), []).append((v, ident, tag))
    return {
        k: (len(r), sum(v is not None for v, _, _ in r), len({i for _, i, _ in r} - {None}), len({t for _, _, t in r} - {None}))
        for k, r in found.items()
    }


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("scale", [5, 1000, 10**12])
def test_grouped_counts_equal_those_over_pairs(spark, scale, how):
    rng = random.Random(scale)
    points = [
        (rng.choice("ab"), None if i % 17 == 0 else rng.randint(-2 * scale, 2 * scale), rng.choice([None, 1]), rng.randint(0, 2), rng.choice([None, i // 2]))
        for i in range(200)
    ]
    intervals = [(rng.choice(["s", "t", None]), lo, hi, rng.choice([None, 1, 2])) for _, lo, hi in some(rng, 80, scale)]
    p = spark.createDataFrame(points, "t string, x long, v int, n int, id int")
    i = spark.createDataFrame(intervals, "status string, lo long, hi long, tag int")
    columns = ["p.t", "i.status", "count(*) AS n", "count(p.v) AS v", "count(DISTINCT p.id) AS ids", "count(DISTINCT i.tag) AS tags"]
    step = j.Join(i, "i", "p.n < 2", how, within=("p.x", "i.lo", "i.hi"))
    got = j.join_chain(p, "p", [step], columns, group_by=["p.t", "i.status"])
    assert got.columns == ["t", "status", "n", "v", "ids", "tags"]
    found = {(r.t, r.status): (r.n, r.v, r.ids, r.tags) for r in got.collect()}
    assert found == counted_by_pairs(points, intervals, how)


def test_grouped_counts_form_no_pairs(spark):
    """Every point lies in every interval: 9 million pairs, of which no operator sees a hundredth."""
    p = spark.range(3000).selectExpr("id", "CAST(id % 7 AS DOUBLE) + id / 1e6 AS x")
    i = spark.range(3000).selectExpr("id AS i", "-1.0 - id AS lo", "CASE WHEN id % 2 = 0 THEN 100.0 + id END AS hi")
    step = j.Join(i, "i", how="inner", within=("p.x", "i.lo", "i.hi"))
    out = j.join_chain(p, "p", [step], ["count(*) AS n"], group_by=["i.i"])
    assert {(r.n) for r in out.collect()} == {3000} and out.count() == 3000
    assert max(rows_put_out(out)) < 90_000


def rows_put_out(df):
    """The rows that every operator of a finished plan put out."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            found.append(metric.get().value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def grouped_by_interval(points, intervals, how):
    """tag -> (different values, different values of t, rows) over all pairs."""
    found = {}
    for t, x, v in points:
        held = [tag for tag, lo, hi in intervals if x is not None and (lo is None or x >= lo) and (hi is None or x < hi)]
        for tag in held or ([None] if how == "left" else []):
            found.setdefault(tag, []).append((v, t))
    return {k: (len({v for v, _ in r} - {None}), len({t for _, t in r} - {None}), len(r)) for k, r in found.items()}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("scale", [5, 1000, 10**12])
def test_distinct_values_per_interval_equal_those_over_pairs(spark, scale, how):
    """Groups of one interval, of repeated, nested, overlapping and separate ones; null groups, values and places."""
    rng = random.Random(scale)
    points = [(rng.choice(["a", "b", None]), None if i % 17 == 0 else rng.randint(-2 * scale, 2 * scale), rng.choice([None, *range(12)])) for i in range(200)]
    once = some(rng, 60, scale)
    intervals = [*once, *once[:20], *[(rng.choice([None, *range(100, 110)]), lo, hi) for _, lo, hi in some(rng, 40, scale)]]
    intervals += [(200, -scale, scale), (200, -scale, 0), (200, 0, scale), (201, None, None), (202, 5, 5)]
    p = spark.createDataFrame(points, "t string, x long, v int")
    i = spark.createDataFrame(intervals, "tag int, lo long, hi long")
    step = j.Join(i, "i", how=how, within=("p.x", "i.lo", "i.hi"))
    columns = ["i.tag", "count(DISTINCT p.v) AS vs", "count(DISTINCT p.t) AS ts", "count(*) AS n"]
    want = grouped_by_interval(points, intervals, how)
    got = j.join_chain(p, "p", [step], columns, group_by=["i.tag"])
    assert got.columns == ["tag", "vs", "ts", "n"]
    assert {r.tag: (r.vs, r.ts, r.n) for r in got.collect()} == want
    alone = j.join_chain(p, "p", [step], columns[1:2], group_by=["i.tag"])
    assert {r.tag: r.vs for r in alone.collect()} == {k: w[0] for k, w in want.items()}


def test_distinct_values_per_interval_meet_no_groups(spark):
    """3000 values within each of 3000 groups: no operator of the plan sees a thirtieth of the 9 million."""
    p = spark.range(3000).selectExpr("id", "CAST(id % 7 AS DOUBLE) + id / 1e6 AS x")
    i = spark.range(3000).selectExpr("id AS i", "-1.0 - id AS lo", "CASE WHEN id % 2 = 0 THEN 100.0 + id END AS hi")
    step = j.Join(i, "i", how="inner", within=("p.x", "i.lo", "i.hi"))
    out = j.join_chain(p, "p", [step], ["count(DISTINCT p.id) AS n"], group_by=["i.i"])
    assert {r.n for r in out.collect()} == {3000} and out.count() == 3000
    assert max(rows_put_out(out)) < 300_000
