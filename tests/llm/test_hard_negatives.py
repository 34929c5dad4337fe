import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import hard_negatives, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50):
    """By comparing every anchor with every row."""
    taking = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taking.append((vec_id, [math.floor(256 * x) for x in vector], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for a_id, a, a_label in taking:
        if a_id is None or a_id % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), i, label) for i, v, label in taking if i != a_id]
        order = sorted(scored, key=lambda s: (-s[0], last(s[1])))
        for p_score, p_id, _ in [s for s in order if s[2] == a_label][:5]:
            fits = [s for s in order if s[2] != a_label and 50 * p_score <= 100 * s[0] <= 95 * p_score][:3]
            out += [(a_id, p_id, r, n_id, p_score, n_score) for r, (n_score, n_id, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def ours(frame, every=50):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(frame, label, F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=str)


def plain(frame):
    return [(r.vec_id, r.embedding, r.label) for r in frame.collect()]


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    v = centres[rng.integers(0, 12, n)] + 0.15 * rng.normal(size=(n, dims))
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, 10))) for i in range(n)]


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 2), (5, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), axis=-1).reshape(-1, dims)
        keys = [k.tobytes() for k in hard_negatives.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        along = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_all_scores():
    rng = np.random.default_rng(3)
    anchors, rows = rng.integers(-99, 99, (20, 9)), rng.integers(-99, 99, (50, 9))
    low, high = rows.min(axis=0), rows.max(axis=0)
    least, most = hard_negatives.reach(anchors, low[None], high[None])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()
    same = np.repeat(rows[:1], 2, axis=0)
    exact = hard_negatives.reach(anchors, same.min(axis=0)[None], same.max(axis=0)[None])
    assert (exact[0] == exact[1]).all() and (exact[0][:, 0] == anchors @ rows[0]).all()


def test_query_over_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = queries.QUERIES["op11_hilbert_hard_negatives"](spark, SF)
    assert dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect()), key=str) == brute(plain(table))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "PART_BLOCKS", 3)
    monkeypatch.setattr(hard_negatives, "GROUP_PARTS", 2)


def test_many_blocks_of_clusters(spark, small_blocks):
    frame = spark.createDataFrame(clustered(900, 6, 1), SCHEMA)
    got = ours(frame, 20)
    assert got == brute(plain(frame), 20) and got


def test_blocks_are_left_out(spark, small_blocks, monkeypatch):
    """Of well-parted clusters, an anchor's windows read a few blocks only."""
    read, settle = [], hard_negatives.settle

    def counted(df, label):
        made = settle(df, label)
        if label == "blocks-to-read":
            read.append(made.count())
        return made

    monkeypatch.setattr(hard_negatives, "settle", counted)
    rows = [(i, [(i % 8 == d) * 1.0 + 0.01 * ((i * 7 + d) % 5) for d in range(8)], i // 8 % 2) for i in range(1600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert ours(frame, 400) == brute(rows, 400)
    blocks = 1600 / 16
    groups = 17
    assert read[0] < 0.5 * blocks * groups


def test_ties_repeats_and_great_values(spark, small_blocks):
    rows = [(i, [1.0, 0.5, 0.0], i % 3) for i in range(200)]
    rows += [(50, [1.0, 0.5, 0.0], 2), (7, [9.0, 9.0, 9.0], 1), (7, [9.0, 9.0, 9.0], 1)]
    rows += [(1000 + i, [3e5 * (i % 4), -2e4, 1.5], i % 2) for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert ours(frame) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.1 * (i % 11), 0.3, -0.2 * (i % 5)], i % 4) for i in range(120)]
    rows += [(None, [5.0, 5.0, 5.0], 1), (None, [0.4, 0.3, 0.1], None), (300, None, 1), (350, [], 2), (400, [1.0], 0)]
    rows += [(450, [None, 1.0, 1.0], 1), (500, [nan, 1.0, 1.0], 1), (550, [inf, 0.0, 0.0], 1), (600, [1.0, 1.0, 1.0], 3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    # Names that the operator uses inside, as extra columns.
    clash = frame.select("*", *[F.lit(1).alias(c) for c in ("anchor", "part", "block", "score", "goals", "q", "grp")])
    assert ours(clash) == brute(rows)


def test_empty_tables_and_empty_vectors(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []
    assert ours(spark.createDataFrame([(0, None, 1), (50, [1.0], None)], SCHEMA)) == []
    rows = [(i, [], i % 2) for i in range(10)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_floats_and_many_dimensions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=300)], i % 3) for i in range(80)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int")
    assert ours(frame, 10) == brute(rows, 10)
