"""Merges into bucketed tables: as the whole-table merge, with untouched buckets left alone."""

import os

import pytest

from sluiceway.operators import merge as m
from sluiceway.sources import bucketed as b


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, fs in os.walk(path)
        for f in fs
        if f.endswith(".parquet")
    }


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(3000).selectExpr("id AS k", "1 AS version", "cast(id % 7 AS string) AS v")
    b.write_bucketed(df, path, ["k"], 64)
    return path, df


def test_a_small_merge_leaves_other_buckets_alone(spark, table, rows):
    path, old = table
    batch = spark.range(3).selectExpr("id * 1000 AS k", "2 AS version", "'new' AS v").unionByName(
        spark.createDataFrame([(0, 3, "newest"), (9999, 2, "added")], "k long, version int, v string")
    )
    before = files(path)
    touched = b.merge_into(batch, path, ["k"], "merge", "version")
    after = files(path)
    want = rows(m.merge_rows(old, batch, ["k"], "version"), "k", "version", "v")
    assert rows(b.read_bucketed(spark, path), "k", "version", "v") == want
    kept = [f for f in before if after.get(f) == before[f]]
    folders = {os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in kept}
    assert 1 <= touched <= 4 and len(folders) == touched and len(kept) >= 60
    # A replay gives the same table.
    b.merge_into(batch, path, ["k"], "merge", "version")
    assert rows(b.read_bucketed(spark, path), "k", "version", "v") == want


def test_delete_and_insert(spark, table, rows):
    path, old = table
    batch = spark.createDataFrame([(5, 9, "a"), (5, 9, "b"), (7, 9, "c")], "k long, version int, v string")
    b.merge_into(batch, path, ["k"], "delete+insert")
    want = rows(m.delete_insert(old, batch, ["k"]), "k", "version", "v")
    assert rows(b.read_bucketed(spark, path), "k", "version", "v") == want


def test_older_rows_change_nothing_in_a_deduplicating_merge(spark, table, rows):
    path, old = table
    batch = spark.createDataFrame([(5, 0, "older"), (6, 2, "newer")], "k long, version int, v string")
    b.merge_into(batch, path, ["k"], "deduped", "version")
    got = {r.k: r.v for r in b.read_bucketed(spark, path).where("k IN (5, 6)").collect()}
    assert got == {5: "5", 6: "newer"}


def test_null_keys_new_columns_and_narrower_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, v int")
    b.write_bucketed(old, path, ["k"], 8)
    batch = spark.createDataFrame([(None, 9, "x"), (1, 4, "y")], "k int, v int, w string")
    with pytest.raises(ValueError):
        b.merge_into(batch, path, ["k"], "delete+insert")
    b.merge_into(batch, path, ["k"], "delete+insert", on_schema_change="append_new_columns")
    got = sorted(map(tuple, b.read_bucketed(spark, path).select("k", "v", "w").collect()), key=str)
    assert got == [(1, 4, "y"), (None, 1, None), (None, 2, None), (None, 9, "x")]
    wide = spark.createDataFrame([(1, 2**40)], "k long, v long")
    for change in ("append_new_columns", "ignore", "sync_all_columns"):
        with pytest.raises(ValueError):
            b.merge_into(wide, path, ["k"], on_schema_change=change)
    assert b.merge_into(old.limit(0), path, ["k"], on_schema_change="ignore") == 0
    with pytest.raises(ValueError):
        b.bucket_column(old)


def test_syncs(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    one = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string")
    two = one.unionByName(spark.createDataFrame([(2, 5, "d"), (3, 4, "e")], "k int, t int, v string"))
    b.sync_bucketed(one, path, ["k"], "t", buckets=256)
    before = files(path)
    assert b.sync_bucketed(two, path, ["k"], "t") <= 2
    assert rows(b.read_bucketed(spark, path)) == [(1, 2, "b"), (2, 5, "d"), (3, 4, "e")]
    assert any(f in files(path) for f in before)
    assert b.sync_bucketed(two, path, ["k"], "t") == 0


def test_a_missing_table_is_made(spark, tmp_path, rows):
    batch = spark.createDataFrame([(1, 1), (1, 2)], "k int, t int")
    for strategy, want in (("merge", [(1, 2)]), ("deduped", [(1, 2)]), ("delete+insert", [(1, 1), (1, 2)])):
        path = f"{tmp_path}/{strategy}"
        b.merge_into(batch, path, ["k"], strategy, "t", buckets=4)
        assert rows(b.read_bucketed(spark, path)) == want
    with pytest.raises(ValueError):
        b.merge_into(batch, path, ["k"], "upsert")
