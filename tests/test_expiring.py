"""An upsert stream whose rows expire: state forgets, the table tells who is gone."""

import datetime as dt

from sluiceway.streaming import ingest as g

DDL = "k int, at timestamp_ntz, v string, ttl long"


def day(d):
    return dt.datetime(2024, 1, d)


def test_rows_expire_and_come_back(spark, tmp_path):
    path, state, arrivals = (f"{tmp_path}/{n}" for n in ("table", "state", "in"))
    runs = [
        [(1, day(1), "a", 86400), (2, day(1), "b", 0), (3, day(1), "c", None), (None, day(2), "n", 0), (1, day(1), "A", 86400)],
        [(4, day(10), "d", 86400 * 30)],
        [(5, day(11), "e", 86400), (2, day(10), "newer", 0)],
        [(1, day(12), "again", 86400 * 9), (2, day(11), None, 0), (3, day(11), "c2", 86400 * 365)],
        None,
    ]
    seen = []
    for run in runs:
        if run:
            spark.createDataFrame(run, DDL).coalesce(1).write.mode("append").parquet(arrivals)
        stream = g.file_stream(spark, arrivals, spark.createDataFrame([], DDL).schema)
        query = g.stream_upsert_expiring(stream, path, state, ["k"], "at", "ttl", "1 hour", ["v"])
        query.awaitTermination()
        living = g.living_rows(spark, path, ["k"], "at", ["v"])
        seen.append(sorted(((r.k, r.v) for r in living.collect()), key=str))
    assert seen[0] == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]
    # Key 1 is gone once event time has passed its end.
    assert seen[1] == [(2, "b"), (3, "c"), (4, "d"), (None, "n")]
    assert seen[2] == [(2, "newer"), (3, "c"), (4, "d"), (5, "e"), (None, "n")]
    assert seen[3] == seen[4] == [(1, "again"), (2, None), (3, "c2"), (4, "d"), (5, "e"), (None, "n")]
    rows = spark.read.parquet(path)
    assert rows.where("k = 1").count() == 3 and rows.where("_gone").count() == 1
    assert [r.v for r in rows.where("_gone").collect()] == ["a"]
