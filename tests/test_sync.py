import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import history as h
from sluiceway.operators import latest, lineage, runs
from sluiceway.operators import matching as mt
from sluiceway.operators import merge as m
from sluiceway.runtime import new_dir
from sluiceway.streaming import ingest as g


@pytest.mark.parametrize(
    "source, dest, mode",
    [
        ("incremental", "append_dedup", "incremental_deduped_history"),
        ("incremental", "overwrite_dedup", "incremental_deduped_history"),
        ("INCREMENTAL", None, "incremental_append"),
        ("incremental", "overwrite", "incremental_append"),
        ("full_refresh", "deduped_history", "full_refresh_overwrite"),
        ("full_refresh", "append", "full_refresh_append"),
        ("full_refresh", "whatever", "full_refresh_overwrite"),
        (None, None, "full_refresh_append"),
    ],
)
def test_sync_mode_names(source, dest, mode):
    assert m.resolve_sync_mode(source, dest) == mode


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (None, 5, "n")], "k int, t int, v string")


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(
        [(2, 20, "same"), (2, 30, "c"), (3, 25, "d"), (3, 40, "e"), (None, 50, "m"), (None, 50, "m")],
        "k int, t int, v string",
    )


def test_cursor_is_strict_and_found_case_blind(target, batch, rows):
    assert rows(m.rows_after(batch, target, "T"), "t") == [(25,), (30,), (40,), (50,), (50,)]
    assert m.rows_after(batch, target, "t", lookback=1).count() == 6
    assert m.rows_after(batch, target.filter("false"), "t").count() == 6
    for bad in (None, "nope"):
        with pytest.raises(m.CursorError):
            m.rows_after(batch, target, bad)


def test_cursor_filter_reaches_the_scan(spark, target):
    path = new_dir(spark, "pushdown")
    spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2)], "ts timestamp_ntz").write.parquet(path)
    src = spark.read.parquet(path)
    out = m.rows_after(src, src.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")), "ts")
    assert "GreaterThan(ts,2024-01-01T00:00)" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "UTC"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_cursor_loses_no_rows_in_any_zone(spark, zone, kind):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        def at(*moments):
            texts = spark.createDataFrame([(i, t) for i, t in enumerate(moments)], "id int, t string")
            return texts.select("id", F.col("t").cast(kind).alias("ts"))

        tgt = at("2024-03-10 10:00:00", "2024-03-10 12:00:00.000001")
        src = at("2024-03-10 10:00:00", "2024-03-10 12:00:00.000001", "2024-03-10 12:00:00.000002", "2024-11-03 01:30:00")
        assert sorted(r.id for r in m.rows_after(src, tgt, "ts").collect()) == [2, 3]
        back = dt.timedelta(microseconds=1)
        assert sorted(r.id for r in m.rows_after(src, tgt, "ts", back).collect()) == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cursors_of_other_types(spark):
    for kind, low, high in (("decimal(12,3)", "1.001", "1.002"), ("date", "2024-01-01", "2024-01-02"), ("double", "1.5", "2.5"), ("string", "a", "b")):
        src = spark.createDataFrame([(low,), (high,)], "t string").select(F.col("t").cast(kind).alias("c"))
        tgt = src.limit(1)
        assert m.rows_after(src, tgt, "c").count() == 1


def test_repeated_keys_without_a_cursor_are_refused(target, batch):
    with pytest.raises(Exception, match="is repeated"):
        m.merge_rows(target, batch, ["k"]).collect()
    once = batch.filter("t IN (30, 40, 50)")
    assert m.merge_rows(target, once, ["k"]).count() == 6


def test_merge(target, batch, rows):
    out = m.incremental(batch, target, "merge", cursor="t", unique_key=["k"])
    assert rows(out) == [
        (None, 5, "n"),
        (None, 50, "m"),
        (None, 50, "m"),
        (1, 10, "a"),
        (2, 30, "c"),
        (3, 40, "e"),
    ]


def test_merge_replay_changes_nothing(target, batch, rows):
    keyed = batch.filter("k IS NOT NULL")
    once = m.merge_rows(target, keyed, ["k"], "t")
    assert rows(m.merge_rows(once, keyed, ["k"], "t")) == rows(once)


def test_delete_insert_keeps_repeats(target, batch, rows):
    out = m.incremental(batch.filter("k IS NOT NULL"), target, "delete+insert", unique_key=["k"])
    assert rows(out, "k", "v") == [(None, "n"), (1, "a"), (2, "c"), (2, "same"), (3, "d"), (3, "e")]


def test_strategy_arguments(target, batch):
    with pytest.raises(ValueError):
        m.incremental(batch, target, "merge")
    with pytest.raises(ValueError):
        m.incremental(batch, target, "upsert", unique_key=["k"])
    with pytest.raises(ValueError):
        m.sync_rows(batch, target, "incremental_deduped_history", cursor="t")
    with pytest.raises(ValueError):
        m.sync_rows(batch, target, "mirror", cursor="t")


def test_small_batches_do_not_shuffle_the_target(spark):
    """A broadcast only where the batch proves to be small."""
    big, small = new_dir(spark, "big"), new_dir(spark, "batch")
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(big)
    spark.range(5).withColumnRenamed("id", "k").write.parquet(small)
    out = m.delete_insert(spark.read.parquet(big), spark.read.parquet(small), ["k"])
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1000


def test_deduped_target_gives_the_same_state(spark, rows):
    ddl = "k int, t int, v string"
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (None, 1, "n")], ddl)
    src = spark.createDataFrame([(1, 1, "a"), (2, 3, "c"), (2, 4, "d"), (3, 4, "e"), (None, 5, "m")], ddl)
    mode, how = "incremental_deduped_history", {"cursor": "t", "keys": ["k"], "tiebreak": ["v"]}
    # Null keys match nothing, as in a merge.
    want = [(None, 1, "n"), (None, 5, "m"), (1, 1, "a"), (2, 4, "d"), (3, 4, "e")]
    assert rows(m.sync_rows(src, old, mode, **how)) == want
    assert rows(m.sync_rows(src, old, mode, **how, target_is_deduped=True)) == want


def test_schema_changes(spark, rows):
    old = spark.createDataFrame([(1, "a")], "k int, gone string")
    new = spark.createDataFrame([(2, 5)], "k int, came int")
    with pytest.raises(ValueError):
        m.incremental(new, old, "append")
    with pytest.raises(ValueError):
        m.evolve(old, new, "guess")
    want = {
        "ignore": [("k", "gone"), [(1, "a"), (2, None)]],
        "append_new_columns": [("k", "gone", "came"), [(1, "a", None), (2, None, 5)]],
        "sync_all_columns": [("k", "came"), [(1, None), (2, 5)]],
    }
    for mode, (columns, content) in want.items():
        out = m.incremental(new, old, "append", on_schema_change=mode)
        assert tuple(out.columns) == columns and rows(out) == content
    wider = spark.createDataFrame([(2**40, "b")], "k bigint, gone string")
    synced = m.incremental(wider, old, "append", on_schema_change="sync_all_columns")
    assert rows(synced) == [(1, "a"), (2**40, "b")]


def test_expiry(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES ('never', null), ('zero', 0), ('edge', 3600), ('old', 3599), ('young', 7200) "
        "AS t(k, ttl_seconds)"
    ).withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    kept = m.drop_expired(df, dt.datetime(2024, 1, 1, 1))
    assert rows(kept, "k") == [("edge",), ("never",), ("young",), ("zero",)]


def test_upsert_log(spark, rows):
    ddl = "id string, status string, at int"
    log = spark.createDataFrame([("a", "running", 9), ("b", "success", 1)], ddl)
    new = spark.createDataFrame([("a", "failed", 2), ("c", "running", 1), ("c", "success", 2)], ddl)
    assert rows(m.upsert_log(log, new, ["id"], "at")) == [("a", "failed", 2), ("b", "success", 1), ("c", "success", 2)]


def test_idempotent_append(spark, rows):
    batch = spark.createDataFrame([("load", "1"), ("load", "2"), ("load", "2")], "name string, key string")
    none = spark.createDataFrame([], "request_id string")
    first = m.idempotent_append(batch, none, "name", "key")
    assert rows(first, "key") == [("1",), ("2",)]
    assert m.idempotent_append(batch, first, "name", "key").count() == 0


def test_newest_rows_are_cut_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 2, "z"), (2, None, "n")], "k int, t int, v string")
    out = latest.keep_latest(df, ["k"], "t", ["v"])
    assert rows(out) == [(1, 2, "z"), (2, None, "n")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert rows(latest.newest_n(df, ["k"], "t", 2, ["v"]), "v") == [("n",), ("y",), ("z",)]


def replay(states, changed):
    """Type-2 history by hand: {key: [[row, from, to], ...]}."""
    kept = {}
    for when, state in states:
        for key, row in state.items():
            versions = kept.setdefault(key, [])
            if not versions:
                versions.append([row, when(row), None])
            elif changed(versions[-1][0], row):
                versions[-1][2] = when(row)
                versions.append([row, when(row), None])
    return [(k, *v[0], v[1], v[2]) for k, vs in kept.items() for v in vs]


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_history_against_replay(spark, strategy):
    rng = random.Random(5)
    ddl = "k int, v string, updated_at timestamp_ntz"
    states, frames, day = [], [], lambda d: dt.datetime(2024, 1, d)
    for step in range(1, 6):
        state = {
            key: (rng.choice(["a", "b", None]), day(rng.randint(1, 20)))
            for key in rng.sample(range(12), 9)
        }
        moment = dt.datetime(2024, 2, step)
        states.append(((lambda r: r[1]) if strategy == "timestamp" else (lambda r, w=moment: w), state))
        frames.append((moment, spark.createDataFrame([(k, *v) for k, v in state.items()], ddl)))
    history = None
    for moment, frame in frames:
        how = {"updated_at": "updated_at"} if strategy == "timestamp" else {"check_cols": ["v"], "as_of": moment}
        for _ in range(2):  # every snapshot is replayed once
            history = h.snapshot(frame, history, ["k"], strategy, **how)
        path = new_dir(spark, "history")
        history.write.parquet(path)
        history = spark.read.parquet(path)
    if strategy == "timestamp":
        want = replay(states, lambda a, b: b[1] > a[1])
    else:
        want = replay(states, lambda a, b: a[0] != b[0])
    columns = ["k", "v", "updated_at", "valid_from", "valid_to"]
    got = [tuple(r) for r in history.select(*columns).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert history.select(h.version_id(["k"])).distinct().count() == history.count()


def test_history_arguments(spark):
    df = spark.range(1)
    for how in ({"strategy": "timestamp"}, {"strategy": "check"}, {"strategy": "guess"}):
        with pytest.raises(ValueError):
            h.snapshot(df, None, ["id"], **how)


def test_history_keeps_missing_keys_open_and_null_keys_stable(spark, rows):
    ddl = "k int, v int"
    one = spark.createDataFrame([(1, 1), (None, 1)], ddl)
    two = spark.createDataFrame([(None, 1)], ddl)
    first = h.snapshot(one, None, ["k"], "check", as_of=dt.datetime(2024, 1, 1))
    second = h.snapshot(two, first, ["k"], "check", as_of=dt.datetime(2024, 1, 2))
    assert rows(second) == rows(first)
    assert h.as_of_time(second, F.lit("2024-01-05").cast("timestamp_ntz")).count() == 2


RUNS = [("m", i, s, "ok") for i, s in enumerate([1.0, 1.0, 2.0, 3.0, 10.0])] + [
    ("one", 1, 4.0, "failed"),
    ("three", 1, 1.0, "ok"),
    ("three", 2, 5.0, "ok"),
    ("three", 3, 9.0, "late"),
    ("fast", 1, 8.0, "ok"),
    ("fast", 2, 8.0, "ok"),
    ("fast", 3, 1.0, "ok"),
    ("fast", 4, 1.0, "ok"),
    ("zero", 1, 0.0, "ok"),
    ("zero", 2, 0.0, "ok"),
    ("zero", 3, 5.0, "ok"),
    ("zero", 4, 5.0, "ok"),
    ("none", 1, None, "ok"),
]


def test_runtime_stats(spark):
    df = spark.createDataFrame(RUNS, "model string, t int, s double, status string")
    found = runs.runtime_stats(df, "model", "t", "s", "status").collect()
    assert [r.model_name for r in found] == ["three", "fast", "one", "m", "zero"]
    got = {r.model_name: r for r in found}
    m_ = got["m"]
    assert (m_.average_seconds, m_.median_seconds, m_.p95_seconds, m_.run_count) == (3.4, 2.0, 10.0, 5)
    # first half is the runs before place n // 2
    assert m_.trend == "degrading" and got["fast"].trend == "improving"
    assert got["three"].trend == "stable" and got["zero"].trend == "stable"
    assert (got["three"].last_run, got["three"].last_status) == (3, "late")
    assert got["fast"].median_seconds == 4.5
    short = runs.runtime_stats(df, "model", "t", "s", "status", max_history=2, only="FAS").collect()
    assert [(r.model_name, r.run_count, r.average_seconds) for r in short] == [("fast", 2, 1.0)]


def test_p95_place(spark):
    df = spark.range(1, 41).select(F.lit("m").alias("m"), "id", F.col("id").cast("double").alias("s"), F.lit("ok").alias("st"))
    # 40 runs: place int(0.95 * 40) = 38 counted from 0
    assert runs.runtime_stats(df, "m", "id", "s", "st").collect()[0].p95_seconds == 39.0


def test_run_filters_and_rates(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", "p", "success", dt.datetime(2024, 1, 1), 1.0),
            ("b", "p", "failed", dt.datetime(2024, 1, 31), 2.0),
            ("c", "p", "running", None, 3.0),
            ("d", "q", "success", dt.datetime(2024, 1, 31), 4.0),
        ],
        "execution_id string, pipeline_name string, status string, start_time timestamp_ntz, seconds double",
    )
    ids = lambda out: [r.execution_id for r in out.collect()]
    assert ids(runs.filter_runs(df, "p", start=dt.datetime(2024, 1, 1), end=dt.datetime(2024, 1, 31))) == ["b", "a"]
    assert ids(runs.filter_runs(df, status="success", limit=1)) == ["d"]
    rate = runs.success_rate(df, ["pipeline_name"], dt.datetime(2024, 2, 1), days=7, duration="seconds")
    assert rows(rate) == [("p", 2, 0, 1, 1, 0.0, 2.5), ("q", 1, 1, 0, 0, 100.0, 4.0)]
    assert rows(runs.state_counts(df.withColumn("status", F.nullif("status", F.lit("failed"))), [], "status")) == [
        ("running", 1),
        ("success", 2),
        ("unknown", 1),
    ]
    assert rows(runs.state_table(df, ["pipeline_name"], "status", ["success", "lost"])) == [("p", 1, 0, 3), ("q", 1, 0, 1)]
    assert rows(runs.run_log_summary(df)) == [(4, 2, 1)]
    stats = runs.recent_sync_stats(
        df.withColumn("status", F.replace("status", F.lit("success"), F.lit("Succeeded"))), ["pipeline_name"], "start_time", "status", 2
    )
    assert rows(stats, "pipeline_name", "total_syncs", "recent_syncs", "succeeded", "success_rate") == [
        ("p", 3, 2, 1, 50.0),
        ("q", 1, 1, 1, 100.0),
    ]


def test_jobs_without_a_group_are_counted_too(spark, rows):
    df = spark.createDataFrame([(None, 1, "succeeded"), (None, 2, "failed"), ("c", 1, "failed")], "g string, t int, s string")
    stats = runs.recent_sync_stats(df, ["g"], "t", "s", 1)
    assert rows(stats, "g", "total_syncs", "recent_syncs", "success_rate") == [(None, 2, 1, 0.0), ("c", 1, 1, 0.0)]


def test_co_access_counts(spark, rows):
    log = spark.createDataFrame(
        [(1, "x"), (1, "x"), (1, "a"), (1, "b"), (2, "x"), (2, "a"), (2, "a"), (3, "a"), (3, "b")], "q int, o string"
    )
    out = lineage.co_access(log, "q", "o", "x")
    assert [tuple(r) for r in out.collect()] == [("a", 3, 4), ("b", 1, 2)]
    assert [r.object for r in lineage.co_access(log, "q", "o", "x", limit=1).collect()] == ["a"]


def test_lineage_closure(spark, rows):
    edges = spark.createDataFrame(
        [
            ("source_customers", "stg_customers"),
            ("stg_customers", "customer_summary"),
            ("x", "x"),
            ("customer_summary", "source_customers"),
            ("other", "unrelated"),
        ],
        "parent string, child string",
    )
    up = lineage.lineage_closure(edges, "customer_summary")
    assert rows(up) == [("source_customers", 2), ("stg_customers", 1)]
    assert rows(lineage.lineage_closure(edges, "customer_summary", max_depth=1)) == [("stg_customers", 1)]
    assert rows(lineage.lineage_closure(edges, "stg_customers", "downstream")) == [("customer_summary", 1), ("source_customers", 2)]
    assert lineage.lineage_closure(edges, "x").count() == 0
    assert lineage.lineage_closure(edges, "nowhere").count() == 0


def test_keywords(spark):
    df = spark.createDataFrame([("Sync the Customer and order_items tables, to DW!",), (None,), ("",)], "p string")
    first, second, third = [r.keywords for r in mt.expand_keywords(df, "p", {"order_items": ["lines"], "customer": ["party"]}).collect()]
    assert sorted(first) == sorted(
        ["customer", "customers", "client", "clients", "account", "accounts", "user", "users", "party", "order_items", "lines"]
    )
    assert second is None and third == []
    assert mt.intent_keywords(spark, "Move orders to the warehouse") == ["orders", "warehouse"]


@pytest.fixture(scope="module")
def streams(spark):
    return spark.createDataFrame(
        [
            ("customers", "crm", "All customer rows", ["id", "email"], ["crm"], ["full_refresh", "INCREMENTAL"]),
            ("orders", "shop", None, ["order_id", "customer_id"], ["shop"], ["full_refresh"]),
            ("weather", None, "", [], [], []),
            (None, "crm", "customer", ["x"], [], None),
        ],
        "name string, namespace string, description string, columns array<string>, tags array<string>, "
        "supported_sync_modes array<string>",
    )


def test_ranking(streams):
    got = {r.name: r.score for r in mt.rank_by_keywords(streams, ["customer", " CRM"]).collect()}
    # name prefix 0.85, namespace exact, description word, tag exact
    assert got["customers"] == pytest.approx(4 * 0.85 + 2 * 0.95 + 2 * 1.0 + 1.0)
    assert got["orders"] == pytest.approx(0.95)
    assert got["weather"] == 0
    assert mt.rank_by_keywords(streams, []).filter("score <> 0").count() == 0


def test_substring_points(streams):
    got = {r.name: r.score for r in mt.substring_score(streams, ["customer", "shop"]).collect()}
    assert got == {"customers": 5, "orders": 1 + 2 + 1, "weather": 0, None: 2}


def test_intent_selection(streams):
    def names(**policy):
        return [(r.name, r.sync_mode) for r in mt.select_for_intent(streams, ["customer"], **policy).collect()]

    assert names() == [("customers", "incremental"), ("orders", "full_refresh")]
    assert names(limit=1) == [("customers", "incremental")]
    assert names(schemas=["shop"]) == [("orders", "full_refresh")]
    assert names(max_sensitivity="low") == [("orders", "full_refresh")]
    assert names(disallowed_names=["ORDERS"]) == [("customers", "incremental")]
    assert names(allowed_namespaces=["Shop"]) == [("orders", "full_refresh")]
    assert names(disallowed_namespaces=["CRM"]) == [("orders", "full_refresh")]
    assert names(max_sensitivity="medium", restricted_markers=["order_"]) == []


def test_sensitive(streams):
    got = {r.name: r.restricted for r in mt.flag_sensitive(streams).collect()}
    assert got == {"customers": True, "orders": False, "weather": False, None: False}


def test_suggestions(spark):
    names = spark.createDataFrame([("customers",), ("custom",), ("orders",), ("customer_orders",)], "name string")
    assert [r.name for r in mt.suggest(names, "Customer", 3).collect()] == ["customer_orders", "customers", "custom"]


def test_best_match(spark, rows):
    items = spark.createDataFrame(
        [
            (5, "AlloyDB for PostgreSQL"),
            (4, "Postgres"),
            (3, "Postgres Fast"),
            (2, "Google Sheets"),
            (1, "sheets (old)"),
            (9, "sheets (new)"),
            (None, "My"),
            (7, ""),
        ],
        "id int, name string",
    )
    needles = spark.createDataFrame(
        [("postgres",), ("POSTGRES ",), ("sheets",), ("google",), ("sql",), ("for",), ("my",), ("",), (None,), ("zzz",)], "needle string"
    )
    assert rows(mt.best_match(needles, items)) == [
        ("for", 5, "AlloyDB for PostgreSQL", 2),
        ("google", 2, "Google Sheets", 3),
        ("postgres", 4, "Postgres", 4),
        ("sheets", 1, "sheets (old)", 3),
        ("sql", 5, "AlloyDB for PostgreSQL", 1),
    ]


def wait(query):
    query.awaitTermination()


def test_streams_resume_and_equal_batch(spark, rows):
    source, path, mark = (new_dir(spark, n) for n in ("src", "dst", "ckp"))
    ddl = "k int, t timestamp_ntz, v string"
    day = lambda d: dt.datetime(2024, 1, d)
    first = spark.createDataFrame([(1, day(1), "a"), (1, day(3), "b"), (2, day(2), "c")], ddl)
    first.write.parquet(source)
    stream = lambda: g.file_stream(spark, source, first.schema)
    args = (["k"], "t", ["v"])
    wait(g.stream_append(stream(), path, mark))
    wait(g.stream_append(stream(), path, mark))
    assert spark.read.parquet(path).count() == 3
    up, upmark = new_dir(spark, "up"), new_dir(spark, "ckp")
    wait(g.stream_upsert(stream(), up, upmark, *args))
    second = spark.createDataFrame([(1, day(2), "late"), (3, day(4), "d")], ddl)
    second.write.mode("append").parquet(source)
    wait(g.stream_upsert(stream(), up, upmark, *args))
    want = rows(latest.keep_latest(first.union(second), *args))
    assert rows(g.latest_rows(spark, up, *args)) == want
    g.compact(spark, up, *args)
    assert rows(g.latest_rows(spark, up, *args)) == want
    # a whole replay from an empty checkpoint changes nothing
    wait(g.stream_upsert(stream(), up, new_dir(spark, "ckp"), *args))
    assert rows(g.latest_rows(spark, up, *args)) == want


def test_stream_quality_and_dedup(spark, rows):
    source = new_dir(spark, "src")
    df = spark.range(0, 200, 1, 4).select(
        (F.col("id") % 50).alias("k"), F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), F.lit(1.0).alias("x")
    )
    df.write.parquet(source)
    out = new_dir(spark, "dst")
    once = g.stream_dedup(g.file_stream(spark, source, df.schema), ["k"], "t", "1 hour")
    wait(g.stream_append(once, out, new_dir(spark, "ckp")))
    assert rows(spark.read.parquet(out), "k") == [(k,) for k in sorted(range(50), key=str)]
    judged = new_dir(spark, "judged")
    rules = {"low": F.col("k") < 10, "odd": F.col("k") % 2 == 1}
    wait(g.stream_quality(g.file_stream(spark, source, df.schema), rules, judged, new_dir(spark, "ckp")))
    found = spark.read.parquet(judged).groupBy("outcome").count()
    assert rows(found) == [("good", 20), ("rejected", 180)]


def test_compact_leaves_a_batch_that_arrives_meanwhile(spark, rows, monkeypatch):
    path = new_dir(spark, "folded")
    ddl = "k int, t int, v string"

    def batch(number, *content):
        spark.createDataFrame(list(content), ddl).write.parquet(f"{path}/_batch_id={number}")

    batch(0, (1, 1, "a"), (2, 1, "b"))
    batch(1, (1, 2, "c"))
    move = g.storage.move

    def move_late(*args):
        batch(2, (3, 3, "d"))
        move(*args)

    monkeypatch.setattr(g.storage, "move", move_late)
    g.compact(spark, path, ["k"], "t")
    monkeypatch.undo()
    want = [(1, 2, "c"), (2, 1, "b"), (3, 3, "d")]
    assert rows(g.latest_rows(spark, path, ["k"], "t"), "k", "t", "v") == want
    assert g.storage.folders(spark, path) == ["_batch_id=-1", "_batch_id=2"]
    g.compact(spark, path, ["k"], "t")
    assert g.storage.folders(spark, path) == ["_batch_id=-2"]
    assert rows(g.latest_rows(spark, path, ["k"], "t"), "k", "t", "v") == want


def test_history_refuses_repeated_keys(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="is repeated"):
        h.snapshot(twice, None, ["k"], "check", as_of=dt.datetime(2024, 1, 1)).collect()


def test_version_ids_tell_keys_apart(spark):
    df = spark.createDataFrame(
        [("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "")], "x string, y string"
    ).withColumn("valid_from", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert df.select(h.version_id(["x", "y"])).distinct().count() == 4
