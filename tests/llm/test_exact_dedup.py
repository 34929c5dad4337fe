import hashlib
from collections import defaultdict

import pytest

from sluiceway.llm import exact_dedup
from sluiceway.runtime import new_dir


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    made = []
    for doc_id, text in rows:
        same = groups[text or ""]
        keep = max((i for i in same if i is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        made.append((doc_id, keep, len(same), doc_id == keep, digest))
    return sorted(made, key=str)


def test_decide_matches_brute_force(odd):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, exact_dedup.decide(odd).collect()), key=str) == brute(docs)


def test_survivors_keep_their_columns_and_come_once(odd):
    kept = exact_dedup.survivors(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 1 repeats 2's text; 3, 4 and the null row are empty; 4 is the largest of them.
    assert ids == sorted([2, 4, 5, None, 6, 7, 8], key=str)


def test_empty(empty):
    assert exact_dedup.decide(empty).count() == 0
    assert exact_dedup.survivors(empty).count() == 0


def test_a_second_batch_adds_only_what_is_new(spark, frame):
    path = new_dir(spark, "index")
    first = frame([(1, "a", None, None, None), (2, "b", None, None, None)])
    index = exact_dedup.DigestIndex(spark, path, first.schema["doc_id"].dataType, buckets=4)
    digests = lambda df: df.select("doc_id", exact_dedup.text_digest().alias("digest"))
    index.add(digests(first))
    again = exact_dedup.DigestIndex(spark, path, first.schema["doc_id"].dataType)
    assert again.buckets == 4
    again.add(digests(frame([(9, "a", None, None, None), (3, "c", None, None, None), (4, "c", None, None, None)])))
    assert sorted((r.keep_id, r.copies) for r in again.entries().collect()) == [(1, 1), (2, 1), (4, 2)]
    assert sorted(r.keep_id for r in again.bucketed().collect()) == [1, 2, 4]


def test_the_index_is_neither_shuffled_nor_sorted_anew(spark, frame):
    docs = frame([(i, f"t{i}", None, None, None) for i in range(50)])
    index, batch = exact_dedup.index_of(docs)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = index.bucketed().select("digest").hint("merge")
        plan = batch.join(other, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("path", [exact_dedup.decide])
def test_no_python_in_the_plan(odd, path):
    plan = path(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_no_table_is_left_in_the_catalog(odd):
    from sluiceway.llm import exact_dedup

    spark = odd.sparkSession
    before = {t.name for t in spark.catalog.listTables()}
    exact_dedup.decide(odd).collect()
    exact_dedup.survivors(odd).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
