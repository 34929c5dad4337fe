"""Every stage against a plain version of what it does, on the given table and on odd rows."""

from collections import defaultdict

import corpus_pipeline
from conftest import SF
from test_ngram_join import shingles

from sluiceway.llm.common import settle


def test_stages_name_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "exact_dedup", "ngram_jaccard", "pareto_mix", "byte_bpe",
    ]


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.schema.simpleString(), dict(corpus_pipeline.STAGES)
    run = lambda name, df: settle(stages[name](spark, df, SF), name)

    known = run("language", docs)
    assert known.schema.simpleString() == columns
    assert known.count() == docs.where("text RLIKE '\\\\p{L}'").count()

    once = run("exact_dedup", known)
    largest = {}
    for r in known.collect():
        largest[r.text] = max(largest.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in once.collect()) == sorted(largest.values())

    apart = run("ngram_jaccard", once)
    rows = sorted((r.doc_id, shingles(r.text)) for r in once.collect())
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-12:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(r.doc_id for r in apart.collect()) == sorted({find(d) for d in root})

    mixed = run("pareto_mix", apart)
    assert mixed.schema.simpleString() == columns
    words = {r.doc_id: (r.source, len(r.text.split())) for r in apart.collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for s, n in words.values():
        sizes[s] += n
    times = defaultdict(int)
    for r in mixed.collect():
        taken[r.source] += words[r.doc_id][1]
        times[r.doc_id] += 1
    assert max(times.values()) <= 2
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.1 * sum(sizes.values())

    done = stages["byte_bpe"](spark, mixed, SF)
    assert done.count() == mixed.count()


def test_odd_rows_go_through(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        before = docs.schema.simpleString()
        docs = settle(stage(spark, docs, SF), name)
        assert name == "byte_bpe" or docs.schema.simpleString() == before
    assert docs.count() > 0


def test_a_table_without_labels_goes_through(spark, frame):
    docs = frame([(i, f"a clean text about the number {i} " * 20, None, "a", None) for i in range(9)])
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = settle(stage(spark, docs, SF), name)
    assert docs.count() == 9


def test_empty(spark, empty):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name)
    assert docs.count() == 0
