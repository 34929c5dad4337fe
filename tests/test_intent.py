"""Scores of a catalog against plain code, and how they are planned."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sluiceway.functions.fuzzy import fuzzy_token_score
from sluiceway.operators import matching as m


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (x != y))
    return row[-1]


def token_score(kw, name):
    kw, name = (kw or "").strip().lower(), (name or "").strip().lower()
    words = re.split(r"[_\-\s.]+", name)
    if not kw or not name:
        return 0.0
    if kw == name:
        return 1.0
    if kw in words:
        return 0.95
    if len(kw) >= 3 and any(w.startswith(kw) for w in words):
        return 0.85
    best = max(1 - distance(kw, w) / max(len(kw), len(w)) for w in [*words, name])
    return 0.5 + 0.3 * ((best - 0.7) / 0.3) if best >= 0.7 else 0.0


def test_token_scores_of_odd_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aab_- .é") for _ in range(rng.randint(0, 9))) for _ in range(600)] + [None, "", "_", "ab"]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(1500)]
    df = spark.createDataFrame(pairs, "k string, t string").withColumn("s", fuzzy_token_score(F.col("k"), F.col("t")))
    for r in df.collect():
        assert r.s == pytest.approx(token_score(r.k, r.t), abs=1e-12), (r.k, r.t)


def test_intent_scores_are_computed_once(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("orde_") for _ in range(rng.randint(1, 8)))
    rows = [(word(), rng.choice([None, word()]), [word(), None, word()], ["Incremental"]) for _ in range(300)]
    catalog = spark.createDataFrame(rows, "name string, namespace string, columns array<string>, supported_sync_modes array<string>")
    keywords = ["order", "red", "oder "]
    out = m.select_for_intent(catalog.coalesce(1), keywords)
    want = []
    for name, space, columns, _ in rows:
        score = sum(
            4 * token_score(k, name) + 2 * token_score(k, space) + max(token_score(k, c) for c in columns) for k in keywords
        )
        if score > 0:
            want.append((round(score, 9), name))
    got = out.collect()
    assert sorted((round(r.score, 9), r.name) for r in got) == sorted(want)
    assert [r.score for r in got] == sorted((r.score for r in got), reverse=True)
    # The sort's sampling pass must not run the scores again.
    assert "levenshtein" not in out._jdf.queryExecution().executedPlan().toString()
