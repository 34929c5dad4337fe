import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def brute(words):
    """Runs by trying every period on every stretch of equal distance."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            if e - s >= max(6, 4 * q):
                smaller = any(
                    all(words[j] == words[j + p] for j in range(s, e - p)) for p in range(1, q)
                )
                if not smaller:
                    found.append((s, e - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def ours(texts):
    return [list(map(tuple, r.tolist())) for r in periodic_runs.runs_of(texts)]


def periodic(rng, letters, pieces):
    words = []
    for _ in range(pieces):
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        reach = rng.randint(1, 7 * len(unit))
        words += (unit * 8)[:reach]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 6))]
    return words


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghijklmnop"])
def test_against_brute_force(letters):
    rng = random.Random(len(letters))
    texts = [periodic(rng, letters, rng.randint(0, 6)) for _ in range(150)]
    assert ours(texts) == [brute(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=90), max_size=4))
def test_any_words(texts):
    assert ours(texts) == [brute(t) for t in texts]


def test_nested_and_long_periods():
    unit = list("abab" * 5 + "c")
    nested = unit * 6 + list("xyz") + unit * 4
    fibonacci, before = list("ab"), list("a")
    while len(fibonacci) < 600:
        fibonacci, before = fibonacci + before, fibonacci
    long = [str(i) for i in range(700)] * 4
    near = [str(i) for i in range(700)] * 4
    near[1500] = "x"
    for words in (nested, fibonacci, long, near, long[:-1], list("a" * 500), list("aab" * 80)):
        assert ours([words]) == [brute(words)]


def test_texts_are_apart(monkeypatch):
    texts = [list("abcdeabcde"), list("abcdeabcde"), [], list("abcdeabcdeabcdeabcde"), list("aaaaa"), list("aaaaa")]
    assert ours(texts) == [[], [], [], [(0, 20, 5)], [], []]
    monkeypatch.setattr(periodic_runs, "TOGETHER", 7)
    assert ours(texts) == [[], [], [], [(0, 20, 5)], [], []]


def test_a_very_long_text():
    rng = random.Random(3)
    unit = [str(rng.randrange(50)) for _ in range(40_000)]
    words = unit * 5 + [str(rng.randrange(9)) for _ in range(100_000)] + ["w"] * 50_000
    found = ours([words])[0]
    assert (300_000, 50_000, 1) in [(max(s, 300_000), min(n, 50_000), q) for s, n, q in found]
    assert any(q == 40_000 and s == 0 and n >= 200_000 for s, n, q in found)


def test_every_position_set_is_locally_consistent():
    rng = random.Random(5)
    words = np.array([rng.randrange(3) for _ in range(400)])
    again = np.concatenate((words, [7, 8, 9], words))
    levels = periodic_runs.names_by_scale(again)
    for k in range(2, 6):
        scale = 1 << k
        chosen = set(periodic_runs.synchronising(levels[k], scale, np.zeros(len(again), bool)).tolist())
        for i in range(400 - 2 * scale):
            assert (i in chosen) == (i + 403 in chosen)


def expected(doc_id, text):
    words = periodic_runs.tail_repeated((text or "").encode().split(), doc_id)
    runs, gone = brute(words), set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_over_the_given_table(spark):
    got = queries.QUERIES["op13_periodic_runs"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = {r.doc_id: r.text for r in docs if len((r.text or "").split()) <= 900}
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(rows) == len(docs) and sum(r[1] > 0 for r in rows.values()) > 5
    assert all(rows[i] == expected(i, t) for i, t in short.items())


def test_tail_as_said():
    words = [str(i).encode() for i in range(50)]
    for doc_id in range(400):
        import zlib

        h = zlib.crc32(str(doc_id).encode())
        a = (h // 10) % 50
        p = 1 + (50 - a) // (3 + (h // 10) % 8)
        want = [words[i] if h % 10 or i < a else words[a + (i - a) % p] for i in range(50)]
        assert periodic_runs.tail_repeated(words, doc_id) == want


def test_odd_rows(odd, empty):
    got = periodic_runs.summarised(odd, periodic_runs.tail_repeated).collect()
    want = [expected(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert periodic_runs.summarised(empty).count() == 0
    assert periodic_runs.find(empty).count() == 0


def test_real_outputs(frame):
    docs = frame([(1, "so so so so so so on", "en", "a", 1), (2, None, "en", "a", 1), (None, "a b c", None, None, 0)])
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find(docs).collect()}
    assert got == {1: (7, [(0, 6, 1)], "so on"), 2: (0, [], ""), None: (2, [], "a b c")}
