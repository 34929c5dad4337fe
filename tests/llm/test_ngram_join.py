import random
import re
from collections import defaultdict

import numpy as np
import pytest

from sluiceway.llm import ngram_join as nj
from sluiceway.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """(doc_id, class_id, n_links) by all pairs; texts without words equal one another."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x == y or (x and y and len(x & y) >= 0.8 * len(x | y) - 1e-12):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    made = [(d, min(ids[find(i)], default=None), links[i]) for i, (d, _) in enumerate(rows)]
    return sorted(made, key=str)


def near(df):
    return sorted(
        ((r.doc_id, r.class_id, r.n_links) for r in nj.near_duplicates(df).collect()), key=str
    )


def corpus(n=150, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    made = []
    for i in range(n):
        if made and rng.random() < 0.6:
            base = list(rng.choice(made[-40:]))
            for _ in range(rng.randint(0, 6)):
                if base:
                    base[rng.randrange(len(base))] = rng.choice(words)
            made.append(base)
        else:
            made.append([rng.choice(words) for _ in range(rng.choice([0, 1, 3, 5, 6, 40, 90, 150]))])
    return [(i, " ".join(w), None, None, None) for i, w in enumerate(made)]


@pytest.mark.parametrize("tile", [512, 7])
def test_matches_all_pairs(frame, monkeypatch, tile):
    """Small tiles split buckets and blocks; the result is the same."""
    monkeypatch.setattr(nj, "BUCKET_TILE", tile)
    monkeypatch.setattr(nj, "BLOCK_TILE", tile)
    rows = corpus()
    assert near(frame(rows)) == brute([r[:2] for r in rows])


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert near(odd) == brute(rows)
    kept = nj.representatives(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {c for _, c, _ in brute(rows) if c is not None}
    assert ids.count(None) == [d for d, _ in rows].count(None)


def test_one_id_for_several_texts(frame):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, "something else altogether, with words"), (2, base + " end"), (3, "nothing of it")]
    got = sorted((r.doc_id, r.n_links) for r in nj.near_duplicates(frame([(*r, None, None, None) for r in rows])).collect())
    assert got == [(1, 0), (1, 1), (2, 1), (3, 0)]


def test_empty(empty):
    assert nj.near_duplicates(empty).count() == 0
    assert nj.representatives(empty).count() == 0


def test_posterior_falls_with_fewer_matches():
    chances = [nj.chance_of_reaching(0.8, m, 32) for m in range(33)]
    assert all(a < b for a, b in zip(chances, chances[1:])) and chances[-1] > 0.99
    # By integration of the likelihood.
    x = (np.arange(100_000) + 0.5) / 100_000
    like = x**20 * (1 - x) ** 12
    assert abs(like[x >= 0.8].sum() / like.sum() - chances[20]) < 1e-4


def test_pruning_keeps_all_similar_pairs():
    rng = random.Random(5)
    least = nj.least_matches(0.8, 1e-6)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(120)) for _ in range(5)]
    many = []
    for t in texts:
        for _ in range(20):
            words = t.split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "x"
            many.append(" ".join(words))
    grams = [nj.ngrams(t.encode()) for t in many]
    values = np.array([nj.minhash(g) & np.uint64(0xFFFF) for g in grams]).astype(np.uint16)
    i, j = nj.surviving(values, values, least, same=True)
    found = set(zip(i.tolist(), j.tolist()))
    every = [(a, b) for b in range(100) for a in range(b)]
    held = nj.links_of(grams, *np.array(every).T, 0.8)
    similar = {p for p, h in zip(every, held) if h}
    assert similar <= found and len(found) < len(every) / 2
    exact = [len(shingles(many[a]) & shingles(many[b])) >= 0.8 * len(shingles(many[a]) | shingles(many[b])) for a, b in every]
    assert held.tolist() == exact


def test_minhash_agreement_is_the_similarity():
    a = nj.ngrams(" ".join(f"w{i}" for i in range(1000)).encode())
    b = nj.ngrams(" ".join(f"w{i}" for i in range(200, 1200)).encode())
    real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((nj.minhash(a) == nj.minhash(b)).mean() - real) < 0.13


def test_components_match_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    edges += [(i, i + 1) for i in range(1000, 1100)]  # a long chain
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {(n, find(n)) for e in edges if e[0] != e[1] for n in e}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_without_ids_keep_their_texts_apart(frame):
    """Near copies without ids: groups as with ids, and each class meets its own text alone."""
    import random

    from sluiceway.llm import ngram_join

    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for g in range(12):
        base = rng.sample(words, 120)
        texts += [" ".join(base[: 120 - k % 3]) for k in range(8)]
    texts += [" ".join(rng.sample(words, 100)) for _ in range(30)]
    named = frame([(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    nameless = frame([(None, t, "en", "a", 1) for t in texts])
    want = sorted(r.n_links for r in ngram_join.near_duplicates(named).collect())
    got = ngram_join.near_duplicates(nameless).collect()
    assert sorted(r.n_links for r in got) == want and {r.class_id for r in got} == {None}
    texts_of = ngram_join._texts_of(nameless.unionByName(nameless))
    assert texts_of.count() == len(set(texts))
    one = frame([(7, t, "en", "a", 1) for t in texts])
    assert sorted(r.n_links for r in ngram_join.near_duplicates(one).collect()) == want
