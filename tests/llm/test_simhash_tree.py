import random

import numpy as np
import pytest
import xxhash

from sluiceway.llm import queries, simhash_tree

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, now = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """doc id to component by comparing all fingerprints."""
    prints = {}
    for doc_id, p in rows:
        prints.setdefault(p, []).append(doc_id)
    distinct = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(distinct[:, None] ^ distinct[None, :]) <= 2
    seen, out = set(), {}
    for start in range(len(distinct)):
        if start in seen:
            continue
        group, todo = {start}, [start]
        while todo:
            for other in np.flatnonzero(near[todo.pop()]).tolist():
                if other not in group:
                    group.add(other)
                    todo.append(other)
        seen |= group
        ids = [i for g in group for i in prints[int(distinct[g])] if i is not None]
        for g in group:
            out[int(distinct[g])] = min(ids) if ids else None
    return out


def check(docs):
    rows = [(r.doc_id, plain_fingerprint(r.text or "")) for r in docs.collect()]
    named = plain_components(rows)
    want = sorted(((i, f"{p:016x}", named[p]) for i, p in rows), key=str)
    got = sorted(map(tuple, simhash_tree.near_duplicates(docs).collect()), key=str)
    assert got == want
    return named


def test_fingerprints():
    texts = ["", " \t\n", "One", "one two", "One TWO three four", "É é\x1cx y\x85z ß ÄB", "a " * 500, "x y z " * 70_000]
    for text in texts:
        assert simhash_tree.fingerprint(text.encode()) == plain_fingerprint(text)


def near_prints(rng, groups, size):
    """Fingerprints in groups whose members differ in few bits, some groups in chains."""
    made = set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(size):
            made.add(centre)
            step = centre
            for _ in range(rng.randint(0, 3)):
                step ^= 1 << rng.randrange(64)
            made.add(step)
            centre = step if rng.random() < 0.4 else centre
    return np.array(sorted(made), np.uint64)


@pytest.mark.parametrize("seed", range(4))
def test_every_linked_pair_shares_a_leaf(seed):
    rng = random.Random(seed)
    prints = near_prints(rng, 60, 25) if seed else near_prints(rng, 1, 1500)
    tree = simhash_tree.Tree(prints[:: seed + 1], 20)
    place, leaf = tree.route(prints)
    assert tree.leaves > 4 and set(place.tolist()) == set(range(len(prints)))
    leaves = [set() for _ in prints]
    for p, at in zip(place.tolist(), leaf.tolist()):
        leaves[p].add(at)
    i, j = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    assert all(leaves[a] & leaves[b] for a, b in zip(i.tolist(), j.tolist()))


def test_forest_joins_what_all_pairs_join():
    rng = random.Random(9)
    prints = near_prints(rng, 8, 120)
    rng.shuffle(order := list(range(len(prints))))
    prints = prints[order]
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    one = np.zeros(len(prints), int)
    two = np.array([rng.randrange(2) for _ in prints])
    for own, linked in ((one, near), (two, near & (two[:, None] != two[None, :]))):
        i, j = simhash_tree.forest(prints, own)
        want = simhash_tree.joined(len(prints), *np.nonzero(linked))
        assert (simhash_tree.joined(len(prints), i, j) == want).all()


def test_tiles_of_a_large_shard(spark, monkeypatch):
    prints = near_prints(random.Random(4), 3, 300)
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    tree = simhash_tree.Tree(prints, len(prints))
    assert tree.leaves == 1
    edges = simhash_tree.links(frame, tree, tile=50).collect()
    at = {int(p): k for k, p in enumerate(prints.view(np.int64))}
    got = simhash_tree.joined(len(prints), np.array([at[e.a] for e in edges]), np.array([at[e.b] for e in edges]))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    assert (got == simhash_tree.joined(len(prints), *np.nonzero(near))).all()
    assert all(near[at[e.a], at[e.b]] or got[at[e.a]] == got[at[e.b]] for e in edges)


def test_query_over_the_given_table(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = check(docs)
    got = queries.QUERIES["op12_simhash_tree"](spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == docs.count()
    assert len(set(named.values())) < docs.count()


def test_near_copies_and_short_texts(frame):
    rng = random.Random(6)
    words = [f"w{rng.randrange(300)}" for _ in range(400)]
    rows = [(i, " ".join(words[: 400 - i % 7] + [f"x{i % 5}"]), "en", "a", 1) for i in range(40)]
    rows += [(100 + i, f"only {i % 4}", "en", "a", 1) for i in range(12)]
    check(frame(rows))


def test_odd_rows(odd, empty):
    check(odd)
    assert simhash_tree.near_duplicates(empty).collect() == []


def test_without_ids(frame):
    rows = [(None, "the same text here", "en", "a", 1)] * 3 + [(None, None, None, None, None), (4, "", "en", "a", 0)]
    check(frame(rows))
