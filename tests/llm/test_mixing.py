import random
import re
from collections import defaultdict

from sluiceway.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_water_fill_matches_rounds_of_resharing():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 9)
        sizes = [rng.choice([0, rng.randint(1, 1000)]) for _ in range(n)]
        weights = [mixing.five_two_one(i) for i in range(n)]
        total = 1.5 * sum(sizes)
        got = mixing.water_fill(sizes, weights, total, 2.0)
        want, left, open_ = [0.0] * n, total, set(range(n))
        while left > 1e-9 and open_:
            share = sum(weights[i] for i in open_)
            given = {i: left * weights[i] / share for i in open_}
            left = 0.0
            for i, more in given.items():
                want[i] += more
                if want[i] >= 2.0 * sizes[i]:
                    left += want[i] - 2.0 * sizes[i]
                    want[i] = 2.0 * sizes[i]
                    open_.discard(i)
        assert all(abs(a - b) <= 1e-6 * max(1, b) for a, b in zip(got, want))


def documents(n, sources, seed=2):
    rng = random.Random(seed)
    return [
        (i, " ".join(["w"] * int(rng.lognormvariate(4, 1))), None, rng.choice(sources), None)
        for i in range(n)
    ]


def test_sources_come_near_their_targets_and_reruns_agree(frame):
    docs = documents(3000, ["a", "b", "c", "d", None])
    df = frame(docs)
    rows = mixing.mix(df, mixing.five_two_one, 1.5).collect()
    assert len(rows) == len(docs)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    want = mixing.water_fill(
        [size[s] for s in ("a", "b", "c", "d", None)], [5, 2, 1, 5, 2], 1.5 * sum(size.values()), 2.0
    )
    for s, t in zip(("a", "b", "c", "d", None), want):
        assert abs(target[s] - t) < 1e-6 * t
        assert abs(taken[s] - t) <= 0.005 * t
    again = mixing.mix(df.repartition(7), mixing.five_two_one, 1.5).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_chances_fall_with_size(frame):
    # One source, half of its words wanted: long documents are taken more rarely.
    docs = [(i, " ".join(["w"] * (10 if i % 2 else 1000)), None, "a", None) for i in range(4000)]
    rows = mixing.mix(frame(docs), lambda place: 1.0, 0.5).collect()
    short = sum(r.copies for r in rows if r.size == 10) / 2000
    long = sum(r.copies for r in rows if r.size == 1000) / 2000
    assert short > 0.95 and 0.4 < long < 0.55
    assert abs(sum(r.taken for r in rows) - 0.5 * 2000 * 1010) <= 20


def test_odd_rows(odd):
    rows = mixing.mix(odd, mixing.five_two_one, 1.5).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: len(WORDS.findall(r.text or "")) for r in odd.collect() if r.doc_id}
    assert all(r.size == by_id[r.doc_id] for r in rows if r.doc_id)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    mixed = mixing.repeated(odd)
    assert mixed.schema.simpleString() == odd.schema.simpleString()
    assert mixed.count() == sum(r.copies for r in rows)


def test_empty(empty):
    assert mixing.mix(empty, mixing.five_two_one, 1.5).count() == 0
    assert mixing.repeated(empty).count() == 0


def xx(value, seed, width=8):
    """Spark's xxhash64 of a whole number, chained by its seed."""
    import xxhash

    return xxhash.xxh64_intdigest((value % 2**64).to_bytes(8, "little")[:width], seed)


def brute(docs, share, most=2.0, seed=17):
    """(id, text, source) to words taken, by sorting every source's documents by random odds over inclusion odds."""
    import math

    import xxhash

    by_source, seen = defaultdict(list), defaultdict(int)
    for doc_id, text, _, source, _ in docs:
        seen[doc_id, text, source] += 1
        mark = xxhash.xxh64_intdigest((text or "").encode(), 42)
        h = xx(doc_id, 42) if doc_id is not None else 42
        h = xx(seed, xx(seen[doc_id, text, source], xx(mark, h)), 4)
        signed = mark - 2**64 if mark >= 2**63 else mark
        row = (doc_id is not None, doc_id or 0, signed, seen[doc_id, text, source])
        by_source[source].append(((doc_id, text), len(WORDS.findall(text or "")), ((h >> 12) + 0.5) / 2**52, row))
    order = sorted(by_source, key=lambda s: (s is None, str(s)))
    sizes = [sum(n for _, n, _, _ in by_source[s]) for s in order]
    targets = mixing.water_fill(sizes, [mixing.five_two_one(i) for i in range(len(order))], share * sum(sizes), most)
    out = []
    for source, size, target in zip(order, sizes, targets):
        base = min(math.floor(target / size), math.floor(most)) if size else 0
        rest = target - base * size
        words = defaultdict(int)
        for _, n, _, _ in by_source[source]:
            words[math.floor(math.log2(max(n, 1)) * 16)] += n
        scale = min(mixing.chance_scale(list(words.items()), rest), 1e300) if rest > 0 else 0.0
        keyed = []
        for name, n, u, row in by_source[source]:
            chance = min(1.0, scale * 2.0 ** (-math.floor(math.log2(max(n, 1)) * 16) / 32))
            key = 0.0 if chance >= 1 else u / (1 - u) * (1 - chance) / chance if chance > 0 else None
            keyed.append((key, row, n, name))
        drawn = sorted(k for k in keyed if k[0] is not None)
        taken, filled = set(), 0
        if rest > 0:
            for key, row, n, _ in drawn:
                if filled + n > rest:
                    break
                filled += n
                taken.add(row)
            gap = rest - filled
            near = [(abs(gap - n), key, row) for key, row, n, _ in drawn if row not in taken and n and abs(gap - n) < abs(gap)]
            if near:
                taken.add(min(near)[2])
        out += [(*name, source, (base + (row in taken)) * n) for _, row, n, name in keyed]
    return sorted(out, key=str)


def mixed_rows(docs, got):
    texts = {}
    for doc_id, text, _, source, _ in docs:
        import xxhash

        mark = xxhash.xxh64_intdigest((text or "").encode(), 42)
        texts[mark - 2**64 if mark >= 2**63 else mark] = text
    return sorted(((r.doc_id, texts[r.mark], r.source, r.taken) for r in got), key=str)


def test_the_sample_against_sorting_all(frame):
    rng = random.Random(3)
    docs = documents(800, ["a", "b", "c", None], seed=8)
    docs = [(i if i % 9 else None, f"{t} {rng.randint(0, 300)}", *rest) for i, t, *rest in docs] + docs[:40] + docs[:40]
    for share in (0.4, 1.5):
        got = mixing.mix(frame(docs), mixing.five_two_one, share).collect()
        assert mixed_rows(docs, got) == brute(docs, share)


def off_target(rows):
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
    return max(abs(taken[s] - t) / t for s, t in target.items())


def test_rows_without_ids_are_drawn_one_by_one(frame):
    docs = [(None, f"{t} x{i}", *rest) for i, t, *rest in documents(3000, ["a", "b", "c", None])]
    assert off_target(mixing.mix(frame(docs), mixing.five_two_one, 1.5).collect()) < 0.01
    same = [(7, "one text of five words", None, s, None) for s in ("a", "b") for _ in range(900)]
    rows = mixing.mix(frame(same), mixing.five_two_one, 0.7).collect()
    assert off_target(rows) < 0.01 and len(rows) == 1800


def test_copies_of_equal_rows_are_shared_out(frame, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 50)
    docs = frame([(7, "one text of five words", "l", "a", i) for i in range(300)] + [(8, "two words", "l", "b", 0)])
    copies = sum(r.copies for r in mixing.mix(docs, mixing.five_two_one, 0.6).collect())
    mixed = mixing.repeated(docs, share=0.6)
    assert mixed.count() == copies and mixed.schema == docs.schema
    counts = [r["count"] for r in mixed.where("doc_id = 7").groupBy("n_chars").count().collect()]
    assert max(counts) == 1 and 100 < len(counts) < 300


def test_a_very_long_text(frame):
    docs = [(1, "w " * 400_000, "en", "a", 0), (2, "a few words", "en", "a", 0), (3, None, "en", None, 0)]
    rows = {r.doc_id: r.size for r in mixing.mix(frame(docs), mixing.five_two_one, 1.5).collect()}
    assert rows == {1: 400_000, 2: 3, 3: 0}
