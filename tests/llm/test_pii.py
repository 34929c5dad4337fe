import random
import re

import numpy as np

from sluiceway.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    tests = [
        ("email", EMAIL, lambda s: True),
        ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", CARD, lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", PHONE, lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in tests for m in p.finditer(text) if ok(m.group())]


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    for letters in ("a.@-1 2+(3", "0123456789- ", "1.25 ", "é@a.b1", "+1 (.)-2"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
            assert pii.base_spans(text) == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000 + ".", "1." * 100_000, "+1" + "(" * 300_000, "a@" * 100_000):
        pii.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger.fresh(rng)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    x, y = rng.integers(1, 90, (3, 6)), rng.integers(0, 9, (3, 6))
    _, grads = tagger.gradients(x, y)
    for k, v in tagger.p.items():
        at = (x[0, 0], 1) if k == "embed" else tuple(rng.integers(0, s) for s in v.shape)
        old = v[at]
        v[at] = old + 1e-4
        up, _ = tagger.gradients(x, y)
        v[at] = old - 1e-4
        down, _ = tagger.gradients(x, y)
        v[at] = old
        assert abs((up - down) / 2e-4 - grads[k][at]) < 1e-3 * max(1, abs(grads[k][at])), k


def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(1)
    tagger = pii.Tagger({"move": rng.standard_normal((3, 3)).astype(np.float32)})
    scores = rng.standard_normal((4, 5, 3)).astype(np.float32)
    paths = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
    for row, best in zip(scores, tagger.decode(scores)):
        worth = [row[range(5), p].sum() + tagger.p["move"][p[:-1], p[1:]].sum() for p in paths]
        assert (paths[int(np.argmax(worth))] == best).all()


def texts(n, seed=11):
    rng = random.Random(seed)
    words = "the of and ination erth ouble thand".split()
    made = []
    for _ in range(n):
        said = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        kind = rng.choice(["email", "phone", "ip", "none"])
        if kind == "email":
            said.insert(2, f"{rng.choice(words)}.{rng.randint(0, 99)}@mail{rng.randint(0, 9)}.example.com")
        if kind == "phone":
            said.insert(2, f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}")
        if kind == "ip":
            said.insert(2, ".".join(str(rng.randint(0, 255)) for _ in range(4)))
        made.append(" ".join(said))
    return made


def test_the_tagger_learns(monkeypatch):
    given, held = texts(300), texts(100, seed=12)
    windows = [w for t in given for w in pii.labelled_windows(t, pii.base_spans(t))]
    tagger = pii.train([w[1] for w in windows], [w[2] for w in windows], steps=250)
    want = [set(pii.base_spans(t)) for t in held]
    got = [set(spans) for spans in pii.tagged_spans(tagger, held)]
    assert sum(len(a & b) for a, b in zip(want, got)) >= 0.8 * sum(map(len, want))
    # Where windows meet doesn't matter: a text and the same text moved give the same spans.
    moved = [" ".join(["and"] * 30) + " " + t for t in held]
    shift = len(moved[0]) - len(held[0])
    again = [{(k, s - shift, e - shift) for k, s, e in spans} for spans in pii.tagged_spans(tagger, moved)]
    same = sum(len(a & b) for a, b in zip(got, again))
    assert same >= 0.95 * sum(map(len, got))


def test_documents(odd, frame, monkeypatch):
    monkeypatch.setattr(pii, "STEPS", 20)
    said = texts(60)
    for df in (odd, frame([(i, t, None, None, None) for i, t in enumerate(said)])):
        rows = pii.find(df).collect()
        assert len(rows) == df.count()
        own = {r.doc_id: r.text or "" for r in df.collect() if r.doc_id is not None}
        for r in rows:
            if r.doc_id is not None and r.doc_id != 1:
                base = plain(own[r.doc_id])
                assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
                    sum(k == kind for k, _, _ in base) for kind in pii.KINDS
                )
                assert {pii.joined([b]) for b in base} <= set(r.spans.split(",")) | {""}


def test_added_spans_are_valid_and_apart():
    text = "call 0049 30 1234567 or 999.1.1.1 or a@b.co"
    base = pii.base_spans(text)
    got = pii.all_spans(text, base, [("phone", 4, 20), ("ip", 24, 33), ("email", 37, 43)])
    assert got == [("email", 37, 43), ("phone", 5, 20)]


def test_empty(empty):
    assert pii.find(empty).count() == 0


def planted(n, seed):
    """(text, spans) with variants of phones and cards, and spans side by side, that no pattern reads as they are."""
    rng = random.Random(seed)
    words = "the of and ination erth ouble thand".split()

    def card():
        digits = [rng.randint(0, 9) for _ in range(15)]
        return next(d for d in ("".join(map(str, [*digits, x])) for x in range(10)) if pii.luhn(d))

    made = []
    for _ in range(n):
        kind = rng.choice(["phone", "phone", "card", "pair"])
        phone = f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        if kind == "pair":
            spans = [("card", card()), ("card", card())]
        else:
            base = phone if kind == "phone" else card()
            spans = [(kind, rng.choice(pii.variants(kind, base)))]
        text = " ".join(rng.choice(words) for _ in range(rng.randint(3, 20))) + " "
        places = []
        for k, own in spans:
            places.append((k, len(text), len(text) + len(own)))
            text += own + " "
        made.append((text + " ".join(rng.choice(words) for _ in range(rng.randint(3, 20))), places))
    return made


def test_held_out_variants_are_found_and_numbers_are_left_alone(spark):
    """Learned from the given table; the planted texts are none of it."""
    tagger = pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    held = planted(300, 21)
    found = pii.tagged_spans(tagger, [t for t, _ in held])
    caught = total = 0
    for (text, places), tagged in zip(held, found):
        base = pii.base_spans(text)
        spans = pii.all_spans(text, base, tagged)
        total += len(places)
        caught += sum(any(k == kind and s < end and e > start and e - s <= end - start + 2 for k, s, e in spans) for kind, start, end in places)
    assert caught >= 0.9 * total, caught / total
    rng = random.Random(2)
    plain = [f"the of {rng.choice(['version', 'page', 'in', 'about'])} {rng.choice([rng.randint(1, 9999), '2.0', '4.0.'])} and ouble" for _ in range(300)]
    spans = [pii.all_spans(t, pii.base_spans(t), found) for t, found in zip(plain, pii.tagged_spans(tagger, plain))]
    assert not any(spans)


def test_stretches_cover_a_region_once():
    for start, end in ((0, 5), (3, pii.STRETCH + 3), (7, 5 * pii.STRETCH)):
        own = [(f, e) for _, _, f, e in pii.stretches(start, end)]
        assert own[0][0] == start and own[-1][1] == end
        assert all(a[1] == b[0] for a, b in zip(own, own[1:]))
        assert all(s <= f and f - s <= pii.WINDOW and last <= end for s, last, f, _ in pii.stretches(start, end))


def test_a_very_long_text_of_numbers(frame, monkeypatch):
    monkeypatch.setattr(pii, "STEPS", 20)
    tagger = pii.learn(frame([(i, t, None, None, None) for i, t in enumerate(texts(60))]))
    text = ("7 " * 40_000) + "a@b.example.com " + "1" * 40_000
    row = pii.find(frame([(1, text, None, None, None)]), tagger).first()
    assert (row.n_email, row.n_ip, row.n_phone) == (1, 0, 0)


def test_windows_of_variants_are_tagged_where_they_stand():
    cut = "the of and 4845168114407329 ination erth ouble thand the of and inat"[: pii.WINDOW]
    tags = [0] * len(cut)
    tags[11:27] = [5] + [6] * 15
    phone = "and ouble +1 (017) 555-7713 rethsh onnatr the of and ination"
    ptags = [0] * len(phone)
    ptags[10:27] = [7] + [8] * 16
    made = pii.varied_windows([("card", cut, tags), ("phone", phone, ptags)] * 20)
    assert len(made) >= 60
    for text, own in made:
        assert len(text) == len(own) <= pii.WINDOW
        for kind, s, e in pii._runs(np.array(own)):
            if e < len(text) and s > 0:
                assert sum(c.isdigit() for c in text[s:e]) in (11, 13, 16)
