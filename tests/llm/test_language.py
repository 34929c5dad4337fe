import random
import zlib

import numpy as np

from sluiceway.llm import language

SOUNDS = {"aa": "ka lo mi ne ru ta", "bb": "sch ung ber ein ach", "cc": "oui eau tre ent ais"}


def documents(n=400, seed=1):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        parts = SOUNDS[lang].split()
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(8, 60))]
        made.append((i, " ".join(words), lang, "s", None))
    return made


def test_held_out_documents_are_told_right(frame):
    docs = documents()
    rows = language.identify(frame(docs)).collect()
    own = {d[0]: d[2] for d in docs}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == own[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_labels_are_not_used(frame):
    docs = documents()
    changed = [
        (i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, None, None) for i, t, lang, *_ in docs
    ]
    a = language.identify(frame(docs)).collect()
    b = language.identify(frame(changed)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_every_language_has_landmarks(frame):
    """With more languages than LANDMARKS, each of its own letters, the last ones are told right too."""
    rng, n = random.Random(7), language.LANDMARKS + 8
    text = lambda k: "".join(chr(0x4E00 + 20 * k + rng.randrange(20)) for _ in range(40))
    model = language.learn(frame([(3 * k + i, text(k), f"l{k:03}", None, None) for k in range(n) for i in range(3)]))
    assert model.languages == [f"l{k:03}" for k in range(n)]
    last = list(range(language.LANDMARKS - 2, n))
    assert model.scores([text(k) for k in last]).argmax(axis=1).tolist() == last


def test_scores_are_the_kernel_machine(frame):
    """The folded table gives what kernel values with the landmarks give."""
    docs = documents(120, seed=4)
    model = language.learn(frame(docs), per_language=40, landmarks=30)
    mark = np.zeros(1 << language.BITS, bool)
    texts = [d[1] for d in documents(20, seed=5)]
    held = [language.buckets_of(t, mark) for t in texts]
    dense = np.zeros((len(held), 1 << language.BITS))
    for row, h in zip(dense, held):
        row[h] = 1
    want = dense @ model.table / np.sqrt(dense.sum(axis=1, keepdims=True))
    assert np.allclose(model.scores(texts), want, atol=1e-4)


def test_buckets_are_those_of_all_ngrams():
    mark = np.zeros(1 << language.BITS, bool)
    for text in ("", "a", "ab", "Abcab ", "日本語日本"):
        alone = set()
        low = text.lower()
        for n in range(1, language.LONGEST + 1):
            for i in range(len(low) - n + 1):
                state = 0
                for c in low[i : i + n]:
                    state = (state + ord(c)) * 0x9E3779B1 % 2**32
                mixed = (state ^ (state >> 15)) * (0x85EBCA6B + 2 * n) % 2**32
                alone.add(mixed >> (32 - language.BITS))
        assert set(language.buckets_of(text, mark).tolist()) == alone
        assert not mark.any()


def test_odd_rows(odd):
    rows = language.identify(odd).collect()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id is not None:
            letters = texts[r.doc_id] is not None and any(c.isalpha() for c in texts[r.doc_id])
            assert (r.lang_pred != "und") == letters
    kept = language.recognised(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    assert kept.count() == sum(r.lang_pred != "und" for r in rows)


def test_without_labels_to_learn_from_texts_stay(frame):
    texts = ["some text", "ein Text", "日本", None, "", "12 _ 3", "x"]
    for told in (lambda i: None, lambda i: "en" if zlib.crc32(str(i).encode()) % 4 == 2 else None):
        docs = [(i, texts[i % 7], told(i), None, None) for i in range(70)]
        kept = language.recognised(frame(docs)).collect()
        assert sorted(r.doc_id for r in kept) == [i for i in range(70) if i % 7 in (0, 1, 2, 6)]
        assert {r.lang_pred for r in language.identify(frame(docs)).collect()} == {"und"}


def test_nothing_to_learn(frame, empty):
    docs = [(i, "some text", None, None, None) for i in range(5)]
    assert {r.lang_pred for r in language.identify(frame(docs)).collect()} == {"und"}
    assert language.identify(empty).count() == 0


def test_every_general_category():
    """One character of each: only letters make a text readable."""
    import sys
    import unicodedata

    from sluiceway.llm import language

    one = {}
    for at in range(sys.maxunicode + 1):
        if not 0xD800 <= at < 0xE000:
            one.setdefault(unicodedata.category(chr(at)), chr(at))
    assert len(one) >= 28
    for category, character in one.items():
        assert bool(language.LETTER.search(character)) == category.startswith("L"), category


def test_numerals_are_no_language(frame):
    from sluiceway.llm import language

    docs = [(i, "the words of one language here", "en", "a", 1) for i in range(9)]
    docs += [(100, "½ ² ③", None, "a", 1), (101, "Ⅷ", None, "a", 1), (102, "१२", None, "a", 1), (103, "ⅷ the", None, "a", 1)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(frame(docs)).collect()}
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3 and got[103][0] == "en"
