import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluiceway.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def ours():
    return bpe.Bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
    )


def test_random_texts(ours, theirs):
    rng = random.Random(7)
    alphabets = ["ab", "theinan ", "0123456789 .,", "éèß日本語  \n\t\x1c\x85", "".join(map(chr, range(1, 0x250)))]
    for _ in range(1500):
        letters = rng.choice(alphabets)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        ids = ours.encode(text)
        assert ids.tolist() == theirs.encode_ordinary(text), text
        assert ours.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(max_size=80))
def test_any_text(ours, theirs, text):
    ids = ours.encode(text)
    assert ids.tolist() == theirs.encode_ordinary(text)
    assert ours.decode(ids) == text.encode()


def test_a_long_piece_without_a_break(ours, theirs):
    rng = random.Random(1)
    for letters in ("a", "abc", "日a"):
        text = "".join(rng.choice(letters) for _ in range(20_000))
        assert ours.encode(text).tolist() == theirs.encode_ordinary(text)


def test_pieces_follow_the_merges(ours):
    rng = random.Random(3)
    for _ in range(500):
        piece = bytes(rng.randrange(256) for _ in range(rng.randint(1, 40)))
        want = [RANKS[t] for t in ours.merge(piece)]
        assert ours.encode_piece(piece) == ([RANKS[piece]] if piece in RANKS else want)


def test_a_full_memory_changes_nothing(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 5)
    small = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    text = "Many words of many kinds, many times: words words kinds 12345 many"
    assert small.encode(text).tolist() == theirs.encode_ordinary(text)


def test_documents(odd, theirs):
    want = []
    for r in odd.collect():
        ids = theirs.encode_ordinary(r.text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        whole = hashlib.sha256((r.text or "").encode()).hexdigest()
        want.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), whole, ids))
    got = bpe.tokenized(odd, RANKS, public_tokenizers.PATTERN, keep_ids=True)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty(empty):
    assert bpe.tokenized(empty, RANKS, public_tokenizers.PATTERN).count() == 0
