"""Byte-level BPE encoding and decoding in linear time, equal to merging by ranks.

A piece of text is encoded without a merge loop. An automaton over the tokens (bytes as Latin-1
characters, reversed, so that one pass from the right finds the longest token *starting* at each
place) gives the candidates; a token may follow another only if merging the two tokens' joined
bytes gives back just these two, which is remembered per pair. Starting with the longest token at
each place and falling back to its next shorter prefix, then to the token before, reaches the one
sequence whose neighbours all agree, which is the result of the merges; a place that has failed
once is not tried again, so the work is linear in the piece.

Defined results: a null text is empty; an empty text has no tokens and the digests of no bytes;
texts of any length are encoded whole; rows that repeat are encoded alike.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sluiceway.llm.common import by_value, map_batches, per_worker, whole_text

# Remembered pieces and pairs; a full memory is emptied, results don't depend on it.
MEMORY = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, lines))}


def split_pattern(pattern: str) -> str:
    r"""``pattern`` for the regex module, with \s as Unicode's White_Space property."""
    return pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")


class Bpe:
    """Encoder and decoder for the ``ranks`` of a vocabulary; every byte must be a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(split_pattern(pattern)).findall
        self.tokens = {r: t for t, r in ranks.items()}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.known: dict[str, bytes] = {}
        # Tokens that their own merges don't reach stand only for a whole piece.
        self.reached = {t for t in ranks if len(t) == 1 or len(self.merge(t)) == 1}
        self.from_right = ahocorasick.Automaton()
        for t in self.reached:
            self.from_right.add_word(t[::-1].decode("latin-1"), t)
        self.from_right.make_automaton()
        self.shorter: dict[bytes, bytes | None] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """The merges by rank, lowest first and leftmost among equals; for short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: bytes, right: bytes) -> bool:
        """True if ``right`` may follow ``left``."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return found

    def next_shorter(self, token: bytes) -> bytes | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            cuts = (token[:k] for k in range(len(token) - 1, 0, -1))
            self.shorter[token] = next((t for t in cuts if t in self.reached), None)
        return self.shorter[token]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        longest: list[bytes | None] = [None] * n
        for end, token in self.from_right.iter(piece[::-1].decode("latin-1")):
            start = n - 1 - end
            if longest[start] is None or len(token) > len(longest[start]):
                longest[start] = token
        taken: list[bytes] = []
        failed = bytearray(n + 1)
        at, token = 0, longest[0] if n else None
        while at < n:
            while token is not None:
                if not failed[at + len(token)] and (not taken or self.agree(taken[-1], token)):
                    break
                token = self.next_shorter(token)
            if token is None:
                failed[at] = 1
                token = taken.pop()
                at -= len(token)
                token = self.next_shorter(token)
            else:
                taken.append(token)
                at += len(token)
                token = longest[at] if at < n else None
        return [self.ranks[t] for t in taken]

    def ids_as_bytes(self, piece: str) -> bytes:
        """The ids of a piece as little-endian unsigned 32-bit integers."""
        if len(self.known) >= MEMORY:
            self.known.clear()
        made = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= 64:
            self.known[piece] = made
        return made

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text; each match of the pattern is a piece."""
        known, make = self.known.get, self.ids_as_bytes
        return np.frombuffer(
            b"".join([known(p) or make(p) for p in self.split(text)]), dtype="<u4"
        )

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ``ids`` stand for."""
        return b"".join(map(self.tokens.__getitem__, array("I", ids.tobytes())))


def tokenized(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids.

    A narrow map: no shuffle, one Arrow batch in memory. The vocabulary (fixed size, about a
    megabyte) travels as a broadcast variable, so executors need no copy of its file.
    """
    spark = docs.sparkSession
    name = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(ranks)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def encode_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        # With what it remembers of earlier tasks; memories are bounded by MEMORY entries.
        bpe = per_worker(f"bpe-{name}", lambda: Bpe(sent.value, pattern))
        counts, ids_digest, text_digest, kept = [], [], [], []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            counts.append(len(ids))
            ids_digest.append(hashlib.sha256(ids.tobytes()).hexdigest())
            text_digest.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            if keep_ids:
                kept.append(ids.astype(np.int64))
        columns = [
            batch.column(0),
            pa.array(counts, pa.int64()),
            pa.array(ids_digest, pa.string()),
            pa.array(text_digest, pa.string()),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns.append(pa.array(kept, pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select("doc_id", whole_text().alias("text"))
    return map_batches(rows, encode_batch, schema + (", ids array<long>" if keep_ids else ""))


by_value(__name__)
