"""Language identification by string kernels.

The kernel of two texts is the share of character n-grams that both hold (blended spectrum: n from
1 to 4, presence only, whole lower-cased texts, n-grams hashed to 2**18 buckets), that is
|G(x) & G(y)| / sqrt(|G(x)| |G(y)|). Nystroem's method maps a text to its kernel values with
landmark texts, whose number grows with the languages only; kernel ridge regression, one language against the rest, is solved in
closed form on that map. Scores of a batch are the product of its presence matrix, the landmarks'
presence matrix and the solution; the last two are multiplied once, ahead.

Learning takes ``PER_LANGUAGE`` documents per language, the smallest by a hash of their ids among
the rows given: the documented bound of the sample. The driver holds the landmarks, at most 2**18 bucket numbers
each, whatever the text's length. Everything else is a map over all rows without shuffle.

Defined results: texts of any length are taken whole; a text that is null or has no letter is ``und`` with score 0; without labelled
rows every text is ``und`` to :func:`identify`, but :func:`recognised` keeps whatever has a letter,
since nothing can be said against it; ties go to the first language by code point; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, map_batches, settle

PER_LANGUAGE = 256
# Landmarks: so many at least, and so many per language; flagged LANDMARKS at a time.
LANDMARKS = 192
LANDMARKS_EACH = 4
# Tasks that sum the sample's products; each hands over one matrix of landmarks squared.
SUMS = 8
RIDGE = 0.1
LONGEST = 4
BITS = 18
MAX_LANGUAGES = 500
UNKNOWN = "und"
# What recognised() calls the language of a text when there was nothing to learn from.
SOME = "mis"
# Letters of any script; numerals, marks and symbols are none.
LETTER = regex.compile(r"\p{L}")


def buckets_of(text: str, mark: np.ndarray) -> np.ndarray:
    """Sorted numbers of the buckets of all n-grams; ``mark`` is a clean scratch of 2**BITS flags."""
    at = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    state = np.zeros(len(at) + 1, np.uint32)
    for n in range(1, LONGEST + 1):
        if len(at) < n:
            break
        state = (state[: len(at) - n + 1] + at[n - 1 :]) * np.uint32(0x9E3779B1)
        mixed = (state ^ (state >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
        mark[mixed >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(mark)
    mark[found] = False
    return found


@dataclass
class Model:
    """``table``: per bucket and language the landmarks' presence times the solution."""

    languages: list[str]
    table: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language."""
        mark = np.zeros(1 << BITS, bool)
        made = np.zeros((len(texts), len(self.languages)), np.float64)
        for i, text in enumerate(texts):
            held = buckets_of(text, mark)
            if len(held):
                # The text's row of the presence matrix times the table: a sum of its rows.
                made[i] = self.table[held].sum(axis=0, dtype=np.float64) / np.sqrt(len(held))
        return made


def is_held_out(doc_id: str = "doc_id") -> Column:
    """The fold that learning never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(rows: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows (lang, text) of each language, smallest by hash of doc_id.

    Rows are thinned by the hash before they are ranked, so what is shuffled stays near the sample.
    """
    known = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = F.xxhash64("doc_id", F.lit("landmark"))
    share = F.shiftrightunsigned(place, 11) / float(2**53)
    near = F.lit(False)
    for r in counts:
        near = near | ((F.col("lang") == r.lang) & (share < min(1.0, 4 * per_language / r["count"])))
    ranked = Window.partitionBy("lang").orderBy(place, "doc_id", "text")
    return (
        known.where(near)
        .select("lang", "text", F.row_number().over(ranked).alias("nth"))
        .where(F.col("nth") <= per_language)
    )


def learn(rows: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int | None = None) -> Model:
    """Fit on rows (doc_id, text, lang).

    Only the landmarks reach the driver; the products of all other texts of the sample are summed in tasks.
    """
    chosen = settle(sample(rows, per_language).select("lang", "nth", "text"), "language-sample")
    languages = sorted(r.lang for r in chosen.select("lang").distinct().collect())

    def presence(batch: pa.RecordBatch) -> pa.RecordBatch:
        mark = np.zeros(1 << BITS, bool)
        held = [buckets_of(t, mark).astype(np.int32) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), batch.column(1)], names=["held", "at"])

    filled = chosen.where("text <> ''")
    # In order of rank, so every language has its share of the landmarks.
    first = filled.orderBy("nth", "lang").limit(landmarks or max(LANDMARKS, LANDMARKS_EACH * len(languages)))
    at = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("nth", "lang"))
    found = map_batches(first.select("text", at.alias("at")), presence, "held array<int>, at int").toArrow()
    order = np.argsort(found.column("at").to_numpy())
    lists = found.column("held").combine_chunks()
    marks = [lists[int(i)].values.to_numpy().astype(np.int64) for i in order]
    if not marks:
        return Model(languages, np.zeros((1 << BITS, len(languages)), np.float32))
    used = np.unique(np.concatenate(marks))
    own = np.sqrt([len(h) for h in marks])
    stretches = [slice(at, at + LANDMARKS) for at in range(0, len(marks), LANDMARKS)]

    values, vectors = np.linalg.eigh(_kernel(marks, marks, used, own, stretches))
    whole = values > 1e-6 * values[-1]
    root = vectors[:, whole] / np.sqrt(values[whole])
    sent = chosen.sparkSession.sparkContext.broadcast((marks, root))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, root = sent.value
        mark = np.zeros(1 << BITS, bool)
        gram, aims = np.zeros((root.shape[1],) * 2), np.zeros((root.shape[1], len(languages)))
        for batch in batches:
            texts, names = batch.column(1).to_pylist(), np.array(batch.column(0).to_pylist())
            for start in range(0, len(texts), 128):
                held = [buckets_of(t, mark) for t in texts[start : start + 128]]
                mapped = _kernel(held, marks, used, own, stretches) @ root
                wanted = np.where(names[start : start + 128, None] == np.array(languages)[None, :], 1.0, -1.0)
                gram += mapped.T @ mapped
                aims += mapped.T @ wanted
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([aims.tobytes()])], names=["gram", "aims"])

    dealt = filled.select("lang", "text").repartition(SUMS, "lang", "text")
    parts = dealt.mapInArrow(summed, "gram binary, aims binary").toArrow()
    gram, aims = (
        sum(np.frombuffer(part.as_py()).reshape(root.shape[1], -1) for part in parts.column(c)) for c in ("gram", "aims")
    )
    weight = (root @ np.linalg.solve(gram + RIDGE * np.eye(len(gram)), aims)) / own[:, None]
    table = np.zeros((1 << BITS, len(languages)), np.float32)
    for few in stretches:
        table[used] += _presence(marks[few], used).T @ weight[few]
    return Model(languages, table)


def _kernel(some: list[np.ndarray], marks: list[np.ndarray], used: np.ndarray, own: np.ndarray, stretches) -> np.ndarray:
    """Kernel values of texts with the landmarks, flags of LANDMARKS landmarks made at a time."""
    made = np.empty((len(some), len(marks)))
    for few in stretches:
        base = _presence(marks[few], used)
        for start in range(0, len(some), 128):
            part = some[start : start + 128]
            common = (_presence(part, used) @ base.T).astype(np.float64)
            made[start : start + len(part), few] = common / np.outer(np.sqrt([len(h) for h in part]), own[few])
    return made


def _presence(held: list[np.ndarray], used: np.ndarray) -> np.ndarray:
    """Rows of flags, as floats, over the buckets ``used``."""
    made = np.zeros((len(held), len(used)), np.float32)
    for i, h in enumerate(held):
        at = np.searchsorted(used, h)
        at[at == len(used)] = 0
        made[i, at[used[at] == h]] = 1.0
    return made


def predict(rows: DataFrame, model: Model, text: str = "text", unlearned: str = UNKNOWN) -> DataFrame:
    """(row, lang_pred, score) for every row; ``row`` is the whole row as it came.

    A text with a letter is ``unlearned`` if the model knows no language.
    """
    sent = rows.sparkSession.sparkContext.broadcast((model.languages, model.table))
    shape = rows.schema.simpleString()

    def predict_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = Model(*sent.value)
        texts = batch.column(0).field(text).to_pylist()
        readable = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
        names: list[str] = [UNKNOWN] * len(texts)
        sure = np.zeros(len(texts))
        for i in readable:
            names[i] = unlearned
        if known.languages and readable:
            scores = known.scores([texts[i] for i in readable])
            best = scores.argmax(axis=1)
            odds = np.exp(4.0 * (scores - scores.max(axis=1, keepdims=True)))
            for i, b, s in zip(readable, best, 1.0 / odds.sum(axis=1)):
                names[i], sure[i] = known.languages[b], s
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(sure, pa.float64())],
            names=["row", "lang_pred", "score"],
        )

    # The text travels once, within its row.
    packed = rows.select(F.struct("*").alias("row"))
    return map_batches(packed, predict_batch, f"row {shape}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from those not held out."""
    model = learn(docs.where(~is_held_out()).select("doc_id", "text", "lang"))
    made = predict(docs.select("doc_id", "text"), model)
    return made.select("row.doc_id", "lang_pred", "score").withColumn("held_out", is_held_out())


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is in some language; those that are ``und`` go.

    Without a labelled row outside the held-out fold these are the texts that are null or have no letter.
    """
    model = learn(docs.where(~is_held_out()).select("doc_id", "text", "lang"))
    return predict(docs, model, unlearned=SOME).where(F.col("lang_pred") != UNKNOWN).select("row.*")


by_value(__name__)
