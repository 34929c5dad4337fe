"""Near-duplicate join on word n-grams: MinHash, Bayesian pruning, exact verification.

1. Every text becomes its set of word 5-grams (64-bit hashes of the words' bytes) and 128 MinHash
   values. Texts of equal sets are one class from here on.
2. Classes that agree in all four values of one of 32 bands share a bucket. Two classes of
   similarity 0.8 miss each other in all bands with a chance of 4e-8.
3. Within a bucket, pairs are compared 16 values at a time. After each step the posterior chance
   (uniform prior) that their similarity reaches the threshold is looked up, and pairs below
   ``TOLERANCE`` are dropped. What a bucket reports is not its pairs but a spanning forest of the pairs
   left. The connected components of all forests are the blocks in which similar classes can lie.
4. The texts of each block are brought together once. Pairs are pruned again by their values and the
   rest is verified exactly on the sets of n-grams. A block reports its classes' numbers of links and
   a spanning forest of the links; the components of those are the groups of near-duplicates.

No pair is ever a row. Buckets and blocks larger than a tile are split into pairs of tiles (each row
goes to as many tasks as there are tiles), so no task holds more than two tiles.

Defined results: words are what stands between white space (space, tab to carriage return); a text of
one to four words is one n-gram; texts without words (null among them) equal one another and nothing
else; rows that repeat an id or a text are in one class; a null id is reported as it is and never
names a group, unless no other id does; rows without an id are told apart by a hash of their text, and cost what rows with ids do;
texts of any length are taken whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, map_batches, per_worker, settle, whole_text
from sluiceway.llm.components import components

WORDS = 5
THRESHOLD = 0.8
VALUES = 128
BANDS = 32
STEP = 16
TOLERANCE = 1e-6
BUCKET_TILE = 512
BLOCK_TILE = 256

_MIX = np.random.default_rng(20240229)
_BYTES = _MIX.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _MIX.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them; the longest so far are kept."""
    kept = per_worker("ngram-powers", dict)
    if kept.get("n", 0) < n:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _BACK, np.uint64)
        up[0] = down[0] = 1
        kept.update(n=n, powers=(np.multiply.accumulate(up), np.multiply.accumulate(down)))
    return kept["powers"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def ngrams(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted, distinct 64-bit hashes of a UTF-8 text's word n-grams."""
    raw = np.frombuffer(text, np.uint8)
    word = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(16, int(len(raw) + 1).bit_length()))
    # A word's hash is the difference of two prefix sums, shifted back to its start.
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    n = max(len(hashes) - words + 1, 1)
    made = np.zeros(n, np.uint64)
    for k in range(min(words, len(hashes))):
        made = _mixed(made * np.uint64(_BASE) + hashes[k : k + n])
    if len(hashes) < words:  # short texts are one n-gram, told apart by their length
        made = _mixed(made + np.uint64(len(hashes)))
    return np.unique(made)


def set_hash(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def minhash(grams: np.ndarray) -> np.ndarray:
    """VALUES 32-bit values; all ones without n-grams."""
    made = np.full(VALUES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(grams), 512):
        part = (grams[start : start + 512, None] * _FACTORS[None, :]) >> np.uint64(32)
        np.minimum(made, part.min(axis=0), out=made)
    return made


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of four values."""
    rows, made = values.reshape(BANDS, -1), np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        made = _mixed(made * np.uint64(_BASE) + rows[:, k])
    return made.view(np.int64)


def chance_of_reaching(threshold: float, matches: int, compared: int) -> float:
    """P(similarity >= threshold | matches of compared values agree), uniform prior."""
    n = compared + 1
    return sum(
        math.comb(n, i) * threshold**i * (1 - threshold) ** (n - i) for i in range(matches + 1)
    )


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, least matches that go on) for each step."""
    return [
        (n, next(m for m in range(n + 1) if chance_of_reaching(threshold, m, n) >= tolerance))
        for n in range(STEP, VALUES + 1, STEP)
    ]


def surviving(left: np.ndarray, right: np.ndarray, least, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that no step drops; with ``same``, each pair once."""
    found_i, found_j = [], []
    for start in range(0, len(left), 64):
        block = left[start : start + 64]
        n, m = least[0]
        agree = (block[:, None, :n] == right[None, :, :n]).sum(axis=2, dtype=np.int16)
        i, j = np.nonzero(agree >= m)
        count = agree[i, j]
        i = i + start
        if same:
            once = i < j
            i, j, count = i[once], j[once], count[once]
        for before, (n, m) in zip((s[0] for s in least), least[1:]):
            if not len(i):
                break
            count = count + (left[i, before:n] == right[j, before:n]).sum(axis=1, dtype=np.int16)
            go_on = count >= m
            i, j, count = i[go_on], j[go_on], count[go_on]
        found_i.append(i)
        found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every place in ``nodes``, the smallest node joined to it by pairs of places (i, j)."""
    low = nodes.copy()
    while True:
        both = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, both)
        np.minimum.at(new, j, both)
        if (new == low).all():
            return low
        low = new


def links_of(grams: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least ``threshold``, exactly."""
    if not len(i):
        return np.zeros(0, bool)
    sizes = np.array([len(g) for g in grams], np.int64)
    # Sets without n-grams have a class of their own and no pairs.
    possible = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
    common = np.zeros(len(i), np.int64)
    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    # Either each pair is intersected, or all sets of the tile at once by matrix products over
    # slices of the n-grams; the cheaper way, with equal results.
    every = np.concatenate([grams[k] for k in used])
    vocabulary = np.unique(every)
    if len(i) * 30e-6 < 2.0 * len(used) ** 2 * len(vocabulary) / 2e10 + len(every) * 1e-7:
        for k in np.flatnonzero(possible):
            common[k] = len(np.intersect1d(grams[i[k]], grams[j[k]], assume_unique=True))
    else:
        at = np.searchsorted(vocabulary, every)
        row = np.repeat(np.arange(len(used)), sizes[used])
        total = np.zeros((len(used), len(used)), np.float32)
        width = 4096
        order = np.argsort(at, kind="stable")
        at, row = at[order], row[order]
        for start in range(0, len(vocabulary), width):
            a, b = np.searchsorted(at, [start, start + width])
            dense = np.zeros((len(used), width), np.float32)
            dense[row[a:b], at[a:b] - start] = 1.0
            total += dense @ dense.T
        common = total[place[: len(i)], place[len(i) :]].astype(np.int64)
    union = sizes[i] + sizes[j] - common
    return possible & (common >= threshold * union - 1e-9) & (union > 0)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, mark (of the text), set_hash, keys (of the bands) and values (two bytes each) of every row."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, keys, values = [], [], []
        for text in batch.column(2).to_pylist():
            grams = ngrams(text)
            v = minhash(grams)
            sets.append(set_hash(grams))
            keys.append(band_keys(v) if len(grams) else [])
            values.append((v & np.uint64(0xFFFF)).astype("<u2").tobytes())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(sets), pa.array(keys, pa.list_(pa.int64())), pa.array(values)],
            names=["doc_id", "mark", "set_hash", "keys", "values"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", _mark(), whole_text().cast("binary").alias("text"))
    return map_batches(texts, sign, f"doc_id {kind}, mark long, set_hash binary, keys array<long>, values binary")


def _mark() -> Column:
    """A hash of the text, by which rows without an id or with one id are told apart."""
    return F.xxhash64(whole_text()).alias("mark")


def _texts_of(docs: DataFrame) -> DataFrame:
    """(text_id, text_mark, text): the rows with an id, and every text of rows without one once."""
    own = docs.select(F.col("doc_id").alias("text_id"), _mark().alias("text_mark"), whole_text().cast("binary").alias("text"))
    alone = own.where("text_id IS NULL").groupBy("text_mark").agg(F.first("text").alias("text"))
    return own.where("text_id IS NOT NULL").unionByName(alone, allowMissingColumns=True)


def _tiles(size: Column, node: Column, tile: int) -> Column:
    """The pairs of tiles that a row belongs to: (own, i, j) with i <= j."""
    n = F.ceil(size / tile).cast("int")
    own = F.pmod(F.xxhash64(node, F.lit("tile")), n).cast("int")
    other = F.sequence(F.lit(0), n - 1)
    return F.transform(
        other,
        lambda u: F.struct(own.alias("own"), F.least(own, u).alias("i"), F.greatest(own, u).alias("j")),
    )


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, same_as.

    ``class_id``: the smallest id of the connected group of near-duplicates; ``n_links``: documents
    of a similarity of at least ``threshold``, copies included; ``same_as``: the smallest id with the same n-grams.
    """
    signed = settle(signatures(docs), "signatures")
    classes = (
        signed.groupBy("set_hash")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark")).alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("keys").alias("keys"),
            F.first("values").alias("values"),
        )
        .select("set_hash", F.col("first.doc_id").alias("first_id"), "first.mark", "copies", "keys", "values")
        # Unique, and stable once it is written.
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = settle(classes, "classes")
    blocks = components(_candidate_edges(classes, threshold, tolerance))
    members = settle(
        blocks.join(classes.select("node", "set_hash", "first_id", "mark", "copies", "values"), "node"),
        "block-members",
    )
    checked = settle(_verified(docs, members, threshold, tolerance), "verified")
    grouped = components(checked.select(F.col("node").alias("a"), F.col("low").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    # The members of each group name it by their smallest id.
    named = (
        classes.select("node", "set_hash", "first_id", "copies")
        .join(links, "node", "left")
        .join(grouped, "node", "left")
        .withColumn("group", F.coalesce("root", "node"))
    )
    named = settle(named, "linked-classes")
    first = named.groupBy("group").agg(F.min("first_id").alias("class_id"))
    results = named.join(first, "group").select(
        F.col("set_hash").alias("own"),
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("first_id").alias("same_as"),
    )
    return (
        signed.select("doc_id", "set_hash")
        .join(results, F.col("set_hash") == F.col("own"))
        .select("doc_id", "class_id", "n_links", "same_as")
    )


def _candidate_edges(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Spanning forests of the pairs that pruning leaves, over all buckets."""
    rows = classes.select("node", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = rows.join(counts.withColumnRenamed("key", "shared"), F.col("key") == F.col("shared"))
    placed = met.select("node", "key", F.explode(_tiles(F.col("n"), F.col("node"), BUCKET_TILE)).alias("t"))
    # A list holds two tiles at most. The same list often comes from many bands: once is enough.
    lists = placed.groupBy("key", "t.i", "t.j").agg(
        F.array_sort(F.collect_list(F.struct("node", "t.own"))).alias("members")
    )
    lists = lists.groupBy(F.xxhash64("members").alias("h"), F.size("members").alias("n")).agg(
        F.first("members").alias("members")
    )
    lists = settle(
        lists.where("n > 1").select(F.monotonically_increasing_id().alias("list"), "members"), "buckets"
    )
    placed = lists.select("list", F.explode("members").alias("m"))
    signed = placed.select("list", "m.node", "m.own").join(classes.select("node", "values"), "node")
    tiles = signed.groupBy("list").agg(F.collect_list(F.struct("node", "own", "values")).alias("members"))
    least = least_matches(threshold, tolerance)

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = [], []
        for members in batch.column(0):
            flat = members.values
            node = flat.field("node").to_numpy()
            own = flat.field("own").to_numpy()
            values = np.frombuffer(b"".join(flat.field("values").to_pylist()), "<u2").reshape(len(node), -1)
            i, j = _pairs(values, own, least)
            low = forest(node, i, j)
            a.append(node[low != node])
            b.append(low[low != node])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], names=["a", "b"]
        )

    return map_batches(tiles.select("members"), compare, "a long, b long")


def _pairs(values: np.ndarray, own: np.ndarray, least) -> tuple[np.ndarray, np.ndarray]:
    """Surviving pairs of places: within the one tile, or across the two."""
    tiles = np.unique(own)
    if len(tiles) == 1:
        return surviving(values, values, least, same=True)
    left, right = np.flatnonzero(own == tiles[0]), np.flatnonzero(own == tiles[1])
    i, j = surviving(values[left], values[right], least, same=False)
    return left[i], right[j]


def _verified(docs: DataFrame, members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, low, links): per tile, exactly verified links and the smallest node they reach."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    placed = members.join(sizes, "root")
    here = F.col("first_id").eqNullSafe(F.col("text_id")) & (F.col("mark") == F.col("text_mark"))
    own = placed.join(_texts_of(docs), here)
    tiled = own.select(
        "root", "node", "set_hash", "copies", "values", "text",
        F.explode(_tiles(F.col("n"), F.col("node"), BLOCK_TILE)).alias("t"),
    ).select("root", "node", "set_hash", "copies", "values", "text", "t.i", "t.j", "t.own")
    least = least_matches(threshold, tolerance)

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["node", "text"])
        grams = [ngrams(bytes(t)) for t in rows["text"]]
        # Texts of one id and mark are equal but for a clash of hashes; the class's own has its set.
        fits = [set_hash(g) == bytes(h) for g, h in zip(grams, rows["set_hash"])]
        rows, grams = rows[fits], [g for g, ok in zip(grams, fits) if ok]
        once = ~rows["node"].duplicated().to_numpy()
        rows, grams = rows[once], [g for g, ok in zip(grams, once) if ok]
        node, copies = rows["node"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
        if not len(node):
            return pd.DataFrame({"node": node, "low": node, "links": copies})
        values = np.frombuffer(b"".join(map(bytes, rows["values"])), "<u2").reshape(len(node), -1)
        i, j = _pairs(values, rows["own"].to_numpy(), least)
        held = links_of(grams, i, j, threshold)
        i, j = i[held], j[held]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        return pd.DataFrame({"node": node, "low": forest(node, i, j), "links": links})

    return tiled.groupBy("root", "i", "j").applyInPandas(verify, "node long, low long, links long")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of every group of near-duplicates the smallest id.

    Rows without an id can't be named, so they stay; an id that stands for several texts stays with
    all of them if it stays with one.
    """
    found = near_duplicates(docs).where(F.col("doc_id") == F.col("class_id"))
    stay = found.select(F.col("doc_id").alias("stays")).distinct()
    own = docs.select(F.struct("*").alias("row"), "doc_id")
    met = own.join(stay, F.col("doc_id") == F.col("stays"), "left")
    return met.where("doc_id IS NULL OR stays IS NOT NULL").select("row.*")


by_value(__name__)
