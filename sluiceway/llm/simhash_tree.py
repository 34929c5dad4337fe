"""Near-duplicates by SimHash, found through a vantage-point tree over the Hamming distance.

1. Every text becomes a 64-bit fingerprint: a bit is 1 if over half of the hashes (XXH64, seed 42) of
   its three-word shingles have it. Rows of equal fingerprints are one from here on.
2. A vantage-point tree is built from a bounded sample of the fingerprints. A node holds a vantage
   point and a bound on the distance to it. By the triangle inequality two fingerprints that differ in at
   most r bits have distances to the vantage point that differ by at most r. So whatever lies within
   the bound goes to the inner branch, and whatever lies beyond the bound less r goes to the outer one:
   of two linked fingerprints on different sides the nearer one goes both ways, so every linked pair
   shares a leaf, while all other branches are pruned.
3. A leaf is a shard. Within it, fingerprints are ordered by their distance to a vantage point of their
   own, and only those whose distances differ by at most r are compared, exactly. A shard reports no
   pairs but a spanning forest of its links; components join these across shards.

The sample (at most ``SAMPLE`` fingerprints, chosen by hash) shapes the tree alone; every fingerprint is
routed, so the result is exact however well the sample fits. Shards above ``TILE`` fingerprints are split
into pairs of tiles, so no task holds more than two tiles. What the driver holds is the sample and
a row per leaf.

Defined results: null text counts as empty; texts without words have fingerprint zero and are linked
like any other; one or two words are one shingle; rows that repeat a text or an id are each answered; a null id is
reported as it is and names a component only if no other id does (then the name is null); texts of any
length are taken whole, their hashes summed in stretches; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, map_batches, settle, whole_text
from sluiceway.llm.components import components
from sluiceway.runtime import settle_counted

WORDS = 3
RADIUS = 2
SAMPLE = 1 << 16
LEAF = 2048  # fingerprints of a shard aimed at
TILE = 4096
_STRETCH = 1 << 16


def fingerprint(text: bytes) -> int:
    """The SimHash of a UTF-8 text, unsigned; zero without words."""
    # Lowering bytes changes A-Z only, and they split at space and \x09 to \x0D only.
    words = text.lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_digest
    if len(words) < WORDS:
        digests, n = [h(b" ".join(words), 42)], 1
    else:
        shingles = zip(words, words[1:], words[2:])
        digests, n = [h(b"%b %b %b" % s, 42) for s in shingles], len(words) - WORDS + 1
    counts = np.zeros(64, np.int64)
    for start in range(0, n, _STRETCH):
        raw = np.frombuffer(b"".join(digests[start : start + _STRETCH]), np.uint8).reshape(-1, 8)
        # Sums of at most 65,536 ones are exact in float32.
        ones = np.ones(len(raw), np.float32) @ np.unpackbits(raw, axis=1).astype(np.float32)
        counts += ones.astype(np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print: the fingerprint as a signed long) of every row; a narrow map."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "print"])

    rows = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    return map_batches(rows, sign, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


class Tree:
    """A vantage-point tree as flat arrays; negative children are leaves (-1 - number)."""

    def __init__(self, sample: np.ndarray, leaf: int, radius: int = RADIUS):
        self.radius, self.leaves = radius, 0
        self.points: list[int] = []
        self.bounds: list[int] = []
        self.inner: list[int] = []
        self.outer: list[int] = []
        self._rng = np.random.default_rng(12)
        self.root = self._grow(sample, max(leaf, 2))
        self.point = np.array(self.points, np.uint64)
        self.bound = np.array(self.bounds, np.int64)
        self.sides = np.array([self.outer, self.inner], np.int64).reshape(2, -1)

    def _grow(self, sample: np.ndarray, leaf: int) -> int:
        split = self._split(sample) if len(sample) > leaf else None
        if split is None:
            self.leaves += 1
            return -self.leaves
        point, bound, distance = split
        at = len(self.points)
        self.points.append(point)
        self.bounds.append(bound)
        self.inner.append(0)
        self.outer.append(0)
        self.inner[at] = self._grow(sample[distance <= bound], leaf)
        self.outer[at] = self._grow(sample[distance > bound - self.radius], leaf)
        return at

    def _split(self, sample: np.ndarray) -> tuple[int, int, np.ndarray] | None:
        """The vantage point and bound that leave the fewest pairs; None if none saves a tenth of them."""
        best, least = None, 0.9 * float(len(sample)) ** 2
        for point in self._rng.choice(sample, min(4, len(sample)), replace=False):
            distance = np.bitwise_count(sample ^ point).astype(np.int64)
            upto = np.cumsum(np.bincount(distance, minlength=65)).astype(float)
            within = upto[:64]
            beyond = len(sample) - np.concatenate((np.zeros(self.radius), upto))[:64]
            pairs = within**2 + beyond**2
            bound = int(pairs.argmin())
            if pairs[bound] < least:
                best, least = (point, bound, distance), pairs[bound]
        return best

    def route(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``prints``, leaf) for every leaf that a fingerprint belongs to."""
        places, leaves = [], []
        place, node = np.arange(len(prints)), np.full(len(prints), self.root, np.int64)
        while len(place):
            done = node < 0
            places.append(place[done])
            leaves.append(-1 - node[done])
            place, node = place[~done], node[~done]
            distance = np.bitwise_count(prints[place] ^ self.point[node]).astype(np.int64)
            bound = self.bound[node]
            within, beyond = distance <= bound, distance > bound - self.radius
            place, node = (
                np.concatenate((place[within], place[beyond])),
                np.concatenate((self.sides[1][node[within]], self.sides[0][node[beyond]])),
            )
        return np.concatenate(places), np.concatenate(leaves)


def joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest place that the pairs (i, j) join it to."""
    low = np.arange(n)
    while True:
        a, b = low[i], low[j]
        if (a == b).all():
            return low
        both = np.minimum(a, b)
        np.minimum.at(low, a, both)
        np.minimum.at(low, b, both)
        while not (low[low] == low).all():
            low = low[low]


def forest(prints: np.ndarray, own: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (places i, j) of the links in a tile, or across two if ``own`` has two values.

    Ordered by their distance to the first, only stretches of near distances are compared.
    """
    prints, first = prints, own == own.min()
    distance = np.bitwise_count(prints ^ prints[0]).astype(np.int64)
    left = np.flatnonzero(first)
    right = left if first.all() else np.flatnonzero(~first)
    left, right = left[np.argsort(distance[left], kind="stable")], right[np.argsort(distance[right], kind="stable")]
    found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(left), 256):
        rows = left[start : start + 256]
        near = slice(
            np.searchsorted(distance[right], distance[rows[0]] - radius, side="left"),
            np.searchsorted(distance[right], distance[rows[-1]] + radius, side="right"),
        )
        columns = right[near]
        i, j = np.nonzero(np.bitwise_count(prints[rows][:, None] ^ prints[columns][None, :]) <= radius)
        i, j = rows[i], columns[j]
        low = joined(len(prints), i[i != j], j[i != j])
        moved = np.flatnonzero(low != np.arange(len(low)))
        found_i.append(moved)
        found_j.append(low[moved])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    low = joined(len(prints), i, j)
    moved = np.flatnonzero(low != np.arange(len(low)))
    return moved, low[moved]


def grown(prints: DataFrame, n: int, radius: int = RADIUS, sample: int = SAMPLE, leaf: int = LEAF) -> Tree:
    """The tree for ``n`` distinct fingerprints, from a bounded sample chosen by hash."""
    share = min(1.0, 1.2 * sample / max(n, 1))
    draw = F.pmod(F.xxhash64(F.col("print"), F.lit("sample")), F.lit(1 << 30))
    rows = prints.where(draw < math.ceil(share * (1 << 30))).limit(sample).toArrow()
    taken = np.sort(rows.column("print").to_numpy()).view(np.uint64)
    return Tree(taken, math.ceil(leaf * len(taken) / max(n, 1)), radius)


def links(prints: DataFrame, tree: Tree, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that join all fingerprints within the tree's radius of each other, never all pairs."""
    radius = tree.radius

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy().view(np.uint64)
        place, leaf = tree.route(values)
        return pa.RecordBatch.from_arrays(
            [pa.array(leaf), pa.array(values[place].view(np.int64))], names=["leaf", "print"]
        )

    shards = settle(map_batches(prints.select("print"), route, "leaf long, print long"), "shards")
    # One row per leaf, and the sample bounds the leaves.
    sizes = shards.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("print", F.lit("tile")), F.col("tiles")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda u: F.struct(F.least(F.col("own"), u).alias("i"), F.greatest(F.col("own"), u).alias("j")),
    )
    tiled = (
        shards.join(F.broadcast(sizes), "leaf")
        .withColumn("own", own)
        .select("leaf", "print", "own", F.explode(pairs).alias("t"))
        .select("leaf", "t.i", "t.j", "own", "print")
    )

    def link(rows: pa.Table) -> pa.Table:
        values = rows.column("print").to_numpy()
        i, j = forest(values.view(np.uint64), rows.column("own").to_numpy(), radius)
        return pa.table({"a": pa.array(values[i]), "b": pa.array(values[j])})

    return tiled.groupBy("leaf", "i", "j").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    signed = settle(fingerprints(docs), "fingerprints")
    distinct, n = settle_counted(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    tree = grown(distinct, n, radius)
    joined_prints = components(links(distinct, tree))
    rooted = settle(
        distinct.join(joined_prints.withColumnRenamed("node", "print"), "print", "left").select(
            "print", "least", F.coalesce("root", "print").alias("root")
        ),
        "rooted-fingerprints",
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(named, "root").select(F.col("print").alias("own"), "component_id")
    return signed.join(found, F.col("print") == F.col("own")).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


by_value(__name__)
