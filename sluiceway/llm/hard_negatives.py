"""Hard negatives of anchors, from Hilbert-ordered blocks of vectors chosen by zone maps.

1. Components become integers; rows are ordered along a Hilbert curve through their vectors, so that
   near vectors lie together, and written as Parquet blocks of ``BLOCK`` rows. A block's zone map is the
   least and the greatest value of every dimension.
2. Every anchor scores its own block: what it finds there is a first bound on its positives.
3. A search asks for the best k rows of each of an anchor's windows of scores. Interval arithmetic
   over a zone map gives the greatest and the least score that an anchor can have with any row of the
   block; only blocks that can reach a window are read. Positives are one window, from the first bound
   up; each positive then sets a window for its negatives.
4. Blocks and anchors meet in tiles: the blocks of a part (a stretch of the curve) and the anchors of a
   group (some parts). Blocks of the highest possible scores come first, and what they yield raises the windows'
   lower ends, so later blocks are skipped where they can't matter. A tile reports at most k rows a
   window; the best over all tiles count.

Every anchor meets every block, at least by its zone map, so work grows with anchors times blocks; memory doesn't: a
tile holds ``PART_BLOCKS`` blocks and the anchors of one group. The driver holds three numbers per dimension.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part;
shorter vectors count as filled up with zeros; rows that share an anchor's id are not among its
partners; rows that repeat an id are each a row; a null id is no anchor unless it is marked as one, and comes last
among ties. Components are held within +-sqrt(2**63 / dimensions), so that every score is a long. Ties
go to the smaller id. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, map_batches, settle

BLOCK = 256  # rows of a block
PART_BLOCKS = 16  # blocks of a part, about
GROUP_PARTS = 48  # parts whose anchors go together, at most
BITS = 2  # of the Hilbert curve in each dimension
_LEAST, _MOST = -(2**63), 2**63 - 1
_BLOCKS = (
    "part int, block long, ids array<long>, labels array<long>, anchors array<boolean>, "
    "vectors binary, low array<long>, high array<long>, floors array<long>"
)
_ANCHORS = "anchor long, part int, anchor_id long, label long, vector binary, floor long"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of rows of cell numbers (below 2**bits), as rows of bytes."""
    x = cells.T.astype(np.uint8 if bits <= 8 else np.uint32).copy()
    dims, step = len(x), 1 << (bits - 1)
    # From the coarsest bit to the finest: undo the turns and mirrorings of the curve, …
    while step > 1:
        below = x.dtype.type(step - 1)
        for i in range(dims):
            mirrored = (x[i] & step) != 0
            swap = np.where(mirrored, 0, (x[0] ^ x[i]) & below).astype(x.dtype)
            x[0] ^= np.where(mirrored, below, swap).astype(x.dtype)
            x[i] ^= swap
        step >>= 1
    # … then count in Gray code.
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn, step = np.zeros_like(x[0]), 1 << (bits - 1)
    while step > 1:
        turn ^= np.where((x[-1] & step) != 0, step - 1, 0).astype(x.dtype)
        step >>= 1
    x ^= turn
    planes = [((x >> bit) & 1).T for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


class Shape:
    """What the vectors have in common: dimensions, spread of each, and how to hold and multiply them."""

    def __init__(self, mean: list[float], spread: list[float], most: int):
        self.dims = len(mean)
        self.held = math.isqrt(_MOST // self.dims)
        most = min(most, self.held)
        self.mean, self.spread = np.array(mean), np.maximum(np.array(spread), 1e-9)
        self.kind = next(t for t in ("<i2", "<i4", "<i8") if most < 2 ** (int(t[2]) * 8 - 1))
        # Sums of products below 2**53 are exact in float64.
        self.exact = np.float64 if most * most * self.dims < 2**53 else np.int64

    def matrix(self, vectors: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(vectors), self.kind).reshape(-1, self.dims).astype(self.exact)


def dense(column: pa.ListArray, dims: int, held: int) -> np.ndarray:
    """Lists of longs as rows, filled up with zeros and held within bounds."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    made = np.zeros((len(column), dims), np.int64)
    made[np.arange(dims) < sizes[:, None]] = values
    return np.clip(made, -held, held)


def reach(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score of each anchor with anything between ``low`` and ``high`` of each block."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def best(window: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k rows of each window by score, then id."""
    order = np.lexsort((ids, -score, window))
    sorted_window = window[order]
    first = np.searchsorted(sorted_window, sorted_window, side="left")
    return order[np.arange(len(order)) - first < k]


def quantised(rows: DataFrame, vector: str, label: Column, anchor: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label, anchor, q) of the rows that take part; q holds floor(scale * component)."""
    values = F.col(vector).cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(label.isNotNull() & values.isNotNull() & ~odd).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(values, lambda x: F.floor(x * scale)).alias("q"),
    )


def shape_of(rows: DataFrame) -> tuple[Shape, int]:
    """The shape of all vectors, and the number of rows; a row per dimension reaches the driver."""
    value = F.col("value").cast("double")
    spread = (
        rows.select(F.posexplode_outer("q").alias("dim", "value"))
        .groupBy("dim")
        .agg(F.avg(value), F.stddev_pop(value), F.min("value"), F.max("value"), F.count(F.lit(1)))
        .collect()
    )
    first = [r for r in spread if r[0] in (None, 0)]
    found = sorted(r for r in spread if r[0] is not None) or [(0, 0.0, 0.0, 0, 0, 0)]
    most = max(max(abs(r[3]), abs(r[4])) for r in found)
    return Shape([r[1] for r in found], [r[2] for r in found], most), sum(r[5] for r in first)


def blocks_of(rows: DataFrame, shape: Shape, parts: int, positives: int) -> DataFrame:
    """Blocks in the order of the curve with their zone maps; per anchor of a block its first bound."""

    def key(batch: pa.RecordBatch) -> pa.RecordBatch:
        q = dense(batch.column(3), shape.dims, shape.held)
        cells = np.clip(np.floor((q - shape.mean) / shape.spread) + 2, 0, 3).astype(np.uint8)
        keys = [k.tobytes() for k in hilbert_keys(cells)]
        vectors = [v.tobytes() for v in q.astype(shape.kind)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
            names=["vec_id", "label", "anchor", "key", "vector"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, waiting = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            while waiting.num_rows >= BLOCK:
                yield block(waiting.slice(0, BLOCK), part, number)
                waiting, number = waiting.slice(BLOCK), number + 1
        if waiting is not None and waiting.num_rows:
            yield block(waiting, part, number)

    def block(rows: pa.Table, part: int, number: int) -> pa.RecordBatch:
        vectors = rows.column("vector").to_pylist()
        matrix = shape.matrix(vectors)
        labels = rows.column("label").to_numpy()
        ids = rows.column("vec_id").to_pylist()
        floors = []
        for at in np.flatnonzero(rows.column("anchor").to_numpy()).tolist():
            partners = (labels == labels[at]) & np.array([i != ids[at] for i in ids])
            scores = np.sort((matrix[partners] @ matrix[at]).astype(np.int64))
            floors.append(int(scores[-positives]) if len(scores) >= positives else _LEAST)
        one = [
            [part],
            [(part << 32) | number],
            [ids],
            [labels.tolist()],
            [rows.column("anchor").to_pylist()],
            [b"".join(vectors)],
            [matrix.min(axis=0).astype(np.int64).tolist()],
            [matrix.max(axis=0).astype(np.int64).tolist()],
            [floors],
        ]
        longs = pa.list_(pa.int64())
        types = [pa.int32(), pa.int64(), longs, longs, pa.list_(pa.bool_()), pa.binary(), longs, longs, longs]
        names = [f.split()[0] for f in _BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, types)], names=names)

    keyed = map_batches(
        rows.select("vec_id", "label", "anchor", "q"), key, "vec_id long, label long, anchor boolean, key binary, vector binary"
    )
    ordered = keyed.repartitionByRange(parts, "key", "vec_id").sortWithinPartitions("key", "vec_id")
    return settle(ordered.mapInArrow(pack, _BLOCKS), "vector-blocks")


def anchors_of(blocks: DataFrame, shape: Shape) -> DataFrame:
    """The anchors among the rows of ``blocks``, each with the number of its place as a name."""

    def take(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        width = shape.dims * int(shape.kind[2])
        for row in batch.to_pylist():
            at = [i for i, a in enumerate(row["anchors"]) if a]
            for i, floor in zip(at, row["floors"]):
                vector = row["vectors"][i * width : (i + 1) * width]
                made.append((row["block"] * BLOCK + i, row["part"], row["ids"][i], row["labels"][i], vector, floor))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        columns = list(zip(*made)) if made else [[]] * 6
        names = [f.split()[0] for f in _ANCHORS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    some = blocks.where(F.size("floors") > 0).select("part", "block", "ids", "labels", "anchors", "vectors", "floors")
    return settle(map_batches(some, take, _ANCHORS), "anchors")


class Windows:
    """The windows of scores of a tile's anchors, flat: place of the anchor, lower and upper end, number."""

    def __init__(self, anchors: pa.Table, bounds: Callable[[int], tuple[int, int]]):
        goals = anchors.column("goals").to_pylist()
        self.place = np.repeat(np.arange(len(goals)), [len(g) for g in goals])
        ends = [bounds(g) for of in goals for g in of]
        clip = lambda at: [min(max(e[at], _LEAST), _MOST) for e in ends]
        self.low, self.high = np.array(clip(0), np.int64), np.array(clip(1), np.int64)
        self.number = np.array([w for of in goals for w in range(len(of))], np.int64)


def search(
    blocks: DataFrame,
    anchors: DataFrame,
    shape: Shape,
    parts: int,
    groups: int,
    same: bool,
    k: int,
    bounds: Callable[[int], tuple[int, int]],
) -> DataFrame:
    """(anchor, window, place, vec_id, score): the first k rows in each window of every anchor.

    ``goals`` of an anchor become windows through ``bounds``; ``same`` asks for partners of its label,
    else for those of others. Among equal scores the smaller id is first.
    """

    def may_matter(windows: Windows, matrix, labels, zones: pa.Table, low=None) -> tuple[np.ndarray, np.ndarray]:
        """Per window and block whether a row of the block may be in the window; the greatest scores too."""
        lows = np.array(zones.column("low").to_pylist()).astype(shape.exact)
        highs = np.array(zones.column("high").to_pylist()).astype(shape.exact)
        least, most = reach(matrix, lows, highs)
        known = [set(x) for x in zones.column("kinds").to_pylist()]
        fits = np.array([[(x in s) if same else (s != {x}) for s in known] for x in labels], bool).reshape(len(labels), -1)
        at = windows.place
        return fits[at] & (most[at] >= windows.low[:, None]) & (least[at] <= windows.high[:, None]), most[at]

    def plan(key: tuple, zones: pa.Table, mine: pa.Table) -> pa.Table:
        grp, part = (int(x.as_py()) for x in key)
        if zones.num_rows and mine.num_rows:
            matrix = shape.matrix(mine.column("vector").to_pylist())
            needed, _ = may_matter(Windows(mine, bounds), matrix, mine.column("label").to_pylist(), zones)
            zones = zones.filter(pa.array(needed.any(axis=0)))
        else:
            zones = zones.slice(0, 0)
        n = zones.num_rows
        return pa.table({
            "grp": pa.array([grp] * n, pa.int32()),
            "part": pa.array([part] * n, pa.int32()),
            "block": zones.column("block").combine_chunks(),
        })

    def score(key: tuple, near: pa.Table, mine: pa.Table) -> pa.Table:
        windows = Windows(mine, bounds)
        low = windows.low.copy()
        names, labels = mine.column("anchor").to_numpy(), mine.column("label").to_numpy()
        none = [np.empty(0, np.int64)] * 4
        kept = none
        if near.num_rows and mine.num_rows:
            matrix = shape.matrix(mine.column("vector").to_pylist())
            needed, most = may_matter(windows, matrix, labels.tolist(), near)
            own_ids = np.array([_MOST if i is None else i for i in mine.column("anchor_id").to_pylist()], np.int64)
            for b in np.argsort(-most.max(axis=0), kind="stable").tolist():
                rows = np.flatnonzero(needed[:, b] & (most[:, b] >= low))
                if not len(rows):
                    continue
                used, at = np.unique(windows.place[rows], return_inverse=True)
                their_labels = np.array(near.column("labels")[b].as_py(), np.int64)
                listed = near.column("ids")[b].as_py()
                ids = np.array([_MOST if i is None else i for i in listed], np.int64)
                scores = (matrix[used] @ shape.matrix([near.column("vectors")[b].as_py()]).T).astype(np.int64)
                equal = labels[used][:, None] == their_labels[None, :]
                partner = (equal & (own_ids[used][:, None] != ids[None, :])) if same else ~equal
                of = scores[at]
                inside = partner[at] & (of >= low[rows][:, None]) & (of <= windows.high[rows][:, None])
                i, j = np.nonzero(inside)
                nulls = np.array([x is None for x in listed], np.int64)
                kept = [np.concatenate(c) for c in zip(kept, (rows[i], of[i, j], ids[j], nulls[j]))]
                first = best(kept[0], kept[1], kept[2], k)
                kept = [c[first] for c in kept]
                full, count = np.unique(kept[0], return_counts=True)
                # The k-th score so far: whatever is below it can't be among the first k.
                last = np.searchsorted(kept[0], full, side="right") - 1
                low[full[count >= k]] = kept[1][last[count >= k]]
        w, found, ids, nulls = kept
        return pa.table({
            "anchor": pa.array(names[windows.place[w]], pa.int64()),
            "window": pa.array(windows.number[w].astype(np.int32), pa.int32()),
            "vec_id": pa.array(ids, pa.int64(), mask=nulls.astype(bool)),
            "score": pa.array(found, pa.int64()),
        })

    per_group = math.ceil(parts / groups)
    mine = anchors.withColumn("grp", (F.col("part") / per_group).cast("int"))
    zones = blocks.select("part", "block", "low", "high", F.array_distinct("labels").alias("kinds"))
    # The zone maps of a part meet the anchors of a group: equal keys, each a bounded stretch of both.
    asked = zones.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asking = mine.drop("part").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    needed = settle(
        asked.groupBy("grp", "part").cogroup(asking.groupBy("grp", "part")).applyInArrow(plan, "grp int, part int, block long"),
        "blocks-to-read",
    )
    read = needed.join(
        blocks.select("block", "ids", "labels", "vectors", "low", "high", F.array_distinct("labels").alias("kinds")), "block"
    )
    tiles = needed.select("grp", "part").distinct().toDF("grp", "tile_part")
    meeting = mine.drop("part").join(tiles, "grp").withColumnRenamed("tile_part", "part")
    meeting = meeting.toDF(*meeting.columns)  # columns of their own, as both sides come from `needed`
    found = (
        read.groupBy("grp", "part")
        .cogroup(meeting.groupBy("grp", "part"))
        .applyInArrow(score, "anchor long, window int, vec_id long, score long")
    )
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(
    rows: DataFrame,
    label: Column,
    anchor: Column,
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive the first negatives whose score is within the given shares of the positive's.

    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Positives are the best rows of the
    anchor's label, negatives those of other labels; scores are integer inner products.
    """
    taking_part = quantised(rows, vector, label, anchor, scale)
    shape, n = shape_of(taking_part)
    parts = max(1, math.ceil(n / (BLOCK * PART_BLOCKS)))
    groups = math.ceil(parts / min(GROUP_PARTS, max(1, parts // 8)))
    blocks = blocks_of(taking_part, shape, parts, positives)
    anchors = anchors_of(blocks, shape)

    upwards = anchors.withColumn("goals", F.array("floor"))
    best_positives = search(blocks, upwards, shape, parts, groups, True, positives, lambda floor: (floor, _MOST))
    found = best_positives.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("vec_id").alias("id"), "score"))).alias("positives")
    )
    # At most `positives` entries an anchor.
    aimed = settle(
        anchors.join(found, "anchor").withColumn("goals", F.transform("positives", lambda p: p.score)), "aimed-anchors"
    )
    within = search(
        blocks,
        aimed.drop("positives"),
        shape,
        parts,
        groups,
        False,
        negatives,
        lambda goal: (-((-low_percent * goal) // 100), (high_percent * goal) // 100),
    )
    named = aimed.select("anchor", "anchor_id", F.posexplode("positives").alias("window", "positive"))
    return within.join(named, ["anchor", "window"]).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


by_value(__name__)
