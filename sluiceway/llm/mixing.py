"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words. Whole copies that all its documents get are certain
(``floor(target / size)``); what is left is sampled without replacement. A document's inclusion
chance is unequal: it falls with the root of the document's size (by size classes of a sixteenth
octave), since long documents move the total most, and is scaled so that the expected words meet
the rest; chances that reach 1 are certain too. Documents are ranked by random odds divided by
inclusion odds, and the sample is the longest stretch of that ranking whose words don't exceed the
rest. What then is missing is closed by the one document outside the stretch that fits it best.

The ranking is never sorted whole. Its keys fall into fixed buckets; sums per bucket tell in
which bucket a source's sample ends, and only that bucket's documents are ordered, so a source with
a third of all rows costs no task more than its share.

Random numbers are hashes of the row's id, of its text and of its number among rows equal in both, so
reruns agree, and rows without an id are drawn one by one like any others. Defined results: null and empty
texts have size 0 and add no words; a null source is a source of its own, last in order; of rows that repeat
id, text and source as many are taken as the draw says, whichever; texts of any length are counted whole; extra columns pass through
``repeated``; an empty table gives an empty mix. The number of sources is bounded by ``MAX_SOURCES`` (an error beyond it, never
a cut), since a row per source passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, map_batches, settle, whole_text

MAX_SOURCES = 100_000
BUCKETS = 4096
CLASSES_PER_OCTAVE = 16
# Equal rows made again from their count at a time.
CHUNK = 10_000


def word_count(text: str = "text") -> Column:
    """Words of a whole text, split at white space."""
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def water_fill(
    sizes: Sequence[int], weights: Sequence[float], total: float, most: float
) -> list[float]:
    """Share ``total`` by weight; none above ``most`` times its size, the excess reshared."""
    targets, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * share >= most * sizes[i]]
        for i in full:
            targets[i] = most * sizes[i]
            left -= targets[i]
        if not full:
            for i in open_:
                targets[i] = weights[i] * share
            break
        open_ = [i for i in open_ if targets[i] == 0.0 and i not in set(full)]
    return targets


def chance_scale(classes: list[tuple[int, int]], rest: float) -> float:
    """c such that the chances min(1, c * w(class)) take ``rest`` words in expectation.

    ``classes``: (size class, words). w falls by the root of the size, so it falls with the class:
    chances reach 1 in the order of classes.
    """
    words = sorted((k, n) for k, n in classes if n)
    certain, tail = 0, sum(n * weight_of(k) for k, n in words)
    for k, n in words:
        c = (rest - certain) / tail if tail > 0 else 0.0
        if c * weight_of(k) < 1:
            return max(c, 0.0)
        certain += n
        tail -= n * weight_of(k)
    return math.inf


def weight_of(size_class: int) -> float:
    return 2.0 ** (-size_class / (2 * CLASSES_PER_OCTAVE))


def mix(
    docs: DataFrame,
    weights: Callable[[int], float],
    share: float,
    most: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, source, mark, size, source_size, target, copies, taken.

    ``weights``: of the source at each place of the code point order; ``share``: of all words that
    the mix takes; ``most``: the largest multiple of a source's size.
    """
    spark = docs.sparkSession
    # Tables of the session's own making are small from here on: numbers and the source's name.
    sized = settle(_numbered(docs), "mix-sizes")
    size_class = F.floor(F.log2(F.greatest("size", F.lit(1))) * CLASSES_PER_OCTAVE).cast("int")
    per_class = settle(
        sized.groupBy("source", size_class.alias("class")).agg(F.sum("size").alias("words")), "mix-classes"
    )
    order = per_class.groupBy("source").agg(F.sum("words").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(order) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    order.sort(key=lambda r: (r.source is None, str(r.source)))
    sizes = [r.size for r in order]
    targets = water_fill(sizes, [weights(i) for i in range(len(order))], share * sum(sizes), most)
    plan = []
    for r, target in zip(order, targets):
        base = min(math.floor(target / r.size), math.floor(most)) if r.size else 0
        plan.append((r.source, r.size, target, base, target - base * r.size))
    kind = docs.schema["source"].dataType.simpleString()
    # At most MAX_SOURCES rows: the broadcasts below have that bound.
    sources = spark.createDataFrame(plan, f"name {kind}, source_size long, target double, base long, rest double")
    sources = settle(_scaled(sources, per_class), "mix-sources")
    known = F.col("source").eqNullSafe(F.col("name"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "mark", "nth", F.lit(seed)), 12) + 0.5) / float(2**52)
    row = ("doc_id", "mark", "nth")
    chance = F.least(
        F.lit(1.0), F.col("scale") * F.pow(F.lit(2.0), -size_class / (2.0 * CLASSES_PER_OCTAVE))
    )
    # Pareto: random odds / inclusion odds, both finite; certain documents come first.
    odds = F.when(chance >= 1, 0.0).when(
        chance > 0, u / (1 - u) * (1 - chance) / chance
    )
    ranked = (
        sized.join(F.broadcast(sources), known)
        .withColumn("key", odds)
        .withColumn("bucket", F.floor(F.col("key") / (1 + F.col("key")) * BUCKETS).cast("int"))
    )
    cumulated = Window.partitionBy("name").orderBy("bucket")
    before = F.sum("words").over(cumulated) - F.col("words")
    ends = (
        ranked.where("key IS NOT NULL AND rest > 0")
        .groupBy("name", "bucket", "rest")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", before)
        .where("before < rest")
        .groupBy("name")
        .agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("end"))
        .select(F.col("name").alias("ending"), F.col("end.bucket").alias("last"), "end.before")
    )
    ends = settle(ends, "mix-ends")
    in_order = Window.partitionBy("name").orderBy("key", *row)
    reached = F.col("before") + F.sum("size").over(in_order)
    cut = (
        ranked.join(
            F.broadcast(ends), F.col("name").eqNullSafe(F.col("ending")) & (F.col("bucket") == F.col("last"))
        )
        .withColumn("reached", reached)
        .where("reached <= rest")
        .groupBy("name")
        .agg(
            F.max(F.struct("key", *row)).alias("to"), F.max("reached").alias("filled")
        )
        .withColumnRenamed("name", "ending")
    )
    stretch = settle(
        ends.alias("e")
        .join(cut.alias("c"), F.expr("e.ending <=> c.ending"), "left")
        .select(
            "e.ending", "last", "to", F.coalesce("filled", "before").cast("double").alias("filled")
        ),
        "mix-stretch",
    )
    here = F.struct("key", *row)
    sampled = ranked.join(
        F.broadcast(stretch), F.col("name").eqNullSafe(F.col("ending")), "left"
    ).withColumn(
        "sampled",
        F.coalesce(
            (F.col("bucket") < F.col("last"))
            | ((F.col("bucket") == F.col("last")) & (here <= F.col("to"))),
            F.lit(False),
        ),
    )
    # One document more per source if it leaves a smaller gap than the stretch alone.
    gap = F.col("rest") - F.col("filled")
    closing = (
        sampled.where("NOT sampled AND key IS NOT NULL AND size > 0")
        .withColumn("off", F.abs(gap - F.col("size")))
        .where(F.col("off") < F.abs(gap))
        .groupBy("name")
        .agg(F.min(F.struct("off", "key", *row)).alias("best"))
        .select(F.col("name").alias("closed"), F.struct(*[f"best.{c}" for c in row]).alias("closing"))
    )
    closing = settle(closing, "mix-closing")
    closes = F.col("closing").isNotNull() & F.struct(*row).eqNullSafe(F.col("closing"))
    done = sampled.join(F.broadcast(closing), F.col("name").eqNullSafe(F.col("closed")), "left")
    done = done.withColumn("copies", F.col("base") + (F.col("sampled") | closes).cast("long"))
    return done.select(
        "doc_id",
        "source",
        "mark",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def _mark() -> Column:
    """A hash of the whole text."""
    return F.xxhash64(whole_text()).alias("mark")


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, source, mark, size, nth) of every row; equal rows are numbered from 1.

    Equal rows are counted, with map-side combine, and made again from the count in two steps, so no task
    or list holds all of them.
    """
    rows = docs.select("doc_id", "source", _mark(), word_count().alias("size"))
    counted = rows.groupBy("doc_id", "source", "mark").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    parts = counted.select("*", F.explode(F.expr(f"sequence(1L, rows, {CHUNK}L)")).alias("from"))
    upto = F.least(F.col("rows"), F.col("from") + CHUNK - 1)
    return parts.select("doc_id", "source", "mark", "size", F.explode(F.sequence("from", upto)).alias("nth"))


def _scaled(sources: DataFrame, per_class: DataFrame) -> DataFrame:
    """``sources`` with the scale of their chances, each from its own size classes (a few hundred at most)."""
    classes = per_class.groupBy("source").agg(F.collect_list(F.struct("class", "words")).alias("classes"))
    met = sources.join(classes, F.col("source").eqNullSafe(F.col("name"))).select(*sources.columns, "classes")

    def scale(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [
            min(chance_scale([(c["class"], c["words"]) for c in classes], rest), 1e300) if rest > 0 else 0.0
            for rest, classes in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
        ]
        return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(made, pa.float64())], names=[*sources_names, "scale"])

    sources_names = sources.columns
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in sources.schema.fields]
    return map_batches(met, scale, ", ".join([*kinds, "scale double"]))


def five_two_one(place: int) -> float:
    """Weights 5, 2, 1, repeating."""
    return (5.0, 2.0, 1.0)[place % 3]


def repeated(docs: DataFrame, weights=five_two_one, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns."""
    same = ("doc_id", "source", "mark")
    # Equal rows get all that the draw gave any of them: `each` copies all, one more the first `more` of them.
    total = F.sum("copies")
    copies = mix(docs, weights, share, most).groupBy(*same).agg(
        F.count(F.lit(1)).alias("rows"),
        F.floor(total / F.count(F.lit(1))).alias("each"),
        (total % F.count(F.lit(1))).alias("more"),
    )
    copies = settle(copies.where("each > 0 OR more > 0"), "mix-copies").withColumnsRenamed({c: f"mixed_{c}" for c in same})
    own = docs.select(F.struct("*").alias("row"), "doc_id", "source", _mark())
    met = own.join(copies, reduce(and_, [F.col(c).eqNullSafe(F.col(f"mixed_{c}")) for c in same]))
    if copies.where("more > 0 AND rows > 1").isEmpty():
        taken = met.withColumn("copies", F.col("each") + F.col("more"))
    else:
        taken = _first_of_equals(met, same)
    many = taken.where("copies > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return many.select("row.*")


def _first_of_equals(met: DataFrame, same: tuple[str, ...]) -> DataFrame:
    """``met`` with copies: ``each``, and one more for the first ``more`` rows of every group of equals.

    Groups are counted per input task; a task's rows take their share of ``more`` in turn, so a group is never
    brought together.
    """
    placed = settle(met.withColumn("task", F.spark_partition_id()), "mix-equals")
    counts = placed.where("rows > 1").groupBy(*same, "task").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy(*same).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0))).drop("here")
    counts = counts.withColumnsRenamed({c: f"at_{c}" for c in (*same, "task")})
    here = reduce(and_, [F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in (*same, "task")])
    nth = F.row_number().over(Window.partitionBy(*same, "task").orderBy(F.lit(1)))
    several = placed.where("rows > 1").withColumn("nth", nth).join(counts, here)
    more = (F.col("before") + F.col("nth") <= F.col("more")).cast("long")
    single = placed.where("rows = 1").withColumn("copies", F.col("each") + F.col("more"))
    several = several.withColumn("copies", F.col("each") + more).select(*single.columns)
    return single.unionByName(several)


by_value(__name__)
