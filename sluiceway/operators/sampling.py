"""Previews and exact-size random samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.keys import row_hash
from sluiceway.operators.joins import join_same
from sluiceway.runtime import settle


# Up to so many rows each task keeps its best; larger samples are cut off by rank.
_HELD = 10_000


def sample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` random rows (all rows if there are fewer), the same however the input is split.

    Rows are ranked by a seeded hash of their values, so every use of the result sees one sample.
    A sample of up to ``_HELD`` rows is what is left of the best of each task. For a larger one the draws of all
    rows are sorted, without the rows, to find the n-th; rows below it are taken where they lie. ``sample_large`` takes
    the same rows without sorting; for a share of a huge table there is ``sample_fraction``.
    """
    if n < 1:
        raise ValueError("the sample size must be at least 1")
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), row_hash(df)))
    if n <= _HELD:
        return drawn.orderBy("_draw").limit(n).drop("_draw")
    cut = _draw_at(drawn, n)
    if cut is None:
        return df  # fewer rows than asked for
    last, left = cut
    taken = drawn.where(F.col("_draw") < last).drop("_draw")
    same = drawn.where(F.col("_draw") == last).withColumn("_piece", F.shiftright("_draw", 1))
    return taken.unionByName(_ranked_copies(same, ["_piece"], F.lit(left), df.columns))


def _draw_at(drawn: DataFrame, n: int) -> tuple[int, int] | None:
    """The draw of rank ``n`` and how many of its rows are within ``n``; None if there are fewer rows.

    Draws, counted if equal, are sorted by range; of the range that holds the rank again, until it is small.
    The driver gets a row per range.
    """
    rest, left = drawn.groupBy("_draw").agg(F.count(F.lit(1)).alias("_copies")), n
    while True:
        ranked = settle(rest.orderBy("_draw").withColumn("_range", F.spark_partition_id()), "draws")
        sizes = ranked.groupBy("_range").agg(F.sum("_copies").alias("rows"), F.count(F.lit(1)).alias("draws"))
        ranges = sorted(sizes.collect(), key=lambda r: r["_range"])
        at = None
        for r in ranges:
            if r["rows"] >= left:
                at = r
                break
            left -= r["rows"]
        if at is None:
            return None
        rest = ranked.where(F.col("_range") == at["_range"]).drop("_range")
        if len(ranges) == 1 or at["draws"] <= _HELD:
            break
    upto = F.sum("_copies").over(Window.orderBy("_draw"))
    found = rest.withColumn("_upto", upto).where(F.col("_upto") >= left).orderBy("_draw").first()
    return found["_draw"], left - (found["_upto"] - found["_copies"])


# Draws are 64 bits; a histogram is of the next _BITS of them, so it has at most 2**_BITS rows.
_BITS = 16
_CHUNK = 10_000


def sample_large(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """The rows of ``sample_rows``, for samples of any size: no step gathers them.

    A histogram of the draws' first bits says which stretch of draws the n-th falls into, a second one
    which part of the stretch. Rows below are taken where they lie; only those of that part, a
    2**-32 of all and copies of one row, are ranked, and copies are counted rather than moved.
    """
    if n < 1:
        raise ValueError("the sample size must be at least 1")
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), row_hash(df)))
    below, within, left = F.lit(False), F.lit(True), n
    for step in (1, 2):
        width = 64 - _BITS * step
        piece = F.shiftright("_draw", width)
        counts = sorted(drawn.where(within).groupBy(piece.alias("piece")).agg(F.count(F.lit(1))).collect())
        at = None
        for value, rows in counts:
            if rows >= left:
                at = value
                break
            left -= rows
        if at is None:
            return df  # fewer rows than asked for
        below, within = below | (within & (piece < at)), within & (piece == at)
    taken = drawn.where(below).drop("_draw")
    rest = drawn.where(within).withColumn("_piece", F.shiftright("_draw", 64 - 2 * _BITS))
    return taken.unionByName(_ranked_copies(rest, ["_piece"], F.lit(left), df.columns))


def _ranked_copies(rows: DataFrame, strata: list[str], left: Column, columns: list[str]) -> DataFrame:
    """Of ``rows`` the first ``left`` by draw (in each stratum); equal draws are copies, made from one row."""
    row = F.struct(*[f"`{c}`" for c in columns])
    counted = rows.groupBy(*strata, "_draw").agg(
        F.count(F.lit(1)).alias("_copies"), F.first(row).alias("_row"), F.first(left).alias("_left")
    )
    order = Window.partitionBy(*strata).orderBy("_draw").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_copies").over(order), F.lit(0))
    take = F.least(F.col("_copies"), F.col("_left") - before)
    some = counted.withColumn("_take", take).where("_take > 0")
    # In two steps, so that no row holds a list of all copies.
    chunks = some.select("_row", "_take", F.explode(F.expr(f"sequence(1L, _take, {_CHUNK}L)")).alias("_from"))
    last = F.least(F.col("_from") + _CHUNK - 1, F.col("_take"))
    return chunks.select("_row", F.explode(F.sequence("_from", last))).select("_row.*")


def sample_per_stratum(df: DataFrame, n: int, strata: list[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` random rows of every stratum (all of it if there are fewer), however large strata are.

    As ``sample_large``, with a histogram per stratum: 4096 pieces of draws, of which one is ranked.
    """
    if n < 1:
        raise ValueError("the sample size must be at least 1")
    piece = F.shiftright("_draw", 52)
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), row_hash(df))).withColumn("_piece", piece)
    counted = drawn.groupBy(*strata, "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    order = Window.partitionBy(*strata).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(order), F.lit(0))
    # The piece in which the n-th row lies; a smaller stratum has none and is taken whole.
    last = (
        counted.withColumn("_before", before)
        .where((F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n))
        .select(*strata, F.col("_piece").alias("_last"), (F.lit(n) - F.col("_before")).alias("_left"))
    )
    placed = join_same(drawn, last, strata, "left")
    taken = placed.where("_last IS NULL OR _piece < _last").select(*[f"`{c}`" for c in df.columns])
    ranked = _ranked_copies(placed.where("_piece = _last"), strata, F.col("_left"), df.columns)
    return taken.unionByName(ranked)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """A sample of about ``fraction`` of the rows, without any shuffle; equal rows go together."""
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), row_hash(df)), 11) / float(2**53)
    return df.filter(share < fraction)


def preview(
    df: DataFrame, n: int = 100, method: str = "top", order: list[str] | None = None, seed: int = 0
) -> DataFrame:
    """First (``top``, by ``order`` if given) or random (``sample``) rows."""
    if method == "sample":
        return sample_rows(df, n, seed)
    if method != "top":
        raise ValueError("method is 'top' or 'sample'")
    return (df.orderBy(*order) if order else df).limit(n)
