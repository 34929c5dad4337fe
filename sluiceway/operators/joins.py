"""Join chains, semi and anti joins, one-row summaries."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.runtime import settle, settle_counted


@dataclass(frozen=True)
class Join:
    """One step of a chain: a named frame, its condition and the join type.

    ``within`` names (point, start, end): the point of the rows so far lies in the step's interval, start
    included, end not, nulls open. Such a join is planned through bins instead of a nested loop; ``on`` may then be empty.
    """

    df: DataFrame
    name: str
    on: str | Column = ""
    how: str = "left"
    within: tuple[str, str, str] | None = None


def join_chain(
    base: DataFrame,
    name: str,
    joins: list[Join],
    columns: list[str] | None = None,
    where: str | Column | None = None,
    group_by: list[str] | None = None,
) -> DataFrame:
    """Base frame plus any number of joins, as one plan.

    Conditions and columns are SQL text over the given names (equi or theta). With
    ``group_by`` the remaining columns are aggregates. Spark chooses every join strategy;
    a join without a condition is refused. A step with ``within`` is an interval join (see
    ``interval_join``); if it is the only one and its rows are just counted per group, they aren't formed (see
    ``_counted_intervals``).
    """
    if group_by and where is None and len(joins) == 1 and joins[0].within:
        counted = _counted_intervals(base, name, joins[0], columns or [], group_by)
        if counted is not None:
            return counted
    out, names = base.alias(name), [name]
    for j in joins:
        if j.how == "cross":
            raise ValueError("a chain joins on a condition; use one_row to attach scalars")
        on = F.expr(j.on) if isinstance(j.on, str) and j.on else j.on
        if j.within:
            # Each frame as one struct of its name, which the same texts reach into.
            packed = out.select(*[F.struct(f"{n}.*").alias(n) for n in names])
            out = interval_join(packed, j.df.select(F.struct("*").alias(j.name)), *j.within, on=on, how=j.how)
        else:
            out = out.join(j.df.alias(j.name), on, j.how)
        names.append(j.name)
    if where is not None:
        out = out.filter(where)
    if group_by:
        measures = [F.expr(c) for c in columns or [] if c not in group_by]
        return out.groupBy(*[F.expr(g) for g in group_by]).agg(*measures)
    if columns:
        return out.select(*[F.expr(c) for c in columns])
    return out.select(*[f"{n}.*" for n in names]) if any(j.within for j in joins) else out


# Bins get 8 times narrower from level to level; intervals shorter than 8**-LEVELS of all share the last.
_FAN, _LEVELS = 8, 12


def _position(df: DataFrame, value: str) -> Column:
    """A number that never falls as ``value`` rises: numbers, dates and timestamps."""
    kind, c = df.select(F.expr(value)).schema[0].dataType, F.expr(value)
    if isinstance(kind, T.TimestampNTZType):
        # Clock time, without a detour through a zone where it may jump back.
        day = F.unix_date(c.cast("date")) * F.lit(86400)
        return (day + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise ValueError(f"no order of numbers for {kind.simpleString()}")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    end: str,
    on: Column | str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Rows of ``points`` with the rows of ``intervals`` whose [start, end) holds their point.

    An interval goes to the few bins it touches at the level whose bins are 1 to 8 times shorter than
    itself; a point goes to its bin at every level that occurs. They meet on equal bins, each pair once,
    and the exact test follows: candidates are at most a small multiple of the result, whatever the lengths, and a
    long interval costs no more rows than a short one. Null bounds are open, a null point lies in
    nothing. ``on`` may hold further conditions. ``how``: inner or left (then columns of both frames differ in name). The
    driver holds the range of the bounds and the numbers of the levels.
    """
    if how not in ("inner", "left"):
        raise ValueError("an interval join is inner or left")
    low, high = _position(intervals, start), _position(intervals, end)
    bounds = intervals.agg(
        F.min(F.least(low, high)).alias("low"), F.max(F.greatest(low, high)).alias("high")
    ).first()
    first = bounds["low"] if bounds["low"] is not None else 0.0
    span = max((bounds["high"] if bounds["high"] is not None else 0.0) - first, 1e-9)

    def share(position: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (position - F.lit(first)) / F.lit(span)))

    def bin_of(part: Column, level: Column) -> Column:
        return F.floor(part * F.pow(F.lit(float(_FAN)), level)).cast("long")

    begins, ends = F.when(low.isNull(), 0.0).otherwise(share(low)), F.when(high.isNull(), 1.0).otherwise(share(high))
    length = F.greatest(ends - begins, F.lit(1e-18))
    level = F.least(F.lit(_LEVELS), F.ceil(-F.log(float(_FAN), length))).cast("int")
    fits = low.isNull() | high.isNull() | (low <= high)
    levelled = intervals.where(fits).withColumns({"_begins": begins, "_ends": ends, "_interval_level": level})
    levels = sorted(r[0] for r in levelled.select("_interval_level").distinct().collect())
    wide = levelled.withColumn(
        "_interval_bin",
        F.explode(
            F.sequence(
                bin_of(F.col("_begins"), F.col("_interval_level")), bin_of(F.col("_ends"), F.col("_interval_level"))
            )
        ),
    )
    if how == "left":
        # Numbered once, so that the rows without a match can be told.
        points = settle(points.withColumn("_point_row", F.monotonically_increasing_id()), "interval-points")
    at = share(_position(points, point))
    bins = F.array(*[F.struct(F.lit(n).alias("level"), bin_of(at, F.lit(n)).alias("bin")) for n in levels or [0]])
    placed = points.where(F.expr(point).isNotNull()).select("*", F.explode(bins).alias("_point_bin"))
    exact = (F.expr(start).isNull() | (F.expr(point) >= F.expr(start))) & (
        F.expr(end).isNull() | (F.expr(point) < F.expr(end))
    )
    meet = (F.col("_point_bin.level") == F.col("_interval_level")) & (F.col("_point_bin.bin") == F.col("_interval_bin"))
    if isinstance(on, Column) or on:
        meet = (F.expr(on) if isinstance(on, str) else on) & meet
    met = placed.join(wide, meet & exact).drop("_point_bin", "_begins", "_ends", "_interval_level", "_interval_bin")
    if how == "inner":
        return met
    met = settle(met, "interval-join")
    alone = points.join(key_side(met, ["_point_row"]), "_point_row", "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).drop("_point_row")


# A plain column, and the counts that are folded before an interval join; other texts are left to the pairs.
_PLAIN = r"[A-Za-z_`][\w.`]*"
_COUNT = re.compile(rf"\s*count\(\s*(?:\*|(distinct\s+)?({_PLAIN}))\s*\)\s+as\s+(\w+)\s*", re.IGNORECASE)
# Nodes of a tree over ranked bounds have 2**_BITS children.
_BITS = 2


def _counted_intervals(
    base: DataFrame, name: str, step: Join, columns: list[str], group_by: list[str]
) -> DataFrame | None:
    """Counts per group of an interval join whose pairs are never formed; None if something else than counts is asked for.

    Points, starts and ends are ranked together, so that any of them is a leaf of a tree with four children
    per node, and an interval is the few nodes that it covers whole: six a level at most. Points are folded per node and
    per value that the groups and the distinct counts look at, and so are intervals; they meet on
    equal nodes, every pair within exactly one. Rows grow with points and intervals times levels, and with the
    values of either side per node, not with the pairs. Every column and the condition must be of one side.

    Where an inner join is grouped by the intervals alone, distinct values of points are counted without meeting the
    groups (see ``_distinct_within``), so neither many values nor many groups multiply; only groups of several
    intervals, none of which holds the others, meet the values per node.
    """
    if step.how not in ("inner", "left"):
        return None
    sides = [base.select(F.struct("*").alias(name)), step.df.select(F.struct("*").alias(step.name))]

    def side_of(text: str) -> int | None:
        """The frame whose columns a text names, if it is one."""
        named = [re.search(rf"(?<![\w.]){re.escape(n)}`?\s*\.", text, re.IGNORECASE) for n in (name, step.name)]
        return int(bool(named[1])) if bool(named[0]) != bool(named[1]) else None

    counts = [_COUNT.fullmatch(c) for c in columns if c not in group_by]
    if not counts or not all(counts) or not all(re.fullmatch(_PLAIN, g) for g in group_by):
        return None
    distinct = [bool(c[1]) for c in counts]
    owners = [side_of(c[2]) if c[2] else -1 for c in counts]
    placed = [side_of(g) for g in group_by]
    judge = side_of(step.on) if isinstance(step.on, str) and step.on else None
    if None in owners or None in placed or (judge is None and (isinstance(step.on, Column) or step.on)):
        return None
    point, start, end = step.within
    for df, bound in ((sides[0], point), (sides[1], start), (sides[1], end)):
        _position(df, bound)
    on = None if judge is None else F.expr(step.on)
    apart = [k for k, i in enumerate(owners) if distinct[k] and i == 0] if step.how == "inner" and all(placed) else []
    groups = {f"_g{k}": sides[i].select(F.expr(g)).columns[0] for k, (g, i) in enumerate(zip(group_by, placed))}

    def folded(i: int, df: DataFrame, bounds: dict[str, Column]) -> DataFrame:
        """A row per bounds, groups and distinct values, with its number of rows and of values that are counted."""
        keys = {f"_g{k}": F.expr(g) for k, g in enumerate(group_by) if placed[k] == i}
        keys |= {f"_d{k}": F.expr(c[2]) for k, c in enumerate(counts) if distinct[k] and owners[k] == i}
        values = [F.count(F.expr(c[2])).alias(f"_c{k}") for k, c in enumerate(counts) if not distinct[k] and owners[k] == i]
        by = [c.alias(k) for k, c in {**bounds, **keys}.items()]
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias(f"_n{i}"), *values)

    at = F.when(on, F.expr(point)) if judge == 0 else F.expr(point)
    points = settle(folded(0, sides[0], {"_at": at}), "interval-points")
    valid = sides[1].where(on) if judge == 1 else sides[1]
    spans = settle(folded(1, valid, {"_start": F.expr(start), "_end": F.expr(end)}), "interval-spans")
    ranks, n = _ranked(points.select("_at").union(spans.select("_start")).union(spans.select("_end")).toDF("_at"))
    kind = ranks.schema["_at"].dataType

    def rank_of(df: DataFrame, column: str, rank: str) -> DataFrame:
        own = ranks.select(F.col("_at").alias("_value"), F.col("_rank").alias(rank))
        return df.join(own, F.col(column).cast(kind) == F.col("_value"), "left").drop(column, "_value")

    depth = 0
    while 2 ** (_BITS * depth) < n:
        depth += 1
    levels = F.array(*[F.lit(k) for k in range(depth + 1)])

    def merged(df: DataFrame, i: int) -> DataFrame:
        sums = [c for c in df.columns if c == f"_n{i}" or c.startswith("_c")]
        keys = [c for c in df.columns if c not in sums]
        return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    points = rank_of(points, "_at", "_rank")
    if step.how == "left" or apart:
        points = settle(points, "interval-points")
    leaves = points.where("_rank IS NOT NULL").withColumn("_level", F.explode(levels))
    node = F.expr(f"shiftright(_rank, {_BITS} * _level)").alias("_node")
    own = [c for c in points.columns if c not in ("_rank", *[f"_d{k}" for k in apart])]
    spots = merged(leaves.select("_level", node, *own), 0)

    spans = rank_of(rank_of(spans, "_start", "_first"), "_end", "_last")
    open_ended = {"_first": F.coalesce("_first", F.lit(0)), "_last": F.coalesce("_last", F.lit(n))}
    spans = spans.withColumns(open_ended).where("_first < _last")
    if apart:
        spans = settle(spans, "interval-spans")
    covers = merged(_canonical(spans.withColumn("_level", F.explode(levels))), 1)
    if step.how == "left":
        covers = settle(covers, "interval-covers")

    def measures(left: Column, right: Column | None) -> list[Column]:
        """What a row of points that meets a row of intervals, or none, adds to each count."""
        out = []
        for k, i in enumerate(owners):
            if k in apart:
                continue
            if distinct[k]:
                out.append(F.col(f"_d{k}") if right is not None or i == 0 else F.lit(None).alias(f"_d{k}"))
            else:
                mine = F.col(f"_c{k}") if i == 0 else left
                theirs = F.lit(int(i != 1)) if right is None else F.col(f"_c{k}") if i == 1 else right
                out.append((mine * theirs).alias(f"_m{k}"))
        return out

    met = spots.join(covers, ["_level", "_node"]).select(*groups, *measures(F.col("_n0"), F.col("_n1")))
    if step.how == "left":
        known = leaves.select("_rank", "_level", node).distinct()
        held = known.join(key_side(covers, ["_level", "_node"]), ["_level", "_node"], "left_semi").select("_rank")
        alone = points.join(held.distinct(), "_rank", "left_anti")
        named = [F.col(g) if i == 0 else F.lit(None).alias(g) for g, i in zip(groups, placed)]
        met = met.unionByName(alone.select(*named, *measures(F.col("_n0"), None)))
    totals = [
        (F.count_distinct(f"_d{k}") if distinct[k] else F.sum(f"_m{k}")).alias(c[3])
        for k, c in enumerate(counts)
        if k not in apart
    ]
    # Without other counts the groups that have a pair still must be told.
    grouped = met.groupBy(*groups).agg(*(totals or [F.count(F.lit(1)).alias("_pairs")]))
    if apart:
        hulls = _hulls(spans, list(groups))
    for k in apart:
        values = points.where(f"_rank IS NOT NULL AND _d{k} IS NOT NULL").select("_rank", F.col(f"_d{k}").alias("_value"))
        found = _distinct_per_group(values.distinct(), spans, hulls, list(groups), levels)
        grouped = join_same(grouped, found, list(groups), "left")
        grouped = grouped.withColumn(counts[k][3], F.coalesce("_found", F.lit(0))).drop("_found")
    return grouped.select(*[F.col(g).alias(shown) for g, shown in groups.items()], *[c[3] for c in counts])


def _ranked(values: DataFrame) -> tuple[DataFrame, int]:
    """(_at, _rank) of the distinct values that aren't null, from 0 without gaps, and their number.

    Sorted by range; a row per range tells how many values lie before it.
    """
    some = values.where("_at IS NOT NULL").distinct().orderBy("_at")
    placed, n = settle_counted(some.select("_at", F.monotonically_increasing_id().alias("_id")), "ranks")
    placed = placed.withColumn("_range", F.shiftright("_id", 33))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"), F.min("_id").alias("_low"))
    before = F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")
    shift = F.broadcast(sizes.select("_range", (before - F.col("_low")).alias("_shift")))
    return placed.join(shift, "_range").select("_at", (F.col("_id") + F.col("_shift")).alias("_rank")), n


def _canonical(spans: DataFrame) -> DataFrame:
    """The nodes of ``_level`` that lie in [_first, _last) while their parents don't, as ``_node``."""
    none = F.array().cast("array<bigint>")

    def run(a: Column, b: Column) -> Column:
        return F.when(a < b, F.sequence(a, b - 1)).otherwise(none)

    def inner(level: str) -> tuple[Column, Column]:
        width = f"({_BITS} * ({level}))"
        begin = F.expr(f"shiftright(_first + shiftleft(1L, {width}) - 1, {width})")
        return begin, F.expr(f"shiftright(_last, {width})")

    (low, high), (above, beyond) = inner("_level"), inner("_level + 1")
    whole, fan = above < beyond, 2**_BITS
    left, right = F.when(whole, above * fan).otherwise(high), F.when(whole, beyond * fan).otherwise(high)
    nodes = F.explode(F.concat(run(low, left), run(right, high))).alias("_node")
    return spans.select("*", nodes).drop("_first", "_last")


def _hulls(spans: DataFrame, groups: list[str]) -> DataFrame:
    """[_from, _to) around all intervals of a group, and whether one of them is as long (``_whole``)."""
    outer = F.min(F.struct("_first", (-F.col("_last")).alias("_ends")))
    found = spans.groupBy(*groups).agg(outer.alias("_outer"), F.max("_last").alias("_to"))
    whole = (F.col("_outer._ends") == -F.col("_to")).alias("_whole")
    return settle(found.select(*groups, F.col("_outer._first").alias("_from"), "_to", whole), "interval-hulls")


def _distinct_per_group(
    values: DataFrame, spans: DataFrame, hulls: DataFrame, groups: list[str], levels: Column
) -> DataFrame:
    """Groups of ``spans`` with the number of distinct values (_rank, _value) within their intervals, as ``_found``."""
    whole = hulls.where("_whole").drop("_whole")
    asked = whole.select("_from", "_to").distinct()
    found = whole.join(_distinct_within(values, asked, levels), ["_from", "_to"]).select(*groups, "_found")
    several = hulls.where("NOT _whole")
    if several.isEmpty():
        return found
    # A value may lie in several intervals of such a group: it meets the groups per node.
    some = join_same(spans, several.select(*groups), groups, "left_semi").withColumn("_level", F.explode(levels))
    covers = _canonical(some).select("_level", "_node", *groups).distinct()
    node = F.expr(f"shiftright(_rank, {_BITS} * _level)").alias("_node")
    spots = values.withColumn("_level", F.explode(levels)).select("_level", node, "_value").distinct()
    met = spots.join(covers, ["_level", "_node"])
    return found.unionByName(met.groupBy(*groups).agg(F.count_distinct("_value").alias("_found")))


def _distinct_within(values: DataFrame, asked: DataFrame, levels: Column) -> DataFrame:
    """(_from, _to, _found): distinct values (_rank, _value) whose rank lies in [_from, _to), for many such intervals.

    A value counts where it stands first within the interval, that is where its place before lies before the
    interval. Per node of the tree that the interval covers whole, these are the places before that are smaller
    than its start: all are sorted with the starts, and running sums tell them. Rows are values and intervals
    times levels; ties are folded, so that the sort deals out any input evenly.
    """
    ranges = _in_order(values, ["_value", "_rank"], "interval-values")
    here = F.struct("_value", "_rank")
    last = ranges.groupBy("_range").agg(F.max_by(here, "_id").alias("_end"))
    carried = last.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_carried"))
    row_before = F.lag(here).over(Window.partitionBy("_range").orderBy("_id"))
    before = ranges.withColumn("_before", row_before).join(F.broadcast(carried), "_range")
    before = before.withColumn("_before", F.coalesce("_before", "_carried"))
    same = F.col("_before._value").eqNullSafe(F.col("_value"))
    place = F.when(same, F.col("_before._rank")).otherwise(-1).alias("_place")
    firsts = before.select("_rank", place).groupBy("_rank", "_place").agg(F.count(F.lit(1)).alias("_weight"))

    # Twice the start, and twice the place before and one: places stand behind the starts that they equal.
    spots = firsts.withColumn("_level", F.explode(levels)).selectExpr(
        "_level", f"shiftright(_rank, {_BITS} * _level) AS _node", "2 * _place + 1 AS _key",
        "_rank AS _from", "_rank AS _to", "_weight", "0 AS _sign",
    )
    spans = asked.withColumns({"_first": F.col("_from"), "_last": F.col("_to")}).withColumn("_level", F.explode(levels))
    # What lies before the node is taken off.
    signed = F.expr("inline(array(struct(2 * _from AS _key, 1 AS _sign), struct(-2L AS _key, -1 AS _sign)))")
    starts = _canonical(spans).select("*", signed).withColumn("_weight", F.lit(0).cast("long"))
    ranges = _in_order(spots.unionByName(starts), ["_level", "_node", "_key", "_from", "_to"], "interval-places")
    sizes = ranges.groupBy("_range").agg(F.sum("_weight").alias("_size"))
    so_far = F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")
    in_range = F.sum("_weight").over(Window.partitionBy("_range").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0))
    summed = ranges.withColumn("_sum", in_range).where("_sign <> 0")
    summed = summed.join(F.broadcast(sizes.select("_range", so_far.alias("_so_far"))), "_range")
    return summed.groupBy("_from", "_to").agg(F.sum(F.expr("_sign * (_sum + _so_far)")).alias("_found"))


def _in_order(df: DataFrame, by: list[str], label: str) -> DataFrame:
    """``df`` sorted by range and settled; ``_id`` rises along the order, ``_range`` tells the ranges."""
    placed = settle(df.orderBy(*by).withColumn("_id", F.monotonically_increasing_id()), label)
    return placed.withColumn("_range", F.shiftright("_id", 33))


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; keeps the key columns of the left side."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    return left.join(renamed, reduce(and_, same), how).drop(*[f"_same_{k}" for k in keys])


def key_side(df: DataFrame, on: list[str]) -> DataFrame:
    """The keys of ``df`` as the right side of a semi or anti join.

    Repeats are merged per key and share of the input, as many shares as the session shuffles to.
    Unlike a plain distinct this leaves the join an exchange of its own on this side: that is
    what lets adaptive execution split hot keys of the other side, or broadcast this one when its
    real size turns out small.
    """
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.select(*on).withColumn("_salt", F.spark_partition_id() % shares)
    return salted.groupBy(*on, "_salt").agg(F.count(F.lit(1)).alias("_n")).select(*on)


def keep_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(key_side(keys, on), on, "left_semi")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key, row_count) of child keys without a parent; null keys are no orphans.

    Child rows are counted per key before the join, so a hot key is one record per task.
    """
    counted = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    parents = parent.select(F.col(parent_column).alias("key"))
    return counted.join(parents, "key", "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The child rows themselves; adaptive execution splits hot keys of the row side."""
    parents = parent.select(F.col(parent_column).alias(column))
    children = child.filter(F.col(column).isNotNull())
    return children.join(key_side(parents, [column]), column, "left_anti")


def one_row(**summaries: DataFrame) -> DataFrame:
    """Put one-value summaries side by side on one row, as scalar subqueries."""
    spark = next(iter(summaries.values())).sparkSession
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in summaries.items()])
