"""Analytics over run logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.operators.joins import join_same
from sluiceway.operators.latest import newest_first, newest_n, placed_per_key

# Relative change of the mean that counts as a trend, and the runs it needs.
TREND_CHANGE = 0.15
TREND_MIN_RUNS = 4


def _moment(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def filter_runs(
    df: DataFrame,
    name: str | None = None,
    status: str | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    limit: int | None = None,
    tiebreak: str = "execution_id",
) -> DataFrame:
    """Runs matching the given filters, newest first; the date range is closed."""
    out = df
    if name:
        out = out.filter(F.col("pipeline_name") == name)
    if status:
        out = out.filter(F.col("status") == status)
    if start:
        out = out.filter(F.col("start_time") >= _moment(start))
    if end:
        out = out.filter(F.col("start_time") <= _moment(end))
    out = out.orderBy(F.desc("start_time"), F.asc(tiebreak))
    return out.limit(limit) if limit else out


def state_counts(df: DataFrame, group: list[str], state: str) -> DataFrame:
    """Rows per group and state; a missing state counts as unknown."""
    known = F.coalesce(F.col(state), F.lit("unknown")).alias(state)
    return df.select(*group, known).groupBy(*group, state).agg(F.count(F.lit(1)).alias("row_count"))


def state_table(df: DataFrame, group: list[str], state: str, states: list[str]) -> DataFrame:
    """The same, one column per listed state."""
    return df.groupBy(*group).agg(
        *[F.count_if(F.col(state) == s).alias(s) for s in states], F.count(F.lit(1)).alias("total")
    )


def success_rate(
    df: DataFrame,
    group: list[str],
    as_of: dt.datetime,
    days: int = 30,
    time: str = "start_time",
    status: str = "status",
    duration: str | None = None,
) -> DataFrame:
    """Runs, outcomes, success percentage (one decimal) over a look-back; undated runs count."""
    cutoff = _moment(as_of - dt.timedelta(days=days))
    recent = df.filter(F.col(time).isNull() | (F.col(time) >= cutoff))

    def outcome(s: str) -> Column:
        return F.count_if(F.col(status) == s)

    total = F.count(F.lit(1))
    rate = F.when(total > 0, F.round(outcome("success") * 100.0 / total, 1)).otherwise(F.lit(0.0))
    extra = [F.avg(duration).alias("average_duration")] if duration else []
    return recent.groupBy(*group).agg(
        total.alias("total_runs"),
        *[outcome(s).alias(s) for s in ("success", "failed", "running")],
        rate.alias("success_rate"),
        *extra,
    )


def recent_sync_stats(
    df: DataFrame,
    group: list[str],
    created: str,
    status: str,
    limit: int = 10,
    tiebreak: list[str] = (),
) -> DataFrame:
    """Outcome counts and success percentage of the newest jobs per group, and all its jobs."""
    newest = newest_n(df, group, created, limit, tiebreak)
    state = F.lower(F.col(status))
    done = F.count_if(state == "succeeded")
    recent = newest.groupBy(*group).agg(
        F.count(F.lit(1)).alias("recent_syncs"),
        *[F.count_if(state == s).alias(s) for s in ("succeeded", "failed", "running", "cancelled")],
        F.round(done * 100.0 / F.count(F.lit(1)), 2).alias("success_rate"),
    )
    total = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total_syncs"))
    return join_same(total, recent, group)


def runtime_stats(
    df: DataFrame,
    model: str,
    time: str,
    seconds: str,
    status: str,
    max_history: int = 50,
    tiebreak: list[str] = (),
    only: str | None = None,
    digits: int = 2,
) -> DataFrame:
    """Runtime profile per model over its newest ``max_history`` runs, slowest mean first.

    Mean, median, range, 95th percentile (the value at place ``int(0.95 n)`` of the sorted
    runs), last run and trend, all exact. Each map task passes on at most ``max_history``
    runs per model; the rest works within that one partitioning. ``only`` keeps models whose
    name contains it.
    """
    runs = df.filter(F.col(seconds).isNotNull())
    if only:
        runs = runs.filter(F.contains(F.lower(model), F.lit(only.lower())))
    kept = placed_per_key(runs, [model], newest_first(time, tiebreak), max_history)
    per_model = Window.partitionBy(model)
    s = F.col(seconds).cast("double")
    n = F.count(F.lit(1)).over(per_model)
    placed = kept.select(
        F.col(model).alias("model_name"),
        F.col(time).alias("time"),
        F.col(status).alias("state"),
        s.alias("s"),
        n.alias("n"),
        (n - F.col("_place") + 1).alias("turn"),
        F.row_number().over(per_model.orderBy(s)).alias("rank"),
    )
    n, turn, rank, s = F.col("n"), F.col("turn"), F.col("rank"), F.col("s")
    half = F.floor(n / 2)
    middle = (rank == F.floor((n + 1) / 2)) | (rank == half + 1)
    p95_place = F.least(F.floor(n * 0.95) + 1, n)
    stats = placed.groupBy("model_name").agg(
        F.avg(s).alias("mean"),
        F.avg(F.when(middle, s)).alias("median"),
        F.min(s).alias("lo"),
        F.max(s).alias("hi"),
        F.max(F.when(rank == p95_place, s)).alias("p95"),
        F.count(F.lit(1)).alias("run_count"),
        F.max("time").alias("last_run"),
        F.max_by("state", "turn").alias("last_status"),
        F.avg(F.when(turn <= half, s)).alias("early"),
        F.avg(F.when(turn > half, s)).alias("late"),
    )
    return stats.select(
        "model_name",
        F.round("mean", digits).alias("average_seconds"),
        F.round("median", digits).alias("median_seconds"),
        F.round("lo", digits).alias("min_seconds"),
        F.round("hi", digits).alias("max_seconds"),
        F.round("p95", digits).alias("p95_seconds"),
        "run_count",
        "last_run",
        "last_status",
        trend(F.col("run_count"), F.col("early"), F.col("late")).alias("trend"),
    ).orderBy(F.desc("average_seconds"), "model_name")


def trend(run_count: Column, early: Column, late: Column) -> Column:
    """Compare the mean of the later half of the runs with that of the earlier half."""
    change = F.when((run_count >= TREND_MIN_RUNS) & (early > 0), (late - early) / early)
    return (
        F.when(change > TREND_CHANGE, "degrading")
        .when(change < -TREND_CHANGE, "improving")
        .otherwise("stable")
    )


def run_log_summary(df: DataFrame, status: str = "status") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_executions"),
        F.count_if(F.col(status) == "success").alias("successful_executions"),
        F.count_if(F.col(status) == "failed").alias("failed_executions"),
    )
