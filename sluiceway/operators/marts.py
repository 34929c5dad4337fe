"""Facts, dimensions, summaries and unions of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact(
    df: DataFrame, dims: list[str] | None = None, measures: dict[str, str | Column] | None = None
) -> DataFrame:
    """Group by ``dims`` when measures are given too; measures alone are a global aggregate."""
    if not measures:
        return df.select(*dims) if dims else df
    named = [
        (F.expr(m) if isinstance(m, str) else m).alias(name) for name, m in measures.items()
    ]
    return df.groupBy(*dims).agg(*named) if dims else df.agg(*named)


def dimension(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def summary(df: DataFrame, key: str, distinct_of: str) -> DataFrame:
    """Rows and distinct values per key."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(distinct_of).alias("unique_count")
    )


def with_grand_total(aggregated: DataFrame, column: str, total: str) -> DataFrame:
    """Add the sum over all rows to every row, as a scalar subquery instead of one big window."""
    whole = aggregated.agg(F.sum(column))
    return aggregated.select("*", whole.scalar().alias(total))


def unify_sources(sources: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL by column name with a source tag; columns a source lacks are NULL."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_per_source(keys: dict[str, Column], sources: dict[str, DataFrame]) -> DataFrame:
    """One row per source: the number of distinct keys."""
    parts = [
        df.agg(F.count_distinct(keys[name]).alias("key_count")).select(
            F.lit(name).alias("source"), "key_count"
        )
        for name, df in sources.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
