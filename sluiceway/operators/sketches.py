"""Profiles kept as mergeable sketches, one row per part of a table and column.

A part (a day, a load, a partition) is read once, when it comes; the profile of the whole table is folded from
the kept rows. Counts, ranges, means and deviations are exact; distinct counts come from HyperLogLog
sketches, quantiles of numbers from KLL sketches, with the errors these have whether the parts are
sketched together or apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import flat
from sluiceway.sources import storage

HLL_BITS = 14  # relative error of distinct counts: 1.04 / sqrt(2**14), under one hundredth
KLL_K = 400  # error of a quantile's rank: about 0.7 hundredths

_SKETCHABLE = (T.StringType, T.CharType, T.VarcharType, T.BinaryType, T.IntegerType, T.LongType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_ROW = (
    "column_name string, data_type string, position int, total_rows bigint, non_null_count bigint, "
    "min_value string, max_value string, min_number double, max_number double, total double, centred double, "
    "min_length int, max_length int, total_length bigint, distinct_sketch binary, quantile_sketch binary"
)


def _sketched(field: T.StructField) -> Column:
    """The value in a type that the distinct sketch takes, equal for equal values only."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _SKETCHABLE):
        return value
    if isinstance(field.dataType, (T.ByteType, T.ShortType)):
        return value.cast("int")
    return flat(field).cast("string")


def sketch_parts(df: DataFrame, part: Column) -> DataFrame:
    """(part, column_name, …): what the profile needs of every part and column, in one scan.

    One aggregate row per part, so parts are what grows; their sketches are a few kilobytes a column.
    """
    measures, rows = [], []
    for i, f in enumerate(df.schema.fields):
        v, named = F.col(f"`{f.name}`"), {}
        named["total_rows"] = F.count(F.lit(1))
        named["non_null_count"] = F.count(v)
        named["distinct_sketch"] = F.hll_sketch_agg(_sketched(f), F.lit(HLL_BITS))
        if isinstance(f.dataType, T.NumericType):
            number = v.cast("double")
            named |= {
                "min_number": F.min(number),
                "max_number": F.max(number),
                "total": F.sum(number),
                # The sum of squared distances from the part's mean: parts add up without cancelling.
                "centred": F.var_pop(number) * F.count(v),
                "quantile_sketch": F.kll_sketch_agg_double(number, F.lit(KLL_K)),
            }
        if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)):
            named |= {
                "min_length": F.min(F.length(v)),
                "max_length": F.max(F.length(v)),
                "total_length": F.sum(F.length(v)),
            }
        if isinstance(f.dataType, _TIMES):
            named |= {"min_value": F.min(v).cast("string"), "max_value": F.max(v).cast("string")}
        measures += [m.alias(f"{k}_{i}") for k, m in named.items()]
        held = [F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type")]
        held.append(F.lit(i + 1).alias("position"))
        for text in _ROW.split(", ")[3:]:
            k, kind = text.split()
            held.append((F.col(f"{k}_{i}") if k in named else F.lit(None)).cast(kind).alias(k))
        rows.append(F.struct(*held))
    return df.groupBy(part.cast("string").alias("part")).agg(*measures).select("part", F.inline(F.array(*rows)))


def profile_of_sketches(parts: DataFrame) -> DataFrame:
    """The profile of all parts together, one row per column, from ``sketch_parts`` rows alone."""
    n = F.sum("non_null_count")
    mean = F.sum("total") / n
    # Sum of squares about the common mean: within the parts, and of the parts' means.
    apart = F.sum(F.col("total") * F.col("total") / F.nullif(F.col("non_null_count"), F.lit(0))) - F.sum("total") * mean
    squares = F.sum("centred") + apart
    folded = parts.groupBy("position", "column_name", "data_type").agg(
        F.sum("total_rows").alias("total_rows"),
        n.alias("non_null_count"),
        F.min("min_number").alias("min_value"),
        F.max("max_number").alias("max_value"),
        mean.alias("avg_value"),
        F.sqrt(F.when(squares < 0, 0.0).otherwise(squares) / n).alias("std_dev"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        (F.sum("total_length") / n).alias("avg_length"),
        F.min("min_value").alias("min_time"),
        F.max("max_value").alias("max_time"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(KLL_K)).alias("_quantiles"),
    )
    points = [(0.25, "quarter"), (0.5, "median"), (0.75, "three_quarters")]
    filled = F.kll_sketch_get_n_double("_quantiles") > 0
    quantiles = [
        F.when(filled, F.kll_sketch_get_quantile_double("_quantiles", F.lit(q))).alias(name) for q, name in points
    ]
    return folded.select("*", *quantiles).drop("_quantiles")


def refresh_profile(df: DataFrame, part: str, kept: str) -> DataFrame:
    """Bring the sketches kept at ``kept`` up to date with the parts of ``df`` and return the whole profile.

    Only parts that have no sketches yet are read: the filter on ``part`` is a list of literals, so a table partitioned by it
    is pruned to its new folders. A part is taken as final once it is sketched. The driver holds the names of the parts.
    """
    spark = df.sparkSession
    new = df
    if storage.exists(spark, kept):
        known = [r[0] for r in spark.read.parquet(kept).select("part").distinct().collect()]
        kind, named = df.schema[part].dataType, [k for k in known if k is not None]
        own = isinstance(kind, (T.StringType, T.IntegralType, T.DateType))
        # In the column's own type where text leads back to it, so that partitions are pruned.
        value = F.col(part) if own else F.col(part).cast("string")
        seen = value.isin([F.lit(k).cast(kind) if own else F.lit(k) for k in named]) if named else F.lit(False)
        new = df.where(F.when(F.col(part).isNull(), F.lit(None not in known)).otherwise(~seen))
    sketch_parts(new, F.col(part)).write.mode("append").parquet(kept)
    return profile_of_sketches(spark.read.parquet(kept))
