"""Column statistics and profiles: one row per column, whole table by default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import flat
from sluiceway.operators.sampling import sample_rows

_NUMBERS = T.NumericType
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_TEXTS = (T.StringType, T.CharType, T.VarcharType)
_ONE_WORD = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    *_TIMES,
)


def _keys(field: T.StructField) -> tuple[Column, Column]:
    """Two 64-bit words that are equal exactly when two values of the column are.

    The hash of a value of at most eight bytes is one-to-one, so one word is exact (and -0.0
    equals 0.0). Anything longer gets two hashes of different seed, 128 bits together.
    """
    v = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _ONE_WORD):
        return F.when(v.isNotNull(), F.xxhash64(v)), F.lit(0).cast("bigint")
    v = flat(field)
    return F.when(v.isNotNull(), F.xxhash64(v)), F.xxhash64(F.lit(1), v)


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column position, value key, rows); the key of nulls is null.

    All columns share one scan and one shuffle of a few bytes per distinct value, however
    long the texts; equal values are merged before it, so a value held by a third of the
    rows costs one record per task.
    """
    entries = []
    for i, name in enumerate(columns or df.columns):
        first, second = _keys(df.schema[name])
        entries.append(
            F.struct(F.lit(i).alias("_column"), first.alias("_key"), second.alias("_key2"))
        )
    long = df.select(F.inline(F.array(*entries)))
    return long.groupBy("_column", "_key", "_key2").agg(F.count(F.lit(1)).alias("_rows"))


def _name_of(columns: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_column") + 1)


def distinct_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, distinct_count); a column without any value has no row."""
    columns = columns or df.columns
    counted = value_counts(df, columns).filter(F.col("_key").isNotNull())
    counted = counted.groupBy("_column").agg(F.count(F.lit(1)).alias("distinct_count"))
    return counted.select(_name_of(columns).alias("column_name"), "distinct_count")


def per_column(df: DataFrame) -> DataFrame:
    """A frame of one row per column is as small as the schema, so it may be broadcast."""
    return F.broadcast(df)


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, 2)).otherwise(F.lit(0.0))


def column_statistics(
    df: DataFrame,
    columns: list[str] | None = None,
    sample: int | None = None,
    approximate: bool = False,
    seed: int = 0,
) -> DataFrame:
    """Row, null and distinct counts with their percentages (two decimals, 0 on no rows).

    One scan: rows, filled rows and distinct values of all columns are folded from the counts per
    value. ``approximate`` trades the exact distinct counts, and their shuffle, for sketches.
    """
    df = sample_rows(df, sample, seed) if sample else df
    columns = columns or df.columns
    names = [F.struct(F.lit(i).alias("_column"), F.lit(c).alias("column_name")) for i, c in enumerate(columns)]
    listed = df.sparkSession.range(1).select(F.inline(F.array(*names)))
    if approximate:
        measured = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(f"`{c}`").alias(f"n_{i}") for i, c in enumerate(columns)],
            *[F.approx_count_distinct(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(columns)],
        )
        rows = [
            F.struct(
                F.lit(i).alias("_column"),
                F.col("rows").alias("total_rows"),
                F.col(f"n_{i}").alias("non_null_count"),
                F.col(f"d_{i}").alias("distinct_count"),
            )
            for i in range(len(columns))
        ]
        counted = measured.select(F.inline(F.array(*rows)))
    else:
        filled = F.col("_key").isNotNull()
        counted = value_counts(df, columns).groupBy("_column").agg(
            F.sum("_rows").alias("total_rows"),
            F.sum(F.when(filled, F.col("_rows")).otherwise(0)).alias("non_null_count"),
            F.count_if(filled).alias("distinct_count"),
        )
    out = listed.join(per_column(counted), "_column", "left").select(
        (F.col("_column") + 1).alias("position"),
        "column_name",
        *[
            F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
            for c in ("total_rows", "non_null_count", "distinct_count")
        ],
    )
    total, filled = F.col("total_rows"), F.col("non_null_count")
    distinct = F.col("distinct_count")
    return out.select(
        "position",
        "column_name",
        "total_rows",
        "non_null_count",
        (total - filled).alias("null_count"),
        _percent(total - filled, total).alias("null_percentage"),
        distinct.alias("distinct_count"),
        _percent(distinct, total).alias("cardinality_percentage"),
    )


def profile_table(
    df: DataFrame, sample: int | None = None, approximate: bool = False, seed: int = 0
) -> DataFrame:
    """Profile by type: range, mean and deviation of numbers, lengths of text, range of times.

    Columns of other types are listed with their counts only. Everything but the distinct
    counts comes from a single aggregate row.
    """
    df = sample_rows(df, sample, seed) if sample else df
    fields = df.schema.fields
    measures, rows = [], []
    for i, f in enumerate(fields):
        v = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, _NUMBERS)
        text = isinstance(f.dataType, _TEXTS)
        time = isinstance(f.dataType, _TIMES)
        named = {"non_null_count": F.count(v)}
        if number:
            named |= {
                "min_value": F.min(v).cast("double"),
                "max_value": F.max(v).cast("double"),
                "avg_value": F.avg(v).cast("double"),
                "std_dev": F.stddev_pop(v),
            }
        if text:
            named |= {
                "min_length": F.min(F.length(v)),
                "max_length": F.max(F.length(v)),
                "avg_length": F.avg(F.length(v)),
            }
        if time:
            named |= {"min_time": F.min(v).cast("string"), "max_time": F.max(v).cast("string")}
        if approximate:
            named["distinct_count"] = F.approx_count_distinct(v)
        measures += [m.alias(f"{k}_{i}") for k, m in named.items()]
        absent = {
            "min_value": "double",
            "max_value": "double",
            "avg_value": "double",
            "std_dev": "double",
            "min_length": "int",
            "max_length": "int",
            "avg_length": "double",
            "min_time": "string",
            "max_time": "string",
            "non_null_count": "bigint",
        }
        if approximate:
            absent["distinct_count"] = "bigint"
        rows.append(
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                *[
                    (F.col(f"{k}_{i}") if k in named else F.lit(None).cast(kind)).alias(k)
                    for k, kind in absent.items()
                ],
            )
        )
    out = df.agg(*measures).select(F.inline(F.array(*rows)))
    if approximate:
        return out
    counted = per_column(distinct_counts(df))
    zero = F.lit(0).cast("bigint")
    return out.join(counted, "column_name", "left").withColumn(
        "distinct_count", F.coalesce("distinct_count", zero)
    )
