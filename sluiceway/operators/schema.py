"""Schema comparison over catalog tables (one row per column of every table)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type families whose members can take each other's values.
NUMBER_FAMILY = (
    "BYTEINT",
    "SMALLINT",
    "INTEGER",
    "BIGINT",
    "DECIMAL",
    "NUMERIC",
    "FLOAT",
    "DOUBLE",
)
TEXT_FAMILY = ("CHAR", "VARCHAR", "NCHAR", "NVARCHAR")


# Whole numbers from narrow to wide, with the decimal digits that each may need.
_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
# Digits of whole numbers that a floating type holds exactly.
_EXACT_DIGITS = {T.FloatType(): 7, T.DoubleType(): 15}


@dataclass(frozen=True)
class Common:
    """The least type that values of two types fit into, and whether both do without loss."""

    type: T.DataType
    lossless: bool


def least_common_type(a: T.DataType, b: T.DataType) -> Common:
    """Where two types meet in the lattice of types.

    Whole numbers widen to the wider one, decimals keep the digits of both before and after the point, floats
    become doubles, dates become timestamps, anything becomes text; structs, arrays and maps meet part
    by part. Whole numbers and decimals meet floating types at a double, with loss if they may have more
    digits than it holds; so do decimals that together need more than 38 digits, and clock times
    with instants, which only a time zone could turn into each other.
    """
    if a == b:
        return Common(a, True)
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return Common(y, True)
        if isinstance(x, T.StringType):
            return Common(T.StringType(), not isinstance(y, (T.BinaryType, T.StructType, T.ArrayType, T.MapType)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _common_number(a, b)
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        if T.TimestampType() in (a, b):
            return Common(T.TimestampType(), False)
        return Common(T.TimestampNTZType(), True)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        met = least_common_type(a.elementType, b.elementType)
        return Common(T.ArrayType(met.type, a.containsNull or b.containsNull), met.lossless)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        keys, values = least_common_type(a.keyType, b.keyType), least_common_type(a.valueType, b.valueType)
        kind = T.MapType(keys.type, values.type, a.valueContainsNull or b.valueContainsNull)
        return Common(kind, keys.lossless and values.lossless)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        met = [least_common_type(f.dataType, g.dataType) for f, g in zip(a.fields, b.fields)]
        fields = [
            T.StructField(f.name, m.type, f.nullable or g.nullable) for f, g, m in zip(a.fields, b.fields, met)
        ]
        return Common(T.StructType(fields), all(m.lossless for m in met))
    plain = not isinstance(a, _NESTED) and not isinstance(b, _NESTED)
    return Common(T.StringType(), plain)


_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def _common_number(a: T.DataType, b: T.DataType) -> Common:
    if a in _WHOLE and b in _WHOLE:
        return Common(max(a, b, key=_WHOLE.get), True)
    if a in _EXACT_DIGITS and b in _EXACT_DIGITS:
        return Common(T.DoubleType(), True)
    if a in _EXACT_DIGITS or b in _EXACT_DIGITS:
        floating, other = (a, b) if a in _EXACT_DIGITS else (b, a)
        digits = _WHOLE[other] if other in _WHOLE else other.precision
        # A decimal fraction has no exact double, but one of few digits comes back as it was.
        return Common(T.DoubleType(), digits <= _EXACT_DIGITS[T.DoubleType()])
    before = max(_WHOLE[t] if t in _WHOLE else t.precision - t.scale for t in (a, b))
    after = max(0 if t in _WHOLE else t.scale for t in (a, b))
    if before + after > 38:
        return Common(T.DecimalType(38, max(0, 38 - before)), False)
    return Common(T.DecimalType(before + after, after), True)


def schema_diff(
    before: DataFrame,
    after: DataFrame,
    table_keys: list[str] = ("table_name",),
    compare: list[str] = ("data_type", "nullable", "length"),
) -> DataFrame:
    """Changed columns of all tables at once: (table keys, column_name, change, details).

    ``change`` is added, removed or modified; for modified columns ``changes`` lists which
    properties differ, as ``name: old -> new``. Pass ``compare=["data_type"]`` for types only.
    """
    keys = [*table_keys, "column_name"]
    old = before.select(*[F.col(k).alias(f"o_{k}") for k in keys], *[F.col(c).alias(f"o__{c}") for c in compare])
    new = after.select(*[F.col(k).alias(f"n_{k}") for k in keys], *[F.col(c).alias(f"n__{c}") for c in compare])
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"o_{k}") == F.col(f"n_{k}"))
    both = old.join(new, cond, "full")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    differences = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.col(f"o__{c}").eqNullSafe(F.col(f"n__{c}")),
                    F.concat(F.lit(f"{c}: "), shown(f"o__{c}"), F.lit(" -> "), shown(f"n__{c}")),
                )
                for c in compare
            ]
        )
    )
    change = (
        F.when(F.col("o_column_name").isNull(), "added")
        .when(F.col("n_column_name").isNull(), "removed")
        .when(F.size(differences) > 0, "modified")
    )
    return (
        both.select(
            *[F.coalesce(f"n_{k}", f"o_{k}").alias(k) for k in keys],
            change.alias("change"),
            F.when(change == "modified", differences).alias("changes"),
        )
        .filter(F.col("change").isNotNull())
    )


def set_diff(before: DataFrame, after: DataFrame, by: list[str], item: str) -> DataFrame:
    """Items of a set (key columns, index names) that came or went: (by, item, change)."""
    old = before.select(*by, item).distinct().withColumn("_old", F.lit(True))
    new = after.select(*by, item).distinct().withColumn("_new", F.lit(True))
    both = old.join(new, [*by, item], "full").filter(F.col("_old").isNull() | F.col("_new").isNull())
    change = F.when(F.col("_old").isNull(), "added").otherwise("removed")
    return both.select(*by, item, change.alias("change"))


def change_summary(diff: DataFrame, table_keys: list[str] = ("table_name",)) -> DataFrame:
    """Per table how many columns came, went or changed."""
    counts = [
        F.count_if(F.col("change") == c).alias(f"columns_{c}") for c in ("added", "removed", "modified")
    ]
    return diff.groupBy(*table_keys).agg(*counts)


def base_type(data_type: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(data_type, r"\(.*$", "")))


def types_compatible(a: Column, b: Column) -> Column:
    """Same base type, or both numbers, or both text."""
    left, right = base_type(a), base_type(b)
    return (
        (left == right)
        | (left.isin(*NUMBER_FAMILY) & right.isin(*NUMBER_FAMILY))
        | (left.isin(*TEXT_FAMILY) & right.isin(*TEXT_FAMILY))
    )


def match_schema(
    file_columns: DataFrame, table_columns: DataFrame, by: list[str] = ()
) -> DataFrame:
    """Compare file columns with table columns, names case-blind: one row per column.

    Both sides have ``column_name`` and ``data_type`` (and the columns ``by`` when many
    files and tables are matched at once). ``status`` is missing (not in the file), extra
    (only in the file), type_mismatch or ok.
    """
    sides = []
    for df, name in ((file_columns, "file_type"), (table_columns, "table_type")):
        sides.append(
            df.select(*by, F.lower("column_name").alias("column_name"), F.upper("data_type").alias(name))
        )
    both = sides[0].join(sides[1], [*by, "column_name"], "full")
    status = (
        F.when(F.col("file_type").isNull(), "missing")
        .when(F.col("table_type").isNull(), "extra")
        .when(~types_compatible(F.col("file_type"), F.col("table_type")), "type_mismatch")
        .otherwise("ok")
    )
    return both.withColumn("status", status)


def is_loadable(matched: DataFrame, by: list[str] = ()) -> DataFrame:
    """Compatible when nothing is missing and no type clashes; extra columns are fine."""
    bad = F.col("status").isin("missing", "type_mismatch")
    out = matched.groupBy(*by) if by else matched.groupBy()
    return out.agg(
        (F.count_if(bad) == 0).alias("compatible"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("missing", "extra", "type_mismatch")],
    )


def register_version(
    history: DataFrame | None, schema: DataFrame, version: int, as_of: dt.datetime
) -> DataFrame:
    """Append a table's catalog rows as a version; registering a version again changes nothing."""
    new = schema.withColumn("version", F.lit(version)).withColumn(
        "registered_at", F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    )
    if history is None:
        return new
    known = history.filter(F.col("version") == version).select("table_name").distinct()
    return history.unionByName(new.join(known, "table_name", "left_anti"))


def schema_history(history: DataFrame, table_keys: list[str] = ("table_name",)) -> DataFrame:
    """Versions in order with their column count and time."""
    return history.groupBy(*table_keys, "version").agg(
        F.count(F.lit(1)).alias("column_count"), F.min("registered_at").alias("registered_at")
    )


def version_changes(history: DataFrame, table_keys: list[str] = ("table_name",)) -> DataFrame:
    """What each version added, removed or modified against the one before it.

    Every column appears with its previous version, found per table by a window over the
    few version numbers, and one full join compares all tables and versions at once.
    """
    versions = history.select(*table_keys, "version").distinct()
    order = Window.partitionBy(*table_keys).orderBy("version")
    steps = versions.withColumn("to_version", F.lead("version").over(order)).filter("to_version IS NOT NULL")
    before = history.join(steps, [*table_keys, "version"]).withColumn("version", F.col("to_version"))
    firsts = versions.groupBy(*table_keys).agg(F.min("version").alias("version"))
    after = history.join(firsts, [*table_keys, "version"], "left_anti")
    return schema_diff(before, after, [*table_keys, "version"])


def is_backward_compatible(diff: DataFrame, after: DataFrame, table_keys: list[str] = ("table_name",)) -> DataFrame:
    """Per changed table: compatible when every change is an added nullable column."""
    keys = [*table_keys, "column_name"]
    nullable = after.select(*keys, "nullable")
    judged = diff.join(nullable, keys, "left")
    fine = (F.col("change") == "added") & F.coalesce(F.col("nullable"), F.lit(True))
    return judged.groupBy(*table_keys).agg(F.every(fine).alias("compatible"))
