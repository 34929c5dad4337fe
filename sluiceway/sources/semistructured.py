"""Raw JSON landing tables and JSON-safe rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpack_raw(df: DataFrame, schema: T.StructType | str, column: str = "_data") -> DataFrame:
    """Typed columns from a JSON text column; text that does not fit gives nulls, kept in ``_bad``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.col(column), full, {"columnNameOfCorruptRecord": "_bad"})
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, parsed.alias("_parsed")).select(*rest, "_parsed.*")


def unpack_open(df: DataFrame, paths: dict[str, tuple[str, str]], column: str = "_data") -> DataFrame:
    """Pick typed values from JSON of unknown schema: name → (json path, type)."""
    doc = F.try_parse_json(F.col(column))
    picked = [F.try_variant_get(doc, path, kind).alias(n) for n, (path, kind) in paths.items()]
    return df.select(*[c for c in df.columns if c != column], *picked)


def json_safe(df: DataFrame) -> DataFrame:
    """Same rows with JSON-safe values: ISO dates, decimals as floats, bytes as their readable text, NaN as null."""
    return df.select(*[_safe(f.dataType, F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])


def _safe(kind: T.DataType, value: Column) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(F.endswith(micros, F.lit(".000000")), whole).otherwise(micros)
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, T.DecimalType):
        return value.cast("double")
    if isinstance(kind, T.BinaryType):
        # Bytes that are no text are left out; readable ones stay.
        text = value.cast("string")
        readable = F.regexp_replace(F.make_valid_utf8(text), "\ufffd", "")
        return F.when(F.is_valid_utf8(text), text).otherwise(readable)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _safe(kind.elementType, x))
    if isinstance(kind, T.StructType):
        inner = [_safe(f.dataType, value.getField(f.name)).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(kind, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return value.cast("string")
    return value


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row; null fields are written."""
    safe = json_safe(df)
    return safe.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
