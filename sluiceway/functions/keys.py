"""Hashes of values and rows that tell nulls, positions and nested values apart."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def hash_key(*columns: Column) -> Column:
    """64-bit surrogate hash over several columns.

    Spark's hash skips nulls, so each column is hashed with its null flag: ``(a, NULL)`` and
    ``(NULL, a)`` differ.
    """
    return F.xxhash64(*[part for c in columns for part in (c, c.isNull())])


def flat(field: T.StructField) -> Column:
    """The column itself, or its JSON text if it is nested (hashes skip nulls in there too)."""
    v = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _NESTED):
        return F.to_json(v, {"ignoreNullFields": "false"})
    return v


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Hash of a row's values, the same for any order of its columns."""
    return hash_key(*[flat(df.schema[c]) for c in sorted(columns or df.columns)])


def bucket_of(df: DataFrame, keys: list[str], buckets: int) -> Column:
    """Number of the bucket of a row's key; rows with a null in their key are dealt out by all values.

    Such rows match nothing in a merge, so they need not meet, and no bucket has to hold them all.
    """
    incomplete = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    keyed = hash_key(*[flat(df.schema[k]) for k in keys])
    return F.pmod(F.when(incomplete, row_hash(df)).otherwise(keyed), F.lit(buckets)).cast("int")
