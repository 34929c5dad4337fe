"""Catalog tables: what tables and columns there are, searched and described by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.text import humanize_name
from sluiceway.operators.profiling import column_statistics
from sluiceway.runtime import metadata_frame
from sluiceway.sources.tables import table_size

# Kinds of real tables (with and without a primary index).
TABLE_KINDS = ("T", "O")

_CODES = (
    (T.ByteType, "I1"),
    (T.ShortType, "I2"),
    (T.IntegerType, "I"),
    (T.LongType, "I8"),
    (T.DecimalType, "D"),
    (T.FloatType, "F"),
    (T.DoubleType, "F"),
    (T.CharType, "CF"),
    (T.VarcharType, "CV"),
    (T.StringType, "CV"),
    (T.DateType, "DA"),
    (T.TimestampNTZType, "TS"),
    (T.TimestampType, "TZ"),
    (T.BinaryType, "BV"),
)

_ROW = (
    "table_name string, position int, column_name string, data_type string, type_code string, "
    "length int, precision int, scale int, nullable boolean, default_value string, description string, "
    "is_primary_key boolean"
)


def _type_code(kind: T.DataType) -> str:
    return next((code for t, code in _CODES if isinstance(kind, t)), "CV")


def catalog_snapshot(
    spark: SparkSession,
    schemas: dict[str, T.StructType],
    database: str,
    primary_keys: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per column of the given tables; the only step that handles metadata locally."""
    keys = primary_keys or {}
    rows = []
    for table, schema in schemas.items():
        for i, f in enumerate(schema.fields):
            kind = f.dataType
            decimal = isinstance(kind, T.DecimalType)
            rows.append(
                (
                    table,
                    i + 1,
                    f.name,
                    kind.simpleString(),
                    _type_code(kind),
                    getattr(kind, "length", None) or f.metadata.get("length"),
                    kind.precision if decimal else None,
                    kind.scale if decimal else None,
                    f.nullable,
                    f.metadata.get("CURRENT_DEFAULT"),
                    f.metadata.get("comment"),
                    f.name in keys.get(table, []),
                )
            )
    out = metadata_frame(spark, rows, _ROW).withColumn("database_name", F.lit(database))
    described = humanize_name(F.col("column_name"), F.col("type_code"))
    return out.withColumn("description", F.coalesce("description", described))


def describe_table(
    df: DataFrame,
    table: str,
    database: str = "",
    keys: list[str] = (),
    include_stats: bool = False,
    location: str | None = None,
) -> DataFrame:
    """One row per column; with ``include_stats`` joined to exact column statistics, with the
    ``location`` of the table's files also to its rows and size."""
    out = catalog_snapshot(df.sparkSession, {table: df.schema}, database, {table: list(keys)})
    if location:
        size = table_size(df.sparkSession, location)
        out = out.withColumns(
            {c: size.select(c).scalar() for c in ("row_count", "bytes", "size_mb", "size_gb")}
        )
    if not include_stats:
        return out
    return out.join(column_statistics(df).drop("position"), "column_name")


def _contains(column: Column, term: str) -> Column:
    return F.ilike(column, F.lit(f"%{term}%"))


def catalog_search(
    catalog: DataFrame,
    term: str,
    scope: str = "tables",
    database: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Tables, columns or comments containing a term (case-blind; ``%`` and ``_`` stay wildcards)."""
    found = catalog.filter(F.col("database_name") == database) if database else catalog
    if scope == "columns":
        cols = ["database_name", "table_name", "column_name", "data_type", "description"]
        out = (
            found.filter(_contains(F.col("column_name"), term))
            .select(*cols)
            .orderBy("database_name", "table_name", "column_name")
        )
        return out.limit(limit) if limit else out
    if scope == "tables":
        hit = _contains(F.col("table_name"), term) & F.col("table_kind").isin(*TABLE_KINDS)
    elif scope == "comment":
        hit = _contains(F.col("description"), term)
    else:
        raise ValueError("scope is tables, columns or comment")
    cols = ["database_name", "table_name", "table_kind", "description"]
    out = found.filter(hit).select(*cols).orderBy("database_name", "table_name")
    return out.limit(limit) if limit else out


def list_tables(
    catalog: DataFrame,
    pattern: str = "%",
    kind: str | None = None,
    database: str | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Tables by name pattern (case-sensitive LIKE) and kind, with sizes on request."""
    out = catalog.filter(F.like(F.col("table_name"), F.lit(pattern)))
    out = out.filter(F.col("table_kind") == kind) if kind else out
    out = out.filter(F.col("database_name") == database) if database else out
    return out.join(sizes, ["database_name", "table_name"], "left") if sizes is not None else out
