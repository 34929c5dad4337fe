"""Statistics, profiles, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.profiling import column_statistics, profile_table
from sluiceway.operators.sampling import preview, sample_fraction, sample_large, sample_per_stratum, sample_rows
from sluiceway.operators.sketches import refresh_profile
from sluiceway.runtime import new_dir
from sluiceway.sources.catalog import describe_table
from sluiceway.sources.tables import table_size
from sluiceway.workload.registry import Tables, query

LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


def _stats_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i + 1} AS position, '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_count,
            count(*) - count({c}) AS null_count,
            CASE WHEN count(*) > 0 THEN round((count(*) - count({c})) * 100.0 / count(*), 2) ELSE 0 END::DOUBLE
              AS null_percentage,
            count(DISTINCT {c}) AS distinct_count,
            CASE WHEN count(*) > 0 THEN round(count(DISTINCT {c}) * 100.0 / count(*), 2) ELSE 0 END::DOUBLE
              AS cardinality_percentage FROM {table}"""
        for i, c in enumerate(columns)
    )


@query(_stats_sql("lineitem", LINEITEM))
def lineitem_statistics(t: Tables):
    return column_statistics(t.lineitem)


_GAPPY = """(SELECT doc_id, CASE WHEN n_chars > 500 THEN text END AS text,
             CASE WHEN lang <> 'en' THEN lang END AS lang, source, n_chars FROM documents)"""


@query(_stats_sql(_GAPPY, ["doc_id", "text", "lang", "source", "n_chars"]))
def gappy_document_statistics(t: Tables):
    """Long texts and columns with many nulls."""
    gappy = t.documents.select(
        "doc_id",
        F.when(F.col("n_chars") > 500, F.col("text")).alias("text"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
        "source",
        "n_chars",
    )
    return column_statistics(gappy)


def _profile_sql(table: str, columns: list[tuple[str, str, str]]) -> str:
    parts = []
    for i, (c, kind, family) in enumerate(columns):
        number = family == "number"
        text = family == "text"
        time = family == "time"
        parts.append(
            f"""SELECT {i + 1} AS position, '{c}' AS column_name, '{kind}' AS data_type,
            {f"min({c})::DOUBLE" if number else "NULL::DOUBLE"} AS min_value,
            {f"max({c})::DOUBLE" if number else "NULL::DOUBLE"} AS max_value,
            {f"round(avg({c}), 4)" if number else "NULL::DOUBLE"} AS avg_value,
            {f"round(stddev_pop({c}), 4)" if number else "NULL::DOUBLE"} AS std_dev,
            {f"min(length({c}))::INTEGER" if text else "NULL::INTEGER"} AS min_length,
            {f"max(length({c}))::INTEGER" if text else "NULL::INTEGER"} AS max_length,
            {f"round(avg(length({c})), 4)" if text else "NULL::DOUBLE"} AS avg_length,
            {f"min({c})::VARCHAR" if time else "NULL::VARCHAR"} AS min_time,
            {f"max({c})::VARCHAR" if time else "NULL::VARCHAR"} AS max_time,
            count({c}) AS non_null_count, count(DISTINCT {c}) AS distinct_count FROM {table}"""
        )
    return " UNION ALL ".join(parts)


def _rounded(profile):
    return profile.withColumns(
        {c: F.round(c, 4) for c in ("avg_value", "std_dev", "avg_length")}
    )


@query(
    _profile_sql(
        "orders",
        [
            ("o_orderkey", "bigint", "number"),
            ("o_custkey", "bigint", "number"),
            ("o_orderstatus", "string", "text"),
            ("o_totalprice", "double", "number"),
            ("o_orderdate", "timestamp_ntz", "time"),
            ("o_orderpriority", "string", "text"),
        ],
    )
)
def orders_profile(t: Tables):
    return _rounded(profile_table(t.orders))


@query(
    _profile_sql(
        "documents",
        [
            ("doc_id", "bigint", "number"),
            ("text", "string", "text"),
            ("lang", "string", "text"),
            ("source", "string", "text"),
            ("n_chars", "bigint", "number"),
        ],
    )
)
def documents_profile(t: Tables):
    return _rounded(profile_table(t.documents))


@query(
    """SELECT column_name, non_null_count FROM (
         SELECT 'vec_id' AS column_name, count(vec_id) AS non_null_count FROM embeddings
         UNION ALL SELECT 'embedding', count(embedding) FROM embeddings
         UNION ALL SELECT 'label', count(label) FROM embeddings)"""
)
def embeddings_profile_counts(t: Tables):
    """A column of a type without its own statistics is still listed and counted."""
    return profile_table(t.embeddings).select("column_name", "non_null_count")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, true AS near FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )
)
def orders_profile_approximate(t: Tables):
    """Sketched distinct counts lie within 15% of the exact ones, all else is equal."""
    exact = profile_table(t.orders).withColumnRenamed("distinct_count", "exact")
    rough = profile_table(t.orders, approximate=True)
    both = rough.join(exact.select("column_name", "exact"), "column_name")
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(2), F.col("exact") * 0.15)
    return both.select("column_name", "non_null_count", near.alias("near"))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, least(count(*), 1000) AS total_rows,
            least(count({c}), 1000) AS non_null_count, true AS possible FROM lineitem"""
        for c in LINEITEM
    )
)
def sampled_statistics(t: Tables):
    """Statistics of an exact sample of 1000 rows: no column has more values than rows."""
    found = column_statistics(t.lineitem, sample=1000, seed=7)
    possible = F.col("distinct_count").between(F.lit(1), F.col("total_rows"))
    return found.select("column_name", "total_rows", "non_null_count", possible.alias("possible"))


@query("SELECT true AS agrees, true AS near, true AS inside FROM (SELECT count(*) FROM orders)")
def sample_of_a_tenth(t: Tables):
    """Drawn by value: two draws agree, a tenth comes near a tenth, all of it is in the table."""
    parts = [sample_fraction(df, 0.1, seed=3) for df in (t.orders, t.orders.repartition(7))]
    sums = [p.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("s")) for p in parts]
    all_rows = t.orders.agg(F.count(F.lit(1))).scalar()
    known = parts[0].join(t.orders.select("o_orderkey"), "o_orderkey", "left_anti").agg(F.count(F.lit(1)))
    return sums[0].select(
        (F.struct("n", "s") == sums[1].select(F.struct("n", "s")).scalar()).alias("agrees"),
        (F.abs(F.col("n") - all_rows * 0.1) <= 5 * F.sqrt(all_rows * 0.09)).alias("near"),
        (known.scalar() == 0).alias("inside"),
    )


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def preview_top_orders(t: Tables):
    return preview(t.orders, 100, order=[F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("SELECT least(count(*), 500) AS sampled, least(count(*), 500) AS known FROM orders")
def sample_is_exact_and_distinct(t: Tables):
    """A sample of 500 rows has 500 rows, all different and all from the table."""
    drawn = sample_rows(t.orders, 500, seed=11)
    known = t.orders.select("o_orderkey", F.lit(1).alias("known"))
    return drawn.join(known, "o_orderkey", "left").agg(
        F.count_distinct("o_orderkey").alias("sampled"), F.count("known").alias("known")
    )


@query("SELECT count(*) AS row_count FROM lineitem")
def lineitem_row_count_on_disk(t: Tables):
    return table_size(t.spark, f"{t.folder}/lineitem.parquet").select("row_count")


@query("SELECT count(*) AS row_count, true AS filled, true AS in_mb, true AS in_gb FROM lineitem")
def lineitem_size_on_disk(t: Tables):
    """Bytes are there, and the larger units are theirs to two decimals."""
    found = table_size(t.spark, f"{t.folder}/lineitem.parquet")
    return found.select(
        "row_count",
        (F.col("bytes") > F.col("row_count")).alias("filled"),
        (F.col("size_mb") == F.round(F.col("bytes") / 1048576, 2)).alias("in_mb"),
        (F.col("size_gb") == F.round(F.col("bytes") / 1073741824, 2)).alias("in_gb"),
    )


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{k}' AS data_type, '{code}' AS type_code, {i + 1} AS position,
            {str(c == 'c_custkey').lower()} AS is_primary_key, '{d}' AS description, NULL::INTEGER AS length,
            {"12" if c == "c_acctbal" else "NULL::INTEGER"} AS precision,
            {"2" if c == "c_acctbal" else "NULL::INTEGER"} AS scale, true AS nullable, NULL::VARCHAR AS default_value,
            count(*) AS row_count, true AS has_size, count({c}) AS non_null_count, count(*) - count({c}) AS null_count,
            count(DISTINCT {c}) AS distinct_count FROM customer"""
        for i, (c, k, code, d) in enumerate(
            [
                ("c_custkey", "bigint", "I8", "C Custkey (BIGINT)"),
                ("c_name", "string", "CV", "C Name (VARCHAR)"),
                ("c_nationkey", "int", "I", "C Nationkey (INTEGER)"),
                ("c_acctbal", "decimal(12,2)", "D", "C Acctbal (DECIMAL)"),
                ("c_mktsegment", "string", "CV", "C Mktsegment (VARCHAR)"),
            ]
        )
    )
)
def describe_customer(t: Tables):
    """With a decimal, whose precision and scale are told, and with the table's rows and size."""
    priced = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    described = describe_table(
        priced, "customer", "sales", ["c_custkey"], True, f"{t.folder}/customer.parquet"
    )
    return described.select(
        "column_name",
        "data_type",
        "type_code",
        "position",
        "is_primary_key",
        "description",
        "length",
        "precision",
        "scale",
        "nullable",
        "default_value",
        "row_count",
        (F.col("bytes") > 0).alias("has_size"),
        "non_null_count",
        "null_count",
        "distinct_count",
    )


@query(
    """SELECT count(*) // 2 AS sampled, count(*) // 2 AS same_as_ranked, 0::BIGINT AS outside FROM lineitem"""
)
def sample_of_half(t: Tables):
    """Half of the rows exactly, without gathering them: the same rows that ranking all draws takes."""
    rows = t.lineitem.withColumn("copy", F.lit(0))
    n = t.lineitem.count() // 2
    drawn, ranked = sample_large(rows, n, seed=5), sample_rows(rows, n, seed=5)
    sides = [df.withColumn("side", F.lit(i)) for i, df in enumerate((drawn, ranked, rows))]
    # Copies of a row on each side, all sides in one exchange.
    met = reduce(DataFrame.unionByName, sides).groupBy(*rows.columns)
    met = met.agg(*[F.count_if(F.col("side") == i).alias(f"n_{i}") for i in range(len(sides))])
    return met.agg(
        F.sum("n_0").alias("sampled"),
        F.sum(F.least("n_0", "n_1")).alias("same_as_ranked"),
        F.sum(F.greatest(F.col("n_0") - F.col("n_2"), F.lit(0))).alias("outside"),
    )


@query(
    """SELECT o_orderstatus, o_orderpriority, least(count(*), 200) AS sampled, least(count(*), 200) AS known
       FROM orders GROUP BY 1, 2"""
)
def samples_of_strata(t: Tables):
    """200 orders of every status and priority, all different and all from the table."""
    drawn = sample_per_stratum(t.orders, 200, ["o_orderstatus", "o_orderpriority"], seed=2)
    known = t.orders.select(F.col("o_orderkey").alias("known"))
    return (
        drawn.join(known, F.col("o_orderkey") == F.col("known"), "left")
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count_distinct("o_orderkey").alias("sampled"), F.count("known").alias("known"))
    )


_SKETCHED = {
    "o_orderkey": "number", "o_custkey": "number", "o_orderstatus": "text", "o_totalprice": "number",
    "o_orderdate": "time", "o_orderpriority": "text",
}


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_count,
            {f'min({c})::DOUBLE' if kind == 'number' else 'NULL::DOUBLE'} AS min_value,
            {f'max({c})::DOUBLE' if kind == 'number' else 'NULL::DOUBLE'} AS max_value,
            {f'round(avg({c}), 4)' if kind == 'number' else 'NULL::DOUBLE'} AS avg_value,
            {f'round(stddev_pop({c}), 4)' if kind == 'number' else 'NULL::DOUBLE'} AS std_dev,
            {f'max(length({c}))::INTEGER' if kind == 'text' else 'NULL::INTEGER'} AS max_length,
            true AS distinct_is_near, true AS median_is_near FROM orders"""
        for c, kind in _SKETCHED.items()
    )
)
def orders_profile_of_sketches(t: Tables):
    """The profile after two loads, folded from the sketches of each year's orders: the second run reads new years only."""
    orders = t.orders.withColumn("year", F.year("o_orderdate"))
    kept = new_dir(t.spark, "sketches")
    refresh_profile(orders.where("year < 1996"), "year", kept)
    profile = refresh_profile(orders, "year", kept).where("column_name <> 'year'")
    names = list(_SKETCHED)
    exact = t.orders.agg(
        *[F.count_distinct(c).alias(f"d_{c}") for c in names],
        *[F.percentile(c, F.array(F.lit(0.47), F.lit(0.53))).alias(f"m_{c}") for c in names if _SKETCHED[c] == "number"],
    )
    rows = [
        F.struct(
            F.lit(c).alias("name"),
            F.col(f"d_{c}").alias("exact"),
            (F.col(f"m_{c}") if _SKETCHED[c] == "number" else F.lit(None).cast("array<double>")).alias("middle"),
        )
        for c in names
    ]
    met = profile.join(exact.select(F.inline(F.array(*rows))), F.col("name") == F.col("column_name"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.05
    middle = F.col("median").between(F.col("middle")[0], F.col("middle")[1])
    return met.select(
        "column_name", "total_rows", "non_null_count", "min_value", "max_value",
        F.round("avg_value", 4).alias("avg_value"), F.round("std_dev", 4).alias("std_dev"), "max_length",
        near.alias("distinct_is_near"), F.coalesce(middle, F.lit(True)).alias("median_is_near"),
    )
