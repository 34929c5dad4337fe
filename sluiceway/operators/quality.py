"""Data tests. Each returns rows (test, column_name, failures, passed).

Row-level tests on one table are folded into a single aggregate, however many there are.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import bucket_of, flat, hash_key, row_hash
from sluiceway.functions.text import seconds_between
from sluiceway.operators.joins import orphan_keys
from sluiceway.operators.profiling import per_column, value_counts
from sluiceway.runtime import metadata_frame, settle

# Fixed value: a plausible mail address.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


@dataclass(frozen=True)
class Check:
    """A row-level test: ``fails`` is true for a failing row."""

    test: str
    column_name: str
    fails: Column
    severity: str = "error"


def not_null(column: str, severity: str = "error") -> Check:
    return Check("not_null", column, F.col(column).isNull(), severity)


def accepted_values(column: str, values: list, severity: str = "error") -> Check:
    return Check("accepted_values", column, ~F.col(column).isin(values), severity)


def in_range(column: str, low=None, high=None, severity: str = "error") -> Check:
    """Bounds are inclusive; nulls pass."""
    below = F.col(column) < low if low is not None else F.lit(False)
    above = F.col(column) > high if high is not None else F.lit(False)
    return Check("range", column, below | above, severity)


def matches(column: str, regex: str = EMAIL, severity: str = "error") -> Check:
    return Check("pattern", column, ~F.col(column).rlike(regex), severity)


def holds(name: str, column: str, condition: str | Column, severity: str = "error") -> Check:
    """Any condition a good row meets; rows where it is null pass."""
    good = F.expr(condition) if isinstance(condition, str) else condition
    return Check(name, column, ~good, severity)


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks in one pass."""
    counted = df.agg(*[F.count_if(c.fails).alias(f"f_{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.test).alias("test"),
            F.lit(c.column_name).alias("column_name"),
            F.col(f"f_{i}").alias("failures"),
            (F.col(f"f_{i}") == 0).alias("passed"),
            F.lit(c.severity).alias("severity"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def test_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return run_checks(df, [not_null(c) for c in columns]).drop("severity")


def _result(test: str, column: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def test_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, how many values occur more than once (nulls ignored); one scan for all."""
    listed = metadata_frame(
        df.sparkSession,
        list(enumerate(columns)),
        "_column int, column_name string",
    )
    repeated = value_counts(df, columns).filter(F.col("_key").isNotNull()).groupBy("_column").agg(
        F.count_if(F.col("_rows") > 1).alias("n")
    )
    failures = F.coalesce("n", F.lit(0).cast("bigint"))
    return listed.join(per_column(repeated), "_column", "left").select(
        F.lit("unique").alias("test"),
        "column_name",
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    )


def test_unique_together(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many combinations of the columns occur more than once."""
    present = df.dropna(subset=columns, how="any")
    counted = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return _result("unique", ",".join(columns), counted.agg(F.count_if(F.col("n") > 1).alias("failures")))


def test_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose value the parent lacks."""
    lost = orphan_keys(child, column, parent, parent_column)
    total = F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint")
    return _result("relationships", column, lost.agg(total.alias("failures")))


def test_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return run_checks(df, [accepted_values(column, values)]).drop("severity")


def test_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return run_checks(df, [in_range(column, low, high)]).drop("severity")


def test_pattern(df: DataFrame, column: str, regex: str = EMAIL) -> DataFrame:
    return run_checks(df, [matches(column, regex)]).drop("severity")


def test_sql(spark: SparkSession, name: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Custom test: the query returns the failing rows."""
    bad = spark.sql(sql, **frames)
    return _result(name, "", bad.agg(F.count(F.lit(1)).alias("failures")))


def severity(results: DataFrame, levels: dict[str, str], keys: list[str] = ()) -> DataFrame:
    """Add ``severity`` by test name (default error; tests on key columns always error) and ``status``."""
    known = F.create_map(*[F.lit(x) for kv in levels.items() for x in kv]) if levels else None
    level = F.coalesce(F.try_element_at(known, F.col("test")), F.lit("error")) if levels else F.lit("error")
    level = F.when(F.col("column_name").isin(list(keys)), F.lit("error")).otherwise(level)
    return results.withColumn("severity", level).withColumn(
        "status",
        F.when(F.col("passed"), F.lit("pass")).when(F.col("severity") == "warn", F.lit("warn")).otherwise("error"),
    )


def derive_tests(catalog: DataFrame, default_severity: str = "error") -> DataFrame:
    """Which tests each catalog column should get: (table_name, column_name, test, severity, …).

    Key columns get unique and not_null (error), other non-nullable columns not_null,
    columns that reference another get relationships.
    """
    key = F.coalesce(F.col("is_primary_key"), F.lit(False))
    required = ~F.coalesce(F.col("nullable"), F.lit(True))

    def test(when: Column, name: str, level: str) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(name).alias("test"),
                F.lit(level).alias("severity"),
                F.when(F.lit(name == "relationships"), F.col("ref_table")).alias("ref_table"),
                F.when(F.lit(name == "relationships"), F.col("ref_column")).alias("ref_column"),
            ),
        )

    wanted = F.array(
        test(key, "unique", "error"),
        test(key, "not_null", "error"),
        test(~key & required, "not_null", default_severity),
        test(F.col("ref_table").isNotNull(), "relationships", "error"),
    )
    named = catalog.filter(F.trim("column_name") != "")
    exploded = named.select(
        "table_name",
        F.lower("column_name").alias("column_name"),
        F.explode(F.filter(wanted, lambda t: t.isNotNull())).alias("t"),
    )
    return exploded.select("table_name", "column_name", "t.*")


def run_derived_tests(tests: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Run derived tests: per table one pass for nulls, one for uniqueness, one per reference.

    Only tests of the given ``tables`` are brought to the driver, which plans one branch per table:
    their number is the caller's choice, however large the catalog of tests is.
    """
    plan: dict[str, list] = {}
    own = tests.filter(F.col("table_name").isin(list(tables)))
    for r in own.orderBy("table_name", "column_name", "test").collect():
        plan.setdefault(r.table_name, []).append(r)
    parts = []
    for name, wanted in plan.items():
        df = tables[name]
        nulls = [r.column_name for r in wanted if r.test == "not_null"]
        uniques = [r.column_name for r in wanted if r.test == "unique"]
        found = [test_not_null(df, nulls)] if nulls else []
        found += [test_unique(df, uniques)] if uniques else []
        found += [
            test_relationships(df, r.column_name, tables[r.ref_table], r.ref_column)
            for r in wanted
            if r.test == "relationships"
        ]
        parts += [f.select(F.lit(name).alias("table_name"), "*") for f in found]
    return _union(parts)


def freshness(
    df: DataFrame, ts: str, as_of: dt.datetime, warn_hours: float = 24, error_hours: float = 48
) -> DataFrame:
    """Age of the newest row against the limits: pass, warn or error (error without rows)."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = df.agg(F.max(ts).alias("newest"))
    age = F.round(seconds_between(now, F.col("newest")) / 3600, 4)
    return newest.withColumn("age_hours", age).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass"),
    )


def null_rate_check(df: DataFrame, columns: list[str], max_rate: float = 0.5) -> DataFrame:
    """Share of nulls per column against a limit; a table without rows fails."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col("rows") - F.col(f"n_{i}")).alias("null_count"),
            F.col("rows").alias("total_rows"),
            ((F.col("rows") - F.col(f"n_{i}")) / F.nullif(F.col("rows"), F.lit(0))).alias("null_rate"),
        )
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*rows))).withColumn(
        "passed", F.coalesce(F.col("null_rate") <= max_rate, F.lit(False))
    )


def row_count_check(df: DataFrame, low: int = 0, high: int | None = None) -> DataFrame:
    """Row count within inclusive bounds."""
    n = F.col("row_count")
    inside = (n >= low) & (n <= high) if high is not None else n >= low
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("passed", inside)


def duplicate_rate_check(df: DataFrame, keys: list[str], max_pct: float = 1.0) -> DataFrame:
    """Percentage of rows beyond the first per key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )
    extra = (F.col("total_rows") - F.col("distinct_keys")) * 100.0
    pct = F.coalesce(F.round(extra / F.nullif(F.col("total_rows"), F.lit(0)), 4), F.lit(0.0))
    return totals.withColumn("duplicate_pct", pct).withColumn("passed", pct <= max_pct)


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of non-null values per column."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(
                F.round(F.col(f"n_{i}") * 100.0 / F.nullif(F.col("rows"), F.lit(0)), 4), F.lit(0.0)
            ).alias("completeness"),
        )
        for i, c in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _fingerprint(df: DataFrame) -> Column:
    return row_hash(df).cast("decimal(38,0)")


# What is left of a cell that its column's common type can't hold; null where the type holds it.
_REST = "{} as text"


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which values of both can be compared; text gives way to anything else."""
    if a == b:
        return a
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return b if isinstance(a, T.StringType) else a
    both = (a, b)
    if all(isinstance(t, T.NumericType) for t in both):
        whole = [t for t in both if isinstance(t, T.IntegralType)]
        scaled = [t for t in both if isinstance(t, T.DecimalType)]
        if len(whole) == 2:
            return T.LongType()
        if whole and not scaled:
            return T.LongType()  # a double that is no whole number is told apart as text
        if scaled:
            return T.DecimalType(38, max(t.scale for t in scaled))
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in both):
        return T.TimestampType() if T.TimestampType() in both else T.TimestampNTZType()
    return T.StringType()


def _held(value: Column, own: T.DataType, kind: T.DataType) -> Column:
    """``value`` as ``kind`` if nothing of it is lost, else null."""
    made = value.try_cast(kind)
    if isinstance(own, T.StringType):
        if isinstance(kind, T.DecimalType):
            return F.when(made == value.try_cast(T.DecimalType(38, 18)), made)
        if isinstance(kind, T.DateType):
            return F.when(made.cast("timestamp_ntz") == value.try_cast("timestamp_ntz"), made)
    if isinstance(own, (T.FloatType, T.DoubleType)) and isinstance(kind, (T.IntegralType, T.DecimalType)):
        return F.when(made.cast("double") == value.cast("double"), made)
    return made


def same_types(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with columns of equal names (case-blind) brought to a common type.

    A column whose types differ becomes two: the value in the common type, and the text of cells that this
    type can't hold without loss (text that does not convert, a fraction among integers). So no
    two values meet that differ, and a lost value never meets a null as its equal. ``schema_diff``
    tells which types differ.
    """
    mine = {f.name.lower(): f for f in a.schema.fields}
    others = {f.name.lower(): f for f in b.schema.fields}

    def shaped(df: DataFrame, partners: dict[str, T.StructField]) -> DataFrame:
        out = []
        for f in df.schema.fields:
            value, other = F.col(f"`{f.name}`"), partners.get(f.name.lower())
            name = mine[f.name.lower()].name if f.name.lower() in mine else f.name
            if other is None or other.dataType == f.dataType:
                out.append(value.alias(name))
                continue
            kind = _common_type(f.dataType, other.dataType)
            held = value if kind == f.dataType else _held(value, f.dataType, kind)
            rest = F.when(held.isNull(), value.cast("string"))
            out += [held.alias(name), rest.alias(_REST.format(name))]
        return df.select(*out)

    return shaped(a, others), shaped(b, mine)


def _rests(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith(_REST.format(""))]


def _match_keys(df: DataFrame, keys: list[str]) -> list[str]:
    """The keys and, where their types differ, what their type can't hold."""
    names = {c.lower(): c for c in df.columns}
    found = [names[k.lower()] for k in keys]
    return found + [_REST.format(k) for k in found if _REST.format(k) in df.columns]


def _digest(df: DataFrame, prefix: str, counted: bool = True) -> list[Column]:
    """Rows, sum of row hashes and, if wanted, cells that did not convert."""
    rest = [F.count(F.col(f"`{c}`")) for c in _rests(df)]
    unconverted = reduce(add, rest, F.lit(0)).cast("bigint")
    return [
        F.count(F.lit(1)).alias(f"{prefix}n"),
        F.sum(_fingerprint(df)).alias(f"{prefix}h"),
        *([unconverted.alias(f"{prefix}u")] if counted else []),
    ]


def reconcile(
    src: DataFrame, tgt: DataFrame, keys: list[str] | None = None, unconverted: bool = False
) -> DataFrame:
    """Compare two tables on one row.

    Always: row counts and whether the contents agree in any order (equal counts and equal
    sums of row hashes). With ``keys`` also how many keys are missing in the target, extra
    in it, or hold different rows; rows are folded per key before the join. Values are compared in
    a common type per column, so text or a narrower number equals the same number; what this type
    can't hold is compared as text, and ``unconverted`` asks for the number of such cells.
    """
    src, tgt = same_types(src, tgt)
    cells = [(F.col("su") + F.col("tu")).alias("unconverted_cells")] if unconverted else []
    if not keys:
        sides = [
            df.agg(*_digest(df, p)).select(F.struct(f"{p}n", f"{p}h", f"{p}u").alias(p))
            for p, df in (("s", src), ("t", tgt))
        ]
        both = src.sparkSession.range(1).select(sides[0].scalar().alias("s"), sides[1].scalar().alias("t"))
        return both.select("s.*", "t.*").select(
            F.col("sn").alias("source_rows"),
            F.col("tn").alias("target_rows"),
            (F.col("sn").eqNullSafe(F.col("tn")) & F.col("sh").eqNullSafe(F.col("th"))).alias("matched"),
            *cells,
        )
    folded = [
        df.groupBy(*[f"`{k}`" for k in _match_keys(df, keys)]).agg(*_digest(df, p))
        for p, df in (("s", src), ("t", tgt))
    ]
    both = _full_join(*folded, _match_keys(src, keys))
    in_src, in_tgt = F.col("sn").isNotNull(), F.col("tn").isNotNull()
    zero = F.lit(0)
    return both.agg(
        F.coalesce(F.sum("sn"), zero).cast("bigint").alias("source_rows"),
        F.coalesce(F.sum("tn"), zero).cast("bigint").alias("target_rows"),
        F.count_if(in_src & ~in_tgt).alias("missing_keys"),
        F.count_if(in_tgt & ~in_src).alias("extra_keys"),
        F.count_if(in_src & in_tgt & ~_agree()).alias("different_keys"),
        F.coalesce(F.sum("su"), zero).alias("su"),
        F.coalesce(F.sum("tu"), zero).alias("tu"),
    ).select(
        "source_rows",
        "target_rows",
        "missing_keys",
        "extra_keys",
        "different_keys",
        ((F.col("missing_keys") == 0) & (F.col("extra_keys") == 0) & (F.col("different_keys") == 0)).alias("matched"),
        *cells,
    )


def _agree() -> Column:
    return (F.col("sn") == F.col("tn")) & (F.col("sh") == F.col("th"))


def _full_join(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join on equal names, null equal to null; the keys once, then the other columns."""
    right = b.withColumnsRenamed({k: f"other {k}" for k in on})
    pairs = [(F.col(f"`{k}`"), F.col(f"`other {k}`")) for k in on]
    both = a.join(right, reduce(and_, [x.eqNullSafe(y) for x, y in pairs]), "full")
    rest = [c for c in (*a.columns, *b.columns) if c not in on]
    return both.select(*[F.coalesce(x, y).alias(k) for k, (x, y) in zip(on, pairs)], *rest)


def bucket_digests(
    df: DataFrame, keys: list[str], buckets: int = 256, leaves: int = 64, bucket: Column | None = None
) -> DataFrame:
    """(bucket, leaf, n, h): rows and sum of row hashes per bucket of keys and share of a bucket.

    Two levels of a hash tree in one scan: sums of a bucket's leaves are the bucket's own digest.
    At most ``buckets`` times ``leaves`` rows, however large the table; kept beside a table, they
    spare the next comparison its scan. ``bucket`` says where a row lies if the table
    is kept in buckets already.
    """
    place = bucket if bucket is not None else bucket_of(df, keys, buckets)
    return df.groupBy(place.alias("bucket"), _leaf(df, keys, leaves).alias("leaf")).agg(*_digest(df, "", False))


def _leaf(df: DataFrame, keys: list[str], leaves: int) -> Column:
    hashed = F.xxhash64(F.lit("leaf"), hash_key(*[flat(df.schema[k]) for k in _match_keys(df, keys)]))
    return F.pmod(hashed, F.lit(leaves)).cast("int")


def differing_keys(
    src: DataFrame,
    tgt: DataFrame,
    keys: list[str],
    buckets: int = 256,
    leaves: int = 64,
    bucket_column: str | None = None,
) -> DataFrame:
    """(keys, state, source_rows, target_rows) of the keys on which two tables differ, by a hash tree.

    Digests of buckets are compared first, then those of the differing buckets' leaves; only rows in
    differing leaves are folded per key and joined. Equal tables cost a scan and a join of the
    digests. ``state`` is ``missing`` (in the target), ``extra`` or ``different``. If both tables
    are partitioned by ``bucket_column`` (see ``bucketed``), only partitions of differing buckets are read again.
    The driver holds the numbers of differing buckets, ``buckets`` of them at most. Rows with a null key
    are told apart by all their values; their counts are those of differing leaves.
    """
    carried = [bucket_column] if bucket_column else []
    src, tgt = same_types(src, tgt)
    on = _match_keys(src, keys)
    sides = []
    for prefix, df in (("s", src), ("t", tgt)):
        data = df.drop(*carried)
        place = F.col(bucket_column) if bucket_column else bucket_of(data, keys, buckets)
        sides.append((prefix, df, data, place, _leaf(data, keys, leaves)))
    digests = [
        df.groupBy(place.alias("bucket"), leaf.alias("leaf")).agg(*_digest(data, prefix, False))
        for prefix, df, data, place, leaf in sides
    ]
    odd = settle(_differing(_full_join(*digests, ["bucket", "leaf"])).select("bucket", "leaf"), "differing-leaves")
    numbers = [r[0] for r in odd.select("bucket").distinct().collect()]
    # At most buckets times leaves rows.
    odd = F.broadcast(odd.select(F.col("bucket").alias("in bucket"), F.col("leaf").alias("in leaf")))
    folded = [
        df.where(place.isin(numbers))
        .join(odd, (place == F.col("in bucket")) & (leaf == F.col("in leaf")), "left_semi")
        .groupBy(*[f"`{k}`" for k in on])
        .agg(*_digest(data, prefix, False))
        for prefix, df, data, place, leaf in sides
    ]
    state = F.when(F.col("tn").isNull(), "missing").when(F.col("sn").isNull(), "extra").otherwise("different")
    return _differing(_full_join(*folded, on)).select(
        *[f"`{k}`" for k in on],
        state.alias("state"),
        F.coalesce("sn", F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce("tn", F.lit(0)).cast("bigint").alias("target_rows"),
    )


def _differing(both: DataFrame) -> DataFrame:
    return both.where(~F.coalesce(_agree(), F.lit(False)))


def load_validation(loaded: DataFrame, expected_rows: int, key: str) -> DataFrame:
    """After a load: row count as expected, no null in the key column, table not empty."""
    counted = loaded.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(key).isNull()).alias("null_keys")
    )
    n = F.col("row_count")
    return counted.withColumn(
        "passed", (n == expected_rows) & (F.col("null_keys") == 0) & (n > 0)
    )


def aggregate_consistency(detail: DataFrame, summary: DataFrame, count_column: str) -> DataFrame:
    """The counts of a summary must add up to the rows of its detail."""
    rows = detail.agg(F.count(F.lit(1)))
    total = summary.agg(F.coalesce(F.sum(count_column), F.lit(0)).cast("bigint").alias("summary_rows"))
    return total.withColumn("detail_rows", rows.scalar()).withColumn(
        "passed", F.col("summary_rows") == F.col("detail_rows")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_table(
    df: DataFrame,
    checks: list[Check],
    unique: list[str] = (),
    references: list[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """A list of checks on one table: row-level ones share a pass, uniqueness another."""
    parts = [run_checks(df, checks).drop("severity")] if checks else []
    parts += [test_unique(df, list(unique))] if unique else []
    parts += [test_relationships(df, c, parent, pc) for c, parent, pc in references]
    return _union(parts)


def verdict(results: DataFrame) -> DataFrame:
    """One row: how many tests ran, failed, and whether all passed."""
    return results.agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.every("passed"), F.lit(True)).alias("valid"),
    )
