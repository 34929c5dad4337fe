"""Name matching, ranking, policy; catalogs and schema comparison."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluiceway.functions.fuzzy import fuzzy_token_score
from sluiceway.functions.text import humanize_name
from sluiceway.operators import matching as m
from sluiceway.operators import schema as sc
from sluiceway.sources.catalog import catalog_search, list_tables
from sluiceway.workload.registry import Tables, query


def _score_sql(keyword: str, target: str) -> str:
    """The token score as SQL over a keyword literal and a text expression."""
    t = f"lower(trim({target}))"
    words = f"string_split_regex({t}, '[_\\-\\s.]+')"
    ratio = f"greatest(list_max(list_transform({words}, lambda w: 1 - levenshtein('{keyword}', w)::DOUBLE / greatest({len(keyword)}, length(w)))), 1 - levenshtein('{keyword}', {t})::DOUBLE / greatest({len(keyword)}, length({t})))"
    prefix = (
        f"WHEN list_bool_or(list_transform({words}, lambda w: starts_with(w, '{keyword}'))) THEN 0.85"
        if len(keyword) >= 3
        else ""
    )
    return f"""CASE WHEN {t} = '' THEN 0 WHEN {t} = '{keyword}' THEN 1 WHEN list_contains({words}, '{keyword}') THEN 0.95
        {prefix} WHEN {ratio} >= 0.7::DOUBLE THEN 0.5::DOUBLE + 0.3::DOUBLE * (({ratio} - 0.7::DOUBLE) / 0.3::DOUBLE)
        ELSE 0 END::DOUBLE"""


@query(f"SELECT p_partkey, round({_score_sql('gaer', 'p_name')}, 9) AS score FROM part")
def fuzzy_scores_of_parts(t: Tables):
    score = fuzzy_token_score(F.lit("Gaer "), F.col("p_name"))
    return t.part.select("p_partkey", F.round(score, 9).alias("score"))


_ITEMS = """(SELECT p_partkey AS id, p_name AS name, p_brand AS namespace, lower(p_type) AS description,
    [p_name, lower(p_brand) || '_email'] AS columns, [lower(p_brand)] AS tags, p_size FROM part)"""


def items(t: Tables):
    """Parts as a catalog of streams."""
    sized = F.col("p_size") > 25
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("namespace"),
        F.lower("p_type").alias("description"),
        F.array("p_name", F.concat(F.lower("p_brand"), F.lit("_email"))).alias("columns"),
        F.array(F.lower("p_brand")).alias("tags"),
        F.when(sized, F.array(F.lit("Full_Refresh"), F.lit("Incremental")))
        .otherwise(F.array(F.lit("full_refresh")))
        .alias("supported_sync_modes"),
    )


KEYWORDS = ["ring", "smal", "econmy"]


def _rank_sql() -> str:
    parts = []
    for k in KEYWORDS:
        parts.append(f"4 * {_score_sql(k, 'name')} + 2 * {_score_sql(k, 'namespace')} + 2 * {_score_sql(k, 'description')}")
        parts.append(f"greatest({_score_sql(k, 'columns[1]')}, {_score_sql(k, 'columns[2]')})")
        parts.append(_score_sql(k, "tags[1]"))
    return " + ".join(parts)


@query(f"SELECT id, round({_rank_sql()}, 6) AS score FROM {_ITEMS}")
def ranked_items(t: Tables):
    return m.rank_by_keywords(items(t), KEYWORDS).select("id", F.round("score", 6).alias("score"))


@query(
    "SELECT id, "
    + " + ".join(
        f"""(CASE WHEN contains(lower(name), '{k}') THEN 3 ELSE 0 END +
             CASE WHEN contains(lower(namespace), '{k}') THEN 2 ELSE 0 END +
             CASE WHEN contains(description, '{k}') THEN 2 ELSE 0 END +
             CASE WHEN contains(lower(columns[1]), '{k}') OR contains(columns[2], '{k}') THEN 1 ELSE 0 END +
             CASE WHEN contains(tags[1], '{k}') THEN 1 ELSE 0 END)"""
        for k in ("ring", "brand", "mail", "o")
    )
    + f" AS score FROM {_ITEMS}"
)
def substring_scores(t: Tables):
    return m.substring_score(items(t), ["ring", "brand", "mail", "o"]).select("id", "score")


_STOPS = ", ".join(f"'{w}'" for w in m.STOP_WORDS)
_SYNONYM_ROWS = ", ".join(
    f"('{k}', '{s}')" for k, v in {**m.SYNONYMS, "elle": ["she", "her"]}.items() for s in v
)


@query(
    f"""WITH words AS (SELECT DISTINCT conv_id, turn, word FROM
          (SELECT conv_id, turn, unnest(string_split_regex(lower(text), '[^a-zA-Z0-9_]+')) AS word FROM conversations)
          WHERE length(word) > 2 AND word NOT IN ({_STOPS})),
        wide AS (SELECT conv_id, turn, word FROM words UNION
          SELECT conv_id, turn, s.synonym FROM words JOIN (VALUES {_SYNONYM_ROWS}) s(base, synonym) ON word = s.base)
        SELECT word AS keyword, count(*) AS turns FROM wide GROUP BY 1"""
)
def keywords_of_conversations(t: Tables):
    wide = m.expand_keywords(t.conversations, "text", {"elle": ["she", "her"]})
    return (
        wide.select(F.explode("keywords").alias("keyword"))
        .groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("turns"))
    )


@query(
    f"""SELECT name, round(greatest(1 - levenshtein('blue blt', lower(name))::DOUBLE / greatest(8, length(name)),
          {_score_sql('blue blt', 'name')}), 9) AS score FROM (SELECT DISTINCT p_name AS name FROM part)
        ORDER BY score DESC, name LIMIT 5"""
)
def suggested_names(t: Tables):
    names = t.part.select(F.col("p_name").alias("name")).distinct()
    return m.suggest(names, "Blue blt", 5).withColumn("score", F.round("score", 9))


_SPOKEN = "(SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS name FROM conversations)"
_MISSPELLED = """(SELECT DISTINCT substr(w, 1, 1) || substr(w, 3) || CASE WHEN length(w) % 2 = 0 THEN upper(substr(w, 1, 1)) ELSE ' ' END
    AS target FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM benchmark))"""


@query(
    f"""WITH names AS (SELECT name, lower(trim(name)) AS low FROM {_SPOKEN}),
        targets AS (SELECT target, lower(trim(target)) AS kw FROM {_MISSPELLED}),
        pairs AS (
          SELECT target, name, low, kw, 1 - levenshtein(lower(target), low)::DOUBLE / greatest(length(target), length(name)) AS spelled,
            1 - levenshtein(kw, low)::DOUBLE / greatest(length(kw), length(low)) AS ratio FROM targets, names WHERE kw <> '' AND low <> ''),
        scored AS (
          SELECT target, name, greatest(spelled,
            CASE WHEN low = kw THEN 1 WHEN length(kw) >= 3 AND starts_with(low, kw) THEN 0.85
              WHEN ratio >= 0.7::DOUBLE THEN 0.5::DOUBLE + 0.3::DOUBLE * ((ratio - 0.7::DOUBLE) / 0.3::DOUBLE) ELSE 0 END::DOUBLE) AS score
          FROM pairs)
        SELECT target, name, round(score, 9) AS score FROM scored WHERE score >= 0.7::DOUBLE
        QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, name) <= 5"""
)
def suggestions_for_misspelled_words(t: Tables):
    """For every word of the benchmark, misspelled, the five closest words of the conversations."""

    def words(df):
        return df.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w"))

    last = F.when(F.length("w") % 2 == 0, F.upper(F.substring("w", 1, 1))).otherwise(F.lit(" "))
    misspelled = F.concat(F.substring("w", 1, 1), F.expr("substr(w, 3)"), last)
    targets = words(t.benchmark).select(misspelled.alias("target"))
    names = words(t.conversations).select(F.col("w").alias("name"))
    return m.suggest_all(names, targets).withColumn("score", F.round("score", 9))


_MARKERS = "|".join([*m.SENSITIVE_MARKERS, "bolt"])


@query(
    f"""SELECT id, regexp_matches(lower(name), '{_MARKERS}') OR p_size > 40 AS restricted FROM {_ITEMS}"""
)
def sensitive_items(t: Tables):
    large = F.array("p_name", F.when(F.col("p_size") > 40, "Home_Phone"))
    catalog = t.part.select(F.col("p_partkey").alias("id"), F.array_compact(large).alias("columns"))
    return m.flag_sensitive(catalog, ["BOLT"]).drop("columns")


@query(
    f"""SELECT id, round(score, 6) AS score, CASE WHEN p_size > 25 THEN 'incremental' ELSE 'full_refresh' END AS sync_mode
        FROM (SELECT *, {_rank_sql()} AS score FROM {_ITEMS})
        WHERE score > 0 AND name <> 'small ring' AND namespace <> 'Brand#3'
        AND NOT regexp_matches(lower(name), '{"|".join(m.SENSITIVE_MARKERS)}')"""
)
def items_for_intent(t: Tables):
    catalog = items(t).withColumn("columns", F.array("name", F.concat(F.lower("namespace"), F.lit("_emai"))))
    chosen = m.select_for_intent(
        catalog,
        KEYWORDS,
        disallowed_names=["Small Ring"],
        disallowed_namespaces=["brand#3"],
        max_sensitivity="medium",
    )
    return chosen.select("id", F.round("score", 6).alias("score"), "sync_mode")


_NEEDLES = """(SELECT DISTINCT lower(trim(n)) AS needle FROM (SELECT p_type AS n FROM part
    UNION ALL SELECT substr(p_name, 2, 4) FROM part UNION ALL SELECT p_name FROM part
    UNION ALL SELECT string_split(p_name, ' ')[1] FROM part UNION ALL SELECT string_split(p_name, ' ')[2] FROM part))"""


@query(
    f"""SELECT needle, id, name, score FROM (SELECT needle, p_partkey AS id, p_name AS name,
          CASE WHEN lower(p_name) = needle THEN 4 WHEN regexp_extract(lower(p_name), '[a-z0-9]+') = needle THEN 3
               WHEN list_contains(regexp_extract_all(lower(p_name), '[a-z0-9]+'), needle) THEN 2
               WHEN contains(lower(p_name), needle) THEN 1 ELSE 0 END AS score FROM part, {_NEEDLES})
        WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY needle ORDER BY score DESC, length(name), id) = 1"""
)
def best_matching_parts(t: Tables):
    words = F.split("p_name", " ")
    needles = (
        t.part.select(F.col("p_type").alias("needle"))
        .union(t.part.select(F.substring("p_name", 2, 4)))
        .union(t.part.select("p_name"))
        .union(t.part.select(F.get(words, F.lit(0))))
        .union(t.part.select(F.get(words, F.lit(1))))
    )
    return m.best_match(needles, t.part, "needle", "p_name", "p_partkey")


# Two versions of a catalog derived from the parts: a brand is a table, a part a column.
_BEFORE = """(SELECT p_brand AS table_name, 'c' || p_partkey AS column_name, p_type AS data_type,
    p_retailprice < 950 AS nullable, p_size AS length FROM part WHERE p_size < 48)"""
_AFTER = """(SELECT p_brand AS table_name, 'c' || p_partkey AS column_name,
    CASE WHEN p_size BETWEEN 10 AND 12 THEN 'LARGE' ELSE p_type END AS data_type,
    p_retailprice < 950 OR p_size = 20 AS nullable,
    CASE WHEN p_size BETWEEN 12 AND 14 THEN p_size + 1 ELSE p_size END AS length FROM part WHERE p_size > 3)"""


def catalogs(t: Tables):
    size = F.col("p_size")
    base = t.part.select(
        F.col("p_brand").alias("table_name"),
        F.concat(F.lit("c"), F.col("p_partkey")).alias("column_name"),
        F.col("p_type").alias("data_type"),
        (F.col("p_retailprice") < 950).alias("nullable"),
        size.alias("length"),
    )
    s = F.col("length")
    after = base.filter(s > 3).select(
        "table_name",
        "column_name",
        F.when(s.between(10, 12), "LARGE").otherwise(F.col("data_type")).alias("data_type"),
        (F.col("nullable") | (s == 20)).alias("nullable"),
        F.when(s.between(12, 14), s + 1).otherwise(s).alias("length"),
    )
    return base.filter(s < 48), after


_DIFF = f"""(SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.column_name, b.column_name) AS column_name,
    CASE WHEN b.column_name IS NULL THEN 'added' WHEN a.column_name IS NULL THEN 'removed' ELSE 'modified' END AS change,
    CASE WHEN a.column_name IS NULL OR b.column_name IS NULL THEN NULL ELSE concat_ws('; ',
      CASE WHEN b.data_type <> a.data_type THEN 'data_type: ' || b.data_type || ' -> ' || a.data_type END,
      CASE WHEN b.nullable <> a.nullable THEN 'nullable: ' || b.nullable || ' -> ' || a.nullable END,
      CASE WHEN b.length <> a.length THEN 'length: ' || b.length || ' -> ' || a.length END) END AS changes
    FROM {_BEFORE} b FULL JOIN {_AFTER} a ON a.table_name = b.table_name AND a.column_name = b.column_name
    WHERE a.column_name IS NULL OR b.column_name IS NULL OR b.data_type <> a.data_type OR b.nullable <> a.nullable
       OR b.length <> a.length)"""


@query(f"SELECT * FROM {_DIFF}")
def schema_changes(t: Tables):
    out = sc.schema_diff(*catalogs(t))
    return out.withColumn("changes", F.array_join("changes", "; "))


@query(
    f"""SELECT table_name, count(*) FILTER (change = 'added') AS columns_added,
        count(*) FILTER (change = 'removed') AS columns_removed, count(*) FILTER (change = 'modified') AS columns_modified
        FROM {_DIFF} GROUP BY 1"""
)
def schema_change_counts(t: Tables):
    return sc.change_summary(sc.schema_diff(*catalogs(t)))


@query(
    f"""SELECT d.table_name, bool_and(change = 'added' AND a.nullable) AS compatible FROM {_DIFF} d
        LEFT JOIN {_AFTER} a USING (table_name, column_name) GROUP BY 1"""
)
def backward_compatible_tables(t: Tables):
    before, after = catalogs(t)
    return sc.is_backward_compatible(sc.schema_diff(before, after), after)


@query(
    f"""SELECT table_name, column_name, 'added' AS change FROM (SELECT table_name, column_name FROM {_AFTER} WHERE NOT nullable
          EXCEPT SELECT table_name, column_name FROM {_BEFORE} WHERE NOT nullable)
        UNION ALL SELECT table_name, column_name, 'removed' FROM (SELECT table_name, column_name FROM {_BEFORE}
          WHERE NOT nullable EXCEPT SELECT table_name, column_name FROM {_AFTER} WHERE NOT nullable)"""
)
def key_set_changes(t: Tables):
    """Required columns stand for key columns."""
    before, after = catalogs(t)
    return sc.set_diff(before.filter("NOT nullable"), after.filter("NOT nullable"), ["table_name"], "column_name")


@query(
    f"""SELECT table_name, 1 AS version, count(*) AS column_count, TIMESTAMP '2024-01-01 00:00:00' AS registered_at
        FROM {_BEFORE} GROUP BY 1
        UNION ALL SELECT table_name, 2, count(*), TIMESTAMP '2024-02-01 00:00:00' FROM {_AFTER} GROUP BY 1"""
)
def schema_versions(t: Tables):
    """Two versions, the second registered twice."""
    before, after = catalogs(t)
    history = sc.register_version(None, before, 1, dt.datetime(2024, 1, 1))
    history = sc.register_version(history, after, 2, dt.datetime(2024, 2, 1))
    return sc.schema_history(sc.register_version(history, after, 2, dt.datetime(2024, 3, 1)))


@query(f"SELECT table_name, 2 AS version, column_name, change, changes FROM {_DIFF}")
def schema_version_changes(t: Tables):
    before, after = catalogs(t)
    history = sc.register_version(None, before, 1, dt.datetime(2024, 1, 1))
    history = sc.register_version(history, after, 2, dt.datetime(2024, 2, 1))
    return sc.version_changes(history).withColumn("changes", F.array_join("changes", "; "))


_TYPE_SQL = """CASE p_type WHEN 'SMALL' THEN 'integer' WHEN 'ECONOMY' THEN 'VARCHAR(50)' WHEN 'LARGE' THEN 'DECIMAL(15,2)'
    ELSE 'DATE' END"""


_MATCHED_SQL = f"""SELECT coalesce(f.p_brand, t.p_brand) AS brand, coalesce(f.c, t.c) AS column_name, upper(file_type) AS file_type,
        upper(table_type) AS table_type, CASE WHEN f.c IS NULL THEN 'missing' WHEN t.c IS NULL THEN 'extra'
        WHEN p_type IN ('SMALL', 'LARGE') OR (p_type = 'ECONOMY' AND p_size <= 30) OR
             (p_type NOT IN ('SMALL', 'LARGE', 'ECONOMY') AND p_size <= 30) THEN 'ok' ELSE 'type_mismatch' END AS status
        FROM (SELECT p_brand, 'col' || p_partkey AS c, {_TYPE_SQL} AS file_type, p_type, p_size FROM part
              WHERE p_size > 5) f
        FULL JOIN (SELECT p_brand, 'col' || p_partkey AS c,
              CASE WHEN p_size > 30 THEN 'BIGINT' ELSE {_TYPE_SQL} END AS table_type FROM part WHERE p_size < 45) t
        ON f.p_brand = t.p_brand AND f.c = t.c"""


@query(_MATCHED_SQL)
def file_columns_matched(t: Tables):
    kind = F.expr(_TYPE_SQL)
    brand = F.col("p_brand").alias("brand")
    file = t.part.filter("p_size > 5").select(
        brand, F.concat(F.lit("COL"), F.col("p_partkey")).alias("column_name"), kind.alias("data_type")
    )
    table = t.part.filter("p_size < 45").select(
        brand,
        F.concat(F.lit("col"), F.col("p_partkey")).alias("column_name"),
        F.when(F.col("p_size") > 30, "BIGINT").otherwise(kind).alias("data_type"),
    )
    return sc.match_schema(file, table, ["brand"])


@query(
    f"""SELECT brand, count(*) FILTER (status IN ('missing', 'type_mismatch')) = 0 AS compatible,
        count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'extra') AS extra,
        count(*) FILTER (status = 'type_mismatch') AS type_mismatch FROM ({_MATCHED_SQL}) GROUP BY 1"""
)
def loadable_files(t: Tables):
    """The verdict per file, from the columns matched above."""
    return sc.is_loadable(file_columns_matched(t), ["brand"])


_TABLES_SQL = """(SELECT p_brand AS database_name, p_name AS table_name,
    CASE WHEN max(p_size) > 30 THEN 'T' WHEN max(p_size) > 15 THEN 'V' ELSE 'O' END AS table_kind,
    max(p_type) AS description FROM part GROUP BY 1, 2)"""


def table_catalog(t: Tables):
    size = F.max("p_size")
    return t.part.groupBy(
        F.col("p_brand").alias("database_name"), F.col("p_name").alias("table_name")
    ).agg(
        F.when(size > 30, "T").when(size > 15, "V").otherwise("O").alias("table_kind"),
        F.max("p_type").alias("description"),
    )


@query(
    f"""SELECT database_name, table_name, table_kind, description FROM {_TABLES_SQL}
        WHERE table_name ILIKE '%Ring%' AND table_kind IN ('T', 'O') ORDER BY 1, 2 LIMIT 100"""
)
def tables_found_by_name(t: Tables):
    return catalog_search(table_catalog(t), "Ring", limit=100)


@query(
    f"""SELECT database_name, table_name, table_kind, description FROM {_TABLES_SQL}
        WHERE description ILIKE '%eco%' AND database_name = 'Brand#7' ORDER BY 1, 2 LIMIT 20"""
)
def tables_found_by_comment(t: Tables):
    return catalog_search(table_catalog(t), "eco", "comment", "Brand#7", 20)


@query(
    """SELECT 'parts' AS database_name, p_brand AS table_name, p_name || '_' || p_partkey AS column_name,
       p_type AS data_type, p_type AS description FROM part WHERE p_name || '_' || p_partkey ILIKE '%bolt_1%'
       ORDER BY 1, 2, 3 LIMIT 100"""
)
def columns_found_by_name(t: Tables):
    catalog = t.part.select(
        F.lit("parts").alias("database_name"),
        F.col("p_brand").alias("table_name"),
        F.concat_ws("_", "p_name", "p_partkey").alias("column_name"),
        F.col("p_type").alias("data_type"),
        F.col("p_type").alias("description"),
    )
    return catalog_search(catalog, "BOLT_1", "columns", limit=100)


@query(
    f"""SELECT t.*, size_mb FROM {_TABLES_SQL} t LEFT JOIN (SELECT p_brand AS database_name, p_name AS table_name,
        round(sum(p_retailprice), 2) AS size_mb FROM part GROUP BY 1, 2) USING (database_name, table_name)
        WHERE table_name LIKE 'red _o%' AND table_kind = 'T'"""
)
def tables_listed_with_sizes(t: Tables):
    sizes = t.part.groupBy(
        F.col("p_brand").alias("database_name"), F.col("p_name").alias("table_name")
    ).agg(F.round(F.sum("p_retailprice"), 2).alias("size_mb"))
    return list_tables(table_catalog(t), "red _o%", "T", sizes=sizes)


@query(
    """SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(string_split(p_name, ' ')[1], 2) || ' ' ||
       upper(substr(string_split(p_name, ' ')[2], 1, 1)) || substr(string_split(p_name, ' ')[2], 2) || ' Id (' ||
       CASE WHEN p_size > 25 THEN 'BIGINT' ELSE 'ZZ' END || ')' AS description FROM part"""
)
def humanized_part_names(t: Tables):
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("Id"))
    code = F.when(F.col("p_size") > 25, "I8").otherwise("ZZ")
    return t.part.select("p_partkey", humanize_name(name, code).alias("description"))
