"""Text files, typed loads, table copies, raw JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sluiceway.functions.masking import redact_json, redact_json_known
from sluiceway.functions.text import redact_text
from sluiceway.runtime import new_dir
from sluiceway.sources import delimited as d
from sluiceway.sources import semistructured as s
from sluiceway.sources import tables as tb
from sluiceway.workload.registry import Tables, query

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query("SELECT * FROM orders")
def orders_through_pipe_text(t: Tables):
    """Export with ``|``, read back with separator and header sniffed, cast to types."""
    path = new_dir(t.spark, "orders-text")
    d.export_delimited(t.orders, path, sep="|")
    return d.accepted(d.cast_to_schema(d.read_delimited(t.spark, path), ORDER_TYPES))


@query("SELECT * FROM orders")
def orders_through_text_parts(t: Tables):
    """Eight parts or more, half of them with their columns in another order, each with its header."""
    root, columns = new_dir(t.spark, "orders-parts"), t.orders.columns
    halves = {"a": ("o_orderkey % 2 = 0", columns), "b": ("o_orderkey % 2 = 1", columns[::-1])}
    for name, (half, order) in halves.items():
        some = t.orders.filter(half).select(*order)
        d.export_delimited(some.repartition(d.parts_for(some, 4)), f"{root}/{name}", sep=";")
    text = d.read_delimited(t.spark, f"{root}/*")
    return d.accepted(d.cast_to_schema(text, ORDER_TYPES))


DOCUMENT_TYPES = {
    "doc_id": "bigint",
    "text": "string",
    "lang": "string",
    "source": "string",
    "n_chars": "bigint",
}


@query("SELECT * FROM documents")
def documents_through_text(t: Tables):
    """Texts with line breaks, quotes and separators come back as they were."""
    path = new_dir(t.spark, "documents-text")
    d.export_delimited(t.documents.repartition(d.parts_for(t.documents, 4)), path)
    return d.accepted(d.cast_to_schema(d.read_delimited(t.spark, path), DOCUMENT_TYPES))


@query(
    """SELECT c_custkey::VARCHAR AS col_1, c_name AS col_2, c_nationkey::VARCHAR AS col_3,
       c_acctbal AS col_4, c_mktsegment AS col_5 FROM customer"""
)
def headerless_semicolon_text(t: Tables):
    path = new_dir(t.spark, "customer-text")
    d.export_delimited(t.customer, path, sep=";", header=False)
    text = d.read_delimited(t.spark, path, header=False)
    return text.withColumn("col_4", F.col("col_4").cast("double"))


_TEXT_SQL = """(SELECT p_partkey::VARCHAR AS partkey, CASE WHEN p_size > 5 THEN (p_size - 25)::VARCHAR ELSE '' END AS size,
    (p_retailprice::DECIMAL(15,2))::VARCHAR AS price, p_name AS name,
    CASE WHEN p_size > 25 THEN 'true' ELSE 'False' END AS large,
    strftime(DATE '2020-02-01' + p_size, '%m/%d/%Y') AS made, NULL::VARCHAR AS empty,
    (p_partkey * 10000000)::VARCHAR AS wide FROM part)"""


def part_text(t: Tables):
    """Parts as all-text columns, as a text file would deliver them."""
    return t.part.select(
        F.col("p_partkey").cast("string").alias("partkey"),
        F.when(F.col("p_size") > 5, (F.col("p_size") - 25).cast("string")).otherwise("").alias("size"),
        F.col("p_retailprice").cast("decimal(15,2)").cast("string").alias("price"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "true").otherwise("False").alias("large"),
        F.date_format(F.date_add(F.lit("2020-02-01").cast("date"), F.col("p_size")), "MM/dd/yyyy").alias("made"),
        F.lit(None).cast("string").alias("empty"),
        (F.col("p_partkey") * 10000000).cast("string").alias("wide"),
    )


def _inferred_sql() -> str:
    def width(lo: str, hi: str) -> str:
        return f"""CASE WHEN {lo} >= -128 AND {hi} <= 127 THEN 'BYTEINT' WHEN {lo} >= -32768 AND {hi} <= 32767
            THEN 'SMALLINT' WHEN {lo} >= -2147483648 AND {hi} <= 2147483647 THEN 'INTEGER' ELSE 'BIGINT' END"""

    def whole(c: str) -> str:
        v = f"try_cast({c} AS BIGINT)"
        return width(f"min({v})", f"max({v})")

    rows = {
        "partkey": whole("partkey"),
        "size": whole("size"),
        "price": "'DECIMAL(15,2)'",
        "name": "'VARCHAR(' || greatest(50, floor(max(length(name)) * 1.5)::INTEGER) || ')'",
        "large": "'BYTEINT'",
        "made": "'DATE'",
        "empty": "'VARCHAR(255)'",
        "wide": whole("wide"),
    }
    return " UNION ALL ".join(
        f"""SELECT {i + 1} AS position, '{c}' AS column_name, {kind} AS inferred_type,
            count(*) - count(nullif({c}, '')) AS null_count, count(DISTINCT nullif({c}, '')) AS unique_count,
            {"max(length(name))::INTEGER" if c == "name" else "NULL::INTEGER"} AS max_length,
            (SELECT coalesce(string_agg(v, '|' ORDER BY turn), '') FROM
              (SELECT min_by({c}, turn) AS v, min(turn) AS turn FROM
                (SELECT *, row_number() OVER () - 1 AS turn FROM {_TEXT_SQL}) WHERE {c} <> '' GROUP BY turn % 5)) AS samples
            FROM {_TEXT_SQL}"""
        for i, (c, kind) in enumerate(rows.items())
    )


@query(_inferred_sql())
def inferred_part_types(t: Tables):
    return d.infer_schema(part_text(t)).withColumn("samples", F.array_join("samples", "|"))


@query(
    """SELECT p_partkey AS partkey, CASE WHEN p_size > 5 THEN p_size - 25 END AS size, p_retailprice AS price,
       p_name AS name, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS large, (DATE '2020-02-01' + p_size)::DATE AS made,
       NULL::VARCHAR AS empty, p_partkey * 10000000 AS wide FROM part"""
)
def part_loaded_with_inferred_types(t: Tables):
    text = part_text(t)
    loaded = d.accepted(d.cast_to_schema(text, d.typed_schema(d.infer_schema(text))))
    return loaded.select(
        F.col("partkey").cast("bigint").alias("partkey"),
        F.col("size").cast("int").alias("size"),
        F.col("price").cast("double").alias("price"),
        "name",
        F.col("large").cast("int").alias("large"),
        "made",
        "empty",
        F.col("wide").cast("bigint").alias("wide"),
    )


# Event text with faults where the data says so: cheap events lost their value, errors carry
# a date nobody can read.
_BAD_VALUE, _BAD_TIME = "value < 5", "event_type = 'error'"
EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}


def event_text(t: Tables):
    return t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.expr(_BAD_TIME), "soon").otherwise(F.col("ts").cast("string")).alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.when(F.expr(_BAD_VALUE), "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        "props",
    )


@query(
    f"SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE NOT ({_BAD_VALUE}) AND NOT ({_BAD_TIME})"
)
def events_accepted_by_types(t: Tables):
    return d.accepted(d.cast_to_schema(event_text(t), EVENT_TYPES))


@query(
    f"""SELECT CASE WHEN {_BAD_TIME} AND {_BAD_VALUE} THEN 'ts,value' WHEN {_BAD_TIME} THEN 'ts' ELSE 'value' END
        AS failed, count(*) AS row_count FROM events WHERE {_BAD_VALUE} OR {_BAD_TIME} GROUP BY 1"""
)
def events_rejected_by_types(t: Tables):
    bad = d.rejected(d.cast_to_schema(event_text(t), EVENT_TYPES))
    return bad.groupBy(F.array_join("_errors", ",").alias("failed")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    f"""SELECT 'good' AS part, count(DISTINCT user_id) AS row_count FROM events
          WHERE NOT ({_BAD_VALUE}) AND NOT ({_BAD_TIME})
        UNION ALL SELECT 'et', count(*) FROM events WHERE {_BAD_VALUE} OR {_BAD_TIME}
        UNION ALL SELECT 'uv', count(*) - count(DISTINCT user_id) FROM events
          WHERE NOT ({_BAD_VALUE}) AND NOT ({_BAD_TIME})"""
)
def append_with_error_tables(t: Tables):
    """First event per user is loaded; bad text and repeats land in their own tables."""
    path = new_dir(t.spark, "events")
    checked = d.cast_to_schema(event_text(t), EVENT_TYPES)
    tb.load_append(checked, path, ["user_id"], ["ts", "event_id"], error_limit=10**15)
    parts = [
        t.spark.read.parquet(p).agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("row_count"))
        for n, p in (("good", path), ("et", f"{path}_et"), ("uv", f"{path}_uv"))
    ]
    return parts[0].union(parts[1]).union(parts[2])


_SECOND = """WITH good AS (SELECT * FROM events WHERE NOT (value < 5) AND event_type <> 'error'),
    one AS (SELECT user_id FROM good WHERE event_id % 2 = 0 GROUP BY 1),
    two AS (SELECT user_id, count(*) AS n FROM good WHERE event_id % 2 = 1 GROUP BY 1)"""


@query(
    f"""{_SECOND} SELECT 'first' AS load, (SELECT count(*) FROM one) AS good,
          (SELECT count(*) FROM events WHERE event_id % 2 = 0 AND ({_BAD_VALUE} OR {_BAD_TIME})) AS et,
          (SELECT count(*) FROM good WHERE event_id % 2 = 0) - (SELECT count(*) FROM one) AS uv
        UNION ALL SELECT 'second', (SELECT count(*) FROM two WHERE user_id NOT IN (SELECT user_id FROM one)),
          (SELECT count(*) FROM events WHERE event_id % 2 = 1 AND ({_BAD_VALUE} OR {_BAD_TIME})),
          (SELECT coalesce(sum(n), 0)::BIGINT FROM two) - (SELECT count(*) FROM two WHERE user_id NOT IN (SELECT user_id FROM one))
        UNION ALL SELECT 'table', (SELECT count(DISTINCT user_id) FROM good), 0, 0"""
)
def append_twice_with_error_tables(t: Tables):
    """Keys that the first load has put into the table are violations of the second."""
    path, parts = new_dir(t.spark, "twice"), []
    for name, half in (("first", 0), ("second", 1)):
        text = event_text(t).filter(F.col("event_id").cast("bigint") % 2 == half)
        got = tb.load_append(
            d.cast_to_schema(text, EVENT_TYPES), path, ["user_id"], ["ts", "event_id"], error_limit=10**15
        )
        parts.append((name, got["good"], got["et"], got["uv"]))
    parts.append(("table", t.spark.read.parquet(path).select("user_id").distinct().count(), 0, 0))
    return t.spark.createDataFrame(parts, "load string, good long, et long, uv long")


@query(
    f"""SELECT true AS refused, 0::BIGINT AS loaded, count(*) AS kept_errors FROM events
        WHERE {_BAD_VALUE} OR {_BAD_TIME}"""
)
def append_refused_over_the_limit(t: Tables):
    """More failures than allowed: nothing is loaded, the failed rows are kept for inspection."""
    path, refused = new_dir(t.spark, "refused"), False
    checked = d.cast_to_schema(event_text(t), EVENT_TYPES)
    tb.create_like(checked.drop("_errors", "_raw"), path)
    try:
        tb.load_append(checked, path, error_limit=0)
    except tb.TooManyRejects:
        refused = True
    loaded = t.spark.read.parquet(path).agg(F.count(F.lit(1)))
    errors = t.spark.read.parquet(f"{path}_et").agg(F.count(F.lit(1)).alias("kept_errors"))
    return errors.select(F.lit(refused).alias("refused"), loaded.scalar().alias("loaded"), "kept_errors")


@query(
    """SELECT o_custkey, count(*) AS orders, sum(o_orderkey)::BIGINT AS keys FROM orders
       JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def join_of_distributed_tables(t: Tables):
    """Both tables are saved by the hash of their key and meet without a shuffle."""
    names = {}
    for name, df in (("orders", t.orders.select("o_custkey", "o_orderkey")), ("customer", t.customer)):
        names[name] = f"distributed_{name}_{uuid.uuid4().hex}"
        tb.write_distributed(df, names[name], 8, path=new_dir(t.spark, "distributed"))
    orders, customer = t.spark.table(names["orders"]), t.spark.table(names["customer"])
    met = orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    return met.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys")
    )


@query(
    """SELECT 'now' AS copy, count(*) AS row_count, max(o_orderkey) AS last FROM orders
       UNION ALL SELECT 'backup', count(*), max(o_orderkey) FROM orders WHERE o_orderstatus = 'F'"""
)
def replace_with_backup(t: Tables):
    path = new_dir(t.spark, "replaced")
    tb.load_replace(t.orders.filter("o_orderstatus = 'F'"), path)
    tb.load_replace(t.orders, path)

    def about(name, p):
        return t.spark.read.parquet(p).agg(
            F.lit(name).alias("copy"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("o_orderkey").alias("last"),
        )

    return about("now", path).union(about("backup", f"{path}_bkp"))


@query(
    """SELECT 1 AS step, 'created' AS outcome, count(*) AS row_count FROM customer
       UNION ALL SELECT 2, 'appended', 2 * count(*) FROM customer
       UNION ALL SELECT 3, 'recreated', count(*) FROM customer"""
)
def transfer_customers(t: Tables):
    """Create, append on equal columns, back up and recreate on other columns."""
    path = new_dir(t.spark, "transfer")
    parts = []
    names = t.customer.columns
    for step, columns in enumerate((None, None, names[::-1]), 1):
        outcome = tb.transfer_table(t.customer, path, columns)
        count = t.spark.read.parquet(path).count()
        parts.append(F.struct(F.lit(step).alias("step"), F.lit(outcome).alias("outcome"), F.lit(count).cast("bigint").alias("row_count")))
    return t.spark.range(1).select(F.inline(F.array(*parts)))


@query("SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1")
def transfer_query_result(t: Tables):
    path = new_dir(t.spark, "transfer-query")
    sql = "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM {orders} GROUP BY o_custkey"
    tb.transfer_query(t.spark, sql, path, orders=t.orders)
    return t.spark.read.parquet(path)


@query("SELECT * FROM lineitem")
def create_like_then_append(t: Tables):
    path = new_dir(t.spark, "like")
    tb.create_like(t.lineitem, path)
    tb.transfer(t.lineitem, path)
    return t.spark.read.parquet(path)


@query("SELECT n_nationkey, n_name, n_regionkey, count(*) AS customers FROM nation JOIN customer "
       "ON n_nationkey = c_nationkey GROUP BY 1, 2, 3")
def customers_per_seeded_nation(t: Tables):
    """A small text file becomes a reference table and joins the customers."""
    text, path = new_dir(t.spark, "nation-text"), new_dir(t.spark, "nation")
    d.export_delimited(t.nation, text)
    seed = d.load_seed(t.spark, text, path)
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    return counts.join(seed, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("n_nationkey").cast("int").alias("n_nationkey"),
        "n_name",
        F.col("n_regionkey").cast("int").alias("n_regionkey"),
        "customers",
    )


RAW_SCHEMA = (
    "id bigint, kind string, score double, active boolean, seen timestamp_ntz, missing string, "
    "user struct<id: bigint, props: struct<k: int>>, tags array<string>"
)


def raw_events(t: Tables):
    """Events as raw landing rows: id, arrival time, one JSON text; purchases arrive broken."""
    doc = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("kind"),
            F.col("value").alias("score"),
            (F.col("value") > 20).alias("active"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("seen"),
            F.lit(None).cast("string").alias("missing"),
            F.struct(
                F.col("user_id").alias("id"),
                F.from_json("props", "k int").alias("props"),
            ).alias("user"),
            F.array("event_type", F.lit("web")).alias("tags"),
        ),
        {"ignoreNullFields": "false"},
    )
    broken = F.when(F.col("event_type") == "purchase", F.concat(F.lit("{"), doc)).otherwise(doc)
    return t.events.select(
        F.sha2(F.col("event_id").cast("string"), 256).alias("_raw_id"),
        F.col("ts").alias("_emitted_at"),
        broken.alias("_data"),
    )


@query(
    """SELECT sha256(event_id::VARCHAR) AS _raw_id, ts AS _emitted_at, ok AND true AS readable,
       CASE WHEN ok THEN event_id END AS id, CASE WHEN ok THEN event_type END AS kind,
       CASE WHEN ok THEN value END AS score, CASE WHEN ok THEN value > 20 END AS active,
       CASE WHEN ok THEN ts END AS seen, NULL::VARCHAR AS missing, CASE WHEN ok THEN user_id END AS user_id,
       CASE WHEN ok THEN json_extract_string(props, '$.k')::INTEGER END AS k,
       CASE WHEN ok THEN event_type || ',web' END AS tags
       FROM (SELECT *, event_type <> 'purchase' AS ok FROM events)"""
)
def unpacked_raw_events(t: Tables):
    out = s.unpack_raw(raw_events(t), RAW_SCHEMA)
    return out.select(
        "_raw_id",
        "_emitted_at",
        F.col("_bad").isNull().alias("readable"),
        "id",
        "kind",
        "score",
        "active",
        "seen",
        "missing",
        F.col("user.id").alias("user_id"),
        F.col("user.props.k").alias("k"),
        F.array_join("tags", ",").alias("tags"),
    )


@query(
    """SELECT ts AS _emitted_at, CASE WHEN event_type <> 'purchase' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'purchase' THEN json_extract_string(props, '$.k')::INTEGER END AS k,
       CASE WHEN event_type <> 'purchase' THEN 'web' END AS second_tag FROM events"""
)
def unpacked_by_paths(t: Tables):
    raw = raw_events(t).drop("_raw_id")
    paths = {
        "user_id": ("$.user.id", "bigint"),
        "k": ("$.user.props.k", "int"),
        "second_tag": ("$.tags[1]", "string"),
    }
    return s.unpack_open(raw, paths)


@query(
    """SELECT '{"o_orderkey":' || o_orderkey || ',"status":' ||
       CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END ||
       ',"ordered_at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","day":"' ||
       strftime(o_orderdate, '%Y-%m-%d') || '","half":' || (o_custkey / 2)::DECIMAL(10,1) || '}' AS json FROM orders"""
)
def orders_as_json_rows(t: Tables):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_custkey").cast("decimal(10,1)") / 2).cast("decimal(10,1)").alias("half"),
    )
    return s.to_json_rows(rows)


_REDACT_SQL = r"""regexp_replace(text,
    '(^|[^\p{L}\p{N}_])(password|token|secret|key|credential)[=:\s]+\S+', '\1\2=***REDACTED***', 'gi')"""


@query(f"SELECT doc_id, {_REDACT_SQL} AS text FROM documents")
def redacted_documents(t: Tables):
    return t.documents.select("doc_id", redact_text(F.col("text")).alias("text"))


@query(f"SELECT conv_id, turn, {_REDACT_SQL} AS text FROM conversations")
def redacted_conversations(t: Tables):
    return t.conversations.select("conv_id", "turn", redact_text(F.col("text")).alias("text"))


@query(
    """SELECT event_id, '{"db_password":"***REDACTED***","user":{"apiKey":"***REDACTED***","id":' || user_id
       || ',"primary_key":' || event_id || '},"logins":[{"accessToken":"***REDACTED***","kind":"' || event_type
       || '"}],"token_url":"x","extra":"***REDACTED***","note":"{\\"k\\": 1, \\"userToken\\": \\"***REDACTED***\\"}"}' AS doc FROM events"""
)
def redacted_open_json(t: Tables):
    doc = F.to_json(
        F.struct(
            F.col("value").alias("db_password"),
            F.struct(
                F.col("props").alias("apiKey"),
                F.col("user_id").alias("id"),
                F.col("event_id").alias("primary_key"),
            ).alias("user"),
            F.array(
                F.struct(F.col("props").alias("accessToken"), F.col("event_type").alias("kind"))
            ).alias("logins"),
            F.lit("x").alias("token_url"),
            F.lit("user:pass").alias("extra"),
            F.concat(F.lit('{"k": 1, "userToken": "'), F.col("event_type"), F.lit('"}')).alias("note"),
        )
    )
    return t.events.select("event_id", redact_json(doc).alias("doc"))


@query("SELECT event_id, props FROM events")
def redacted_event_props(t: Tables):
    """Documents without secrets come back as they were, character by character."""
    return t.events.select("event_id", redact_json(F.col("props")).alias("props"))


@query(
    """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"login":{"userToken":"***REDACTED***","id":'
       || user_id || '},"note":"{\\"dbPassword\\": \\"***REDACTED***\\", \\"at\\": 1}","gone":null}' AS doc FROM events"""
)
def redacted_known_json(t: Tables):
    doc = F.to_json(
        F.struct(
            F.from_json("props", "k int").getField("k").alias("k"),
            F.struct(F.col("event_type").alias("userToken"), F.col("user_id").alias("id")).alias(
                "login"
            ),
            F.concat(F.lit('{"dbPassword": "'), F.col("event_type"), F.lit('", "at": 1}')).alias("note"),
        )
    )
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(
        "k int, login struct<userToken: string, id: bigint>, note string, gone string"
    )
    return redact_json_known(t.events.select("event_id", doc.alias("doc")), "doc", schema)
