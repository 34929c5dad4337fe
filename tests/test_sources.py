import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from sluiceway.runtime import new_dir
from sluiceway.sources import delimited as d
from sluiceway.sources import semistructured as s
from sluiceway.sources import storage
from sluiceway.sources import tables as tb


@pytest.fixture
def write(tmp_path):
    def to_file(text, name="in.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return to_file


@pytest.mark.parametrize("sep", [",", "|", "\t", ";"])
def test_separator_and_header_are_found(spark, write, rows, sep):
    table = [["port", "ship", "tons", "sailed"], ["7", "Gannet, grey", "12.25", "2021-03-04"], ["11", "Heron", "8", ""]]
    text = "\n".join(sep.join(f'"{c}"' if sep in c else c for c in r) for r in table)
    path = write(text + "\n")
    assert d.shape_of(spark, path).sep == sep
    df = d.read_delimited(spark, path)
    assert df.columns == table[0]
    assert rows(df, "port", "ship") == [("11", "Heron"), ("7", "Gannet, grey")]


def test_headerless_text_gets_numbered_columns(spark, write):
    df = d.read_delimited(spark, write("1,2.5\n2,3.5\n3,4.5\n"))
    assert df.columns == ["col_1", "col_2"]
    assert df.count() == 3


@pytest.mark.parametrize(
    "lines, header",
    [
        ([], False),
        ([""], False),
        (["id,name"], True),
        ([",,"], False),
        (["  , "], False),
        (["boat", "skiff", "barge"], True),
        (["skiff", "barge", "skiff"], False),
        (["4", "5", "6"], False),
        (["4.5,1", "7.5,3"], False),
        (["p,4", "q,5", "r,6"], False),
        (["when,4", "2020-01-02,5", "2020-02-02,6"], True),
        (["on,x", "true,y", "false,z", ",x"], True),
        (["n,x", *["5,x"] * 3000, "five,x"], False),
    ],
)
def test_header_edge_cases(spark, write, lines, header):
    path = write("".join(f"{x}\n" for x in lines))
    shape = d.shape_of(spark, path, ",")
    assert d.has_header(spark, path, shape) is header


@pytest.fixture
def parts(tmp_path):
    def to_folder(*texts, encoding="utf-8"):
        folder = tmp_path / "parts"
        folder.mkdir()
        for i, text in enumerate(texts):
            (folder / f"part-{i}.csv").write_bytes(text.encode(encoding))
        return str(folder)

    return to_folder


def test_parts_with_headers_are_mapped_by_name(spark, parts, rows):
    path = parts("k,v\n1,a\n2,b\n", "v,k\nc,3\n", "k,v\n", "k,v\n4,d\n")
    df = d.read_delimited(spark, path)
    assert df.columns in (["k", "v"], ["v", "k"])
    assert rows(df, "k", "v") == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d")]


def test_many_first_lines_lose_no_file(spark, parts, rows, monkeypatch):
    monkeypatch.setattr(d, "MAX_HEADERS", 2)
    heads = ["k,v", '"k",v', 'k,"v"', '"k","v"', "v,k", '"v",k', 'v,"k"']
    path = parts(*(f"{h}\n{i},{i}\n" for i, h in enumerate(heads)))
    df = d.read_delimited(spark, path, header=True)
    assert df.columns == ["k", "v"]
    assert rows(df) == [(str(i), str(i)) for i in range(len(heads))]
    typed = d.read_delimited(spark, path, header=True, schema=T.StructType.fromDDL("v int, k int"))
    assert rows(typed, "v") == [(i,) for i in range(len(heads))]


def test_too_many_orders_of_columns_are_refused(spark, parts, monkeypatch):
    monkeypatch.setattr(d, "MAX_HEADERS", 2)
    path = parts("a,b,c\n1,2,3\n", "b,a,c\n1,2,3\n", "c,a,b\n1,2,3\n", "c,b,a\n1,2,3\n")
    with pytest.raises(ValueError, match="orders of columns"):
        d.read_delimited(spark, path, header=True)


def test_a_header_in_every_one_of_many_parts(spark, parts, rows):
    """More first lines than orders of columns that are mapped: read right or refused, never taken for rows."""
    import itertools

    names = [f"name{i}" for i in range(7)]
    orders = list(itertools.islice(itertools.permutations(names), 1100))
    path = parts(*(",".join(o) + "\n" + ",".join(str(o.index(n)) for n in o) + "\n" for o in orders))
    with pytest.raises(ValueError, match="orders of columns"):
        d.read_delimited(spark, path)


def test_many_parts_without_a_header(spark, parts):
    path = parts(*(f"{i},x{i}\n{i + 1},y{i}\n" for i in range(1050)))
    df = d.read_delimited(spark, path)
    assert df.columns == ["col_1", "col_2"] and df.count() == 2100


def test_lone_lines_that_differ_are_no_headers(spark, parts, rows):
    df = d.read_delimited(spark, parts("a,b\n", "c,d\n"))
    assert rows(df) == [("a", "b"), ("c", "d")]


def test_every_headerless_part_tells_the_shape(spark, parts, rows, monkeypatch):
    monkeypatch.setattr(d, "MAX_HEADERS", 2)
    # Each separator but ";" is missing somewhere; one part is wider and has a cell of two lines.
    path = parts(*(f"{i};a,b|c\n" for i in range(9)), "9;x\n", '10;"two\nlines"\n')
    shape = d.shape_of(spark, path)
    assert (shape.sep, shape.broken, shape.lines) == (";", True, 12)
    df = d.read_delimited(spark, path)
    assert df.columns == ["col_1", "col_2"] and df.count() == 11
    assert ("10", "two\nlines") in rows(df)


def test_parts_that_disagree_are_refused(spark, parts):
    path = parts("k,v\n1,a\n", "k,w\n2,b\n", "3,c\n4,d\n")
    with pytest.raises(ValueError, match="different columns"):
        d.read_delimited(spark, path, header=True)
    with pytest.raises(ValueError, match="seem to have a header"):
        d.read_delimited(spark, path)


def test_line_breaks_quotes_and_blanks_survive(spark, rows):
    path = new_dir(spark, "round-trip")
    cells = ["x\ny", ' "quoted", and more ', "", "tab\there", "end"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, v string").repartition(3)
    d.export_delimited(df, path)
    back = d.read_delimited(spark, path)
    assert sorted((int(r.i), r.v or "") for r in back.collect()) == list(enumerate(cells))


def test_other_encodings(spark, parts, rows):
    path = parts("k;v\n1;é\n", "k;v\n2;ü\n", encoding="iso-8859-1")
    df = d.read_delimited(spark, path, encoding="ISO-8859-1")
    assert rows(df, "k", "v") == [("1", "é"), ("2", "ü")]


def test_ragged_lines_stop_the_read(spark, write):
    df = d.read_delimited(spark, write("a,b\n1,2\n3,4,5\n"), sep=",", header=True)
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        df.collect()


def test_samples_come_from_the_whole_input(spark):
    rows = [(None,)] * 1500 + [(f"v{i}",) for i in range(1500)]
    got = d.infer_schema(spark.createDataFrame(rows, "c string").coalesce(1)).first()
    assert got.samples == ["v0", "v1", "v2", "v3", "v4"]


def test_very_wide_text_is_no_varchar(spark):
    got = d.infer_schema(spark.createDataFrame([("x" * 70_000,)], "c string")).first()
    assert (got.inferred_type, got.max_length) == ("CLOB", 70_000)


def test_empty_file(spark, write):
    df = d.read_delimited(spark, write(""))
    assert df.columns == [] and df.count() == 0
    assert d.shape_of(spark, write("")).sep == ","


def test_separator_must_be_one_character(spark, write):
    with pytest.raises(ValueError):
        d.read_delimited(spark, write("a||b\n"), sep="||")


def test_quoted_line_breaks_are_one_row(spark, write):
    path = write('id,note\n1,"two\nlines, one cell"\n2,plain\n')
    df = d.read_delimited(spark, path, sep=",", header=True, multiline=True)
    assert df.count() == 2


def test_malformed_lines_are_kept_apart(spark, write, rows):
    path = write("id,name\n1,a\n2\n3,c,too many\n")
    df = d.read_delimited(spark, path, sep=",", header=True, malformed_column="_bad")
    assert rows(df.cache().filter("_bad IS NOT NULL"), "_bad") == [("2",), ("3,c,too many",)]


INFER_CASES = [
    ("tiny", ["1", "-5", "127"], "BYTEINT"),
    ("negative", ["-5000", "100"], "SMALLINT"),
    ("wide", ["1", "40000"], "INTEGER"),
    ("huge", ["1", "3000000000"], "BIGINT"),
    ("blanks", ["1", "", " \t "], "BYTEINT"),
    ("decimal", ["1", "2.5"], "DECIMAL(15,2)"),
    ("science", ["1e300", "2.5"], "FLOAT"),
    ("flag", ["true", "FALSE"], "BYTEINT"),
    ("iso", ["2024-01-31", "2024-2-1"], "DATE"),
    ("american", ["12/31/2024", "1/2/2024"], "DATE"),
    ("european", ["31-12-2024"], "DATE"),
    ("mixed", ["2024-01-31", "01/31/2024"], "VARCHAR(50)"),
    ("no_date", ["2024-13-31"], "VARCHAR(50)"),
    ("text", ["x" * 100], "VARCHAR(150)"),
    ("long", ["x" * 60000], "VARCHAR(64000)"),
    ("nothing", ["", ""], "VARCHAR(255)"),
    ("suffix", ["1d", "2f"], "VARCHAR(50)"),
]


def test_inferred_types(spark):
    longest = max(len(v) for _, v, _ in INFER_CASES)
    table = [
        tuple(v[i] if i < len(v) else None for _, v, _ in INFER_CASES) for i in range(longest)
    ]
    df = spark.createDataFrame(table, ", ".join(f"{n} string" for n, _, _ in INFER_CASES))
    found = {r.column_name: r for r in d.infer_schema(df).collect()}
    assert {n: found[n].inferred_type for n, _, _ in INFER_CASES} == {n: t for n, _, t in INFER_CASES}
    assert found["blanks"].null_count == 2 and found["blanks"].unique_count == 1
    assert found["nothing"].unique_count == 0 and found["nothing"].samples == []
    assert found["text"].max_length == 100 and found["tiny"].max_length is None
    assert found["flag"].samples == ["true", "FALSE"]


def test_inference_of_a_sample(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",)], "a string").coalesce(1)
    assert d.infer_schema(df, fraction=1.0).collect()[0].inferred_type == "VARCHAR(50)"
    assert d.infer_schema(df).collect()[0].inferred_type == "VARCHAR(50)"


def test_inference_of_no_rows(spark):
    found = d.infer_schema(spark.createDataFrame([], "a string, b string")).collect()
    assert sorted((r.column_name, r.inferred_type, r.null_count) for r in found) == [
        ("a", "VARCHAR(255)", 0),
        ("b", "VARCHAR(255)", 0),
    ]


def test_cast_splits_good_and_bad_rows(spark, rows):
    df = spark.createDataFrame(
        [
            ("1", "2.50", "2024-01-31", "2024-01-31 10:00:00", "true"),
            ("x", "2.5", "31-01-2024", "never", "0"),
            ("", None, "", " ", ""),
        ],
        "i string, n string, d string, t string, b string",
    )
    checked = d.cast_to_schema(
        df, {"i": "int", "n": "decimal(15,2)", "d": "date", "t": "timestamp_ntz", "b": "tinyint"}
    )
    assert rows(d.accepted(checked)) == [
        (None, None, None, None, None),
        (1, Decimal("2.50"), dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 10), 1),
    ]
    bad = d.rejected(checked).collect()
    assert [r._errors for r in bad] == [["i", "t"]]
    assert '"t":"never"' in bad[0]._raw


def test_append_keeps_errors_and_repeats_apart(spark, rows):
    path = new_dir(spark, "append")
    text = spark.createDataFrame(
        [("1", "b"), ("1", "a"), ("2", "c"), ("x", "d"), ("1", "a")], "k string, v string"
    )
    checked = d.cast_to_schema(text, {"k": "int", "v": "string"})
    assert tb.load_append(checked, path, ["k"], ["v"]) == {"good": 2, "et": 1, "uv": 2}
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "c")]
    assert spark.read.parquet(path).columns == ["k", "v"]
    assert rows(spark.read.parquet(f"{path}_uv"), "k", "v") == [(1, "a"), (1, "b")]
    assert rows(spark.read.parquet(f"{path}_et"), "_errors") == [(["k"],)]
    more = d.cast_to_schema(
        spark.createDataFrame([("3", "e")], "k string, v string"), {"k": "int", "v": "string"}
    )
    assert tb.load_append(more, path) == {"good": 1, "et": 0, "uv": 0}
    assert spark.read.parquet(path).count() == 3


def test_append_refuses_keys_that_the_table_holds(spark, rows):
    path = new_dir(spark, "second")
    schema = {"k": "int", "v": "string"}
    load = lambda *r: tb.load_append(
        d.cast_to_schema(spark.createDataFrame(list(r), "k string, v string"), schema), path, ["k"], ["v"]
    )
    assert load(("1", "a"), ("2", "b"), ("", "n")) == {"good": 3, "et": 0, "uv": 0}
    assert load(("1", "c"), ("3", "d"), ("3", "e"), ("", "m")) == {"good": 1, "et": 0, "uv": 3}
    assert rows(spark.read.parquet(path)) == [(None, "n"), (1, "a"), (2, "b"), (3, "d")]
    assert rows(spark.read.parquet(f"{path}_uv"), "v") == [("c",), ("e",), ("m",)]


def test_append_over_the_error_limit_is_refused(spark):
    path = new_dir(spark, "refused")
    text = spark.createDataFrame([("1",), ("x",), ("y",)], "k string")
    checked = d.cast_to_schema(text, {"k": "int"})
    with pytest.raises(tb.TooManyRejects):
        tb.load_append(checked, path, error_limit=1)
    assert not storage.exists(spark, path)
    assert tb.load_append(checked, path, error_limit=2)["good"] == 1


def test_replace_keeps_one_backup(spark, rows):
    path = new_dir(spark, "replace")
    for n in (1, 2, 3):
        tb.load_replace(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(f"{path}_bkp").count() == 2


def test_replace_may_read_the_table_it_replaces(spark, rows):
    path = new_dir(spark, "self")
    spark.range(3).write.parquet(path)
    tb.load_replace(spark.read.parquet(path).filter("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_transfer_compares_names_and_types(spark):
    path = new_dir(spark, "transfer")
    two = spark.createDataFrame([(1, "a")], "a int, b string")
    assert tb.transfer(two, path) == "created"
    assert tb.transfer(two, path) == "appended"
    other = spark.createDataFrame([("a", 1)], "b string, a int")
    assert tb.transfer(other, path) == "recreated"
    assert spark.read.parquet(f"{path}_bkp").count() == 2


def test_create_like_has_no_rows(spark):
    made = tb.create_like(spark.range(5), new_dir(spark, "like"))
    assert made.count() == 0 and made.columns == ["id"]


def test_seed_round_trip(spark, write, rows):
    path = write("country_code,country_name\nUS,United States\nFR,France\nDE,Germany\n")
    seed = d.load_seed(spark, path, new_dir(spark, "seed"))
    assert rows(seed) == [("DE", "Germany"), ("FR", "France"), ("US", "United States")]


def test_export_quotes_and_reads_back(spark, rows):
    path = new_dir(spark, "export")
    df = spark.createDataFrame([("a|b", 'say "x"'), (None, "")], "p string, q string")
    d.export_delimited(df, path, sep="|")
    back = d.read_delimited(spark, path, sep="|", header=True)
    assert back.filter("p = 'a|b'").collect()[0].q == 'say "x"'
    assert back.count() == 2


def test_table_size(spark):
    path = new_dir(spark, "size")
    spark.range(1000).repartition(3).write.parquet(path)
    size = tb.table_size(spark, path).collect()[0]
    assert size.row_count == 1000 and size.bytes > 0
    assert size.size_mb == round(size.bytes / 1024**2, 2)


def test_bucketed_tables_join_without_shuffle(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS depot LOCATION '{new_dir(spark, 'depot')}'")
    for name in ("depot.a", "depot.b"):
        tb.write_distributed(spark.range(100).withColumnRenamed("id", "k"), name, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("depot.a").join(spark.table("depot.b"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE depot CASCADE")


def test_sql_with_parameters(spark, rows):
    df = tb.run_sql(spark, "SELECT id FROM {t} WHERE id > ? AND id < ?", [1, 4], t=spark.range(9))
    assert rows(df) == [(2,), (3,)]


RAW = [
    ("s", '{"name": "Test User", "age": 30, "balance": 1000.50, "score": 95.5}'),
    ("d", '{"created_at": "2025-01-01T12:00:00", "is_active": true}'),
    ("a", '{"tags": ["tag1", "tag2"], "scores": [90, 85]}'),
    ("n", '{"user": {"name": "John", "address": {"city": "NYC", "zip": "10001"}}}'),
    ("z", '{"name": null, "age": null}'),
    ("b", "{broken"),
]


def test_raw_json_becomes_typed_columns(spark):
    df = spark.createDataFrame(RAW, "id string, _data string")
    schema = (
        "name string, age int, balance double, score double, created_at timestamp_ntz, is_active boolean, "
        "tags array<string>, scores array<int>, user struct<name: string, address: struct<city: string, zip: string>>"
    )
    got = {r.id: r for r in s.unpack_raw(df, schema).collect()}
    assert (got["s"].name, got["s"].age, got["s"].balance) == ("Test User", 30, 1000.5)
    assert got["d"].created_at == dt.datetime(2025, 1, 1, 12) and got["d"].is_active is True
    assert got["a"].tags == ["tag1", "tag2"] and got["a"].scores == [90, 85]
    assert got["n"].user.address.city == "NYC"
    assert got["z"].name is None and got["z"].age is None and got["z"]._bad is None
    assert got["b"]._bad == "{broken" and got["b"].name is None


def test_open_json_by_paths(spark):
    df = spark.createDataFrame(RAW, "id string, _data string")
    got = s.unpack_open(df, {"city": ("$.user.address.city", "string"), "age": ("$.age", "int")})
    assert {r.id: (r.city, r.age) for r in got.collect()} == {
        "s": (None, 30),
        "d": (None, None),
        "a": (None, None),
        "n": ("NYC", None),
        "z": (None, None),
        "b": (None, None),
    }


def test_json_safe_rows(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2025-01-01 12:00:00' AS t, timestamp_ntz'2025-01-01 12:00:00.5' AS u, "
        "date'2025-01-02' AS d, 1.50BD AS m, cast('abc' AS binary) AS b, double('nan') AS n, null AS z, "
        "named_struct('x', array(2.5BD)) AS s"
    )
    assert s.to_json_rows(df).collect()[0].json == (
        '{"t":"2025-01-01T12:00:00","u":"2025-01-01T12:00:00.500000","d":"2025-01-02","m":1.5,"b":"abc",'
        '"n":null,"z":null,"s":{"x":[2.5]}}'
    )


def test_bytes_keep_what_can_be_read(spark):
    df = spark.createDataFrame([(bytearray(b"A\xffB"),), (bytearray("é�".encode()),), (None,)], "b binary")
    assert [r.b for r in s.json_safe(df).collect()] == ["AB", "é�", None]


def test_parts_grow_with_the_text(spark, monkeypatch):
    """Four parts of little text, then as many as its bytes ask for; none holds much more than its share."""
    import os

    from sluiceway.workload import loads

    rows = [(i, "é\n" * (i % 300) + "x", "xx", None, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    size = sum(len(str(i)) * 2 + 3 * (i % 300) + 1 + 2 + 5 for i in range(2000))
    monkeypatch.setattr(d, "PART_BYTES", size // 20)
    assert d.parts_for(df) == -(-size // (size // 20)) and d.parts_for(df, 100) == 100
    assert d.parts_for(df.limit(0), 4) == 4
    written = []
    new_dir = loads.new_dir
    monkeypatch.setattr(loads, "new_dir", lambda *a: written.append(new_dir(*a)) or written[-1])

    class Given:
        documents = df

    Given.spark = spark
    got = loads.documents_through_text(Given)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    sizes = [os.path.getsize(f"{written[0]}/{f}") for f in os.listdir(written[0]) if f.endswith(".csv")]
    assert len(sizes) >= 20 and max(sizes) < size // 10
