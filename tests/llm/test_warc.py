import gzip
import hashlib
import io
import zlib

import pytest

from sluiceway.llm import warc

PAGES = "page_id long, url string, html string, path string, digest string, offsets int"


def brute(rows):
    largest = {}
    for page_id, _, html, *_ in rows:
        raw = (html or "").encode()
        if len(raw) >= warc.REVISIT_BYTES and page_id is not None:
            largest[raw] = max(largest.get(raw, page_id), page_id)
    made = []
    for page_id, _, html, *_ in rows:
        raw = (html or "").encode()
        to = largest.get(raw)
        to = None if to == page_id else to
        kind = "response" if to is None else "revisit"
        made.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), kind, to))
    return sorted(made, key=str)


def test_round_trip(spark):
    long = "<html>é" + "x" * 2000 + "\r\n\r\nWARC/1.1\r\n</html>"
    rows = [
        (1, "http://a.example/é?q=1 2%20\r\nX: y", long),
        (2, None, long),
        (7, "http://b.example/", long),
        (7, "http://b.example/", long),
        (3, "http://c.example/", "short"),
        (4, "http://d.example/", "short"),
        (5, "", None),
        (6, "http://e.example/", ""),
        (None, "http://f.example/", long),
        (None, None, "z" * 1500),
        (None, "http://g.example/", "z" * 1500),
    ]
    rows = [(*r, "p", "d", 1) for r in rows]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    got = warc.archive_and_read(pages).collect()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=str) == brute(rows)
    assert sorted((r.url for r in got), key=str) == sorted((r[1] for r in rows), key=str)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest


def test_empty(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0


def records(n=20):
    return [warc.to_bytes(i, f"http://x/{i}", bytes([i]) * (i * 999), hashlib.sha1(b"").digest(), None) for i in range(n)]


@pytest.mark.parametrize("members", [1, 3])
def test_normalised_members_and_index(members, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 777)
    made = records()
    whole = b"".join(made)
    cuts = [len(whole) * k // members for k in range(members + 1)]
    source = io.BytesIO(b"".join(gzip.compress(whole[a:b]) for a, b in zip(cuts, cuts[1:])))
    out, index = io.BytesIO(), io.BytesIO()
    assert warc.normalise_stream(source, out, index)[0] == len(made)
    raw = out.getvalue()
    places = [tuple(map(int, line.split(b"\t"))) for line in index.getvalue().splitlines()]
    assert [zlib.decompress(raw[o : o + n], 31) for o, n in places] == made
    assert sum(n for _, n in places) == len(raw)
    assert gzip.decompress(raw) == whole


def test_a_cut_stream_is_refused():
    whole = b"".join(records(3))
    with pytest.raises(ValueError):
        list(warc.cut_records([whole[:-10]]))


def test_archives_roll(spark):
    from sluiceway.runtime import new_dir

    rows = [(i, "http://x/", "y" * 500, None, None, None) for i in range(40)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    folder, clean = new_dir(spark, "raw"), new_dir(spark, "clean")
    archives = warc.write_archives(warc.with_references(pages, "page_id", "url", "html"), folder, 5000)
    assert archives.count() > 3 and archives.agg({"records": "sum"}).first()[0] == 40
    normal = warc.normalise_archives(spark, archives, clean)
    warc.remove_files(archives, folder)
    assert warc.read_archives(normal, clean).count() == 40
