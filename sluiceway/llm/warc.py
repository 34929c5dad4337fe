"""WARC archives: writing, normalising to one gzip member per record, reading by index.

Pages are written as WARC records to monolithic archives, each one gzip stream as many crawlers and
mirrors leave them. The normaliser inflates such a stream once, front to back, writes every record
again as its own gzip member, and writes a sidecar index of offsets and lengths beside the archive.
Readers take members by the index, in any order and from any task.

Archives live in a folder that all executors reach through ``pyarrow.fs``. Tasks write under names
of their own and report them; only reported files count, so a task that is run again leaves no
trace but an unread file. Memory holds one record and one buffer.

Defined results: a null payload is empty; a null id, address or both are left out of the record and
read back as null; of equal payloads of at least ``REVISIT_BYTES`` bytes the record with the largest
id is the response (each such row if it repeats, and all rows if no id is known), the others
revisit it; an empty table makes no archive. Addresses are percent-encoded where a header can't
hold them.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.common import by_value, settle
from sluiceway.runtime import new_dir

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 * 1024 * 1024
CHUNK = 1 << 20
END = b"\r\n\r\n"
ID = "urn:x-page:"
# Characters of an address that stand as they are; the others, and the escape itself, are encoded.
PLAIN = "!#$&'()*+,/:;=?@[]~"


@dataclass
class Record:
    """One record: its headers (names in lower case) and its block."""

    headers: dict[str, str]
    block: bytes

    def payload(self) -> bytes:
        """The block without its HTTP header."""
        return self.block.partition(END)[2]

    def http_length(self) -> int:
        """The payload's length as the HTTP header gives it, for revisits too."""
        for line in self.block.partition(END)[0].split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.lower() == b"content-length":
                return int(value)
        raise ValueError("no length in the HTTP header")


def to_bytes(page_id, url, payload: bytes, digest: bytes, refers_to) -> bytes:
    """A response, or a revisit if ``refers_to`` is known, as it stands in an archive."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload)
    ) + END
    headers = [("WARC-Type", "response" if refers_to is None else "revisit")]
    if page_id is not None:
        headers.append(("WARC-Record-ID", f"<{ID}{page_id}>"))
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=PLAIN)))
    headers.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode()))
    if refers_to is not None:
        headers.append(("WARC-Refers-To", f"<{ID}{refers_to}>"))
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    block = http + (payload if refers_to is None else b"")
    headers.append(("Content-Type", "application/http; msgtype=response"))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in headers)
    return head.encode() + END + block + END


def parse_head(head: bytes) -> dict[str, str]:
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record: {first[:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse(whole: bytes) -> Record:
    """One whole record."""
    head, _, rest = whole.partition(END)
    headers = parse_head(head)
    return Record(headers, rest[: int(headers["content-length"])])


def inflated(stream: BinaryIO) -> Iterator[bytes]:
    """The content of a gzip file of one or many members, in pieces of at most CHUNK bytes."""
    inflate = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            yield inflate.decompress(data, CHUNK)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data = inflate.unused_data
                inflate = zlib.decompressobj(31)
    yield inflate.flush()


def cut_records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Whole records, as bytes, from the pieces of a stream."""
    held, need = bytearray(), None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                at = held.find(END)
                if at < 0:
                    break
                need = at + 4 + int(parse_head(bytes(held[:at]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError(f"the stream ends within a record ({len(held)} bytes left)")


def normalise_stream(source: BinaryIO, target: BinaryIO, index: BinaryIO) -> tuple[int, int]:
    """Rewrite ``source``, one member per record; lines of offset, length to ``index``.

    Returns the records and bytes written.
    """
    offset = records = 0
    for record in cut_records(inflated(source)):
        pack = zlib.compressobj(6, wbits=31)
        member = pack.compress(record) + pack.flush()
        target.write(member)
        index.write(b"%d\t%d\n" % (offset, len(member)))
        offset += len(member)
        records += 1
    return records, offset


def with_references(pages: DataFrame, id_: str, url: str, body: str) -> DataFrame:
    """page_id, url, payload, digest, refers_to for every page.

    Only digests meet: groups of equal payloads are folded before the shuffle, and pages meet their
    group in a join whose hot keys Spark may split.
    """
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    own = pages.select(
        F.col(id_).alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    groups = (
        own.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND newest IS NOT NULL")
        .select(F.col("digest").alias("same"), "newest")
    )
    met = own.join(settle(groups, "same-payloads"), F.col("digest") == F.col("same"), "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest"))
    return met.select("page_id", "url", "payload", "digest", first.alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of :func:`with_references` to monolithic archives; a row (path, records) for each.

    Every task writes its own, a new one after ``archive_bytes`` of content.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        out = path = None
        size = count = 0
        done: list[tuple[str, int]] = []

        def close():
            out.write(pack.flush())
            out.close()
            done.append((path, count))

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(path, compression=None)
                    pack = zlib.compressobj(1, wbits=31)
                record = to_bytes(page_id, url, payload, digest, refers_to)
                out.write(pack.compress(record))
                size, count = size + len(record), count + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in done]), pa.array([n for _, n in done], pa.int64())],
                names=["path", "records"],
            )

    _make_folder(folder)
    return settle(records.mapInArrow(write, "path string, records long"), "archives")


def normalise_archives(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite monolithic ``archives`` (path, ...); a row (path, index, records, bytes) for each."""

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = f"{root}/{posixpath.basename(path)}-{uuid.uuid4().hex[:8]}.gz"
                with (
                    files.open_input_stream(path, compression=None) as source,
                    files.open_output_stream(target, compression=None) as out,
                    files.open_output_stream(f"{target}.idx", compression=None) as index,
                ):
                    records, size = normalise_stream(source, out, index)
                yield pa.RecordBatch.from_pylist(
                    [{"path": target, "index": f"{target}.idx", "records": records, "bytes": size}]
                )

    _make_folder(folder)
    n = max(1, archives.count())
    one_each = archives.select("path").repartitionByRange(n, "path")
    schema = "path string, index string, records long, bytes long"
    return settle(one_each.mapInArrow(normalise, schema), "normalised-archives")


def read_archives(archives: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """Every record of normalised ``archives``, taken by its index entry.

    page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to, payload (null for
    revisits). Raises if a payload differs from its digest or length.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_stream(index, compression=None) as lines:
                    rows = [line.split(b"\t") for line in lines.read().splitlines()]
                for start in range(0, len(rows), 1000):
                    part = rows[start : start + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path]),
                            pa.array([[int(r[0]) for r in part]], pa.list_(pa.int64())),
                            pa.array([[int(r[1]) for r in part]], pa.list_(pa.int64())),
                        ],
                        names=["path", "offsets", "lengths"],
                    )

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_file(path) as source:
                    rows, size = [], 0
                    for offset, length in zip(offsets, lengths):
                        source.seek(offset)
                        rows.append(_row(parse(zlib.decompress(source.read(length), 31))))
                        size += len(rows[-1][-1] or b"")
                        if size > 16 * CHUNK:
                            yield _batch(rows, names, types)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows, names, types)

    places = archives.select("path", "index").mapInArrow(
        entries, "path string, offsets array<long>, lengths array<long>"
    )
    schema = (
        "page_id string, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to string, payload binary"
    )
    found = places.mapInArrow(read, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _row(record: Record) -> tuple:
    h, payload = record.headers, None
    digest = base64.b32decode(h["warc-payload-digest"].partition(":")[2])
    size = record.http_length()
    if h["warc-type"] == "response":
        payload = record.payload()
        if len(payload) != size or hashlib.sha1(payload).digest() != digest:
            raise ValueError(f"the payload of {h.get('warc-record-id')} is damaged")
    url = h.get("warc-target-uri")
    return (
        _id(h.get("warc-record-id")),
        None if url is None else unquote(url),
        size,
        digest.hex(),
        h["warc-type"],
        _id(h.get("warc-refers-to")),
        payload,
    )


def _id(value: str | None) -> str | None:
    return None if value is None else value.strip("<>").removeprefix(ID)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _make_folder(folder: str) -> None:
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)


def remove_files(archives: DataFrame, folder: str) -> None:
    """Delete the files of ``archives`` (path), once what was made of them is settled."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if files.get_file_info(path).type != fs.FileType.NotFound:
                    files.delete_file(path)
            yield batch

    archives.select("path").mapInArrow(remove, "path string").write.format("noop").mode("overwrite").save()


def archive_and_read(
    pages: DataFrame, id_: str = "page_id", url: str = "url", body: str = "html"
) -> DataFrame:
    """Write all ``pages``, normalise the archives, read every record back."""
    spark = pages.sparkSession
    raw, clean = new_dir(spark, "warc-monolithic"), new_dir(spark, "warc")
    archives = write_archives(with_references(pages, id_, url, body), raw)
    normalised = normalise_archives(spark, archives, clean)
    remove_files(archives, raw)
    return read_archives(normalised, clean, pages.schema[id_].dataType.simpleString())


by_value(__name__)
