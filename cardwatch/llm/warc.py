"""WARC archives with revisit records and a two-level capture index.

Archives are files of gzip members, one WARC record each, written by Spark's own text writer:
its separator is a zero byte, and a gzip member ends in one (the top byte of its length, or that
of an empty member appended to a record of 16 MB and more).  So any store that Spark writes to
holds them, task attempts are committed or dropped as a whole, and any gzip reader can read them.

The index has one line per capture, sorted by the URL's key (host labels reversed, then path), in
compressed blocks of ``BLOCK_LINES``; the directory has the first and last key of each block.  A
lookup finds its blocks in the directory, bisects the lines of a block, and reads byte ranges.
Reading everything goes the same way: blocks give the ranges of every archive file.

Of records with equal payloads of at least ``LEAST`` bytes the one with the smallest page_id is
the response and the others revisit it.  Null html is an empty payload.  A null page_id comes
last; if all ids of a payload are null, or an id is repeated, every record with the least id is a
response.  A null url has the empty key.  An empty table gives archives without records.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

LEAST = 100
BLOCK_LINES = 512
RECORDS_PER_FILE = 5_000
DATE = "1970-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_EMPTY = gzip.compress(b"", 1, mtime=0)

RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def url_key(url: str | None) -> str:
    """``http://blog.example.com:81/a?b`` becomes ``com,example,blog:81)/a?b``."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return (url or "").lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail if host else (url or "")


def quoted(url: str) -> str:
    """The URL as records have it: spaces and other letters than ASCII in percent form."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def _member(page_id, url, digest: str, size: int, payload: bytes | None, refers_to=None) -> bytes:
    """One record as gzip bytes without the zero byte that ends it."""
    block = b"" if payload is None else _HTTP + payload
    head = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": quoted(url) if url is not None else None,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(size),
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        "WARC-Profile": None if payload is not None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None) + "\r\n"
    data = gzip.compress(lines.encode() + block + b"\r\n\r\n", 5, mtime=0)
    return (data if data[-1] == 0 else data + _EMPTY)[:-1]


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            ids, urls, htmls = (part.column(c).to_pylist() for c in ("page_id", "url", "html"))
            rows = []
            for i, u, h in zip(ids, urls, htmls):
                payload = (h or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                rows.append((i, u, digest, len(payload), _member(i, u, digest, len(payload), payload)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))],
                ["page_id", "url", "digest", "size", "member"])


def _revisits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "size", "refers_to", "member")))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m if r is None else _member(i, u, d, s, None, r) for i, u, d, s, r, m in rows], pa.binary())], ["member"])


def write_archives(pages: DataFrame, root: str) -> None:
    """Write one record for every row of ``pages`` (page_id, url, html) below ``root``/archives.

    Records are compressed before the one shuffle that brings equal payloads together.
    """
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _responses, "page_id long, url string, digest string, size long, member binary")
    digests = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    again = (
        digests.filter(F.octet_length("payload") >= LEAST)
        .groupBy(F.sha2("payload", 256).alias("digest"))
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    known = records.join(again, "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    known = known.select("page_id", "url", "digest", "size", F.when(other, F.col("first")).alias("refers_to"),
                         F.when(~other, F.col("member")).alias("member"))
    known.mapInArrow(_revisits, "member binary").select(F.col("member").cast("string").alias("value")).write.option(
        "lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(f"{root}/archives")


def _inflate(data: memoryview, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at`` and where it ends."""
    machine, parts = zlib.decompressobj(31), []
    while not machine.eof:
        piece = data[at : at + 65536]
        if not len(piece):
            raise ValueError("archive ends inside a record")
        parts.append(machine.decompress(piece))
        at += len(piece) - len(machine.unused_data)
    return b"".join(parts), at


def _headers(record: bytes) -> tuple[dict[str, str], int]:
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), end + 4


def _number(urn: str | None):
    text = (urn or "")[len("<urn:page:") : -1]
    return int(text) if text else None


def parse(record: bytes) -> tuple:
    """The columns of ``RECORD`` of one inflated record; the digest of a stored payload is checked."""
    head, start = _headers(record)
    payload = record[start : start + int(head["Content-Length"])][len(_HTTP):]
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = head["WARC-Type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(head["WARC-Payload-Length"])):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    return (_number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), kind, _number(head.get("WARC-Refers-To")),
            int(head["WARC-Payload-Length"]), digest, payload if kind == "response" else None)


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            data, at, rows = memoryview(content.as_buffer()), 0, []
            while at < len(data):
                record, end = _inflate(data, at)
                head, _ = _headers(record) if record else ({}, 0)
                if record:
                    rows.append((url_key(head.get("WARC-Target-URI")), path, at, end - at, head["WARC-Payload-Digest"][7:]))
                at = end
            for s in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[s : s + 4096]), kinds)], ["key", "path", "at", "length", "digest"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def block(lines: list[tuple]) -> tuple:
        text = "\n".join("\t".join(map(str, line)) for line in lines)
        return lines[0][0], lines[-1][0], len(lines), zlib.compress(text.encode(), 6)

    held: list[tuple] = []
    names, kinds = ["first_key", "last_key", "lines", "block"], (pa.string(), pa.string(), pa.int32(), pa.binary())
    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns))
        full = len(held) - len(held) % BLOCK_LINES
        if full:
            rows = [block(held[s : s + BLOCK_LINES]) for s in range(0, full, BLOCK_LINES)]
            held = held[full:]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(block(held), kinds)], names)


def _archives(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{root}/archives")


def write_index(spark: SparkSession, root: str) -> None:
    """Scan the archives and write ``root``/index (blocks) and ``root``/directory (their key ranges)."""
    captures = _archives(spark, root).select("path", "content").mapInArrow(
        _captures, "key string, path string, at long, length long, digest string")
    order = ["key", "path", "at"]
    blocks = captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _blocks, "first_key string, last_key string, lines int, block binary")
    blocks.withColumn("number", F.monotonically_increasing_id()).write.parquet(f"{root}/index")
    spark.read.parquet(f"{root}/index").select("first_key", "last_key", "number").orderBy("first_key", "number").write.parquet(
        f"{root}/directory")


def _lines(block: bytes) -> list[list[str]]:
    return [line.rsplit("\t", 4) for line in zlib.decompress(block).decode().split("\n")]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column("block"):
            lines = _lines(value.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[1] for x in lines]), pa.array([int(x[2]) for x in lines], pa.int64()),
                 pa.array([int(x[3]) for x in lines], pa.int64())], ["path", "at", "length"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    for batch in batches:
        for content, ranges in zip(batch.column("content"), batch.column("ranges").to_pylist()):
            data = memoryview(content.as_buffer())
            for s in range(0, len(ranges), 128):
                rows = [parse(_inflate(data[r["at"] : r["at"] + r["length"]], 0)[0]) for r in ranges[s : s + 128]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """Every record of the archives, by way of the index: byte ranges per file, at most ``RECORDS_PER_FILE``."""
    ranges = (
        spark.read.parquet(f"{root}/index").select("block")
        .mapInArrow(_ranges, "path string, at long, length long")
        .groupBy("path").agg(F.sort_array(F.collect_list(F.struct("at", "length"))).alias("ranges"))
    )
    return _archives(spark, root).select("path", "content").join(ranges, "path").select("content", "ranges").mapInArrow(_records, RECORD)


def _range_of(spark: SparkSession, path: str, at: int, length: int) -> bytes:
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        stream.seek(at)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()


def lookup(spark: SparkSession, root: str, url: str) -> list[tuple]:
    """The captures of one URL, as rows of ``RECORD``: directory, then blocks, then byte ranges."""
    key = url_key(quoted(url))
    where = (F.col("first_key") <= key) & (F.col("last_key") >= key)
    numbers = [r.number for r in spark.read.parquet(f"{root}/directory").filter(where).select("number").toLocalIterator()]
    found = []
    for row in spark.read.parquet(f"{root}/index").filter(where & F.col("number").isin(numbers)).select("block").toLocalIterator():
        lines = _lines(bytes(row.block))
        for line in lines[bisect.bisect_left(lines, key, key=lambda x: x[0]):]:
            if line[0] != key:
                break
            found.append(parse(_inflate(memoryview(_range_of(spark, line[1], int(line[2]), int(line[3]))), 0)[0]))
    return found


def round_trip(pages: DataFrame, root: str) -> DataFrame:
    """Write archives and index below ``root`` and return every record as it is read back."""
    write_archives(pages, root)
    write_index(pages.sparkSession, root)
    return read_records(pages.sparkSession, root)
