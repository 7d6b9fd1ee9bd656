"""WARC archives with revisit records, and a two-level capture index to read them by URL.

Writing: a payload of at least ``MIN_REVISIT`` bytes that several pages share is stored once, in
the response of its smallest page id; the others become revisits of it. Every record is a gzip
member of its own. Each task writes one archive under a name that no other attempt uses and
reports it; only reported archives are read.

Indexing: archives are scanned for (reversed-host URL key, place) entries. These are sorted by
range partitioning on (key, archive, offset), whose unique tail lets a hot URL spread, and packed
into compressed blocks of lines. The first level is the sparse directory: one row a block with
its first and last key. Blocks get longer when a table is so large that the directory would
exceed ``DIRECTORY_ROWS``, so its broadcast has a fixed bound.

Reading: a key is binary-searched in the directory, each block that may hold it is read by range
and searched, and the captures found are read by range from their archives, in archive order.

Defined cases: a very long page is one record; a null id gives a record without a page id; null
html is an empty payload; a null URL has the empty key; rows that repeat page
id and payload are the same capture and are all responses; a null page id is written as ``null``
and never the target of a revisit; an empty table gives an empty result. Other columns of the
input are not read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from hashlib import sha256
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultlens.llm.bpe import text_batches
from vaultlens.llm.common import materialize, read_table
from vaultlens.llm.files import open_fs
from vaultlens.session import scratch_dir

MIN_REVISIT = 100
BLOCK_LINES = 1000
DIRECTORY_ROWS = 1 << 17
BROADCAST_GROUPS = 200_000     # groups of equal payloads joined by broadcast; more are joined by shuffle
READ_BYTES = 1 << 20
TASK_BYTES = 64 << 20          # archive bytes a reading task fetches
DATE = "2000-01-01T00:00:00Z"  # of captures that carry none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.Example.com:80/a?b`` is ``com,example)/a?b``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url if "//" in url else "//" + url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return ")" + _clean(url)
    host = ",".join(reversed(re.sub(r"^www\d*\.", "", host).split(".")))
    tail = f":{port}" if port and port not in (80, 443) else ""
    return _clean(f"{host}{tail}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else ""))


def _clean(text: str) -> str:
    """Without the control characters and spaces that would break a header or an index line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


UNNAMED = "<urn:unnamed-page>"   # the record of a page without an id; no other record refers to it


def _urn(page: str | None) -> str:
    return UNNAMED if page is None else f"<urn:page:{quote(page, safe='')}>"


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One uncompressed record: a response with its payload, or a revisit with the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    body = head if refers_to is not None else head + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _page(value: str | None) -> str | None:
    return None if value in (None, UNNAMED) else unquote(value.removeprefix("<urn:page:").removesuffix(">"))


def parse(data: bytes) -> dict:
    """Fields of one record; a response whose payload does not have its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "type": fields["WARC-Type"],
            "digest": digest, "bytes": size, "refers_to": _page(fields.get("WARC-Refers-To"))}


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(uri: str):
    """(offset, length, content) of each gzip member of a file, read as a stream."""
    system, path = open_fs(uri)
    with system.open_input_stream(path, compression=None) as f:
        buffer, start, z, out, used = b"", 0, zlib.decompressobj(31), [], 0
        while True:
            if not buffer:
                buffer = f.read(READ_BYTES)
                if not buffer:
                    break
            out.append(z.decompress(buffer))
            used += len(buffer) - len(z.unused_data)
            buffer = z.unused_data
            if z.eof:
                yield start, used, b"".join(out)
                start, z, out, used = start + used, zlib.decompressobj(31), [], 0
        if used:
            raise OSError(f"{uri}: the last member is cut off")


class _Writer:
    """A file of gzip members under a name of its own; created with its first member."""

    def __init__(self, folder: str, suffix: str):
        self.system, base = open_fs(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"
        self.uri, self.path, self.base, self.out, self.size = f"{folder}/{name}", f"{base}/{name}", base, None, 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.out is None:
            self.system.create_dir(self.base, recursive=True)
            self.out = self.system.open_output_stream(self.path, compression=None)
        data = _member(data)
        self.out.write(data)
        self.size += len(data)
        return self.size - len(data), len(data)

    def close(self):
        if self.out is not None:
            self.out.close()


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes the archives of ``pages`` under the shared scratch folder. Returns ``file, n_bytes``."""
    folder = scratch_dir(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(f"`{id_col}`").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    groups = materialize(src.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
                         .agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
                         .select(F.col("digest").alias("gdigest"), "first"), "warc-groups")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    marked = src.join(groups, F.col("digest") == F.col("gdigest"), "left").select(
        F.col("page").cast("string").alias("page"), "url", "payload", "digest",
        F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"))

    def run(batches):
        out = _Writer(folder, ".warc.gz")
        try:
            for b in text_batches(batches, 2):
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    out.add(record(*row))
        finally:
            out.close()
        if out.size:
            yield pa.RecordBatch.from_arrays([pa.array([out.uri]), pa.array([out.size], type=pa.int64())], names=["file", "n_bytes"])

    return materialize(marked.mapInArrow(run, "file string, n_bytes long"), "warc-archives")


def build_index(archives: DataFrame, block_lines: int = BLOCK_LINES, directory_rows: int = DIRECTORY_ROWS) -> DataFrame:
    """Scans the archives and writes the index blocks. Returns the directory: ``first_key, last_key,
    file, offset, length, lines``, one row a block."""
    spark = archives.sparkSession
    folder = scratch_dir(spark, "warc-index")

    def scan(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows = []
                for offset, length, data in members(file):
                    r = parse(data)
                    rows.append((url_key(r["url"]), file, offset, length, r["digest"], r["type"]))
                    if len(rows) == 5000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)],
                                          names=["key", "file", "offset", "length", "digest", "type"])

    n_files = archives.count()
    entries = materialize(archives.select("file").repartition(max(1, n_files), "file")
                          .mapInArrow(scan, "key string, file string, offset long, length long, digest string, type string"), "warc-entries")
    lines = max(block_lines, -(-entries.count() // directory_rows))

    def pack(batches):
        out, rows = _Writer(folder, ".cdx.gz"), []

        def flush():
            text = "".join(f"{k} {DATE} " + json.dumps({"file": f, "offset": o, "length": n, "digest": d, "type": t}) + "\n"
                           for k, f, o, n, d, t in rows)
            offset, length = out.add(text.encode())
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[0][0]]), pa.array([rows[-1][0]]), pa.array([out.uri]), pa.array([offset], type=pa.int64()),
                 pa.array([length], type=pa.int64()), pa.array([len(rows)], type=pa.int64())],
                names=["first_key", "last_key", "file", "offset", "length", "lines"])
        try:
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    rows.append(row)
                    if len(rows) == lines:
                        yield flush()
                        rows = []
            if rows:
                yield flush()
        finally:
            out.close()

    ordered = entries.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return materialize(ordered.mapInArrow(pack, "first_key string, last_key string, file string, offset long, length long, lines long"),
                       "warc-directory")


class _RangeReader:
    """Reads ranges of files; neighbours of one file share a read of ``READ_BYTES``."""

    def __init__(self):
        self.uri, self.file, self.at, self.data = None, None, 0, b""

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self.uri:
            if self.file is not None:
                self.file.close()
            system, path = open_fs(uri)
            self.uri, self.file, self.at, self.data = uri, system.open_input_file(path), 0, b""
        if not (self.at <= offset and offset + length <= self.at + len(self.data)):
            self.at, self.data = offset, self.file.read_at(max(length, READ_BYTES), offset)
        part = self.data[offset - self.at:offset - self.at + length]
        if len(part) != length:
            raise OSError(f"{uri}: {len(part)} of {length} bytes at {offset}")
        return part


def find_captures(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """``file, offset, length`` of every capture whose key is in ``keys`` (column ``key``)."""
    spark = keys.sparkSession
    rows = sorted(directory.collect(), key=lambda r: (r.first_key, r.last_key, r.file, r.offset))   # DIRECTORY_ROWS and a block a task
    shared = spark.sparkContext.broadcast(([r.first_key for r in rows], [r.last_key for r in rows],
                                           [(r.file, r.offset, r.length) for r in rows]))

    def search(batches):
        first, last, place = shared.value
        for b in batches:
            found = [(k, *place[i]) for k in b.column(0).to_pylist() if k is not None
                     for i in range(bisect_left(last, k), bisect_right(first, k))]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(
                list(zip(*found)) or [[]] * 4, [pa.string(), pa.string(), pa.int64(), pa.int64()])], names=["key", "file", "offset", "length"])

    def read(batches):
        reader, block, wanted = _RangeReader(), None, []

        def captures():
            got = set(wanted)
            for line in zlib.decompress(reader.read(*block), 31).decode().removesuffix("\n").split("\n"):   # splitlines() cuts at more
                key, _, place = line.split(" ", 2)
                if key in got:
                    place = json.loads(place)
                    yield place["file"], place["offset"], place["length"]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(
                list(zip(*rows)) or [[]] * 3, [pa.string(), pa.int64(), pa.int64()])], names=["file", "offset", "length"])
        for b in batches:
            for key, *place in zip(*(c.to_pylist() for c in b.columns)):
                if place != block:
                    if wanted:
                        yield out(list(captures()))
                    block, wanted = place, []
                wanted.append(key)
        if wanted:
            yield out(list(captures()))

    blocks = keys.select("key").distinct().mapInArrow(search, "key string, file string, offset long, length long")
    return blocks.repartition("file", "offset").sortWithinPartitions("file", "offset", "key") \
        .mapInArrow(read, "file string, offset long, length long")


def read_captures(captures: DataFrame, id_type: str = "long") -> DataFrame:
    """Range-reads captures (file, offset, length): ``page_id, url, record_type, payload_bytes,
    payload_digest, refers_to`` of each, page ids as ``id_type``."""
    spark = captures.sparkSession
    captures = materialize(captures, "warc-captures")
    total = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def run(batches):
        reader = _RangeReader()
        for b in batches:
            rows = []
            for place in zip(*(c.to_pylist() for c in b.columns)):
                r = parse(zlib.decompress(reader.read(*place), 31))
                rows.append((r["page"], r["url"], r["type"], r["bytes"], r["digest"], r["refers_to"]))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)],
                                             names=["page", "url", "record_type", "payload_bytes", "payload_digest", "refers"])

    near = captures.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    d = near.mapInArrow(run, "page string, url string, record_type string, payload_bytes long, payload_digest string, refers string")
    return d.select(F.col("page").cast(id_type).alias("page_id"), "url", "record_type",
                    "payload_bytes", "payload_digest", F.col("refers").cast(id_type).alias("refers_to"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """Writes, indexes and reads back every page, found by its URL."""
    directory = build_index(write_archives(pages, id_col, url_col, html_col), **options)

    def keyed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u and _clean(u)) for u in b.column(0).to_pylist()], type=pa.string())], names=["key"])

    keys = pages.select(F.col(f"`{url_col}`").cast("string").alias("url")).mapInArrow(keyed, "key string")
    return read_captures(find_captures(keys, directory), pages.schema[id_col].dataType.simpleString())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
