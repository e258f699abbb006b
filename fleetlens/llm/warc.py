"""WARC archives: a writer with revisit records and a splittable reader.

The reader gives each task a byte range of a file. The task looks for the
gzip magic number, takes a candidate only if its members decode to WARC
records one after the other up to the end of the range, and owns the records
that start inside its range. So one large archive is read by many tasks, no
index is needed, and every record is read once.

Files are written and read by the tasks through ``pyarrow.fs``, in the shared
folder. A file counts only if the manifest of the finished job names it, so a
task that is run twice leaves no second copy of its records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .shared import shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 16
#: Bytes of an archive that one task scans, and of a file before the next.
RANGE_BYTES = 4 << 20
FILE_BYTES = 64 << 20
#: Equal payloads of at least so many bytes are written once.
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(uri: str):
    """(filesystem, path) of a URI as Spark writes it (``file:/x`` too)."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


# ------------------------------------------------------------------- writing


def record(kind: str, record_id: str, uri: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One gzip member with one record. A revisit has the HTTP headers of the
    full payload, its digest, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    head.append("WARC-Payload-Digest: sha1:" + hashlib.sha1(payload).hexdigest())
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def _write(folder):
    def run(batches):
        ctx = TaskContext.get()
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        done, out, size, number, count = [], None, 0, 0, 0
        for batch in batches:
            for page, uri, payload, target in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{number:04d}.warc.gz"
                    out, size, count, number = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0, number + 1
                member = record("response" if target is None else "revisit", f"urn:page:{page}", uri, payload or b"", f"urn:page:{target}")
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, count))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])

    return run


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One record per row, payload the html in UTF-8 (null: empty) -> the
    manifest (path, bytes, records) of the archives written.

    Of rows with equal payloads of at least ``LEAST_REVISIT`` bytes, that with
    the largest id is the response and the others are revisits of it; rows
    that share that id are all responses. A null id is written as ``None`` and
    read back as null; it is a revisit where a row with an id has the payload.
    Very long payloads are one record each, written and read whole by one
    task. An empty table writes no file. Other columns are ignored.
    """
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    key: Column = F.when(F.octet_length("payload") >= LEAST_REVISIT, F.sha2("payload", 256))
    many = stored(rows.select("page_id", key.alias("same")).where("same is not null").groupBy("same").agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    named = rows.withColumn("same", F.coalesce(key, F.lit(""))).withColumn("doc_id", F.xxhash64("same"))
    # Only payloads that may be among the repeated ones are joined and moved.
    maybe, single = bloom.split(named, many.select(F.xxhash64("same").alias("doc_id")))
    revisit = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("target")), F.col("target"))
    named = maybe.join(many, "same", "left").select("page_id", "url", "payload", revisit.alias("target"))
    named = named.unionByName(single.select("page_id", "url", "payload", F.lit(None).cast("long").alias("target")))
    return stored(named.mapInArrow(_write(shared_folder(pages.sparkSession, "warc")), "path string, bytes long, records long"), "manifest")


# ------------------------------------------------------------------- reading


def _inflate(file, at: int, keep: bool) -> tuple[bytes, int] | None:
    """(the member at this offset, or its first bytes; the offset behind it);
    None if it is no whole gzip member that holds a WARC record."""
    unpack, parts, size = zlib.decompressobj(31), [], 0
    file.seek(at)
    while not unpack.eof:
        raw = file.read(BLOCK)
        if not raw:
            return None
        at += len(raw)
        try:
            data = unpack.decompress(raw)
        except zlib.error:
            return None
        if size < 5 and data and not (b"".join(parts) + data)[:5] == b"WARC/"[: size + len(data)]:
            return None
        size += len(data)
        if keep or size - len(data) < 5:
            parts.append(data)
    data = b"".join(parts)
    return (data, at - len(unpack.unused_data)) if data[:5] == b"WARC/" else None


def _runs_on(file, at: int, end: int, size: int) -> bool:
    """Whether records follow one another from here past ``end``."""
    while at < end and at < size:
        found = _inflate(file, at, keep=False)
        if found is None:
            return False
        at = found[1]
    return at >= size or _inflate(file, at, keep=False) is not None


def first_record(file, start: int, end: int, size: int) -> int | None:
    """Offset of the first record that starts in [start, end)."""
    at, tail = start, b""
    while at < end:
        file.seek(at)
        raw = tail + file.read(min(BLOCK, end - at + len(MAGIC) - 1))
        base = at - len(tail)
        i = raw.find(MAGIC)
        while i >= 0:
            if base + i < end and _runs_on(file, base + i, end, size):
                return base + i
            i = raw.find(MAGIC, i + 1)
        at = base + len(raw)
        if at >= min(end + len(MAGIC) - 1, size):
            break
        tail = raw[-(len(MAGIC) - 1) :]
    return None


def parse(data: bytes) -> dict:
    """Headers and payload of a decoded record; header names in lower case."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = rest[: int(fields.get("content-length", len(rest)))]
    http = {}
    if fields.get("content-type", "").startswith("application/http"):
        top, _, block = block.partition(b"\r\n\r\n")
        http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in top.decode("utf-8", "replace").split("\r\n")[1:])}
    return {"fields": fields, "http": http, "payload": block}


def read_range(path: str, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, parsed record) of the records that start in [start, end)."""
    fs, name = open_fs(path)
    with fs.open_input_file(name) as file:
        size = file.size()
        at = first_record(file, start, end, size)
        while at is not None and at < end and at < size:
            data, behind = _inflate(file, at, keep=True)
            yield at, parse(data)
            at = behind


READ_SCHEMA = "path string, at long, type string, record_id string, target_uri string, refers_to string, digest string, full_length long, payload binary"


def _read(batches):
    def row(path, at, rec):
        f = rec["fields"]
        inner = lambda k: f[k].strip("<>") if k in f else None
        length = rec["http"].get("content-length")
        return (path, at, f.get("warc-type"), inner("warc-record-id"), f.get("warc-target-uri"), inner("warc-refers-to"), f.get("warc-payload-digest"), int(length) if length else None, rec["payload"])

    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
    for batch in batches:
        for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            rows, held = [], 0
            for at, rec in read_range(path, start, end):
                rows.append(row(path, at, rec))
                held += len(rec["payload"])
                if held > 8 << 20 or len(rows) >= 1000:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, bytes) of archives -> their records (``READ_SCHEMA``), in no
    order. ``full_length`` is the Content-Length of the HTTP headers, which a
    revisit has too; ``payload`` is what the record itself holds."""
    step = F.lit(range_bytes).cast("long")
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + step, F.col("bytes")).alias("end"))
    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return ranges.repartition(tasks, "path", "start").mapInArrow(_read, READ_SCHEMA)


def page_records(pages: DataFrame, **columns: str) -> DataFrame:
    """pages -> written to archives and read back: (page_id, payload_bytes,
    payload_digest, record_type, refers_to). A response's bytes and digest are
    those of the payload that was read, a revisit's those in its headers."""
    own = F.col("type") == "response"
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^urn:page:(-?[0-9]+)$', 1) as long)")
    return read_warc(write_warc(pages, **columns)).select(
        number("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("full_length")).alias("payload_bytes"),
        F.when(own, F.sha1("payload")).otherwise(F.regexp_extract("digest", "^sha1:(.*)$", 1)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )
