"""Line dedup by a range-partitioned, sorted stream of line hashes.

Every long line gives one row (hash of its key, document, position). Rows are
range-partitioned on hash, document and position, largest document first, and
sorted in the tasks; a line that a third of all documents hold simply spreads
over many ranges. A task streams its rows: the first document of a hash keeps
its lines, and as soon as ``least_docs`` documents have been seen the lines of
the others go. Only a range's first hash, and its last one when it has met too
few documents, may go on in a neighbour: their rows are handed on undecided,
and decided by one summary row for each.

What comes out is a compressed keep bitmap per document; texts are read again
only to apply it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bloom
from .shared import apart, stored
from .words import flat_bytes

#: Stripped from both ends of a line: fixed values.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
LEAST_CHARS, LEAST_DOCS = 40, 5
KEY = ["doc_id", "same"]
#: A line's place in the sorted stream: two halves of its hash, then the place.
PLACE = ["k1", "k2", "doc_id", "same", "pos"]
STREAMED = "k1 long, k2 long, doc_id long, same long, pos int, docs int, last long, sure boolean"


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The stripped, A-Z lower-cased line; None if it is too short."""
    key = line.strip(BLANKS).lower()
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return key


def _hashed(least_chars):
    """Per text: its lines, its digest, and the hash and position of each of
    its long lines."""

    def run(batches):
        for batch in batches:
            buf, off = flat_bytes(batch.column("text"))
            cols: dict[str, list] = {c: [] for c in ("n_lines", "whole_sha256", "pos", "k1", "k2")}
            for a, b in zip(off[:-1], off[1:]):
                raw = buf[a:b].tobytes()
                lines = raw.split(b"\n")
                keys = [line_key(x, least_chars) for x in lines]
                at = [i for i, k in enumerate(keys) if k is not None]
                halves = np.frombuffer(b"".join(hashlib.blake2b(keys[i], digest_size=16).digest() for i in at), np.int64)
                for c, x in zip(cols, (len(lines), hashlib.sha256(raw).hexdigest(), at, halves[0::2], halves[1::2])):
                    cols[c].append(x)
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in KEY] + [pa.array(x, k) for x, k in zip(cols.values(), kinds)], names=[*KEY, *cols])

    return run


# ------------------------------------------------------- the sorted stream


class _Stream:
    """Follows the rows of one range, hash by hash."""

    def __init__(self, least_docs: int):
        self.least_docs = least_docs
        self.key: tuple[int, int] | None = None
        self.first = True  # still in the range's first hash
        self.held: list[dict] = []  # rows of fewer than least_docs documents
        self.docs = self.top = self.last = None

    def rows(self, part: dict[str, np.ndarray], sure: bool) -> pa.RecordBatch:
        n = len(part["pos"])
        none = pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(part[c]) for c in PLACE] + [*none, pa.array(np.full(n, sure))], names=[*PLACE, "docs", "last", "sure"])

    def _summary(self) -> pa.RecordBatch:
        """The hash with its documents so far, the largest and the smallest."""
        of = [[self.key[0]], [self.key[1]], [self.top], [None], [None], [self.docs], [self.last], [None]]
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(of, kinds)], names=[*PLACE, "docs", "last", "sure"])

    def part(self, part: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Rows of one hash, the next ones in order."""
        key = int(part["k1"][0]), int(part["k2"][0])
        if key != self.key:
            if self.key is not None:
                if self.first:
                    yield self._summary()
                self.first = False
            self.key, self.held, self.docs, self.top, self.last = key, [], 0, int(part["doc_id"][0]), None
        ids = part["doc_id"]
        new = np.concatenate([[self.last is None or int(ids[0]) != self.last], ids[1:] != ids[:-1]])
        self.docs += int(new.sum())
        self.last = int(ids[-1])
        if self.first:
            # The largest document may lie in the range before.
            yield self.rows(part, False)
            return
        self.held.append({c: x[ids != self.top] for c, x in part.items()})
        if self.docs >= self.least_docs:
            for x in self.held:
                if len(x["pos"]):
                    yield self.rows(x, True)
            self.held = []

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.key is not None:
            for x in self.held:
                if len(x["pos"]):
                    yield self.rows(x, False)
            yield self._summary()


def _whole(rows: dict[str, np.ndarray], edges: np.ndarray, least_docs: int) -> np.ndarray:
    """Which rows go, of hashes that lie between ``edges`` as a whole."""
    ids, runs = rows["doc_id"][edges[0] : edges[-1]], np.diff(edges)
    of = np.repeat(np.arange(len(runs)), runs)
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (of[1:] != of[:-1])])
    docs = np.bincount(of[new], minlength=len(runs))
    return edges[0] + np.flatnonzero((docs[of] >= least_docs) & (ids != ids[edges[:-1] - edges[0]][of]))


def _first_occurrences(least_docs):
    def run(batches):
        stream = _Stream(least_docs)
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in PLACE}
            if not len(rows["pos"]):
                continue
            new = np.flatnonzero((np.diff(rows["k1"]) != 0) | (np.diff(rows["k2"]) != 0)) + 1
            edges = np.concatenate([[0], new, [len(rows["pos"])]])
            # Only the batch's first and last hash may go on in another one.
            yield from stream.part({c: x[: edges[1]] for c, x in rows.items()})
            if len(edges) > 3:
                gone = _whole(rows, edges[1:-1], least_docs)
                if len(gone):
                    yield stream.rows({c: x[gone] for c, x in rows.items()}, True)
            if len(edges) > 2:
                yield from stream.part({c: x[edges[-2] :] for c, x in rows.items()})
        yield from stream.end()

    return run


def dropped_lines(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(k1, k2, doc_id, same, pos) -> (doc_id, same, pos) of the lines whose
    hash is in ``least_docs`` documents or more, but not of those in the
    largest of them."""
    by = [F.col(c).desc() if c == "doc_id" else F.col(c) for c in PLACE]
    found = stored(lines.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_first_occurrences(least_docs), STREAMED), "line-stream")
    # Two rows a range at most. Ranges of one hash follow one another, largest
    # documents first; one that ends in the document with which the next one
    # begins has it counted twice.
    edges = found.where("docs is not null").select("k1", "k2", "docs", "last", F.col("doc_id").alias("top"))
    before = F.lag("last").over(Window.partitionBy("k1", "k2").orderBy(F.col("top").desc(), F.col("last").desc(), "docs"))
    edges = edges.withColumn("docs", F.col("docs") - F.when(before == F.col("top"), 1).otherwise(0))
    edges = edges.groupBy("k1", "k2").agg(F.sum("docs").alias("n"), F.max("top").alias("top")).where(F.col("n") >= least_docs)
    unsure = found.where("not sure").select(*PLACE).join(F.broadcast(edges), ["k1", "k2"]).where("doc_id != top")
    return found.where("sure").select(*KEY, "pos").unionByName(unsure.select(*KEY, "pos"))


# ------------------------------------------------------------------ bitmaps


def pack_bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    """One bit a line, set where it is kept; deflated."""
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack_bitmap(n_lines: int, bitmap: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).view(bool)


def _bitmaps(batches):
    none = np.empty(0, np.int64)
    for batch in batches:
        n = batch.column("n_lines").to_pylist()
        at = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else none for x in batch.column("dropped")]
        keep = [batch.column(c) for c in (*KEY, "n_lines", "whole_sha256")]
        yield pa.RecordBatch.from_arrays(
            [*keep, pa.array([len(x) for x in at], pa.int64()), pa.array([pack_bitmap(k, x) for k, x in zip(n, at)], pa.binary())],
            names=[*KEY, "n_lines", "whole_sha256", "n_dropped", "bitmap"],
        )


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """docs -> (doc_id, same, n_lines, whole_sha256, n_dropped, bitmap), one
    row per input row: which lines of its text stay (``unpack_bitmap``).

    Lines end at \\n. A line's key is the line without white space at both
    ends, A-Z lower-cased. Keys of ``least_chars`` code points that
    ``least_docs`` documents or more hold lose all their lines except those of
    the largest doc_id that holds them. ``same`` is a hash of the text,
    ``whole_sha256`` the digest of the whole text.

    A null or empty text is one empty line, which stays. Rows with a null id
    keep all lines and don't count for others. Rows that share an id are one
    document; repeated rows come back each. Very long texts are taken whole,
    one at a time; a very long line is one key. An empty table gives no rows.
    Other columns are ignored. Keys are compared by 128-bit hashes.
    """
    docs = apart(docs, id_col, text_col)[0].drop("rest")
    kind = "doc_id long, same long, n_lines long, whole_sha256 string, pos array<int>, k1 array<long>, k2 array<long>"
    hashed = stored(docs.mapInArrow(_hashed(least_chars), kind), "lines")
    each = hashed.where("doc_id is not null").select(*KEY, F.explode(F.arrays_zip("pos", "k1", "k2")).alias("line"))
    gone = dropped_lines(each.select("line.k1", "line.k2", *KEY, "line.pos"), least_docs)
    gone = stored(gone.groupBy(*KEY).agg(F.sort_array(F.collect_set("pos")).alias("dropped")), "dropped")
    rows = hashed.select(*KEY, "n_lines", "whole_sha256").join(gone, KEY, "left")
    return stored(rows.mapInArrow(_bitmaps, "doc_id long, same long, n_lines long, whole_sha256 string, n_dropped long, bitmap binary"), "bitmaps")


def _apply(others, finish):
    """The columns ``others``, and ``kept``: what ``finish`` makes of the lines
    that a text keeps (all without a bitmap; a null text stays one)."""

    def run(batches):
        for batch in batches:
            buf, off = flat_bytes(batch.column("text"))
            there = batch.column("text").is_valid().to_pylist()
            kept = []
            for a, b, bitmap, valid in zip(off[:-1], off[1:], batch.column("bitmap").to_pylist(), there):
                lines = buf[a:b].tobytes().split(b"\n")
                keep = unpack_bitmap(len(lines), bitmap) if bitmap is not None else [True] * len(lines)
                kept.append(finish(b"\n".join([x for x, k in zip(lines, keep) if k])) if valid else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(kept, pa.string())], names=[*others, "kept"])

    return run


def _lossy(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps of texts that lose lines; repeated rows have one."""
    return stored(bitmaps.where("n_dropped > 0").select(*KEY, "bitmap").dropDuplicates(KEY), "lossy")


def line_digests(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs and their ``line_bitmaps`` -> (doc_id, n_lines, n_dropped,
    kept_sha256), one row per input row: the digest of the lines that stay,
    joined by \\n. Odd rows are those of ``line_bitmaps``."""
    lossy = _lossy(bitmaps)
    texts = bloom.split(apart(docs, id_col, text_col)[0].drop("rest"), lossy)[0].dropDuplicates(KEY).join(lossy, KEY)
    digest = lambda raw: hashlib.sha256(raw).hexdigest()
    cut = stored(texts.mapInArrow(_apply(KEY, digest), "doc_id long, same long, kept string"), "digests")
    return bitmaps.join(cut, KEY, "left").select("doc_id", "n_lines", "n_dropped", F.coalesce("kept", "whole_sha256").alias("kept_sha256"))


def without_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with all their columns, whatever they are called, and
    their ``line_bitmaps`` applied to the text; texts that lose nothing come
    back as they are. An empty table gives no rows."""
    keyed, as_docs = apart(docs, id_col, text_col)
    lossy = _lossy(bitmaps)
    maybe, whole = bloom.split(keyed, lossy)
    kind = T.StructType([keyed.schema["rest"], T.StructField("kept", T.StringType())])
    cut = maybe.join(lossy, KEY, "left").select("rest", "text", "bitmap").mapInArrow(_apply(["rest"], lambda raw: raw.decode("utf-8", "replace")), kind)
    cut = cut.unionByName(whole.select("rest", F.col("text").alias("kept")))
    return as_docs(cut, F.col("kept"))
