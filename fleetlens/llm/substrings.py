"""Substring dedup by relative Lempel-Ziv parsing.

Documents are parsed against the texts of all documents with smaller ids: a
factor is a run of words that the reference has too, taken as far as it goes;
factors of ``span`` words and more are duplicates. A parse that went on behind
each factor would miss the windows of ``span`` words that lie across its end,
so every one of those is looked up as well.

The reference is indexed in blocks. A window of ``span`` words belongs to the
block of its anchor: the smallest hash among its runs of ``ANCHOR`` words.
Equal windows have equal anchors, so what stands together with one anchor in a
document, a passage, is parsed against exactly the block that can hold its
windows, and only anchors that at least two documents have make a block (about
one anchor in thirteen words is looked at to find that out). A block is the
passages of its anchor in order of document, each content once, by its
smallest document: all others that have it are covered as a whole. A passage is
parsed against those of smaller documents and then becomes part of the
reference itself. It is held as its sequence of windows (96-bit hashes), in
which a factor goes on as long as the next windows are equal too.

Contents are combined map-side, and minima are joined back from stored tables,
so a passage that a third of all documents share is split. A block of very many
contents is cut by the hash of the windows: each part looks up its own windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bloom
from .shared import apart, stored
from .words import U64, each_text, mix, rolling, signed, unsigned

SPAN = 50
ANCHOR = 25
#: A window in a passage: two hashes of its words.
WINDOW = np.dtype([("a", "<u8"), ("b", "<u4")])
#: Windows in one batch of rows; contents of one part of a block.
PIECE_ROWS, BLOCK_CONTENTS = 50_000, 2000


def anchor_of_windows(word_hashes: np.ndarray, span: int = SPAN, k: int = ANCHOR) -> np.ndarray:
    """The anchor of each window of ``span`` words; none in a shorter text."""
    runs = rolling(word_hashes, k)
    width = span - k + 1
    if len(runs) < width:
        return np.empty(0, U64)
    # Minimum of every ``width`` values: blockwise from both sides.
    n = len(runs)
    pad = -n % width
    block = np.concatenate([runs, np.full(pad, np.iinfo(np.uint64).max, U64)]).reshape(-1, width)
    left = np.minimum.accumulate(block, axis=1).ravel()
    right = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _digest(buf, start, end, gone) -> str:
    """SHA-256 of the kept words joined by one space."""
    raw = buf.tobytes()
    return hashlib.sha256(b" ".join([raw[start[i] : end[i]] for i in np.flatnonzero(~gone)])).hexdigest()


def _cut(buf, start, end, gone) -> str:
    """The text without the removed words and the white space behind each."""
    raw, parts, at = buf.tobytes(), [], 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    for a, b in zip(edge[0::2], edge[1::2]):
        parts.append(raw[at : start[a]])
        at = start[b] if b < len(start) else len(raw)
    parts.append(raw[at:])
    return b"".join(parts).decode("utf-8", "replace")


def _anchors(span, k):
    def run(batches):
        for batch in batches:
            n, whole, anchors = [], [], []
            for buf, h, _, _ in each_text(batch.column("text")):
                n.append(len(h))
                whole.append(hashlib.sha256(b" ".join(buf.tobytes().split())).hexdigest())
                anchors.append(signed(np.unique(anchor_of_windows(h, span, k))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("same"), pa.array(n, pa.int64()), pa.array(whole, pa.string()), pa.array(anchors, pa.list_(pa.int64()))],
                names=["doc_id", "same", "n_words", "whole_sha256", "anchors"],
            )

    return run


def _passages(span, k):
    """The passages of a text with a shared anchor: runs of consecutive windows
    of one anchor, as pairs of hashes per window and as a content hash."""

    def run(batches):
        for batch in batches:
            ids, same = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "same"))
            out: dict[str, list] = {c: [] for c in ("doc_id", "same", "start", "n", "anchor", "windows")}
            size = 0
            for i, (shared, (_, h, _, _)) in enumerate(zip(batch.column("shared"), each_text(batch.column("text")))):
                anchors = anchor_of_windows(h, span, k)
                at = np.flatnonzero(np.isin(anchors, unsigned(shared.values.to_numpy(zero_copy_only=False))))
                if not len(at):
                    continue
                pair = np.empty(len(at), WINDOW)
                pair["a"], pair["b"] = rolling(h, span)[at], rolling(mix(h), span)[at] >> U64(32)
                anchors = anchors[at]
                new = np.concatenate([[0], np.flatnonzero((np.diff(at) != 1) | (anchors[1:] != anchors[:-1])) + 1, [len(at)]])
                raw = pair.tobytes()
                for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
                    for c, x in zip(out.values(), (ids[i], same[i], at[a], b - a, anchors[a], raw[a * WINDOW.itemsize : b * WINDOW.itemsize])):
                        c.append(x)
                size += len(at)
                if size >= PIECE_ROWS:
                    yield _passage_rows(out)
                    out, size = {c: [] for c in out}, 0
            yield _passage_rows(out)

    return run


def _passage_rows(out: dict[str, list]) -> pa.RecordBatch:
    content = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in out["windows"]), np.int64)
    longs = [pa.array(np.array(out[c], np.int64)) for c in ("doc_id", "same")]
    ints = [pa.array(np.array(out[c], np.int32)) for c in ("start", "n")]
    anchor = pa.array(signed(np.array(out["anchor"], np.uint64)))
    return pa.RecordBatch.from_arrays(
        [*longs, *ints, anchor, pa.array(content[0::2]), pa.array(content[1::2]), pa.array(out["windows"], pa.binary())], names=["doc_id", "same", "start", "n", "anchor", "c1", "c2", "windows"]
    )


# -------------------------------------------------------------- the parsing


class Block:
    """The reference of one anchor (or of one part of its windows): passages
    of documents in rising order, indexed by window."""

    def __init__(self, part: int = 0, parts: int = 1):
        self.part, self.parts = part, parts
        self.passages: list[list[bytes]] = []
        self.places: dict[bytes, tuple[int, int, int]] = {}

    def _own(self, window: bytes) -> bool:
        return self.parts == 1 or int.from_bytes(window[:2], "big") % self.parts == self.part

    def parse(self, windows: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, windows, document) of the factors of a passage: at each
        place that the index knows, the reference is followed as far as it
        goes. The next place is looked up again: its window lies across the
        factor's end."""
        factors, i, n = [], 0, len(windows)
        while i < n:
            hit = self.places.get(windows[i]) if self._own(windows[i]) else None
            if hit is None:
                i += 1
                continue
            doc, passage, at = hit
            reference, m = self.passages[passage], 1
            while i + m < n and at + m < len(reference) and windows[i + m] == reference[at + m]:
                m += 1
            factors.append((i, m, doc))
            i += m
        return factors

    def add(self, doc: int, windows: list[bytes]) -> None:
        for at, window in enumerate(windows):
            if self._own(window):
                self.places.setdefault(window, (doc, len(self.passages), at))
        self.passages.append(windows)


def _parsed(batches):
    """Passages in order of block and document -> the factors of each."""
    key = block = doc = None
    waiting: list[list[bytes]] = []  # of the present document: no reference of its own
    for batch in batches:
        out: dict[str, list] = {"anchor": [], "c1": [], "c2": [], "factors": []}
        for anchor, part, parts, lo, c1, c2, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "part", "parts", "lo", "c1", "c2", "windows"))):
            if (anchor, part) != key:
                key, block, doc, waiting = (anchor, part), Block(part, parts), lo, []
            if lo != doc:
                for windows in waiting:
                    block.add(doc, windows)
                doc, waiting = lo, []
            windows = [raw[i : i + WINDOW.itemsize] for i in range(0, len(raw), WINDOW.itemsize)]
            waiting.append(windows)
            factors = block.parse(windows)
            if factors:
                for c, x in zip(out.values(), (anchor, c1, c2, [{"at": a, "n": m, "source": d} for a, m, d in factors])):
                    c.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("source", pa.int64())])))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out.values(), kinds)], names=list(out))


def factors_of(starts: np.ndarray, sources: np.ndarray, span: int = SPAN) -> list[tuple[int, int, int]]:
    """(start, words, reference document) of the maximal runs of consecutive
    window starts with one reference."""
    order = np.argsort(starts, kind="stable")
    s, r = starts[order], sources[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(s) != 1) | (np.diff(r) != 0)])) if len(s) else np.empty(0, np.int64)
    last = np.append(new[1:], len(s)) - 1
    return [(int(s[a]), int(s[b] - s[a]) + span, int(r[a])) for a, b in zip(new, last)]


def covered(factors: list[tuple[int, int, int]], n_words: int) -> np.ndarray:
    gone = np.zeros(n_words, bool)
    for start, words, _ in factors:
        gone[start : start + words] = True
    return gone


KEY = ["doc_id", "same"]


CONTENT = ["anchor", "c1", "c2"]


def parse_blocks(passages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored passages -> (contents, factors): (anchor, c1, c2, lo) of each
    content with its smallest document, and (anchor, c1, c2, factors) of the
    contents that have any, of that document."""
    contents = stored(passages.groupBy(*CONTENT).agg(F.min("doc_id").alias("lo")), "contents")
    blocks = stored(contents.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1").select("anchor", F.ceil(F.col("size") / BLOCK_CONTENTS).cast("int").alias("parts")), "blocks")
    one = passages.select(*CONTENT, "doc_id", "windows").join(contents.join(blocks, "anchor"), CONTENT).where("doc_id = lo")
    # A part takes the contents that hold one of its windows.
    first = F.transform(F.sequence(F.lit(1), F.octet_length("windows"), F.lit(WINDOW.itemsize)), lambda i: F.conv(F.hex(F.substring(F.col("windows"), i, F.lit(2))), 16, 10).cast("int") % F.col("parts"))
    part = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.array_distinct(first))
    rows = one.select(*CONTENT, "parts", "lo", "windows", F.explode(part).alias("part"))
    ordered = rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "lo", "c1", "c2")
    factors = ordered.mapInArrow(_parsed, "anchor long, c1 long, c2 long, factors array<struct<at int, n int, source long>>")
    factors = factors.groupBy(*CONTENT).agg(F.array_distinct(F.flatten(F.collect_list("factors"))).alias("factors"))
    return contents, stored(factors, "factors")


def parse_documents(docs: DataFrame, span: int = SPAN, k: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """(doc_id, same, text) -> (counts, found): (doc_id, same, n_words,
    whole_sha256) of every row, and per text with repeats the list ``found``
    of (start, n, source): so many windows from this word on are in the smaller
    document ``source``."""
    counts = stored(docs.mapInArrow(_anchors(span, k), "doc_id long, same long, n_words long, whole_sha256 string, anchors array<long>"), "anchors")
    each = counts.where("doc_id is not null").select(*KEY, F.explode("anchors").alias("anchor"))
    shared = stored(each.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"), "shared")
    of_text = stored(each.join(shared, "anchor").groupBy(*KEY).agg(F.collect_set("anchor").alias("shared")), "of-text")
    texts = bloom.split(docs, of_text)[0].join(of_text.hint("merge"), KEY).select(*KEY, "text", "shared")
    passages = stored(texts.mapInArrow(_passages(span, k), "doc_id long, same long, start int, n int, anchor long, c1 long, c2 long, windows binary"), "passages")
    contents, factors = parse_blocks(passages)
    rows = passages.drop("windows").join(contents, CONTENT)
    # A content is whole in its smallest document for all others that have it.
    whole = rows.where("doc_id > lo").select(*KEY, F.struct("start", "n", F.col("lo").alias("source")).alias("f"))
    first = rows.where("doc_id = lo").join(factors, CONTENT).select(*KEY, "start", F.explode("factors").alias("g"))
    parsed = first.select(*KEY, F.struct((F.col("start") + F.col("g.at")).alias("start"), F.col("g.n").alias("n"), F.col("g.source").alias("source")).alias("f"))
    return counts.drop("anchors"), stored(whole.unionByName(parsed).groupBy(*KEY).agg(F.collect_set("f").alias("found")), "found")


def _apply(span, finish):
    """Adds ``n_removed`` and ``kept`` by the list ``found`` (null: none)."""

    def run(batches):
        for batch in batches:
            removed, kept = [], []
            there = batch.column("text").is_valid().to_pylist()
            for (buf, h, start, end), found, valid in zip(each_text(batch.column("text")), batch.column("found"), there):
                own = found.values if found.is_valid else None
                start_, n, source = ((own.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "n", "source")) if own is not None else (np.empty(0, np.int64),) * 3)
                starts, sources = np.repeat(start_ - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(source, n)
                gone = covered(factors_of(starts, sources, span), len(h))
                removed.append(int(gone.sum()))
                kept.append(finish(buf, start, end, gone) if valid else None)
            others = [c for c in batch.schema.names if c not in ("found", "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[*others, "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """docs -> (doc_id, n_words, n_removed, kept_sha256), one row per input row.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged. A word goes when a
    window of ``span`` words covers it whose word sequence also starts in a
    document with a smaller id; windows are those of the input.
    ``kept_sha256`` is that of the kept words joined by one space. Null, empty
    and short texts lose nothing; rows with a null id neither lose words nor
    count for others. Rows that share an id are compared with smaller ids
    only. Very long texts are parsed passage by passage. An empty table gives no rows. Other columns are ignored.
    """
    docs = apart(docs, id_col, text_col)[0].drop("rest")
    counts, found = parse_documents(docs, span)
    hits = bloom.split(docs, found)[0].join(found.hint("merge"), KEY)
    cut = hits.mapInArrow(_apply(span, _digest), "doc_id long, same long, n_removed long, kept string").dropDuplicates(KEY)
    return counts.join(stored(cut, "cut"), KEY, "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept", "whole_sha256").alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """The rows of docs with all their columns, whatever those are called, the
    repeated words (see ``remove_repeats``) cut out of the text. Rows without
    repeats come back as they are; an empty table gives no rows."""
    rows, as_docs = apart(docs, id_col, text_col)
    found = parse_documents(rows.drop("rest"), span)[1]
    maybe, rest = bloom.split(rows, found)
    kind = T.StructType([rows.schema["rest"], T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    hits = maybe.join(found.hint("merge"), KEY, "left").select("rest", "text", "found")
    cut = hits.mapInArrow(_apply(span, _cut), kind).select("rest", "kept")
    return as_docs(cut.unionByName(rest.select("rest", F.col("text").alias("kept"))), F.col("kept"))
