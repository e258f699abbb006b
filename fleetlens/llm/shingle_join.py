"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches ``num / den``. In a global order of shingles (rare first) two linked
sets of n shingles share at least ``m`` of their first ``n - ceil(s n) + m``
ones, for every ``m``. Each document picks its own ``m`` by the cost it
expects: a longer prefix means more rows, but a partner must share more of it.
A pair needs ``min(m, m')`` shared prefix shingles before it is verified.

* The order comes from a fixed-size table of hashed counts over all documents
  (``2**SKETCH_BITS`` cells, a bound that does not depend on the data); any
  order gives the same links, a good one gives fewer candidates.
* Equal sets are one node, so copies cost one row each.
* Prefix shingles that the table shows as frequent are salted; the rest meet
  by shingle, and those found in one set only are dropped.
* Candidates come in two steps. Stars: each shingle's sets against the
  smallest of them. All the rest: pairs of sets of *different* components that
  share a prefix shingle. A large group of near copies is joined by its stars
  and hardly paired with itself; no link between components is missed. A
  shingle of many sets is worked on in blocks of bounded size.
* Verification first bounds the overlap by bitmaps (never too low), then
  intersects the sets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from .components import components
from .shared import apart, one_text, stored
from .words import U64, each_text, mix, shingle_set, signed, unsigned

#: Cells of the count table: 2**22 counts are 16 MB wherever they are sent.
SKETCH_BITS = 22
SKETCH_PARTS = 64
#: Prefixes ask for four to eight shared shingles (sets of fewer: for all).
LEAST_MATCHES, MOST_MATCHES = 4, 8
#: A prefix shingle in more sets than this, by the table, is salted.
FREQUENT = 4096
SALTS = 64
#: Sets that share a prefix shingle are paired as rows up to so many sets; a
#: longer list is compared in blocks of so many.
LIST_ROWS, BLOCK_ROWS = 128, 1024
#: Words of bitmaps that are compared at a time: 16 MB, however long the sets.
PAIR_WORDS = 1 << 21


# ------------------------------------------------------------ shingle order


def _pack(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Counts per part of the table, in the narrowest type and compressed."""
    narrow = [x.astype(np.min_scalar_type(int(x.max()))) for x in parts.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(parts), pa.int32()), pa.array([x.dtype.itemsize for x in narrow], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in narrow], pa.binary())],
        names=["part", "width", "counts"],
    )


def _unpack(width: int, counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), f"<u{width}")


def _count_shingles(k):
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)  # of one task
        for batch in batches:
            cells = [shingle_set(h, k) >> U64(64 - SKETCH_BITS) for _, h, _, _ in each_text(batch.column(0), lower=True)]
            if cells:
                at, n = np.unique(np.concatenate(cells).astype(np.int64), return_counts=True)
                total[at] += n.astype(np.uint32)
        yield _pack({i: x for i, x in enumerate(np.split(total, SKETCH_PARTS)) if x.any()})

    return run


def _add_counts(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, width, counts in zip(*(c.to_pylist() for c in batch.columns)):
            total[part] = total.get(part, 0) + _unpack(width, counts).astype(np.int64)
    yield _pack(total)


def shingle_counts(docs: DataFrame, k: int) -> np.ndarray:
    """The table of hashed shingle counts over all texts (fixed size)."""
    kind = "part int, width int, counts binary"
    parts = docs.select("text").mapInArrow(_count_shingles(k), kind).repartition(SKETCH_PARTS, "part").mapInArrow(_add_counts, kind)
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    for row in parts.collect():
        out[row.part] = np.minimum(_unpack(row.width, row.counts).astype(np.uint64), (1 << 32) - 1)
    return out.reshape(-1)


def _at_least(n, num, den):
    """ceil(n * num / den)"""
    return -(-n * num // den)


def choose_prefix(counts: np.ndarray, load: float, num: int, den: int) -> tuple[int, int]:
    """(matches asked for, prefix length) of a set whose shingles have the
    ascending table counts ``counts``; ``load`` is a cell's mean count. The
    cost of asking for m is the prefix rows, plus one verification of n
    shingles for every expected candidate; sets that share m or more of the
    prefix are at most (sum of the others' occurrences) / m."""
    n = len(counts)
    least = _at_least(n, num, den)
    others = np.maximum(counts - load - 1, 0).cumsum()
    asked = np.arange(min(LEAST_MATCHES, least), min(MOST_MATCHES, least) + 1)
    length = n - least + asked
    best = int(np.argmin(length + others[length - 1] / asked * n))
    return int(asked[best]), int(length[best])


def _prefixes(k, num, den, counts):
    def run(batches):
        table = counts.value
        load = float(table.mean())
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in ("n", "fp1", "fp2", "matches", "frequent_from", "prefix")}
            for _, h, _, _ in each_text(batch.column(1), lower=True):
                s = shingle_set(h, k)
                seen = table[(s >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)
                order = np.argsort(seen, kind="stable")
                seen = seen[order]
                m, length = choose_prefix(seen, load, num, den) if len(s) else (0, 0)
                cols["n"].append(len(s))
                cols["fp1"].append(int(signed(np.asarray([s.sum(dtype=U64)]))[0]))
                cols["fp2"].append(int(signed(np.asarray([mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)]))[0]))
                cols["matches"].append(m)
                cols["frequent_from"].append(int(np.searchsorted(seen[:length], load + FREQUENT, side="right")))
                cols["prefix"].append(signed(s[order[:length]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols["n"], pa.int64()), pa.array(cols["fp1"], pa.int64()), pa.array(cols["fp2"], pa.int64())]
                + [pa.array(cols[c], pa.int32()) for c in ("matches", "frequent_from")]
                + [pa.array(cols["prefix"], pa.list_(pa.int64()))],
                names=["doc_id", "n", "fp1", "fp2", "matches", "frequent_from", "prefix"],
            )

    return run


# ------------------------------------------------------------- verification


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A power of two of bits, at least four a shingle; bit = lowest hash bits."""
    width = 1 << max(6, int(4 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(tokens & U64(width - 1)).astype(np.int64)] = True
    return bits


def overlap_bound(x: np.ndarray, y: np.ndarray, nx: int, ny: int) -> int:
    """At least the overlap of the two sets with these bitmaps: each bit that
    one has and the other lacks is a shingle that they don't share."""
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(nx - int((x & ~y).sum()), ny - int((y & ~x).sum()))


def similar(overlap: int, nx: int, ny: int, num: int, den: int) -> bool:
    return den * overlap >= num * (nx + ny - overlap)


def _sets(k, wanted):
    """The sets of texts whose id is wanted (a Bloom filter: a few others come
    along, and meet nothing). Filter and sets take one Python process."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(bloom.probe(wanted.value, batch.column(0)))
            sets = [shingle_set(h, k) for _, h, _, _ in each_text(batch.column(1), lower=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([np.packbits(bitmap(s)).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["doc", "bits", "tokens"],
            )

    return run


def _hold(exact, num, den):
    def one(x, y):
        if exact:
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(large, small)
            at[at == len(large)] = 0
            return similar(int((large[at] == small).sum()), len(x), len(y), num, den)
        (x, nx), (y, ny) = x, y
        return similar(overlap_bound(*(np.unpackbits(np.frombuffer(b, np.uint8)).view(bool) for b in (x, y)), nx, ny), nx, ny, num, den)

    def run(batches):
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            if exact:
                keep = [one(x, y) for x, y in zip(c["xa"].to_pylist(), c["xb"].to_pylist())]
            else:
                keep = [one((x, nx), (y, ny)) for x, y, nx, ny in zip(*(c[i].to_pylist() for i in ("xa", "xb", "na", "nb")))]
            yield pa.RecordBatch.from_arrays([c[i].filter(pa.array(keep, pa.bool_())) for i in ("a", "b", "na", "nb")], names=["a", "b", "na", "nb"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose sets reach the similarity, as links."""
    for exact, column in ((False, "bits"), (True, "tokens")):
        if exact:  # only the sets of pairs that are left are shuffled
            ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
            sets = bloom.split(sets.withColumnRenamed("doc", "doc_id"), stored(ids, "ids"))[0].withColumnRenamed("doc_id", "doc")
        a = sets.select(F.col("doc").alias("a"), F.col(column).alias("xa"))
        b = sets.select(F.col("doc").alias("b"), F.col(column).alias("xb"))
        pairs = stored(pairs.join(a, "a").join(b, "b").mapInArrow(_hold(exact, num, den), "a long, b long, na long, nb long"), "pairs")
    return pairs.select("a", "b")


# ------------------------------------------------------------------ the join


def _enough(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Shared prefix shingles (a, b, na, nb, ma, mb per shingle) -> pairs that
    share as many as the shorter asking wants and whose sizes allow a link."""
    return (
        pairs.where((F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num))
        .groupBy("a", "b")
        .agg(*(F.max(c).alias(c) for c in ("na", "nb", "ma", "mb")), F.count("*").alias("shared"))
        .where(F.col("shared") >= F.least("ma", "mb"))
        .select("a", "b", "na", "nb")
    )


def _star_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    centre = stored(postings.groupBy("token").agg(F.min(F.struct("doc", "n", "matches")).alias("c")), "centres")
    both = postings.join(centre, "token").where("doc != c.doc")
    return _enough(
        both.select(F.col("c.doc").alias("a"), F.col("doc").alias("b"), F.col("c.n").alias("na"), F.col("n").alias("nb"), F.col("c.matches").alias("ma"), F.col("matches").alias("mb")), num, den
    )


def _block_pairs(num, den):
    """Of two blocks of sets that share a prefix shingle, the pairs of
    different components that their bitmaps don't rule out."""

    def run(pdf):
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        pdf = pdf.assign(words=pdf["bits"].str.len() // 8).sort_values("words", kind="stable")
        out = []
        for wx, x in pdf[pdf["block"] == i].groupby("words"):
            for wy, y in pdf[pdf["block"] == j].groupby("words"):
                if max(wx, wy) > 2 * min(wx, wy):  # sizes too far apart
                    continue
                bx, by = (_folded(z["bits"], min(wx, wy)) for z in (x, y))
                nx, ny, cx, cy, dx, dy = (z[c].to_numpy() for c in ("n", "comp", "doc") for z in (x, y))
                step = max(1, PAIR_WORDS // (len(y) * min(wx, wy)))
                for lo in range(0, len(x), step):
                    at = slice(lo, lo + step)
                    only_x = np.bitwise_count(bx[at, None, :] & ~by).sum(-1, dtype=np.int64)
                    only_y = np.bitwise_count(by & ~bx[at, None, :]).sum(-1, dtype=np.int64)
                    size = nx[at, None] + ny
                    most = np.minimum(nx[at, None] - only_x, ny - only_y)
                    a, b = np.nonzero((most * (num + den) >= num * size) & (cx[at, None] != cy) & (dx[at, None] != dy))
                    out.append(pd.DataFrame({"a": dx[at][a], "b": dy[b], "na": nx[at][a], "nb": ny[b]}))
        found = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "na": [], "nb": []}).astype("int64")
        return found[found["a"] < found["b"]] if i == j else found

    return run


def _folded(bits: pd.Series, words: int) -> np.ndarray:
    x = np.stack([np.frombuffer(b, U64) for b in bits])
    return x if x.shape[1] == words else x[:, :words] | x[:, words:]


def _cross_pairs(postings: DataFrame, comps: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of sets of different components that share prefix shingles.
    Short lists are paired as rows. Long ones are compared in blocks inside
    the tasks, by bitmaps, and only pairs that may link become rows."""
    named = postings.join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
    named = stored(named, "postings")
    mixed = stored(named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("sets")).where("lo < hi").select("token", "sets"), "mixed")
    named = stored(named.join(mixed, "token"), "postings")
    short = named.where(F.col("sets") <= LIST_ROWS)
    side = lambda s: short.select("token", F.col("comp").alias(f"c{s}"), F.col("doc").alias(s), F.col("n").alias(f"n{s}"), F.col("matches").alias(f"m{s}"))
    fits = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    pairs = _enough(side("a").join(side("b"), "token").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & fits), num, den)
    blocks = F.ceil(F.col("sets") / BLOCK_ROWS).cast("int")
    long = named.where(F.col("sets") > LIST_ROWS).join(sets.select("doc", "bits"), "doc").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    # A block meets itself and every other one: once for each pair (i <= j).
    long = long.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    long = long.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "comp", "n", "bits")
    return pairs.unionByName(long.groupBy("token", "i", "j").applyInPandas(_block_pairs(num, den), "a long, b long, na long, nb long").distinct())


def shingle_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs -> (doc_id, n_shingles, component_id), one row per input row.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text, A-Z
    lower-cased; a text of fewer than ``k`` words is one shingle of all of
    them. Documents link when ``den * overlap >= num * union``;
    ``component_id`` is the smallest id reachable by links, the own included.

    Null or empty texts and texts without words have no shingles and link with
    nothing. Rows with a null id link with nothing and have a null component.
    Rows that share an id are one document: a link of either holds for both.
    Very long texts are one set like others, compared whole.
    An empty table gives no rows. Columns beside the two named are ignored.
    """
    spark = docs.sparkSession
    docs = one_text(docs, id_col, text_col)
    counts = spark.sparkContext.broadcast(shingle_counts(docs, k))
    kind = "doc_id long, n long, fp1 long, fp2 long, matches int, frequent_from int, prefix array<long>"
    rows = stored(docs.mapInArrow(_prefixes(k, num, den, counts), kind), "prefixes")
    counts.unpersist()
    usable = rows.where("n > 0 and doc_id is not null")
    # One node for each distinct set: the smallest id that has it.
    nodes = stored(usable.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("doc")), "nodes")
    copies = stored(usable.join(nodes, ["fp1", "fp2", "n"]).where("doc_id != doc").select("doc_id", "fp1", "fp2"), "copies")
    maybe, rest = bloom.split(usable, copies)
    firsts = rest.unionByName(maybe.join(copies, ["doc_id", "fp1", "fp2"], "left_anti"))
    spread = firsts.select(F.col("doc_id").alias("doc"), "n", "matches", "frequent_from", F.posexplode("prefix").alias("at", "token"))
    # A salt below zero marks a shingle that is not frequent.
    salt = F.when(F.col("at") >= F.col("frequent_from"), F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")).otherwise(F.lit(-1))
    spread = spread.select("token", salt.alias("salt"), "doc", "n", "matches")
    met = F.count("*").over(Window.partitionBy("token", "salt"))
    postings = stored(spread.withColumn("met", met).where("met > 1 or salt >= 0").select("token", "doc", "n", "matches").distinct(), "postings")
    # Sets that share too few prefix shingles with all others are out.
    live = stored(postings.groupBy("doc").agg(F.max("n").alias("n"), F.count("*").alias("met")).where(F.col("met") >= F.least(F.lit(LEAST_MATCHES), F.ceil(F.col("n") * num / den))).select("doc"), "live")
    postings = stored(postings.join(live, "doc"), "postings")
    wanted = bloom.held(live.select(F.col("doc").alias("doc_id")))
    sets = stored(docs.mapInArrow(_sets(k, wanted), "doc long, bits binary, tokens binary"), "sets")
    wanted.unpersist()
    links = stored(verify(_star_pairs(postings, num, den), sets, num, den), "stars")
    links = links.unionByName(verify(_cross_pairs(postings, components(links), sets, num, den), sets, num, den))
    # Rows that share an id tie their sets together.
    same = usable.groupBy("doc_id", "fp1", "fp2", "n").agg(F.lit(1)).join(nodes, ["fp1", "fp2", "n"]).where("doc != doc_id").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    comps = stored(components(links.unionByName(same)), "components")
    return rows.select("doc_id", F.col("n").alias("n_shingles")).join(comps.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") >= 0, F.coalesce("component", "doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all their columns, whatever those are called, without
    those that link to a smaller id: one document of each group stays. Of rows
    that share an id one stays; rows with a null id all stay. An empty table
    gives no rows."""
    found = stored(shingle_join(docs, id_col, text_col), "groups").where("doc_id is not null")
    again = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.col("component_id")).alias("c")).where("n > 1 or c != doc_id")
    touched = stored(again.select("doc_id", (F.col("c") != F.col("doc_id")).alias("gone")), "touched")
    rows, as_docs = apart(docs, id_col, text_col)
    maybe, rest = bloom.split(rows, touched)
    maybe = maybe.join(touched.where("gone"), "doc_id", "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("same"))
    maybe = maybe.withColumn("first", first).where("first = 1 or doc_id is null").drop("first")
    return as_docs(maybe.unionByName(rest), F.col("text"))
