"""Filter interaction audit from sorted posting lists.

Which documents does each filter remove, and what would have gone anyway, in
every order of the filters? Per part (a source) and filter the ids of failing
documents are kept as sorted posting lists, cut into id ranges so that a part
with a third of all rows is many blocks. A block's lists are merged once, all
together, by galloping; the merge gives the sizes of all intersections and
differences of the lists (cells: ids that are on just these lists), so every
union or difference of any filters is a sum of cells, and sums over blocks.
Cells are a few numbers a part; the orders are read off them.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import numbered, stored
from .words import each_text

#: The five filters, in bit order, and the two label lists behind them.
FILTERS = "ABCDE"
LABELS = ("good", "toxic")
#: Ids of one block of posting lists, and of one list that a merge takes in.
BLOCK_IDS, STEP_IDS = 1 << 16, 1 << 12
UPPER, MARK = np.zeros(256, bool), np.zeros(256, bool)
UPPER[65:91] = True
MARK[[ord(c) for c in "#$%&*|"]] = True
SIZES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in SIZES)


# -------------------------------------------------------------- the filters


def text_fails(buf: np.ndarray, hashes: np.ndarray) -> int:
    """Bits of the filters A to D that a text fails."""
    n, points = len(hashes), int(((buf & 0xC0) != 0x80).sum())
    fails = (n < 50, 100 * len(np.unique(hashes)) < 65 * n, 100 * int(UPPER[buf].sum()) > 5 * points, bool(MARK[buf].any()))
    return sum(1 << i for i, x in enumerate(fails) if x)


def _fails(batches):
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        fails, digests = [], []
        for buf, h, _, _ in each_text(batch.column("text")):
            fails.append(text_fails(buf, h))
            digests.append(hashlib.blake2b(buf.tobytes(), digest_size=16).digest())
        halves = np.frombuffer(b"".join(digests), np.int64)
        rows = np.arange(at, at + len(fails), dtype=np.int64)
        at += len(fails)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(rows), pa.array(fails, pa.int32()), pa.array(halves[0::2]), pa.array(halves[1::2])],
            names=["doc_id", "part", "row", "fails", "t1", "t2"],
        )


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """docs, labels (doc_id, quality, toxic) -> (part, row, marks): one row per
    document with its number and a bit per filter it fails, then one for a
    good and one for a toxic label. Filters: A under 50 words, B under 65 %
    distinct words, C over 5 % capitals, D any of ``#$%&*|``, E the text of a
    smaller doc_id.

    A null text is empty, a null part the empty string. A row is counted
    whatever its id: with a null one it is no copy, has no copies and no label;
    rows that share an id are no copies of one another and share their labels
    (any good or toxic one counts).
    """
    rows, (id_, text, part) = numbered(docs, id_col, text_col, part_col)
    rows = rows.select(F.col(id_).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").alias("text"))
    # Stored: a row's number must not change when a task runs again.
    rows = stored(rows.mapInArrow(_fails, "doc_id long, part string, row long, fails int, t1 long, t2 long"), "fails")
    same = rows.where("doc_id is not null").groupBy("t1", "t2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    same = stored(same.where("first < last").drop("last"), "copies")
    named, (id_, quality, toxic) = numbered(labels, "doc_id", "quality", "toxic")
    of = lambda c: F.max(F.coalesce(F.col(c).cast("double") == 1, F.lit(False)))
    named = stored(named.where(F.col(id_).isNotNull()).groupBy(F.col(id_).cast("long").alias("doc_id")).agg(of(quality).alias("good"), of(toxic).alias("toxic")), "labels")
    rows = rows.join(same, ["t1", "t2"], "left").join(named, "doc_id", "left")
    bit = lambda c, i: F.when(c, F.lit(1 << i)).otherwise(F.lit(0))
    marks = F.col("fails").bitwiseOR(bit(F.col("first") < F.col("doc_id"), 4)).bitwiseOR(bit(F.col("good"), 5)).bitwiseOR(bit(F.col("toxic"), 6))
    return rows.select("part", "row", marks.cast("int").alias("marks"))


# ------------------------------------------------------------ posting lists


def _blocks(n_lists):
    """Rows in order of part and number -> posting lists per block."""

    def block(part, rows, marks):
        row, mark = np.concatenate(rows), np.concatenate(marks)
        lists = [row[(mark >> i) & 1 == 1] for i in range(n_lists)]
        off = np.cumsum([0, *map(len, lists)])
        inner = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(lists)))
        outer = pa.ListArray.from_arrays(pa.array([0, n_lists], pa.int32()), inner)
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([int(row[0])]), pa.array([int(row[-1])]), pa.array([len(row)]), outer], names=["part", "lo", "hi", "n_docs", "ids"])

    def run(batches):
        part, rows, marks, n = None, [], [], 0
        for batch in batches:
            names = batch.column("part").dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            row, mark = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "marks"))
            edges = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                own = names.dictionary[int(code[a])].as_py()
                if rows and (own != part or n + b - a > BLOCK_IDS):
                    yield block(part, rows, marks)
                    rows, marks, n = [], [], 0
                part, n = own, n + b - a
                rows.append(row[a:b])
                marks.append(mark[a:b])
        if rows:
            yield block(part, rows, marks)

    return run


def posting_lists(marked: DataFrame, n_lists: int) -> DataFrame:
    """(part, row, marks) -> (part, lo, hi, n_docs, ids): for each part and
    range of row numbers the sorted numbers that have each bit."""
    ordered = stored(marked, "marks").repartitionByRange("part", "row").sortWithinPartitions("part", "row")
    return stored(ordered.mapInArrow(_blocks(n_lists), "part string, lo long, hi long, n_docs long, ids array<array<long>>"), "postings")


def gallop(ids: np.ndarray, at: int, bound: int) -> int:
    """The first place from ``at`` on that lies above ``bound``: steps double
    until they pass it, then the last one is halved."""
    step = 1
    while at + step <= len(ids) and ids[at + step - 1] <= bound:
        step *= 2
    lo, hi = at + step // 2, min(at + step, len(ids))
    return lo + int(np.searchsorted(ids[lo:hi], bound, side="right"))


def merged_cells(lists: list[np.ndarray]) -> np.ndarray:
    """How many ids are on just the lists of each bit mask, by one merge of
    the sorted lists. Each turn gallops in every list to the nearest of the
    ids that lie ``STEP_IDS`` ahead; a list alone there is counted unseen."""
    cells = np.zeros(1 << len(lists), np.int64)
    at = [0] * len(lists)
    while live := [i for i, x in enumerate(lists) if at[i] < len(x)]:
        bound = min(int(lists[i][min(at[i] + STEP_IDS, len(lists[i])) - 1]) for i in live)
        if len(live) == 1:
            bound = int(lists[live[0]][-1])
        to = {i: gallop(lists[i], at[i], bound) for i in live}
        met = [i for i in live if to[i] > at[i]]
        if len(met) == 1:
            cells[1 << met[0]] += to[met[0]] - at[met[0]]
        else:
            ids = np.concatenate([lists[i][at[i] : to[i]] for i in met])
            bits = np.repeat([1 << i for i in met], [to[i] - at[i] for i in met])
            order = np.argsort(ids, kind="stable")  # merges the sorted runs
            ids, bits = ids[order], bits[order]
            start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            cells += np.bincount(np.bitwise_or.reduceat(bits, start), minlength=len(cells))
        for i in live:
            at[i] = to[i]
    return cells


def _cells(batches):
    for batch in batches:
        out = {"part": [], "cell": [], "n": []}
        for part, n_docs, ids in zip(batch.column("part").to_pylist(), batch.column("n_docs").to_pylist(), batch.column("ids")):
            cells = merged_cells([x.values.to_numpy(zero_copy_only=False) for x in ids.values])
            cells[0] = n_docs - cells.sum()
            for cell in np.flatnonzero(cells).tolist():
                for c, x in zip(out, (part, cell, int(cells[cell]))):
                    out[c].append(x)
        yield pa.RecordBatch.from_arrays([pa.array(out["part"], pa.string()), pa.array(out["cell"], pa.int32()), pa.array(out["n"], pa.int64())], names=list(out))


def cell_sizes(lists: DataFrame) -> DataFrame:
    """Posting lists -> (part, cell, n): documents of the part that are on just
    the lists of the bit mask ``cell`` (0: on none)."""
    return lists.select("part", "n_docs", "ids").mapInArrow(_cells, "part string, cell int, n long").groupBy("part", "cell").agg(F.sum("n").alias("n"))


# --------------------------------------------------------------- the report


def order_rows(cells: np.ndarray, filters: str = FILTERS) -> list[tuple]:
    """(order, step, sizes) for all orders of the filters, from the sizes of a
    part's cells (bits: the filters, good, toxic)."""
    k = len(filters)
    mask = np.arange(len(cells))
    fails = mask & ((1 << k) - 1)
    good, toxic = cells * ((mask >> k) & 1), cells * ((mask >> (k + 1)) & 1)
    size = lambda where, n=cells: int(n[where].sum())
    # Per filter and set of earlier filters: the difference of its list and
    # the earlier ones' union, of all, good and toxic documents.
    diff = {(f, prev): [size((fails >> f & 1 == 1) & (fails & prev == 0), n) for n in (cells, good, toxic)] for f in range(k) for prev in range(1 << k) if not prev >> f & 1}
    union = {s: size(fails & s != 0) for s in range(1 << k)}
    orders = list(permutations(range(k)))
    shapley, steps = [0] * k, []
    for order in orders:
        prev = 0
        for step, f in enumerate(order, 1):
            removed, good_lost, toxic_lost = diff[f, prev]
            shapley[f] += removed
            others = ((1 << k) - 1) ^ (1 << f)
            steps.append((order, step, f, int(cells.sum()) - union[prev | 1 << f], removed, union[1 << f] - removed, diff[f, others][0], good_lost, toxic_lost))
            prev |= 1 << f
    return [("".join(filters[i] for i in order), step, *sizes, shapley[f]) for order, step, f, *sizes in steps]


def _report(n_lists, filters):
    def run(batches):
        for pdf in batches:
            for part, own in zip(pdf["part"], pdf["cells"]):
                cells = np.zeros(1 << n_lists, np.int64)
                for c in own:
                    cells[c["cell"]] = c["n"]
                yield pd.DataFrame([(part, *row) for row in order_rows(cells, filters)], columns=["part", "filter_order", "step", *SIZES])

    return run


def filter_audit(marked: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, row, marks) of ``judged``, or of any other filters, one letter
    and bit each, then a good and a toxic bit -> one row per part, order of
    the filters and step: documents of the part that are ``kept`` after the
    step, ``removed`` by it, fail its filter but went before (``redundant``),
    fail no other filter (``unique_fails``); good and toxic ones that it
    removes; and its filter's ``removed``, summed over all orders.

    Row numbers must be unique. All orders come for every part, zeros
    included; an empty table has no part and gives no rows. Ties don't matter:
    only sizes of sets are counted. Texts of any length are one row here.
    """
    n_lists = len(filters) + len(LABELS)
    cells = cell_sizes(posting_lists(marked, n_lists))
    # At most 2 ** n_lists rows a part.
    of_part = cells.groupBy("part").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
    return of_part.mapInPandas(_report(n_lists, filters), REPORT)
