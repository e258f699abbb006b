"""Packing by concatenating and cutting, with two-pass prefix sums.

Pass one turns texts into ids and stores them with each task's number and the
ids that came before within the task. The tasks' totals, summed up in task
order, give every document its place in one endless row of ids; pass two cuts
that row every ``width`` ids. Only one row per task is ever summed in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import one_text, stored
from .tokens import Encoder
from .words import kept

WIDTH = 1024
#: Closes each document.
END_ID = 0

def _tokenize(path):
    def run(batches):
        held = kept("ids")
        encoder = held[path] = held.get(path) or Encoder(path)
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [np.append(x, np.uint32(END_ID)).astype("<u4") for x in encoder.encode(batch.column(1))]
            n = np.array([len(x) for x in ids], np.int64)
            at = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), task), pa.int32()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "task", "at", "doc_tokens", "ids"],
            )

    return run


def cut(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, task, at, doc_tokens, ids) -> pieces. ``rows`` must be stored:
    both passes have to see the same tasks."""
    totals = rows.groupBy("task").agg(F.max(F.col("at") + F.col("doc_tokens")).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each task of pass one.
    placed = rows.join(F.broadcast(totals.select("task", before.alias("base"))), "task").withColumn("at", F.col("base") + F.col("at"))
    first, last = F.floor(F.col("at") / width), F.floor((F.col("at") + F.col("doc_tokens") - 1) / width)
    pieces = placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("at"), F.col("sequence_id") * width)
    hi = F.least(F.col("at") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * width)
    pieces = pieces.withColumn("start", lo - F.col("at")).withColumn("length", hi - lo).withColumn("offset", lo - F.col("sequence_id") * width)
    return pieces.withColumn("ids", F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"
    )


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """docs -> pieces (doc_id, start, length, ids, doc_tokens, sequence_id,
    offset): ``ids`` holds little-endian unsigned 32-bit ids.

    Each document is its ids and ``END_ID``; a null or empty text is that one
    id; a very long one is encoded whole, in pieces. Documents follow one another in the order in which they are read, and
    every sequence but the last is full. Repeated and null doc_ids are packed
    like any other row; an empty table gives no rows. Other columns are
    ignored; ``tokenizer`` is the path of a ``tokenizers`` file that each
    worker can open.
    """
    kind = "doc_id long, task int, at long, doc_tokens long, ids binary"
    return cut(stored(one_text(docs, id_col, text_col).mapInArrow(_tokenize(tokenizer), kind), "tokens"), width)


def padded(length: int, width: int = WIDTH) -> int:
    """The ids that a sequence of this length takes with its padding."""
    return length if length & (length - 1) == 0 else width
