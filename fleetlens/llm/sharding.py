"""Shards of near-equal bytes by fixed virtual slots.

A record's hash puts it into one of thousands of slots for good. Only the map
from slots to shards changes: every change is a new version of a small stored
table, made by moving as few slots as it takes. So rebalancing or growing
moves whole slots and needs nothing but the bytes per slot, one row each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import one_text, shared_folder, stored

#: Fixed for the life of a data set.
SLOTS = 4096


def first_map(n_shards: int) -> np.ndarray:
    return np.arange(SLOTS) % n_shards


def rebalance(slot_shard: np.ndarray, slot_bytes: np.ndarray, n_shards: int) -> np.ndarray:
    """An edited map: slots move from the fullest shard to the emptiest as
    long as that narrows the gap between the two."""
    shard = slot_shard.copy()
    total = np.bincount(shard, slot_bytes, n_shards)
    while True:
        full, low = int(total.argmax()), int(total.argmin())
        gap = total[full] - total[low]
        own = np.flatnonzero((shard == full) & (slot_bytes > 0) & (slot_bytes < gap))
        if not len(own):
            return shard
        # The slot that brings the two closest together; the first on a tie.
        move = own[np.abs(slot_bytes[own] - gap / 2).argmin()]
        shard[move] = low
        total[full] -= slot_bytes[move]
        total[low] += slot_bytes[move]


def grow(slot_shard: np.ndarray, slot_bytes: np.ndarray, n_shards: int) -> np.ndarray:
    """One shard more (numbered ``n_shards``): it takes slots from the fullest
    shards until it holds its part; no slot moves between old shards."""
    shard = slot_shard.copy()
    total = np.bincount(shard, slot_bytes, n_shards + 1)
    share = slot_bytes.sum() / (n_shards + 1)
    while True:
        fits = (shard < n_shards) & (slot_bytes > 0) & (slot_bytes <= share - total[n_shards])
        # The fullest shard that has such a slot: one huge record may fill it.
        left = [s for s in np.argsort(-total[:n_shards], kind="stable") if total[s] > total[n_shards] and (fits & (shard == s)).any()]
        if not left:
            return shard
        own = np.flatnonzero(fits & (shard == left[0]))
        move = own[slot_bytes[own].argmax()]
        shard[move] = n_shards
        total[left[0]] -= slot_bytes[move]
        total[n_shards] += slot_bytes[move]


def edit(slot_shard: np.ndarray, slot_bytes: np.ndarray, n_shards: int) -> np.ndarray:
    """The present map, changed as little as today's bytes and number of
    shards ask for: new shards take their part, slots of shards that are no
    more go to the emptiest ones, then the rest is rebalanced."""
    shard = slot_shard.copy()
    for have in range(int(shard.max()) + 1, n_shards):
        shard = grow(shard, slot_bytes, have)
    homeless = np.flatnonzero(shard >= n_shards)
    if len(homeless):
        kept = shard < n_shards
        total = np.bincount(shard[kept], slot_bytes[kept], n_shards)
        for slot in homeless[np.argsort(-slot_bytes[homeless], kind="stable")]:
            shard[slot] = int(total.argmin())
            total[shard[slot]] += slot_bytes[slot]
    return rebalance(shard, slot_bytes, n_shards)


class SlotMap:
    """Versions of the map in a shared folder: (version, slot, shard) rows,
    one Parquet folder a version, never changed once written. Opening a folder
    continues with its newest whole version; two writers of one version can't
    both succeed."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or shared_folder(spark, "slot-map")
        top = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(top)] if fs.exists(top) else []
        whole = [n for n in names if n.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}/_SUCCESS"))]
        self.version = max((int(n.split("=")[1]) for n in whole), default=-1)

    def write(self, slot_shard: np.ndarray) -> DataFrame:
        rows = self.spark.createDataFrame([(self.version + 1, i, int(s)) for i, s in enumerate(slot_shard)], "version int, vslot int, shard int")
        rows.coalesce(1).write.parquet(f"{self.folder}/version={self.version + 1:06d}")
        self.version += 1
        return self.read()

    def read(self, version: int | None = None) -> DataFrame:
        """A version, the newest one by default: (vslot, shard)."""
        return self.spark.read.schema("vslot int, shard int").parquet(f"{self.folder}/version={self.version if version is None else version:06d}")

    def newest(self) -> np.ndarray | None:
        """The newest version as an array; None in an empty folder."""
        if self.version < 0:
            return None
        out = np.zeros(SLOTS, np.int64)
        for r in self.read().collect():  # SLOTS rows
            out[r.vslot] = r.shard
        return out


def with_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot): size is the UTF-8 bytes plus one; the
    slot is a hash of the id and the text's checksum."""
    rows, text = one_text(docs, id_col, text_col), F.col("text")
    rows = rows.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    return rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOTS)).cast("int"))


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text", slot_map: SlotMap | None = None) -> DataFrame:
    """docs -> (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    ``slot_map`` is the stored map of the data set: its newest version is
    edited for these documents' bytes (see ``edit``) and stored as a new one if
    it changed, so that only the slots move that have to. Without one a new map
    is begun.

    The law is ``bytes``: the shards' sums of ``size`` are near equal (no slot
    move would bring the fullest and the emptiest closer). ``slot`` is a row's
    place in its shard, gapless from 0, ordered by virtual slot and doc_id.
    Groups of equal texts are no unit here: each row follows its own id, so
    that a large group spreads over all shards.

    A null text has size 1; a null id hashes like any other value; repeated
    rows are placed each; very long texts are one row like others, and may
    leave their shard the fullest; an empty table gives no rows. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    rows = stored(with_slots(docs, id_col, text_col), "slots")
    # At most SLOTS rows, whatever the input.
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    slot_bytes, slot_rows = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for r in sums:
        slot_bytes[r.vslot], slot_rows[r.vslot] = r.bytes, r.n
    slot_map = slot_map or SlotMap(spark)
    now = slot_map.newest()
    if now is None:
        now = first_map(n_shards)
        slot_map.write(now)
    changed = edit(now, slot_bytes, n_shards)
    if (changed != now).any():
        slot_map.write(changed)
    shard, placed = slot_map.newest(), slot_map.read()
    base = np.zeros(SLOTS, np.int64)
    for s in range(n_shards):
        own = np.flatnonzero(shard == s)
        base[own] = np.cumsum(slot_rows[own]) - slot_rows[own]
    bases = spark.createDataFrame([(i, int(b)) for i, b in enumerate(base)], "vslot int, base long")
    of_slot = placed.join(F.broadcast(bases), "vslot")
    order = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("place", F.row_number().over(order)).join(F.broadcast(of_slot), "vslot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
