"""Structured Streaming: source, micro-batch Bronze/Silver writes with a
per-bus carry so stream trips equal batch trips (S7, ST1-ST11, A22, K1, K2).

The reference cuts trips inside each micro-batch only, so trip numbers
restart every batch (F1). Here each batch is enriched together with the carry
- per bus its last row and trip number - of the buses it holds. The carry is
a log: a batch writes the new rows of its own buses only, and folds one
part of the fleet after the other, batch by batch, so what is written follows
the batch and not the fleet. A small version file names the folders that make
up the carry of a batch. Batch N reads only version N-1 and overwrites only its
own outputs, so a retried batch gives the same result (F16). Rows older than
the bus's carried point are late: they stay in Bronze, are flagged, and are
left out of Silver until ``apply_late_repair`` recomputes those buses from the
last point before them (ST7).
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections import deque
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.normalize import decode_events, drop_incomplete, normalize_events
from ..operators.segments import default_tie_cols, enrich_segments, valid_pings
from ..plans.joins import join_dimension
from ..plans.ordered_scan import SLOT_ROWS
from ..session import materialize
from ..settings import Quality

log = logging.getLogger(__name__)
CARRY_FLAG = "_carry"


def read_ping_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "json",
    schema=None,
    max_files_per_trigger: int | None = None,
    kafka_options: dict | None = None,
) -> DataFrame:
    """S7 / ST1 / ST2: a file source (json, csv, parquet) with a fixed schema
    and ``maxFilesPerTrigger``, or Kafka (``startingOffsets``,
    ``failOnDataLoss``, ``maxOffsetsPerTrigger`` in ``kafka_options``) where
    the cluster has the connector."""
    if fmt == "kafka":
        opts = {"subscribe": source, "startingOffsets": "earliest", "failOnDataLoss": "false", **(kafka_options or {})}
        reader = spark.readStream.format("kafka")
        for k, v in opts.items():
            reader = reader.option(k, str(v))
        return reader.load()
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source)


#: Versions of the carry that stay on disk: the one in use, the one before it
#: (a retried batch reads that), and one more.
KEEP_CARRIES = 3
#: Parts of the fleet, by bus; a batch folds one of them. The log holds the
#: batches of one such round.
CARRY_PARTS = 16
VERSION_FILE = "version.json"


def _query_id(spark: SparkSession) -> str:
    """Spark's id of the running stream; it is kept in the checkpoint, so a
    restarted stream has it and one with a fresh checkpoint doesn't."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def _carry_root(spark: SparkSession, root: str) -> str:
    return f"{root}/query_id={_query_id(spark)}"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside and renamed."""
    fs, target = _folder(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/_{target.getName()}-{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, target):  # where a rename does not replace
        fs.delete(target, False)
        if not fs.rename(part, target):
            raise OSError(f"can't write {path}")


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return None
    source = fs.open(at)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _refuse_other_stream(spark: SparkSession, root: str) -> None:
    """A stream that starts at batch 0 over another stream's carry would
    overwrite that one's Silver: fail instead."""
    fs, path = _folder(spark, root)
    if fs.exists(path):
        others = [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName() != f"query_id={_query_id(spark)}"]
        if others:
            raise RuntimeError(f"{root} belongs to another stream ({others[0]}); its checkpoint was reset or another one is used")


def _carry_version(spark: SparkSession, own: str, batch_id: int) -> dict | None:
    """What makes up the carry behind batch ``batch_id``: ``log`` (folders of
    changed rows, oldest first) and ``parts`` (per folded part its folder and
    the number of the last log entry in it)."""
    text = _read_text(spark, f"{own}/batch_id={batch_id}/{VERSION_FILE}")
    return None if text is None else json.loads(text)


def _rows_of(spark: SparkSession, own: str, version: dict) -> DataFrame:
    """All rows of a version with their age ``_seq``: of a bus the one with
    the largest counts."""
    kind = T.StructType.fromJson(json.loads(version["schema"]))
    frames = [spark.read.schema(kind).parquet(f"{own}/{e['path']}").withColumn("_seq", F.lit(e["seq"])) for e in [*version["parts"].values(), *version["log"]]]
    return reduce(DataFrame.unionByName, frames)


def _newest(rows: DataFrame) -> DataFrame:
    """One row per bus, the last written; a partial aggregate."""
    cols = [c for c in rows.columns if c != "_seq"]
    return rows.groupBy("bus_id").agg(F.max_by(F.struct(*(c for c in cols if c != "bus_id")), "_seq").alias("_l")).select("bus_id", "_l.*").select(*cols)


def _read_carry(spark: SparkSession, root: str, batch_id: int, buses: DataFrame | None = None) -> DataFrame | None:
    """The carry behind batch ``batch_id - 1`` of the given buses (of all by
    default), or None for the first batch. A missing version for a later batch
    is an error (never guess)."""
    if batch_id == 0:
        _refuse_other_stream(spark, root)
        return None
    own = _carry_root(spark, root)
    version = _carry_version(spark, own, batch_id - 1)
    if version is None:
        raise RuntimeError(f"carry version {batch_id - 1} missing under {own}")
    rows = _rows_of(spark, own, version)
    if buses is not None:
        rows = rows.join(buses, rows.bus_id.eqNullSafe(buses._bus), "left_semi")
    return _newest(rows)


ROW_HASH = "_row_hash"


def enrich_with_carry(
    batch: DataFrame,
    batch_id: int,
    carry_root: str,
    quality: Quality = Quality(),
    tie_cols: list[str] | None = None,
    slot_rows: int | None = SLOT_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ST6: enrich one micro-batch as if it continued the whole history.

    Returns ``(silver_all, late_rows, new_carry)``; ``new_carry`` must be
    written with ``write_carry``. A row is late when it comes before its bus's
    carried row: by time and tie key, or by time alone where rows have no key
    of their own (pings of the carried second are then still in time)."""
    spark = batch.sparkSession
    columns = batch.columns
    ties = default_tie_cols(batch) if tie_cols is None else list(tie_cols)
    keyed = bool(ties)
    if not keyed:
        batch = batch.withColumn(ROW_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
        ties = [ROW_HASH]
    prev = _read_carry(spark, carry_root, batch_id, batch.select(F.col("bus_id").alias("_bus")).distinct())
    rows = batch.withColumn(CARRY_FLAG, F.lit(False)).withColumn("_off", F.lit(None).cast("long"))
    late = rows.limit(0)
    if prev is not None:
        known = ["event_time", *(ties if keyed else [])]
        last = prev.select(F.col("bus_id").alias("_cb"), F.struct(*known).alias("_ck"), (F.col("trip_seq") - 1).alias("_co"))
        tagged = join_dimension(rows, last, F.col("bus_id").eqNullSafe(F.col("_cb")), "left").withColumn("_off", F.col("_co"))
        here = F.struct(*known)
        is_late = F.col("_ck").isNotNull() & F.col("event_time").isNotNull() & ((here <= F.col("_ck")) if keyed else (here < F.col("_ck")))
        late = tagged.filter(is_late).drop("_cb", "_ck", "_co")
        carried = prev.select(*batch.columns, F.lit(True).alias(CARRY_FLAG), (F.col("trip_seq") - 1).alias("_off"))
        rows = tagged.filter(~is_late).drop("_cb", "_ck", "_co").unionByName(carried)
    # The carried row sorts before the rows of its second.
    rows = rows.withColumn("_after", F.when(F.col(CARRY_FLAG), 0).otherwise(1))
    enriched = enrich_segments(rows, quality=quality, tie_cols=["_after", *ties], slot_rows=slot_rows)
    seq = F.col("trip_seq") + F.coalesce(F.col("_off"), F.lit(0))
    enriched = enriched.withColumn("trip_seq", seq).withColumn("trip_id", F.concat_ws("_", F.col("bus_id"), F.col("trip_seq").cast("string"))).drop("_off")
    hidden = [CARRY_FLAG, "_after"] + ([] if keyed else [ROW_HASH])
    out = enriched.filter(~F.col(CARRY_FLAG)).drop(*hidden)
    # New carry: last row of the batch's buses over carry + batch. max_by is a
    # partial aggregate.
    cols = batch.columns + ["trip_seq"]
    last_row = enriched.groupBy("bus_id").agg(F.max_by(F.struct(*[F.col(c) for c in cols if c != "bus_id"]), F.struct("event_time", "_after", *ties)).alias("_l"))
    return out, late.select(*columns), last_row.select("bus_id", "_l.*").select(*cols)


def _part(c: str = "bus_id"):
    return F.pmod(F.xxhash64(c), F.lit(CARRY_PARTS)).cast("int")


def write_carry(carry: DataFrame, carry_root: str, batch_id: int) -> None:
    """Add the batch's rows to the log, fold one part of the fleet once the log
    holds a round of batches, write this version, and delete the versions and
    folders that no batch can read any more."""
    spark = carry.sparkSession
    own = _carry_root(spark, carry_root)
    before = {"log": [], "parts": {}} if batch_id == 0 else _carry_version(spark, own, batch_id - 1)
    log_path = f"rows/log-{batch_id}"
    carry.write.mode("overwrite").parquet(f"{own}/{log_path}")
    version = {"schema": carry.schema.json(), "log": [*before["log"], {"path": log_path, "seq": 2 * batch_id}], "parts": dict(before["parts"])}
    if batch_id >= CARRY_PARTS:
        part = batch_id % CARRY_PARTS
        path = f"rows/part-{part}-{batch_id}"
        _newest(_rows_of(spark, own, version).where(_part() == part)).write.mode("overwrite").parquet(f"{own}/{path}")
        version["parts"][str(part)] = {"path": path, "seq": 2 * batch_id}
        if len(version["parts"]) == CARRY_PARTS:  # entries that every part has folded
            done = min(p["seq"] for p in version["parts"].values())
            version["log"] = [e for e in version["log"] if e["seq"] > done]
    _write_version(spark, own, batch_id, version)


def _write_version(spark: SparkSession, own: str, batch_id: int, version: dict) -> None:
    fs = _folder(spark, own)[0]
    fs.mkdirs(_folder(spark, f"{own}/batch_id={batch_id}")[1])
    _write_text(spark, f"{own}/batch_id={batch_id}/{VERSION_FILE}", json.dumps(version))
    if batch_id < KEEP_CARRIES:
        return
    gone = batch_id - KEEP_CARRIES
    old = _carry_version(spark, own, gone)
    kept = [_carry_version(spark, own, i) or {"log": [], "parts": {}} for i in range(gone + 1, batch_id + 1)]
    paths = lambda v: {e["path"] for e in [*v["log"], *v["parts"].values()]}
    for path in paths(old or {"log": [], "parts": {}}) - set().union(*map(paths, kept)):
        fs.delete(_folder(spark, f"{own}/{path}")[1], True)
    fs.delete(_folder(spark, f"{own}/batch_id={gone}")[1], True)


def write_batch(df: DataFrame, root: str, batch_id: int, fmt: str = "parquet") -> None:
    """K1 / K2: overwrite the ``batch_id=N`` folder, so a retried batch
    replaces its own output instead of appending a second copy (F16)."""
    df.write.mode("overwrite").format(fmt).save(f"{root}/batch_id={batch_id}")


@dataclass
class BatchMetrics:
    """Rows in and valid rows out of the last ``keep`` batches, gathered
    with ``Observation`` (no extra pass over the batch)."""

    keep: int = 1000
    history: deque = field(default_factory=deque)

    def add(self, row: dict) -> None:
        self.history.append(row)
        while len(self.history) > self.keep:
            self.history.popleft()


def wire_events(batch: DataFrame) -> DataFrame:
    """Kafka-style rows (``value``, ``partition``, ``offset``) to
    complete, typed events; the payload stays beside them for Bronze."""
    return drop_incomplete(normalize_events(decode_events(batch)))


def make_batch_handler(
    bronze_root: str,
    silver_root: str,
    carry_root: str,
    quality: Quality = Quality(),
    tie_cols=None,
    metrics: BatchMetrics | None = None,
    late_root: str | None = None,
    prepare=None,
    slot_rows: int | None = SLOT_ROWS,
):
    """ST3: the ``foreachBatch`` function. ``prepare`` turns the stream's rows
    into events (``wire_events`` for Kafka). The batch is persisted once (F22);
    an empty batch still writes its carry version so batch N+1 finds N."""

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch = (batch_df if prepare is None else prepare(batch_df)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            obs_in = Observation(f"bronze_{batch_id}")
            bronze = batch.observe(obs_in, F.count(F.lit(1)).alias("rows"))
            write_batch(bronze, bronze_root, batch_id)
            events = batch.drop("json_payload")
            silver_all, late, carry = enrich_with_carry(events, batch_id, carry_root, quality, tie_cols, slot_rows)
            obs_out = Observation(f"silver_{batch_id}")
            silver = valid_pings(silver_all).observe(obs_out, F.count(F.lit(1)).alias("rows"))
            write_batch(silver, silver_root, batch_id)
            if late_root is not None:
                write_batch(late, late_root, batch_id)
            write_carry(carry, carry_root, batch_id)
            if metrics is not None:
                metrics.add({"batch_id": batch_id, "input_rows": obs_in.get.get("rows", 0), "valid_rows": obs_out.get.get("rows", 0)})
        finally:
            batch.unpersist()

    return handle


def _offset(text: str | None) -> str | None:
    return None if text in (None, "null") else text


class StreamMetrics(StreamingQueryListener):
    """ST5: keeps the last ``keep`` progress reports (batch id, rows, rows per
    second, first and last offset of each source); ``run_stream`` attaches it
    when it is given one."""

    def __init__(self, keep: int = 1000):
        self.progress = deque(maxlen=keep)

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.progress.append(progress_report(event.progress))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        if event.exception:
            log.error("stream failed: %s", event.exception)


def progress_report(p) -> dict:
    """One progress report of Spark as a flat row with its sources."""
    sources = [{"source": s.description, "start_offset": _offset(s.startOffset), "end_offset": _offset(s.endOffset), "rows": s.numInputRows} for s in p.sources]
    return {"batchId": p.batchId, "numInputRows": p.numInputRows, "processedRowsPerSecond": p.processedRowsPerSecond, "timestamp": p.timestamp, "sources": sources}


PROGRESS = "batch_id long, input_rows long, rows_per_second double, reported_at string, source string, start_offset string, end_offset string"


def progress_table(spark: SparkSession, reports) -> DataFrame:
    """ST5 / ST2: progress reports (of a listener, or ``recentProgress`` of a
    query by ``progress_report``) as rows, one per batch and source, so that
    rate limits can be checked and kept beside the data."""
    rows = [(r["batchId"], s["rows"], r["processedRowsPerSecond"], r["timestamp"], s["source"], s["start_offset"], s["end_offset"]) for r in reports for s in r["sources"]]
    return spark.createDataFrame(rows, PROGRESS)


def run_stream(
    stream: DataFrame,
    bronze_root: str,
    silver_root: str,
    carry_root: str,
    checkpoint: str,
    quality: Quality = Quality(),
    tie_cols=None,
    available_now: bool = True,
    metrics: BatchMetrics | None = None,
    late_root: str | None = None,
    prepare=None,
    slot_rows: int | None = SLOT_ROWS,
    listener: StreamMetrics | None = None,
):
    """ST3 / ST4: start the Bronze/Silver stream with a checkpoint; with
    ``available_now`` it processes what is there and stops."""
    if listener is not None:
        stream.sparkSession.streams.addListener(listener)
    handler = make_batch_handler(bronze_root, silver_root, carry_root, quality, tie_cols, metrics, late_root, prepare=prepare, slot_rows=slot_rows)
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


#: Rows of a replayed file: what one task sorts.
FILE_ROWS = 500_000


def replay_as_stream(events: DataFrame, folder: str, n_files: int, order_cols=("event_time",), fmt: str = "json", shape=None) -> int:
    """ST10: lay the events out as ``n_files`` files in order for a file
    stream with ``maxFilesPerTrigger=1``; where these would have more than
    ``FILE_ROWS`` rows, as ``n_files`` slices of several files. Returns the
    files of a slice, which ``maxFilesPerTrigger`` has to be. One
    range-partitioned job writes all files in parallel, rows without an order
    key in the first one; then the files' times are set in their order, because
    the file source takes the oldest first (names only reach the driver).
    ``shape`` makes the rows that are written from ordered ones, row by row, so
    that narrow rows are sampled and sorted."""
    spark = events.sparkSession
    each = max(1, -(-events.count() // (n_files * FILE_ROWS)))
    ordered = events.repartitionByRange(n_files * each, *order_cols).sortWithinPartitions(*order_cols)
    ordered = ordered if shape is None else shape(ordered)
    ordered.write.mode("append").format(fmt).save(folder)
    fs, path = _folder(spark, folder)
    files = sorted((s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    start = int(time.time() * 1000) - 1000 * (len(files) + 1)
    for i, file in enumerate(files):
        fs.setTimes(file, start + 1000 * i, -1)
    return each


#: The file that says which folder holds each batch's Silver, and where
#: repaired batches lie (a name that Spark's listings pass over).
POINTER = "_current.json"


def _pointer(spark: SparkSession, silver_root: str) -> dict[str, str]:
    """Per batch that a repair wrote anew, its folder below ``silver_root``."""
    return json.loads(_read_text(spark, f"{silver_root}/{POINTER}") or "{}")


def read_silver(spark: SparkSession, silver_root: str) -> DataFrame:
    """Silver as the last whole repair left it: batches that it wrote anew are
    read from its own folder, so a reader that comes while the next repair
    writes sees the old state or the new one, never a part."""
    held = _pointer(spark, silver_root)
    fs, path = _folder(spark, silver_root)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    bases: dict[str, list[str]] = {}
    for b in (n.split("=")[1] for n in names if n.startswith("batch_id=")):
        folder = f"{silver_root}/{held.get(b, f'batch_id={b}')}"
        bases.setdefault(folder.rpartition("/")[0], []).append(folder)
    frames = [spark.read.option("basePath", base).parquet(*folders) for base, folders in bases.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def restart_points(silver: DataFrame, late: DataFrame) -> DataFrame:
    """(bus_id, ...) per bus with late rows: its last Silver row before the
    first of them, with its trip number. A bus without such a row has none."""
    first = late.groupBy("bus_id").agg(F.min("event_time").alias("_from"))
    before = silver.join(first.withColumnRenamed("bus_id", "_bus"), F.col("bus_id").eqNullSafe(F.col("_bus"))).where(F.col("event_time") < F.col("_from"))
    cols = [c for c in silver.columns if c != "bus_id"]
    ties = default_tie_cols(silver)
    return before.groupBy("bus_id").agg(F.max_by(F.struct(*cols), F.struct("event_time", *ties)).alias("_l")).select("bus_id", "_l.*")


def repaired_rows(spark: SparkSession, bronze_root: str, late: DataFrame, quality: Quality = Quality(), tie_cols=None, silver: DataFrame | None = None, points: DataFrame | None = None) -> DataFrame:
    """ST7: the rows, before the validity filter, of the buses that got late
    rows, computed anew from Bronze: with ``silver`` from the last Silver row
    before a bus's first late row (older Bronze is filtered away in the scan),
    else, and where there is none, from the bus's beginning. A Bronze
    ``batch_id`` rides along; the restart rows themselves are not returned.
    ``points`` are the written restart points, where they are known."""
    bronze = spark.read.parquet(bronze_root).drop("json_payload")
    ties = list(tie_cols or default_tie_cols(bronze))
    buses = late.select(F.col("bus_id").alias("_bus")).distinct()
    if silver is None:
        rows = bronze.join(buses, F.col("bus_id").eqNullSafe(F.col("_bus")), "left_semi")
        return enrich_segments(rows, quality=quality, tie_cols=ties or None)
    points = materialize(restart_points(silver, late), "late-restart") if points is None else points
    oldest = points.agg(F.count(F.lit(1)).alias("n"), F.min("event_time").alias("t")).first()
    if buses.count() == oldest.n:  # a literal, so that the scan skips files
        bronze = bronze.where(F.col("event_time").isNull() | (F.col("event_time") >= F.lit(oldest.t)))
    rows = bronze.join(buses, F.col("bus_id").eqNullSafe(F.col("_bus")), "left_semi")
    if not ties:
        cols = [c for c in bronze.columns if c != "batch_id"]
        rows = rows.withColumn(ROW_HASH, F.xxhash64(*(F.col(f"`{c}`") for c in cols)))
        points = points.withColumn(ROW_HASH, F.xxhash64(*(F.col(f"`{c}`") for c in cols)))
        ties = [ROW_HASH]
    key = lambda: F.struct("event_time", *ties)
    known = points.select(F.col("bus_id").alias("_cb"), key().alias("_ck"), (F.col("trip_seq") - 1).alias("_off"))
    rows = rows.join(known, F.col("bus_id").eqNullSafe(F.col("_cb")), "left")
    rows = rows.where(F.col("_ck").isNull() | (key() > F.col("_ck"))).drop("_cb", "_ck").withColumn(CARRY_FLAG, F.lit(False))
    carried = points.select(*(c for c in rows.columns if c in points.columns), (F.col("trip_seq") - 1).alias("_off"), F.lit(True).alias(CARRY_FLAG))
    every = enrich_segments(rows.unionByName(carried, allowMissingColumns=True), quality=quality, tie_cols=ties)
    seq = F.col("trip_seq") + F.coalesce(F.col("_off"), F.lit(0))
    every = every.withColumn("trip_seq", seq).withColumn("trip_id", F.concat_ws("_", F.col("bus_id"), F.col("trip_seq").cast("string")))
    return every.where(~F.col(CARRY_FLAG)).drop(CARRY_FLAG, "_off", *([ROW_HASH] if ROW_HASH in ties else []))


def repair_late(spark: SparkSession, bronze_root: str, late: DataFrame, quality: Quality = Quality(), tie_cols=None) -> DataFrame:
    """ST7: Silver rows of the buses that got late rows, computed anew from all
    of Bronze (the plain way, without restart points)."""
    return valid_pings(repaired_rows(spark, bronze_root, late, quality, tie_cols))


def apply_late_repair(spark: SparkSession, bronze_root: str, silver_root: str, late_root: str, carry_root: str | None = None, quality: Quality = Quality(), tie_cols=None) -> None:
    """ST7: replace the Silver rows of the buses that got late rows, from the
    first late row on, and empty the late folder; run it between two runs of
    the stream. With ``carry_root`` the newest carry of each stream gets those
    buses' new trip numbers.

    The ``batch_id`` folders that hold such rows are written, each as a whole,
    into a folder of the repair's own; one small file then turns ``read_silver``
    to it. Only after that the plain folders are replaced, for readers who know
    nothing of that file. The folders of the repair before last go."""
    fs = _folder(spark, silver_root)[0]
    folders = [s.getPath() for s in fs.listStatus(_folder(spark, late_root)[1]) if s.getPath().getName().startswith("batch_id=")]
    late = spark.read.parquet(late_root) if folders else None
    if late is None or late.isEmpty():
        return
    silver = read_silver(spark, silver_root)
    same_bus = F.col("bus_id").eqNullSafe(F.col("_bus"))
    key = F.struct("event_time", *default_tie_cols(silver))
    points = materialize(restart_points(silver, late), "late-restart")
    known = points.select(F.col("bus_id").alias("_cb"), key.alias("_ck"))
    buses = late.select(F.col("bus_id").alias("_bus")).distinct()
    buses = materialize(buses.join(known, F.col("_bus").eqNullSafe(F.col("_cb")), "left").select("_bus", "_ck"), "late-buses")
    every = materialize(repaired_rows(spark, bronze_root, late, quality, tie_cols, silver, points), "late-rows")
    fixed, behind = valid_pings(every), F.col("_ck").isNull() | (key > F.col("_ck"))
    old = silver.join(buses, same_bus).where(behind)
    touched = materialize(fixed.select("batch_id").unionByName(old.select("batch_id")).distinct(), "late-batches")
    batches = sorted(r.batch_id for r in touched.collect())  # numbers of batches
    kept = silver.join(touched, "batch_id", "left_semi").join(buses.withColumn("_hit", F.lit(True)), same_bus, "left")
    kept = kept.where(F.col("_hit").isNull() | ~behind).select(*silver.columns)
    repair = f"_repair-{uuid.uuid4().hex[:12]}"
    kept.unionByName(fixed, allowMissingColumns=True).write.partitionBy("batch_id").parquet(f"{silver_root}/{repair}")
    before = _pointer(spark, silver_root)
    written = {str(b): f"{repair}/batch_id={b}" for b in batches}
    _write_text(spark, f"{silver_root}/{POINTER}", json.dumps(before | written))
    whole = spark.read.option("basePath", f"{silver_root}/{repair}").parquet(*(f"{silver_root}/{f}" for f in written.values()))
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(silver_root)
    used = {f.split("/")[0] for f in [*before.values(), *written.values()]}
    for status in fs.listStatus(_folder(spark, silver_root)[1]):
        if status.getPath().getName().startswith("_repair-") and status.getPath().getName() not in used:
            fs.delete(status.getPath(), True)
    if carry_root is not None:
        _repair_carry(spark, carry_root, every, tie_cols)
    for folder in folders:
        fs.delete(folder, True)


def _repair_carry(spark: SparkSession, carry_root: str, every: DataFrame, tie_cols) -> None:
    """The repaired buses' last trip numbers as one more entry of the log."""
    fs, path = _folder(spark, carry_root)
    ties = list(tie_cols or default_tie_cols(every))
    last = every.groupBy(F.col("bus_id").alias("_bus")).agg(F.max_by("trip_seq", F.struct("event_time", *ties)).alias("_trip"))
    for stream in fs.listStatus(path):
        own = stream.getPath().toString()
        newest = max(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(stream.getPath()) if s.getPath().getName().startswith("batch_id="))
        version = _carry_version(spark, own, newest)
        old = _newest(_rows_of(spark, own, version))
        moved = old.join(last, F.col("bus_id").eqNullSafe(F.col("_bus"))).withColumn("trip_seq", F.col("_trip")).select(*old.columns)
        entry = {"path": f"rows/repair-{uuid.uuid4().hex[:12]}", "seq": 2 * newest + 1}
        moved.write.parquet(f"{own}/{entry['path']}")
        _write_version(spark, own, newest, {**version, "log": [*version["log"], entry]})


def stream_hourly(stream: DataFrame, watermark: str = "1 hour", minutes: int = 60) -> DataFrame:
    """ST11: hourly totals on a stream with a watermark for late data
    (append mode emits a window once the watermark passes it)."""
    return (
        stream.withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", f"{minutes} minutes"), "route_id")
        .agg(F.count(F.lit(1)).alias("pings"), F.approx_count_distinct("bus_id").alias("approx_buses"))
    )
