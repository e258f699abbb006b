"""Carry log, late repair and readers beside it, lookups by day and bus
(ST6, ST7, S11, R10)."""

import datetime as dt
import glob
import os
import random
import tempfile

from pyspark.sql import functions as F

from fleetlens.streaming import stream as S

T0 = dt.datetime(2024, 1, 1, 10)
SCHEMA = "event_time timestamp, bus_id string, route_id string, latitude double, longitude double, speed_kmh double, event_id long, copy_no int"


def _row(bus, minute, event_id):
    return (T0 + dt.timedelta(minutes=minute), bus, "R1", 10.0, 106.0, 5.0, event_id, 0)


def test_carry_log_follows_the_batch(spark, monkeypatch):
    """What a batch writes is its own buses and one part of the fleet; every
    bus goes on with its last row, however long ago that was."""
    monkeypatch.setattr(S, "CARRY_PARTS", 3)
    root, rng, last, silver = tempfile.mkdtemp(prefix="fl-log-"), random.Random(1), {}, []
    every = []
    for batch in range(10):
        buses = rng.sample(range(12), 3 if batch else 12)
        rows = [_row(f"B{b}", batch * 10 * (1 + b % 2), batch * 100 + b) for b in buses]
        every += rows
        out, late, carry = S.enrich_with_carry(spark.createDataFrame(rows, SCHEMA), batch, root)
        assert late.count() == 0
        silver += out.select("event_id", "trip_seq").collect()
        S.write_carry(carry, root, batch)
        last |= {f"B{b}": batch * 100 + b for b in buses}
        assert spark.read.parquet(f"{root}/query_id=none/rows/log-{batch}").count() == len(buses)
        assert len(glob.glob(f"{root}/query_id=none/batch_id=*")) <= S.KEEP_CARRIES
    carried = S._read_carry(spark, root, 10)
    assert {r.bus_id: r.event_id for r in carried.collect()} == last and carried.count() == 12
    # Folders that no kept version names are gone.
    assert len(os.listdir(f"{root}/query_id=none/rows")) <= 3 * (S.KEEP_CARRIES + 1) + 2 * S.KEEP_CARRIES
    whole = S.enrich_segments(spark.createDataFrame(every, SCHEMA)).select("event_id", "trip_seq").collect()
    assert sorted(map(tuple, silver)) == sorted(map(tuple, whole))
    # A batch that is tried again reads the same version and gives the same.
    again = S.enrich_with_carry(spark.createDataFrame(rows, SCHEMA), 9, root)[0]
    assert sorted(map(tuple, again.select("event_id", "trip_seq").collect())) == sorted(map(tuple, silver))[-3:]


def _batch(spark, root, batch, rows):
    """One micro-batch as the handler writes it."""
    df = spark.createDataFrame(rows, SCHEMA)
    S.write_batch(df, f"{root}/bronze", batch)
    out, late, carry = S.enrich_with_carry(df, batch, f"{root}/carry")
    S.write_batch(S.valid_pings(out), f"{root}/silver", batch)
    S.write_batch(late, f"{root}/late", batch)
    S.write_carry(carry, f"{root}/carry", batch)


def _rows_of(df):
    return sorted((r.event_id, r.trip_id, r.prev_event_time, r.batch_id) for r in df.collect())


def test_readers_see_a_repair_as_a_whole(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="fl-repair-")
    rng = random.Random(5)
    rows = [_row(f"B{i % 4}", 3 * i + 40 * (i // 11), i) for i in range(60)]
    late = [rows.pop(i) for i in sorted(rng.sample(range(20, 50), 5), reverse=True)]
    _batch(spark, root, 0, rows[:20])
    _batch(spark, root, 1, rows[20:40])
    _batch(spark, root, 2, rows[40:])
    _batch(spark, root, 3, late[:3])
    before = _rows_of(S.read_silver(spark, f"{root}/silver"))
    assert len(before) == 55 and spark.read.parquet(f"{root}/late").count() == 3
    seen, write = [], S._write_text

    def watch(spark, path, text):
        if path.endswith(S.POINTER):  # all is written, nothing is turned yet
            seen.append(_rows_of(S.read_silver(spark, f"{root}/silver")))
        write(spark, path, text)
        if path.endswith(S.POINTER):
            seen.append(_rows_of(S.read_silver(spark, f"{root}/silver")))

    monkeypatch.setattr(S, "_write_text", watch)
    repair = lambda: S.apply_late_repair(spark, f"{root}/bronze", f"{root}/silver", f"{root}/late", f"{root}/carry")
    repair()
    plain = lambda: _rows_of(spark.read.parquet(f"{root}/silver"))
    want = lambda rows: sorted((r.event_id, r.trip_id, r.prev_event_time) for r in S.enrich_segments(spark.createDataFrame(rows, SCHEMA)).collect())
    assert seen[0] == before and seen[1] == plain() == _rows_of(S.read_silver(spark, f"{root}/silver"))
    assert [r[:3] for r in plain()] == want(rows + late[:3])
    assert not glob.glob(f"{root}/late/batch_id=*")
    repair()  # nothing left to do
    # The stream goes on from the repaired trips, and is repaired again.
    more = [_row("B1", 400 + i, 100 + i) for i in range(3)]
    _batch(spark, root, 4, more + late[3:])
    repair()
    assert [r[:3] for r in plain()] == want(rows + late + more)
    assert len(glob.glob(f"{root}/silver/_repair-*")) <= 2
    assert sorted({r[3] for r in plain()}) == [0, 1, 2, 3, 4]


def test_repair_reads_bronze_from_the_restart_on(spark):
    root = tempfile.mkdtemp(prefix="fl-restart-")
    _batch(spark, root, 0, [_row("B1", i, i) for i in range(30)])
    _batch(spark, root, 1, [_row("B1", 100, 100)])
    late = spark.createDataFrame([_row("B1", 50, 50)], SCHEMA)
    S.write_batch(late, f"{root}/bronze", 2)
    silver = spark.read.parquet(f"{root}/silver")
    points = S.restart_points(silver, late).collect()
    assert [r.event_id for r in points] == [29]
    got = S.repaired_rows(spark, f"{root}/bronze", late, silver=silver)
    assert sorted((r.event_id, r.trip_seq) for r in got.collect()) == [(50, 2), (100, 3)]
    assert "GreaterThanOrEqual(event_time" in got._jdf.queryExecution().executedPlan().toString()


def test_trip_points_skip_folders_and_row_groups(spark):
    from fleetlens.registry import _laid_out
    from fleetlens.settings import REPORT_TIMEZONE
    from fleetlens.sources.tables import trip_points

    silver, top = _laid_out(spark, "/root/testdata/sf0.001")
    few = top.limit(2)
    got = trip_points(silver, few, REPORT_TIMEZONE)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "event_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(bus_id, [" in plan or "EqualTo(bus_id," in plan
    ids = [r.trip_id for r in few.collect()]
    assert sorted(map(str, got.collect())) == sorted(map(str, silver.where(F.col("trip_id").isin(ids)).select(*got.columns).collect()))


def test_gold_files_are_in_order(spark):
    import pyarrow.parquet as pq

    from fleetlens.plans import flows
    from fleetlens.sources.sinks import write_gold

    root = tempfile.mkdtemp(prefix="fl-gold-")
    write_gold(flows.gold_tables(spark, "/root/testdata/sf0.001"), root)
    files = glob.glob(f"{root}/**/*.parquet", recursive=True)
    assert files
    for f in files:
        rows = pq.ParquetFile(f).read()
        column = next((c for c in ("event_hour", "trip_start") if c in rows.column_names), None)
        if column is not None:
            values = rows.column(column).to_pylist()
            assert values == sorted(values)


def test_repair_works_out_restart_points_once(spark, monkeypatch):
    root, calls, points = tempfile.mkdtemp(prefix="fl-once-"), [], S.restart_points
    _batch(spark, root, 0, [_row("B1", i, i) for i in range(30)])
    _batch(spark, root, 1, [_row("B1", 100, 100)])
    _batch(spark, root, 2, [_row("B1", 50, 50)])
    monkeypatch.setattr(S, "restart_points", lambda *a: calls.append(1) or points(*a))
    S.apply_late_repair(spark, f"{root}/bronze", f"{root}/silver", f"{root}/late", f"{root}/carry")
    assert len(calls) == 1
    assert sorted((r.event_id, r.trip_seq) for r in S.read_silver(spark, f"{root}/silver").where("event_id > 28").collect()) == [(29, 1), (50, 2), (100, 3)]
