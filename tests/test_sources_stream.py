"""Raw readers, schema mapping and stream-equals-batch (S1-S6, N1-N5, ST6)."""

import json
import tempfile

import pytest

from fleetlens.operators.normalize import map_schema
from fleetlens.sources.raw import read_json_flexible, read_mapped, read_raw


def test_json_shapes(spark):
    d = tempfile.mkdtemp(prefix="fl-json-")
    rows = [{"msgBusWayPoint": {"vehicle": f"B{i}", "datetime": i, "x": 106.0 + i / 10, "y": 10.0 + i / 10}} for i in (1, 2, 3)]
    open(f"{d}/pretty.json", "w").write(json.dumps(rows, indent=2))
    open(f"{d}/oneline.json", "w").write(json.dumps(rows))
    open(f"{d}/lines.json", "w").write("\n".join(json.dumps(r) for r in rows) + "\nnot json\n")
    open(f"{d}/empty.json", "w").write("")
    df = read_json_flexible(spark, d)
    got = sorted(r["vehicle"] for r in df.select("msgBusWayPoint.vehicle").collect())
    assert got == sorted(["B1", "B2", "B3"] * 3)


def test_map_schema_columns_and_errors(spark):
    d = tempfile.mkdtemp(prefix="fl-csv-")
    open(f"{d}/a.csv", "w").write("timestamp,vehicle_id,route,lat,lon,speed,heading\n2024-01-01T10:00:00Z,B01,R01,10.1,106.1,30,45\n")
    ev = read_mapped(spark, d)
    assert ev.columns == ["event_time", "bus_id", "route_id", "latitude", "longitude", "speed_kmh", "heading", "source_file"]
    r = ev.first()
    assert r.bus_id == "B01" and r.latitude == 10.1 and str(r.event_time) == "2024-01-01 10:00:00"
    bad = spark.createDataFrame([("x",)], "foo string")
    with pytest.raises(ValueError):
        map_schema(bad)
    assert read_raw(spark, d).count() == 1


def _files(**texts):
    d = tempfile.mkdtemp(prefix="fl-raw-")
    for name, text in texts.items():
        open(f"{d}/{name.replace('__', '.')}", "w").write(text)
    return d


def test_csv_files_with_their_own_headers(spark):
    d = _files(a__csv="timestamp,vehicle_id,lat,lon\n2024-01-01T10:00:00Z,B1,10.1,106.1\n", b__CSV="\ufefflon,vehicle_id,timestamp,lat,extra\n106.2,B2,2024-01-01T11:00:00Z,10.2,x\n106.3,B3,,10.3,y\n", c__csv="")
    rows = sorted((r.bus_id, r.latitude, r.longitude, r.event_time is None) for r in read_mapped(spark, d).collect())
    assert rows == [("B1", 10.1, 106.1, False), ("B2", 10.2, 106.2, False), ("B3", 10.3, 106.3, True)]
    assert {"extra", "vehicle_id"} <= set(read_raw(spark, d).columns)


def test_json_of_one_shape_only(spark):
    """Each shape alone in its folder: pretty array, compact array over
    lines, pretty object; a stray bracket costs no other line."""
    one = {"ts": 1704103200, "bus_id": "B1", "lat": 1.5, "lon": 2.5}
    for text in (json.dumps([one, one], indent=2), "[" + json.dumps(one) + ",\n" + json.dumps(one) + "]", " \n[" + json.dumps(one) + ", " + json.dumps(one) + "]"):
        assert [r.bus_id for r in read_mapped(spark, _files(x__json=text)).collect()] == ["B1", "B1"]
    assert read_mapped(spark, _files(x__json=json.dumps(one, indent=2))).count() == 1
    lines = [json.dumps(one)] * 100
    lines[50:50] = ["}", "not json", "["]
    assert read_mapped(spark, _files(x__json="\n".join(lines))).count() == 100


def test_json_files_with_their_own_names(spark):
    d = _files(a__json='{"ts": "2024-01-01T10:00:00Z", "lat": 1, "lon": 2, "plate": "B1"}', b__json='{"time": "2024-01-01T10:00:00Z", "latitude": 3, "longitude": 4, "imei": "B2"}\n{"time": 1e306, "latitude": 5, "longitude": 6, "imei": "B3"}')
    got = sorted((r.bus_id, r.latitude, r.longitude, r.event_time is None) for r in read_mapped(spark, d).collect())
    assert got == [("B1", 1.0, 2.0, False), ("B2", 3.0, 4.0, False), ("B3", 5.0, 6.0, True)]


def test_parquet_files_with_other_columns_and_types(spark):
    d = tempfile.mkdtemp(prefix="fl-pq-")
    spark.sql("select '2024-01-01T10:00:00Z' ts, 'B1' bus_id, 1.5D lat, 2.5D lon").write.parquet(f"{d}/a")
    spark.sql("select '2024-01-01T10:00:00Z' ts, 'B2' bus_id, 1.5D lat, 2.5D lon, 9.0D speed").write.parquet(f"{d}/b")
    got = {r.bus_id: r.speed_kmh for r in read_mapped(spark, d).collect()}
    assert got == {"B1": None, "B2": 9.0}
    spark.sql("select '2024-01-01T10:00:00Z' ts, 'B3' bus_id, '3.5' lat, 2.5D lon").write.parquet(f"{d}/c")
    assert {r.bus_id: r.latitude for r in read_mapped(spark, d).collect()} == {"B1": 1.5, "B2": 1.5, "B3": 3.5}


def test_the_plan_grows_with_layouts_and_broken_files_are_left_out(spark):
    from fleetlens.sources.raw import read_parquet, rejected_records, wider

    d = tempfile.mkdtemp(prefix="fl-layouts-")
    spark.range(100).repartition(7).write.parquet(f"{d}/a")
    spark.range(100).selectExpr("cast(id as string) id").repartition(6).write.parquet(f"{d}/b")
    open(f"{d}/broken.parquet", "w").write("no parquet")
    df = read_parquet(spark, d)
    assert df.count() == 200 and df.schema["id"].dataType.simpleString() == "string"
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert [(r.reason, r.scope) for r in rejected_records(spark, d).collect()] == [("no readable footer", "file")]
    assert [wider(k) for k in (["int32", "int64"], ["int32", "float"], ["int8", "float"], ["double", "int16"], ["date32[day]", "timestamp[us, tz=UTC]"], ["bool", "int32"], ["string", "int64"])] == ["bigint", "double", "float", "double", "timestamp", "string", "string"]


def test_json_in_other_modes_and_with_odd_names(spark):
    text = '{"a b": 1, "c.d": {"x`y": [1, 2]}, "e": null}\n17\n{"a b": 2.5}\nnope\n'
    d = _files(x__json=text)
    df = read_json_flexible(spark, d)
    assert df.columns == ["a b", "c.d", "e", "source_file"] and sorted(r["a b"] for r in df.collect()) == [1.0, 2.5]
    assert read_json_flexible(spark, d, "PERMISSIVE").count() == 4
    with pytest.raises(Exception, match="malformed JSON record"):
        read_json_flexible(spark, d, "FAILFAST").collect()
    from fleetlens.sources.raw import raw_file_columns

    assert sorted(r.column_name for r in raw_file_columns(spark, d).collect()) == ["a b", "c.d.x`y", "e"]


def test_event_cache_and_point_sources(spark):
    from fleetlens.sources.tables import read_event_cache, resolve_points

    good = _files(x__json='{"event_time": "2024-01-01T10:00:00Z", "bus_id": "B1", "latitude": 1.0, "longitude": 2.0}')
    bad = _files(x__json='{"foo": 1}')
    assert read_event_cache(spark, good).count() == 1
    with pytest.raises(ValueError):
        read_event_cache(spark, bad)
    raw = _files(a__csv="timestamp,vehicle_id,lat,lon\n2024-01-01T10:00:00Z,B9,10.1,106.1\n")
    nowhere = f"{raw}/nothing"
    assert resolve_points(spark, nowhere, good, raw)[0] == "cache"
    kind, rows = resolve_points(spark, nowhere, bad, raw)
    assert kind == "raw" and rows.first().bus_id == "B9"
    with pytest.raises(FileNotFoundError):
        resolve_points(spark, nowhere, nowhere, nowhere)


def test_file_health(spark):
    from fleetlens.operators.profile import file_health

    d = _files(a__json='{"a": 1}\n}\nnot json\n{"a": 2}\n', b__json="[{\"a\": 1},\n{\"a\": 2}]", c__json="[{", d__json="", e__csv="x,y\n1,2\n", f__csv="\n")
    got = {r.source_file[-6:]: (r.lines, r.bad_lines, r.error, r.empty) for r in file_health(spark, d).collect()}
    assert got == {
        "a.json": (4, 2, None, False),
        "b.json": (2, 0, None, False),
        "c.json": (1, 0, "not JSON", False),
        "d.json": (0, 0, None, True),
        "/e.csv": (2, 0, None, False),
        "/f.csv": (0, 0, None, True),
    }


WIRE = "key string, value string, partition int, offset long"


def _wire(rows):
    """(offset, second, route) of bus B1 -> wire rows."""
    event = lambda s, r: json.dumps({"event_time": f"2024-01-01T10:00:{s:02d}.000000Z", "bus_id": "B1", "route_id": r, "latitude": 10.0 + s / 1e4, "longitude": 106.0})
    return [("B1", event(s, r), 0, o) for o, s, r in rows]


def _run(spark, root, checkpoint="checkpoint"):
    from fleetlens.streaming.stream import BatchMetrics, StreamMetrics, read_ping_stream, run_stream, wire_events

    metrics, listener = BatchMetrics(), StreamMetrics()
    stream = read_ping_stream(spark, f"{root}/in", "json", schema=WIRE, max_files_per_trigger=1)
    try:
        run_stream(stream, f"{root}/bronze", f"{root}/silver", f"{root}/carry", f"{root}/{checkpoint}", metrics=metrics, late_root=f"{root}/late", prepare=wire_events, listener=listener).awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    return metrics


def _feed(spark, root, rows):
    import time

    spark.createDataFrame(_wire(rows), WIRE).coalesce(1).write.mode("append").json(f"{root}/in")
    time.sleep(1.1)  # the file source orders by whole seconds


def test_wire_stream_across_batches_and_restart(spark):
    root = tempfile.mkdtemp(prefix="fl-wire-")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    _feed(spark, root, [(1, 1, "R1"), (2, 5, "R1")])
    _feed(spark, root, [(3, 5, "R2"), (4, 5, "R2")])  # the carried second again
    _run(spark, root)
    spark.createDataFrame([("k", "no json", 0, 9)], WIRE).coalesce(1).write.mode("append").json(f"{root}/in")  # an empty batch
    _feed(spark, root, [(5, 7, "R2"), (6, 3, "R9")])  # one late row
    _run(spark, root)  # a restart from the checkpoint
    got = [(r.offset, r.trip_id) for r in spark.read.parquet(f"{root}/silver").orderBy("offset").collect()]
    assert got == [(1, "B1_1"), (2, "B1_1"), (3, "B1_2"), (4, "B1_2"), (5, "B1_2")]
    assert [r.offset for r in spark.read.parquet(f"{root}/late").collect()] == [6]
    assert spark.read.parquet(f"{root}/bronze").count() == 6
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    import glob

    assert 1 <= len(glob.glob(f"{root}/carry/query_id=*/batch_id=*")) <= 3
    with pytest.raises(Exception, match="another stream"):
        _run(spark, root, "checkpoint2")
    from fleetlens.streaming.stream import apply_late_repair

    apply_late_repair(spark, f"{root}/bronze", f"{root}/silver", f"{root}/late", f"{root}/carry")
    got = [(r.offset, r.trip_id) for r in spark.read.parquet(f"{root}/silver").orderBy("offset").collect()]
    assert got == [(1, "B1_1"), (2, "B1_3"), (3, "B1_4"), (4, "B1_4"), (5, "B1_4"), (6, "B1_2")]


def test_rows_without_a_key_in_the_carried_second(spark):
    import datetime as dt

    from fleetlens.streaming.stream import enrich_with_carry, write_carry

    root = tempfile.mkdtemp(prefix="fl-carry-")
    t = dt.datetime(2024, 1, 1, 10)
    schema = "event_time timestamp, bus_id string, route_id string, latitude double, longitude double, speed_kmh double"
    first = spark.createDataFrame([(t, "B1", "R1", 1.0, 2.0, 3.0)], schema)
    for _ in range(2):  # a retried batch gives the same
        silver, late, carry = enrich_with_carry(first, 0, root)
        assert silver.count() == 1 and late.count() == 0
        write_carry(carry, root, 0)
    second = spark.createDataFrame([(t, "B1", "R1", 1.0, 2.0, x) for x in (3.0, 4.0, 5.0)] + [(t - dt.timedelta(seconds=1), "B1", "R1", 1.0, 2.0, 6.0), (None, "B1", "R1", 1.0, 2.0, 7.0)], schema)
    silver, late, _ = enrich_with_carry(second, 1, root)
    assert sorted(r.speed_kmh for r in silver.collect()) == [3.0, 4.0, 5.0, 7.0] and [r.speed_kmh for r in late.collect()] == [6.0]


def test_replay_keeps_rows_without_an_order_key(spark):
    from fleetlens.streaming.stream import replay_as_stream

    root = tempfile.mkdtemp(prefix="fl-replay-")
    rows = spark.range(110).selectExpr("if(id < 10, null, id) k", "id")
    replay_as_stream(rows, f"{root}/x", 4, order_cols=("k",))
    assert spark.read.json(f"{root}/x").count() == 110


def test_stream_equals_batch(spark):
    from fleetlens.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    batch = QUERIES["valid_pings"](spark, sf)
    for name in ("stream_silver", "stream_late_repair"):
        a = QUERIES[name](spark, sf).select(*batch.columns)
        assert a.count() == batch.count()
        assert a.exceptAll(batch).count() == 0 and batch.exceptAll(a).count() == 0


def test_replay_slices_are_files_of_bounded_rows(spark, monkeypatch):
    """A task sorts so many rows as a file may have, not a whole slice; the
    files' times follow the order, and rows are shaped after the sort."""
    import glob
    import os

    from fleetlens.streaming import stream as S

    monkeypatch.setattr(S, "FILE_ROWS", 100, raising=False)
    root = tempfile.mkdtemp(prefix="fl-slices-")
    rows = spark.range(1000).selectExpr("id k")
    each = S.replay_as_stream(rows, f"{root}/x", 2, order_cols=("k",), shape=lambda df: df.selectExpr("k", "concat('row ', k) text"))
    files = sorted(glob.glob(f"{root}/x/part-*.json"), key=os.path.getmtime)
    assert each == 5 and len(files) == 10
    held = [[json.loads(line) for line in open(f)] for f in files]
    assert [r["k"] for rows in held for r in rows] == list(range(1000))
    assert max(map(len, held)) <= 250 and held[0][0]["text"] == "row 0"


def test_rows_of_a_few_large_files_do_not_meet_by_file(spark):
    """What is known of a file is a small table of known size: neither JSON
    lines nor mapped rows are shuffled by file name for it."""
    from fleetlens.sources.raw import json_records

    d = tempfile.mkdtemp(prefix="fl-byfile-")
    for name in "ab":
        with open(f"{d}/{name}.json", "w") as f:
            f.write("\ufeff" if name == "a" else "")
            f.writelines(json.dumps({"imei": f"B{i}", "time": i, "longitude": 106.0, "latitude": 10.0}) + "\n" for i in range(50))
            f.write(' \t{"imei": "B9"}\n[1, 2]\n7\n"{"\nnot json\n')
    records = json_records(spark, d)
    found = sorted((r.error or "", r.n) for r in records.groupBy("error").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect())
    assert found == [("", 102), ("not JSON", 2), ("not an object", 6)]
    for df in (records, read_mapped(spark, d)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert read_mapped(spark, d).where("event_time is not null").count() == 100
