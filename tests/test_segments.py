"""Segments, trips and the skew-safe scan (F4, F5, F6, ST9, W1, W2)."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlens.operators.segments import build_silver, enrich_segments
from fleetlens.plans import flows

#: Rows of a bus that stay in one task: plain window, no bus cut, all cut.
CUTS = (None, 1_000_000, 1, 2)
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _rows(spark, rows):
    schema = "event_time timestamp, bus_id string, route_id string, latitude double, longitude double, speed_kmh double, event_id long, copy_no int"
    return spark.createDataFrame(rows, schema)


def test_trip_gap_rule_and_null_flags(spark):
    rows = [
        (T0, "B1", "R1", 10.0, 106.0, 5.0, 1, 0),
        (T0 + dt.timedelta(minutes=10), "B1", "R1", 10.001, 106.0, 5.0, 2, 0),  # same trip
        (T0 + dt.timedelta(minutes=30), "B1", "R1", 10.002, 106.0, 5.0, 3, 0),  # gap 20 min > 15: new
        (T0 + dt.timedelta(minutes=31), "B1", "R2", 10.003, 106.0, 5.0, 4, 0),  # route change: new
        (T0 + dt.timedelta(minutes=32), "B1", None, 10.004, 106.0, 5.0, 5, 0),  # NULL route: same
    ]
    for slot_rows in CUTS:
        out = enrich_segments(_rows(spark, rows), slot_rows=slot_rows).orderBy("event_id").collect()
        assert [r.trip_seq for r in out] == [1, 1, 2, 3, 3]
        assert out[0].is_duplicate is None and out[0].is_outlier is None  # F4
        assert out[0].segment_distance_m == 0.0 and out[0].segment_duration_s is None


def test_equal_times_use_rows_frame(spark):
    # equal timestamps must not share the largest trip number.
    rows = [(T0, "B1", "R1", 10.0, 106.0, 0.0, i, 0) for i in range(4)]
    rows[2] = (T0, "B1", "R2", 10.0, 106.0, 0.0, 2, 0)
    for slot_rows in CUTS:
        out = enrich_segments(_rows(spark, rows), slot_rows=slot_rows).orderBy("event_id").collect()
        assert [r.trip_seq for r in out] == [1, 1, 2, 3]


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cut_scan_equals_window_with_hot_bus(spark):
    # One bus holds most rows and is cut into many slots.
    base = flows.bronze(spark, "/root/testdata/sf0.001")
    hot = base.withColumn("bus_id", F.when(F.col("event_id") % 3 != 0, F.lit("HOT")).otherwise(F.col("bus_id")))
    a = enrich_segments(hot, slot_rows=None)
    assert a.count() == hot.count()
    for slot_rows in (1, 20, 300):
        _same(a, enrich_segments(hot, slot_rows=slot_rows))


def test_cut_scan_of_one_instant_and_of_null_times(spark):
    # Neither can be cut by time: the tie column cuts them. A NULL bus is one.
    base = flows.bronze(spark, "/root/testdata/sf0.001")
    time = F.when(F.col("event_id") % 3 == 0, F.lit(None)).when(F.col("event_id") % 3 == 1, F.lit("2025-03-20 10:00:00.25")).otherwise(F.col("event_time"))
    rows = base.withColumns({"event_time": time.cast("timestamp"), "bus_id": F.when(F.col("event_id") % 5 != 0, F.lit("HOT")), "route_id": F.when(F.col("event_id") % 7 == 0, F.lit("7")).otherwise(F.lit("8"))})
    _same(enrich_segments(rows, slot_rows=None), enrich_segments(rows, slot_rows=30))


def test_cut_scan_spreads_a_hot_bus(spark):
    """No window group is larger than the bound, or much so where time and tie
    columns are uneven."""
    from fleetlens.plans import ordered_scan as S

    hot = flows.bronze(spark, "/root/testdata/sf0.001").withColumn("bus_id", F.lit("HOT"))
    order = ["event_time", "event_id", "copy_no"]
    cuts = S._cuts(hot, "bus_id", order, 40)
    sizes = [r["count"] for r in S._with_slot(hot, "bus_id", order, cuts).groupBy("bus_id", S.SLOT).count().collect()]
    assert sum(sizes) == hot.count() and len(sizes) > hot.count() / 80 and max(sizes) <= 40
    total = S.ordered_scan(hot, "bus_id", order, [], slot_rows=40, total=True)
    assert total.select(S.TOTAL).distinct().collect() == [(hot.count(),)]
    assert total.agg(F.countDistinct(S.IDX)).first()[0] == hot.count() == total.agg(F.max(S.IDX)).first()[0] + 1


def test_fixture_figures(spark):
    s = flows.silver(spark, "/root/testdata/sf0.001")
    assert s.count() == 1013
    assert s.select("trip_id").distinct().count() == 262


def test_scan_shuffles_its_rows_once_and_keeps_no_cache(spark, monkeypatch):
    from fleetlens.plans import ordered_scan

    def no_table(df, name):
        raise AssertionError(f"stores {name}")

    monkeypatch.setattr(ordered_scan, "materialize", no_table)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    s = flows.silver_all(spark, "/root/testdata/sf0.001")
    assert s.count() > 0
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Exchange hashpartitioning(bus_id") == 1
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_flags_can_drop_rows(spark):
    rows = [(T0, "B1", "R1", 10.0, 106.0, 5.0, 1, 0), (T0, "B1", "R1", 10.0, 106.0, 5.0, 2, 0), (T0 + dt.timedelta(minutes=1), "B1", "R1", 11.0, 106.0, 5.0, 3, 0)]
    ids = lambda **kw: sorted(r.event_id for r in build_silver(_rows(spark, rows), **kw).collect())
    assert ids() == [1, 2, 3] and ids(drop_duplicates=True) == [1, 3] and ids(drop_outliers=True) == [1]
