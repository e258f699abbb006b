"""Map-ready trip and route geometry (M3, W5-W8, D15, D16, A14-A18, R8, R9,
A23, A24, J9-J11, U3).

Only the ranked trips (a ``limit`` result, so a bounded broadcast) are
drawn. Their points are de-duplicated by aggregation, indexed per trip with
the skew-safe ordered scan, and thinned to at most ``max_points`` per trip;
after thinning every group is bounded by ``max_points``, so the windows and
``collect_list`` calls below never hold an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.routes import normalize_route_id
from ..plans.ordered_scan import IDX, SLOT_ROWS, TOTAL, ordered_scan
from ..session import materialize
from ..settings import BUCKET_MINUTES, MAX_POINTS_PER_TRIP, REPORT_TIMEZONE, Emission

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def rank_trips(ranked: DataFrame) -> DataFrame:
    """One row per ``trip_id`` (the first in rank order) from a ranked
    trip list that may repeat a trip (F23). Input needs ``rank`` (1-based)."""
    w = Window.partitionBy("trip_id").orderBy("rank")
    return ranked.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_rank(top: DataFrame, order_cols) -> DataFrame:
    """Attach the 1-based rank of a bounded top-k list (at most k rows)."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order_cols)))


def focus_points(silver: DataFrame, trips: DataFrame, timezone: str = REPORT_TIMEZONE, tie_cols: list[str] | None = None) -> DataFrame:
    """Points of the chosen trips, complete rows only,
    local time, route normalized, and repeated (time, position) removed per
    trip (the copy kept is the first by tie key)."""
    ties = [c for c in (tie_cols or ["event_id", "copy_no"]) if c in silver.columns]
    cols = ["trip_id", "event_time", "latitude", "longitude", "speed_kmh", "route_id", *ties]
    pts = silver.select(*cols).join(F.broadcast(trips.select("trip_id").distinct()), "trip_id", "left_semi")
    pts = pts.dropna(subset=["event_time", "trip_id", "latitude", "longitude"])
    tie = F.struct(*[F.col(c) for c in ties]) if ties else F.lit(0)
    dedup = pts.groupBy("trip_id", "event_time", "latitude", "longitude").agg(
        F.min_by(F.struct("speed_kmh", "route_id"), tie).alias("_v"), F.min(tie).alias("_tie")
    )
    return dedup.select(
        "trip_id",
        "event_time",
        F.from_utc_timestamp("event_time", timezone).alias("event_time_local"),
        "latitude",
        "longitude",
        F.col("_v.speed_kmh").alias("speed_kmh"),
        normalize_route_id(F.col("_v.route_id")).alias("route_id"),
        "_tie",
    )


def is_kept(i: Column, n: Column, m: int) -> Column:
    """M3: whether index ``i`` of ``n`` points stays when thinning to at most
    ``m``: all when n <= m; both ends when m <= 2; else the indexes
    ``bround(j*(n-1)/(m-1))`` for j in 0..m-1 (half-even, as the reference's
    ``round``). The only ``j`` that can reach ``i`` are next to i / step."""
    if m <= 2:
        return (n <= m) | (i == 0) | (i == n - 1)
    step = (n - 1).cast("double") / F.lit(float(m - 1))
    near = F.floor(i.cast("double") / step)
    reach = lambda j: (j >= 0) & (j < m) & (F.least(F.bround(j.cast("double") * step, 0).cast("long"), (n - 1).cast("long")) == i)
    return (n <= m) | reach(near - 1) | reach(near) | reach(near + 1) | reach(near + 2)


def keep_indexes(n: Column | str, m: int) -> Column:
    """All indexes of ``n`` points that stay (see ``is_kept``), in order."""
    n = (F.col(n) if isinstance(n, str) else n).cast("long")
    return F.filter(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: is_kept(i, n, m))


def thin_trips(points: DataFrame, max_points: int = MAX_POINTS_PER_TRIP, slot_rows: int | None = SLOT_ROWS) -> DataFrame:
    """M3 + W5: index points per trip (ordered by time then tie key), keep
    the evenly spaced indexes; adds ``point_idx``, ``point_count_raw``,
    ``view_idx`` and ``point_count_view``."""
    indexed = ordered_scan(points, key="trip_id", order=["event_time", "_tie"], carry=[], slot_rows=slot_rows, total=True)
    indexed = indexed.withColumnsRenamed({IDX: "point_idx", TOTAL: "point_count_raw"})
    # Kept indexes lie more than one apart on average, so all m are distinct.
    view = F.least(F.col("point_count_raw"), F.lit(max(2, max_points)))
    kept = indexed.where(is_kept(F.col("point_idx"), F.col("point_count_raw"), max_points)).withColumn("point_count_view", view.cast("long"))
    w = Window.partitionBy("trip_id").orderBy("point_idx")
    return kept.withColumn("view_idx", (F.row_number().over(w) - 1).cast("long"))


def bucket_start(c: str, minutes: int = BUCKET_MINUTES) -> F.Column:
    """ST8: floor of a (local) timestamp to ``minutes``."""
    step = int(minutes) * 60 * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(F.col(c)) / F.lit(step)).cast("long") * F.lit(step))


def map_segments(thinned: DataFrame, trips: DataFrame, emission: Emission = Emission(), minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Segments between consecutive kept points. Idle only
    when the speed is known and <= 1 (unlike Gold, F7). ``trips`` gives the
    trip's route and name (its Gold row)."""
    w = Window.partitionBy("trip_id").orderBy("view_idx")
    seg = (
        thinned.withColumn("lat1", F.lag("latitude").over(w))
        .withColumn("lon1", F.lag("longitude").over(w))
        .withColumn("t1", F.lag("event_time_local").over(w))
        .filter(F.col("view_idx") > 0)
        .withColumnRenamed("latitude", "lat2")
        .withColumnRenamed("longitude", "lon2")
    )
    dist = haversine_km("lat1", "lon1", "lat2", "lon2")
    minutes_ = F.greatest((F.unix_micros("event_time_local") - F.unix_micros("t1")).cast("double") / F.lit(60_000_000.0), F.lit(0.0))
    speed = F.col("speed_kmh")
    idle = F.when(speed.isNotNull() & ~F.isnan(speed) & (speed <= F.lit(float(emission.idle_speed_kmh))), minutes_).otherwise(F.lit(0.0))
    seg = seg.withColumn("distance_km", dist).withColumn("duration_min", minutes_).withColumn("idle_min", idle)
    seg = seg.withColumn(
        "co2_kg_est",
        (F.col("distance_km") * float(emission.fuel_liter_per_km) + F.col("idle_min") * float(emission.idle_liter_per_minute))
        * float(emission.co2_kg_per_liter),
    )
    meta = trips.select("trip_id", F.col("route_id").alias("trip_route_id"), F.coalesce(F.col("route_name"), F.lit("")).alias("route_name"))
    seg = seg.join(F.broadcast(meta), "trip_id", "left")
    return seg.select(
        "trip_id",
        F.col("view_idx").alias("segment_idx"),
        F.col("trip_route_id").alias("route_id"),
        "route_name",
        "lat1",
        "lon1",
        "lat2",
        "lon2",
        "distance_km",
        "duration_min",
        "idle_min",
        "co2_kg_est",
        F.bround("distance_km", 4).alias("distance_km_r4"),
        F.bround("co2_kg_est", 4).alias("co2_kg_r4"),
        bucket_start("event_time_local", minutes).alias("bucket_start"),
    )


def bucket_segments(segments: DataFrame) -> DataFrame:
    """Segments grouped per bucket, route and rounded end points; sums,
    count and the first-seen coordinates (trip id, then segment order)."""
    key = [
        "bucket_start",
        "route_id",
        F.bround("lat1", 4).alias("lat1_r4"),
        F.bround("lon1", 4).alias("lon1_r4"),
        F.bround("lat2", 4).alias("lat2_r4"),
        F.bround("lon2", 4).alias("lon2_r4"),
    ]
    first = F.min_by(
        F.struct(
            "route_name",
            F.array(F.bround("lat1", 5), F.bround("lon1", 5)).alias("start"),
            F.array(F.bround("lat2", 5), F.bround("lon2", 5)).alias("end"),
            F.array(F.bround((F.col("lat1") + F.col("lat2")) / 2.0, 5), F.bround((F.col("lon1") + F.col("lon2")) / 2.0, 5)).alias("midpoint"),
        ),
        F.struct("trip_id", "segment_idx"),
    )
    agg = segments.groupBy(*key).agg(
        F.sum("co2_kg_est").alias("co2_sum"), F.sum("distance_km").alias("distance_sum"), F.count(F.lit(1)).alias("segment_count"), first.alias("_f")
    )
    return agg.select(
        "bucket_start",
        "route_id",
        "lat1_r4",
        "lon1_r4",
        "lat2_r4",
        "lon2_r4",
        F.col("_f.route_name").alias("route_name"),
        F.col("_f.start").alias("start"),
        F.col("_f.end").alias("end"),
        F.col("_f.midpoint").alias("midpoint"),
        "co2_sum",
        "distance_sum",
        F.bround("co2_sum", 4).alias("co2_kg_est"),
        F.bround("distance_sum", 4).alias("distance_km"),
        "segment_count",
    )


def time_slices(segments: DataFrame, buckets: DataFrame) -> DataFrame:
    """Per bucket totals, distinct trips and routes, and the nested
    segments sorted by CO2 (largest first)."""
    counts = segments.groupBy("bucket_start").agg(
        F.countDistinct("trip_id").alias("active_trips"), F.countDistinct("route_id").alias("active_routes")
    )
    seg_struct = F.struct(
        F.negative("co2_kg_est").alias("_order"),
        "route_id",
        "route_name",
        "start",
        "end",
        "midpoint",
        "co2_kg_est",
        "distance_km",
        "segment_count",
    )
    nested = buckets.groupBy("bucket_start").agg(
        F.bround(F.sum("co2_sum"), 3).alias("total_co2_kg"),
        F.bround(F.sum("distance_sum"), 3).alias("total_distance_km"),
        F.sort_array(F.collect_list(seg_struct)).alias("_segs"),
    )
    return nested.join(counts, "bucket_start").select(
        "bucket_start",
        F.date_format("bucket_start", "yyyy-MM-dd HH:mm").alias("bucket_label"),
        "total_co2_kg",
        "total_distance_km",
        "active_trips",
        "active_routes",
        F.transform("_segs", lambda s: s.dropFields("_order")).alias("segments"),
    )


def route_emission_days(segments: DataFrame, buckets: DataFrame) -> DataFrame:
    """Per local day and route, CO2 per bucket (sums of the
    4-digit segment values), running total, totals and trip counts.
    ``active_trip_count`` counts every trip in each bucket the route is
    active in (F17); ``route_trip_count`` counts the route's own trips."""
    # Sums of 4-digit values are exact in DECIMAL, so the later rounding of a
    # tie does not depend on the float summation order.
    dec = lambda c: F.col(c).cast("decimal(20,4)")
    per_bucket = buckets.withColumn("event_date", F.to_date("bucket_start")).groupBy("event_date", "route_id", "bucket_start").agg(
        F.sum(dec("co2_kg_est")).alias("bucket_co2"),
        F.sum(dec("distance_km")).alias("bucket_distance"),
        F.first("route_name").alias("route_name"),
    )
    wr = Window.partitionBy("event_date", "route_id").orderBy("bucket_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_bucket = per_bucket.withColumn("cumulative", F.sum("bucket_co2").over(wr))
    days = per_bucket.groupBy("event_date", "route_id").agg(
        F.min_by("route_name", "bucket_start").alias("route_name"),
        F.sort_array(
            F.collect_list(
                F.struct(
                    "bucket_start",
                    F.bround("bucket_co2", 4).cast("double").alias("exact"),
                    F.bround("cumulative", 4).cast("double").alias("cum"),
                )
            )
        ).alias("_b"),
        F.bround(F.sum("bucket_co2"), 3).cast("double").alias("total_co2_kg"),
        F.bround(F.sum("bucket_distance"), 3).cast("double").alias("total_distance_km"),
    )
    # Trips of the buckets a route is active in, per day (set union).
    route_buckets = segments.select("route_id", "bucket_start").distinct()
    bucket_trips = segments.select("bucket_start", "trip_id").distinct()
    active = (
        route_buckets.join(bucket_trips, "bucket_start")
        .withColumn("event_date", F.to_date("bucket_start"))
        .groupBy("event_date", "route_id")
        .agg(F.countDistinct("trip_id").alias("active_trip_count"))
    )
    own = (
        segments.withColumn("event_date", F.to_date("bucket_start"))
        .groupBy("event_date", "route_id")
        .agg(F.countDistinct("trip_id").alias("route_trip_count"))
    )
    return (
        days.join(active, ["event_date", "route_id"], "left")
        .join(own, ["event_date", "route_id"], "left")
        .select(
            "route_id",
            "route_name",
            F.col("event_date").cast("string").alias("event_date"),
            F.transform("_b", lambda b: F.date_format(b["bucket_start"], "HH:mm")).alias("bucket_labels"),
            F.transform("_b", lambda b: b["bucket_start"]).alias("bucket_keys"),
            F.transform("_b", lambda b: b["exact"]).alias("co2_kg_exact"),
            F.transform("_b", lambda b: b["cum"]).alias("co2_kg_cumulative"),
            "total_co2_kg",
            "total_distance_km",
            "active_trip_count",
            "route_trip_count",
        )
    )


def trip_paths(thinned: DataFrame, segments: DataFrame, trips: DataFrame) -> DataFrame:
    """Per trip the ordered coordinates and timestamps of the kept
    points, segment arrays, point counts; distance and CO2 from Gold (2
    digits), or from the rounded segments when Gold has none."""
    pts = thinned.groupBy("trip_id").agg(
        F.first("point_count_raw").alias("point_count_raw"),
        F.first("point_count_view").alias("point_count_view"),
        F.sort_array(
            F.collect_list(
                F.struct(
                    "view_idx",
                    F.array(F.bround("latitude", 6), F.bround("longitude", 6)).alias("c"),
                    F.date_format("event_time_local", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
                )
            )
        ).alias("_p"),
    )
    segs = segments.groupBy("trip_id").agg(
        F.sort_array(F.collect_list(F.struct("segment_idx", "co2_kg_r4", "distance_km_r4"))).alias("_s"),
        # Exact sums of the 4-digit values (DECIMAL), rounded later.
        F.sum(F.col("distance_km_r4").cast("decimal(20,4)")).cast("double").alias("_seg_km"),
        F.sum(F.col("co2_kg_r4").cast("decimal(20,4)")).cast("double").alias("_seg_co2"),
    )
    out = (
        trips.join(pts, "trip_id")
        .join(segs, "trip_id", "left")
        .withColumn("_s", F.coalesce(F.col("_s"), F.array().cast("array<struct<segment_idx:bigint,co2_kg_r4:double,distance_km_r4:double>>")))
    )
    seg_km = F.coalesce(F.col("_seg_km"), F.lit(0.0))
    seg_co2 = F.coalesce(F.col("_seg_co2"), F.lit(0.0))
    gold_km = F.bround(F.coalesce(F.col("distance_km"), F.lit(0.0)), 2)
    gold_co2 = F.bround(F.coalesce(F.col("co2_kg_est"), F.lit(0.0)), 2)
    return out.select(
        "trip_id",
        "bus_id",
        "route_id",
        F.coalesce(F.col("route_name"), F.lit("")).alias("route_name"),
        F.date_format("trip_start", "yyyy-MM-dd'T'HH:mm:ss").alias("trip_start"),
        F.date_format("trip_end", "yyyy-MM-dd'T'HH:mm:ss").alias("trip_end"),
        F.when(gold_km <= 0, F.bround(seg_km, 2)).otherwise(gold_km).alias("distance_km"),
        F.when(gold_co2 <= 0, F.bround(seg_co2, 2)).otherwise(gold_co2).alias("co2_kg_est"),
        "point_count_raw",
        "point_count_view",
        F.transform("_p", lambda p: p["c"]).alias("coordinates"),
        F.transform("_p", lambda p: p["ts"]).alias("timestamps"),
        F.transform("_s", lambda s: s["co2_kg_r4"]).alias("segment_co2_kg"),
        F.transform("_s", lambda s: s["distance_km_r4"]).alias("segment_distance_km"),
    )


def route_geometries(paths: DataFrame) -> DataFrame:
    """Per route the path with the most kept points (smallest trip id on
    ties, the reference's iteration order)."""
    best = F.min_by(
        F.struct("trip_id", "route_name", "coordinates", "point_count_view"),
        F.struct(F.negative("point_count_view"), F.col("trip_id")),
    )
    return paths.groupBy("route_id").agg(best.alias("_g")).select(
        "route_id",
        F.col("_g.route_name").alias("route_name"),
        F.col("_g.trip_id").alias("trip_id"),
        F.col("_g.coordinates").alias("coordinates"),
        F.col("_g.point_count_view").alias("point_count_view"),
    )


def route_snapshot(
    days: DataFrame,
    geometries: DataFrame,
    day: str | None = None,
    route: str = "ALL",
    bucket_index: int = 0,
    mode: str = "cumulative",
    bucket_start: str | None = None,
) -> DataFrame:
    """Routes of one day at bucket position
    ``bucket_index`` of their own bucket list (the page's positional rule),
    or at the time ``bucket_start`` when given. Sorted by the shown CO2, with
    the share of the largest and the city totals over the shown routes."""
    rows = days
    if day == "FIRST":  # one row: the smallest day
        rows = rows.join(F.broadcast(days.agg(F.min("event_date").alias("event_date"))), "event_date", "left_semi")
    elif day is not None:
        rows = rows.filter(F.col("event_date") == F.lit(day))
    if route and route != "ALL":
        rows = rows.filter(F.col("route_id") == F.lit(route))
    if bucket_start is not None:
        pos = F.array_position(F.transform("bucket_keys", lambda k: F.date_format(k, "yyyy-MM-dd HH:mm:ss")), F.lit(bucket_start))
        exact = F.when(pos > 0, F.element_at("co2_kg_exact", pos.cast("int"))).otherwise(F.lit(0.0))
        cum = F.when(pos > 0, F.element_at("co2_kg_cumulative", pos.cast("int"))).otherwise(F.lit(0.0))
    else:
        exact = F.coalesce(F.try_element_at("co2_kg_exact", F.lit(bucket_index + 1)), F.lit(0.0))
        cum = F.coalesce(F.try_element_at("co2_kg_cumulative", F.lit(bucket_index + 1)), F.lit(0.0))
    geo = geometries.filter(F.size("coordinates") > 1).select("route_id", F.col("coordinates").alias("geometry"))
    shown = rows.join(geo, "route_id").select(
        "route_id", "route_name", "event_date", exact.alias("exact"), cum.alias("cumulative"), "total_distance_km", "active_trip_count", "geometry"
    )
    shown = shown.withColumn("co2", F.col("exact") if mode == "exact" else F.col("cumulative"))
    all_rows = Window.partitionBy(F.lit(1))  # the shown routes of one day: bounded by the route count
    top = F.max("co2").over(all_rows)
    return shown.select(
        "*",
        F.when(top > 0, F.col("co2") / top).otherwise(F.lit(0.0)).alias("share_of_max"),
        F.sum("co2").over(all_rows).alias("city_co2_kg"),
        F.sum("total_distance_km").over(all_rows).alias("city_distance_km"),
        F.row_number().over(all_rows.orderBy(F.desc("co2"), "route_id")).alias("rank"),
    )


def filter_values(days: DataFrame) -> DataFrame:
    """The distinct days and routes a viewer can pick, sorted."""
    d = days.select(F.lit("day").alias("kind"), F.col("event_date").alias("value")).distinct()
    r = days.select(F.lit("route").alias("kind"), F.col("route_id").alias("value")).distinct()
    return d.unionByName(r).orderBy("kind", "value")


def build_map(silver: DataFrame, trip_summary: DataFrame, catalog: DataFrame, max_trips: int = 80, max_points: int = MAX_POINTS_PER_TRIP, timezone: str = REPORT_TIMEZONE, emission: Emission = Emission()) -> dict[str, DataFrame]:
    """All map datasets from Silver and the Gold trip summary."""
    from .reports import top_trips

    trips = top_trips(trip_summary.withColumn("route_id", normalize_route_id("route_id")), catalog, k=max_trips)
    trips = rank_trips(with_rank(trips, [F.desc_nulls_last("distance_km"), F.desc_nulls_last("co2_kg_est"), F.asc("trip_id"), F.asc("route_id")]))
    # max_trips rows, then max_trips x max_points rows: both feed several map
    # datasets and are worked out once.
    trips = materialize(trips, "map-trips")
    points = materialize(focus_points(silver, trips, timezone), "map-focus")
    thinned = materialize(thin_trips(points, max_points), "map-points")
    segs = materialize(map_segments(thinned, trips, emission), "map-segments")
    buckets = bucket_segments(segs)
    paths = trip_paths(thinned, segs, trips)
    days = route_emission_days(segs, buckets)
    return {
        "trips": trips,
        "points": thinned,
        "segments": segs,
        "bucket_segments": buckets,
        "time_slices": time_slices(segs, buckets),
        "trip_paths": paths,
        "route_geometries": route_geometries(paths),
        "route_emission_days": days,
    }
