"""Registered queries: one callable per operator, each ``(spark, sf_dir) ->
DataFrame`` over the driver tables, and its DuckDB oracle SQL.

Output columns are aliased identically on both sides; doubles are rounded
to 6 places and timestamps rendered as text for the value comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions.routes import normalize_route_id
from .operators import reports
from .operators.segments import quality_reasons, quarantine
from .plans import flows
from .session import apply_session_conf, ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_conf(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def r6(c, name: str | None = None):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or (c if isinstance(c, str) else None))


def ts_text(c: str, name: str | None = None):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(name or c)


def d_text(c: str, name: str | None = None):
    return F.col(c).cast("string").alias(name or c)


def _gold(spark, sf_dir):
    g = flows.gold_tables(spark, sf_dir)
    p = reports.prepare_gold(g["route_hourly_emissions"], g["trip_summary"], g["bus_daily_emissions"])
    return p["trip_summary"], p["route_hourly"], p["bus_daily"]


ROW_KEY = ["bus_id", "event_id", "copy_no"]

# ------------------------------------------------------------------ Silver


@register(
    "silver_segments",
    O.with_base(
        "SELECT bus_id, event_id, copy_no, trip_id, trip_seq, segment_duration_s, "
        + ", ".join([O.r6("segment_distance_m", "segment_distance_m"), O.r6("derived_speed_kmh", "derived_speed_kmh")])
        + ", is_duplicate, is_valid_gps, is_outlier FROM silver_all"
    ),
)
def q_silver_segments(spark, sf_dir):
    """Every ping with previous point, measures, flags and trip."""
    s = flows.silver_all(spark, sf_dir)
    return s.select(
        *ROW_KEY,
        "trip_id",
        "trip_seq",
        "segment_duration_s",
        r6("segment_distance_m"),
        r6("derived_speed_kmh"),
        "is_duplicate",
        "is_valid_gps",
        "is_outlier",
    )


@register("valid_pings", O.with_base("SELECT bus_id, event_id, copy_no, trip_id FROM silver"))
def q_valid_pings(spark, sf_dir):
    """Q1: Silver keeps valid GPS points only."""
    return flows.silver(spark, sf_dir).select(*ROW_KEY, "trip_id")


@register(
    "quality_reasons",
    O.with_base(
        """SELECT bus_id, event_id, copy_no, reason FROM (
  SELECT bus_id, event_id, copy_no, unnest(list_filter([
    CASE WHEN t IS NULL THEN 'bad_time' END,
    CASE WHEN NOT coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false) THEN 'bad_range' END,
    CASE WHEN coalesce(is_duplicate, false) THEN 'duplicate' END,
    CASE WHEN segment_duration_s <= 0 THEN 'non_positive_duration' END,
    CASE WHEN derived_speed_kmh > 120 THEN 'speed' END,
    CASE WHEN segment_distance_m > 2000 THEN 'jump' END], lambda x: x IS NOT NULL)) AS reason
  FROM silver_all) q"""
    ),
)
def q_quality_reasons(spark, sf_dir):
    """One row per (ping, reason)."""
    q = quality_reasons(flows.silver_all(spark, sf_dir))
    return q.select(*ROW_KEY, F.explode("quality_reasons").alias("reason"))


@register(
    "quarantine",
    O.with_base(
        """SELECT bus_id, event_id, copy_no,
  CASE WHEN t IS NULL THEN 'bad_time' WHEN latitude IS NULL OR longitude IS NULL THEN 'missing_position'
       ELSE 'bad_range' END AS reject_reason
FROM silver_all WHERE NOT coalesce(is_valid_gps, false)"""
    ),
)
def q_quarantine(spark, sf_dir):
    """Rejected rows with a reason."""
    return quarantine(flows.silver_all(spark, sf_dir)).select(*ROW_KEY, "reject_reason")


# ------------------------------------------------------- mapping and catalog


@register("vehicle_route_map", O.with_base("SELECT vehicle, route_no AS mapped_route_id FROM mapping"))
def q_vehicle_route_map(spark, sf_dir):
    """One route per vehicle from the mapping rows."""
    return flows.mapping(spark, sf_dir)


@register(
    "route_catalog",
    O.with_base(
        "SELECT route_id, route_name, duration_min, distance_km_ref, stops_inbound_outbound, connected_metro1 FROM catalog"
    ),
)
def q_route_catalog(spark, sf_dir):
    """Normalized catalog."""
    return flows.catalog(spark, sf_dir)


@register(
    "normalize_route_id",
    O.with_base(
        f"SELECT route_raw AS route_id, {O.norm_route('route_raw')} AS route_norm, count(*) AS n FROM ping GROUP BY route_raw"
    ),
)
def q_normalize_route_id(spark, sf_dir):
    """N10 over every raw route value."""
    b = flows.bronze(spark, sf_dir)
    return b.groupBy("route_id").agg(F.count(F.lit(1)).alias("n")).select(
        "route_id", normalize_route_id("route_id").alias("route_norm"), "n"
    )


@register("fill_route", O.with_base("SELECT bus_id, event_id, copy_no, route_id FROM filled"))
def q_fill_route(spark, sf_dir):
    """Blank routes filled from the mapping (broadcast when small)."""
    from .operators.emissions import fill_route

    s = fill_route(flows.silver(spark, sf_dir), flows.mapping(spark, sf_dir))
    return s.select(*ROW_KEY, "route_id")


@register(
    "estimate_emissions",
    O.with_base(
        "SELECT bus_id, event_id, copy_no, "
        + ", ".join(
            [
                O.r6("distance_km", "distance_km"),
                O.r6("idle_min", "idle_min"),
                O.r6("fuel_liter_est", "fuel_liter_est"),
                O.r6("co2_kg_est", "co2_kg_est"),
                O.ts_text("event_time_local", "event_time_local"),
            ]
        )
        + ", CAST(event_date AS VARCHAR) AS event_date, event_hour FROM enriched_t"
    ),
)
def q_estimate_emissions(spark, sf_dir):
    """Per-row model values and local time."""
    e = flows.enriched(spark, sf_dir)
    return e.select(
        *ROW_KEY,
        r6("distance_km"),
        r6("idle_min"),
        r6("fuel_liter_est"),
        r6("co2_kg_est"),
        ts_text("event_time_local"),
        d_text("event_date"),
        "event_hour",
    )


# -------------------------------------------------------------------- Gold


@register(
    "trip_summary",
    O.with_base(
        "SELECT trip_id, bus_id, route_id, "
        + ", ".join(
            [
                O.ts_text("trip_start", "trip_start"),
                O.ts_text("trip_end", "trip_end"),
                O.r6("distance_km", "distance_km"),
                O.r6("fuel_liter_est", "fuel_liter_est"),
                O.r6("co2_kg_est", "co2_kg_est"),
            ]
        )
        + " FROM g_trip"
    ),
)
def q_trip_summary(spark, sf_dir):
    """A1."""
    t = flows.gold_tables(spark, sf_dir)["trip_summary"]
    return t.select(
        "trip_id", "bus_id", "route_id", ts_text("trip_start"), ts_text("trip_end"), r6("distance_km"), r6("fuel_liter_est"), r6("co2_kg_est")
    )


@register(
    "route_hourly_emissions",
    O.with_base(
        "SELECT route_id, CAST(event_date AS VARCHAR) AS event_date, event_hour, "
        + ", ".join([O.r6("distance_km", "distance_km"), O.r6("fuel_liter_est", "fuel_liter_est"), O.r6("co2_kg_est", "co2_kg_est")])
        + ", active_buses FROM g_hour"
    ),
)
def q_route_hourly(spark, sf_dir):
    """A2."""
    t = flows.gold_tables(spark, sf_dir)["route_hourly_emissions"]
    return t.select("route_id", d_text("event_date"), "event_hour", r6("distance_km"), r6("fuel_liter_est"), r6("co2_kg_est"), "active_buses")


@register(
    "bus_daily_emissions",
    O.with_base(
        "SELECT bus_id, CAST(event_date AS VARCHAR) AS event_date, "
        + ", ".join([O.r6("distance_km", "distance_km"), O.r6("fuel_liter_est", "fuel_liter_est"), O.r6("co2_kg_est", "co2_kg_est")])
        + " FROM g_day"
    ),
)
def q_bus_daily(spark, sf_dir):
    """A3."""
    t = flows.gold_tables(spark, sf_dir)["bus_daily_emissions"]
    return t.select("bus_id", d_text("event_date"), r6("distance_km"), r6("fuel_liter_est"), r6("co2_kg_est"))


# ----------------------------------------------------------------- reports

SUM3_SQL = ", ".join([O.r6("distance_km", "distance_km"), O.r6("fuel_liter_est", "fuel_liter_est"), O.r6("co2_kg_est", "co2_kg_est")])


def _sum3():
    return [r6("distance_km"), r6("fuel_liter_est"), r6("co2_kg_est")]


@register("bus_totals", O.with_base(f"SELECT bus_id, {SUM3_SQL} FROM bus_tot"))
def q_bus_totals(spark, sf_dir):
    """A4."""
    _, _, bd = _gold(spark, sf_dir)
    return reports.bus_totals(bd).select("bus_id", *_sum3())


@register("route_totals", O.with_base(f"SELECT route_id, {SUM3_SQL} FROM route_tot"))
def q_route_totals(spark, sf_dir):
    """A5 (with N14 route normalization)."""
    _, rh, _ = _gold(spark, sf_dir)
    return reports.route_totals(rh).select("route_id", *_sum3())


@register(
    "peak_hours",
    O.with_base(
        "SELECT event_hour, round(coalesce(sum(distance_km), 0), 6) AS distance_km, round(coalesce(sum(co2_kg_est), 0), 6) AS co2_kg_est "
        "FROM rh WHERE event_hour IS NOT NULL GROUP BY event_hour"
    ),
)
def q_peak_hours(spark, sf_dir):
    """A6 / R3."""
    _, rh, _ = _gold(spark, sf_dir)
    return reports.peak_hours(rh).select("event_hour", r6("distance_km"), r6("co2_kg_est"))


@register(
    "daily_totals",
    O.with_base(
        "SELECT CAST(event_date AS VARCHAR) AS event_date, "
        "round(coalesce(sum(distance_km), 0), 6) AS distance_km, round(coalesce(sum(fuel_liter_est), 0), 6) AS fuel_liter_est, "
        "round(coalesce(sum(co2_kg_est), 0), 6) AS co2_kg_est FROM bd WHERE event_date IS NOT NULL GROUP BY event_date"
    ),
)
def q_daily_totals(spark, sf_dir):
    """A7 / R4."""
    _, _, bd = _gold(spark, sf_dir)
    return reports.daily_totals(bd).select(d_text("event_date"), *_sum3())


@register("bus_route_counts", O.with_base("SELECT bus_id, route_id, trip_count FROM brc"))
def q_bus_route_counts(spark, sf_dir):
    """A8."""
    ts, _, _ = _gold(spark, sf_dir)
    return reports.bus_route_counts(ts)


@register("dominant_route", O.with_base("SELECT bus_id, dominant_route_id, trip_count FROM dom"))
def q_dominant_route(spark, sf_dir):
    """A9."""
    ts, _, _ = _gold(spark, sf_dir)
    return reports.dominant_route(ts)


@register("route_unique_buses", O.with_base("SELECT route_id, unique_active_buses FROM rub"))
def q_route_unique_buses(spark, sf_dir):
    """A10."""
    ts, _, _ = _gold(spark, sf_dir)
    return reports.route_unique_buses(ts)


@register(
    "top_buses",
    O.with_base(
        f"""SELECT b.bus_id, round(b.distance_km, 6) AS distance_km, round(b.fuel_liter_est, 6) AS fuel_liter_est,
  round(b.co2_kg_est, 6) AS co2_kg_est, d.dominant_route_id, c.route_name AS dominant_route_name
FROM (SELECT * FROM bus_tot ORDER BY co2_kg_est DESC NULLS LAST, bus_id LIMIT 10) b
LEFT JOIN dom d ON b.bus_id = d.bus_id
LEFT JOIN catalog c ON d.dominant_route_id = c.route_id"""
    ),
)
def q_top_buses(spark, sf_dir):
    """R1 / J3 / J4."""
    ts, _, bd = _gold(spark, sf_dir)
    t = reports.top_buses(bd, ts, flows.catalog(spark, sf_dir))
    return t.select("bus_id", *_sum3(), "dominant_route_id", "dominant_route_name")


@register(
    "top_routes",
    O.with_base(
        """SELECT r.route_id, round(r.distance_km, 6) AS distance_km, round(r.fuel_liter_est, 6) AS fuel_liter_est,
  round(r.co2_kg_est, 6) AS co2_kg_est, u.unique_active_buses, c.route_name, c.duration_min, c.distance_km_ref,
  c.stops_inbound_outbound, c.connected_metro1
FROM (SELECT * FROM route_tot ORDER BY co2_kg_est DESC NULLS LAST, route_id LIMIT 10) r
LEFT JOIN rub u ON r.route_id = u.route_id
LEFT JOIN catalog c ON r.route_id = c.route_id"""
    ),
)
def q_top_routes(spark, sf_dir):
    """R2 / J5 / J6."""
    ts, rh, _ = _gold(spark, sf_dir)
    t = reports.top_routes(rh, ts, flows.catalog(spark, sf_dir))
    return t.select(
        "route_id", *_sum3(), "unique_active_buses", "route_name", "duration_min", "distance_km_ref", "stops_inbound_outbound", "connected_metro1"
    )


@register(
    "trip_outliers",
    O.with_base(
        """SELECT o.trip_id, o.bus_id, o.route_id, round(o.distance_km, 6) AS distance_km, round(o.co2_kg_est, 6) AS co2_kg_est,
  round(o.co2_kg_per_km, 6) AS co2_kg_per_km, c.route_name
FROM (SELECT *, co2_kg_est / CASE WHEN distance_km <> 0 THEN distance_km END AS co2_kg_per_km FROM ts
      WHERE distance_km >= 1 ORDER BY co2_kg_per_km DESC NULLS LAST, trip_id, route_id LIMIT 15) o
LEFT JOIN catalog c ON o.route_id = c.route_id"""
    ),
)
def q_trip_outliers(spark, sf_dir):
    """R5 / Q5 / D14 / J7."""
    ts, _, _ = _gold(spark, sf_dir)
    t = reports.trip_outliers(ts, flows.catalog(spark, sf_dir))
    return t.select("trip_id", "bus_id", "route_id", r6("distance_km"), r6("co2_kg_est"), r6("co2_kg_per_km"), "route_name")


@register(
    "top_trips",
    O.with_base(
        f"""SELECT o.trip_id, o.bus_id, o.route_id, round(o.distance_km, 6) AS distance_km, round(o.co2_kg_est, 6) AS co2_kg_est,
  {O.ts_text('o.trip_start', 'trip_start')}, {O.ts_text('o.trip_end', 'trip_end')}, c.route_name
FROM (SELECT * FROM ts ORDER BY distance_km DESC NULLS LAST, co2_kg_est DESC NULLS LAST, trip_id, route_id LIMIT 80) o
LEFT JOIN catalog c ON o.route_id = c.route_id"""
    ),
)
def q_top_trips(spark, sf_dir):
    """R6 / J8."""
    ts, _, _ = _gold(spark, sf_dir)
    t = reports.top_trips(ts, flows.catalog(spark, sf_dir))
    return t.select(
        "trip_id", "bus_id", "route_id", r6("distance_km"), r6("co2_kg_est"), ts_text("trip_start"), ts_text("trip_end"), "route_name"
    )


@register(
    "kpi_summary",
    O.with_base(
        """SELECT b.total_distance_km, b.total_fuel_liter, b.total_co2_kg, b.active_buses, r.active_routes, t.total_trips,
  t.trip_route_missing_count, t.trip_route_missing_ratio, b.date_from, b.date_to
FROM (SELECT round(coalesce(sum(distance_km), 0), 2) AS total_distance_km,
             round(coalesce(sum(fuel_liter_est), 0), 2) AS total_fuel_liter,
             round(coalesce(sum(co2_kg_est), 0), 2) AS total_co2_kg,
             count(DISTINCT bus_id) AS active_buses,
             CAST(min(event_date) AS VARCHAR) AS date_from, CAST(max(event_date) AS VARCHAR) AS date_to FROM bd) b,
     (SELECT count(DISTINCT route_id) AS active_routes FROM rh) r,
     (SELECT count(DISTINCT trip_id) AS total_trips,
             CAST(coalesce(sum(CASE WHEN route_id = 'UNKNOWN' THEN 1 ELSE 0 END), 0) AS BIGINT) AS trip_route_missing_count,
             round(coalesce(sum(CASE WHEN route_id = 'UNKNOWN' THEN 1 ELSE 0 END), 0) / greatest(count(*), 1), 4)
               AS trip_route_missing_ratio FROM ts) t"""
    ),
)
def q_kpi_summary(spark, sf_dir):
    """A11 / A12."""
    ts, rh, bd = _gold(spark, sf_dir)
    return reports.kpi_summary(bd, rh, ts)


@register(
    "insight_values",
    O.with_base(
        """SELECT r.route_id AS top_route_id, round(r.co2_kg_est, 2) AS top_route_co2_kg, round(r.distance_km, 2) AS top_route_distance_km,
  CAST(coalesce(u.unique_active_buses, 0) AS BIGINT) AS top_route_unique_buses,
  h.peak_hour, h.peak_hour_co2_kg, d.peak_day, d.peak_day_co2_kg, b.top_bus_id, b.top_bus_co2_kg
FROM (SELECT * FROM route_tot ORDER BY co2_kg_est DESC NULLS LAST, route_id LIMIT 1) r
LEFT JOIN rub u ON r.route_id = u.route_id,
(SELECT lpad(CAST(event_hour AS VARCHAR), 2, '0') AS peak_hour, round(co2, 2) AS peak_hour_co2_kg FROM (
   SELECT event_hour, coalesce(sum(co2_kg_est), 0) AS co2 FROM rh WHERE event_hour IS NOT NULL GROUP BY event_hour)
 ORDER BY co2 DESC NULLS LAST, event_hour LIMIT 1) h,
(SELECT CAST(event_date AS VARCHAR) AS peak_day, round(co2, 2) AS peak_day_co2_kg FROM (
   SELECT event_date, coalesce(sum(co2_kg_est), 0) AS co2 FROM bd WHERE event_date IS NOT NULL GROUP BY event_date)
 ORDER BY co2 DESC NULLS LAST, event_date LIMIT 1) d,
(SELECT bus_id AS top_bus_id, round(co2_kg_est, 2) AS top_bus_co2_kg FROM bus_tot
 ORDER BY co2_kg_est DESC NULLS LAST, bus_id LIMIT 1) b"""
    ),
)
def q_insight_values(spark, sf_dir):
    """A19 / K12."""
    ts, rh, bd = _gold(spark, sf_dir)
    return reports.insight_values(bd, rh, ts, flows.catalog(spark, sf_dir))


# --------------------------------------------------------------------- map


def _map(spark, sf_dir):
    from .operators import gold
    from .operators.emissions import estimate_emissions, fill_route
    from .operators.mapdata import build_map

    # One Silver for both the Gold trip ranking and the map points.
    silver = flows.silver(spark, sf_dir)
    e = estimate_emissions(fill_route(silver, flows.mapping(spark, sf_dir)))
    ts = reports.prepare_gold(trip_summary=gold.trip_summary(e))["trip_summary"]
    return build_map(silver, ts, flows.catalog(spark, sf_dir))


@register(
    "thin_trips",
    O.with_map("SELECT trip_id, point_idx, view_idx, point_count_raw, point_count_view FROM mthin"),
)
def q_thin_trips(spark, sf_dir):
    """Evenly thinned points of the ranked trips."""
    return _map(spark, sf_dir)["points"].select("trip_id", "point_idx", "view_idx", "point_count_raw", "point_count_view")


@register(
    "map_segments",
    O.with_map(
        "SELECT trip_id, segment_idx, route_id, distance_km_r4, co2_kg_r4, round(duration_min, 6) AS duration_min, "
        + O.ts_text("bucket_start", "bucket_start")
        + " FROM mseg"
    ),
)
def q_map_segments(spark, sf_dir):
    """W6 / D15 / D16 / ST8: segments between kept points with 30-minute bucket."""
    s = _map(spark, sf_dir)["segments"]
    return s.select("trip_id", "segment_idx", "route_id", "distance_km_r4", "co2_kg_r4", r6("duration_min"), ts_text("bucket_start"))


@register(
    "bucket_segments",
    O.with_map(
        "SELECT " + O.ts_text("bucket_start", "bucket_start") + ", route_id, lat1_r4, lon1_r4, lat2_r4, lon2_r4, "
        "round(co2_sum, 6) AS co2_sum, round(distance_sum, 6) AS distance_sum, segment_count FROM mbuck"
    ),
)
def q_bucket_segments(spark, sf_dir):
    """A14."""
    b = _map(spark, sf_dir)["bucket_segments"]
    return b.select(ts_text("bucket_start"), "route_id", "lat1_r4", "lon1_r4", "lat2_r4", "lon2_r4", r6("co2_sum"), r6("distance_sum"), "segment_count")


@register(
    "time_slices",
    O.with_map(
        """SELECT strftime(b.bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start, strftime(b.bucket_start, '%Y-%m-%d %H:%M') AS bucket_label,
  b.total_co2_kg, b.total_distance_km, c.active_trips, c.active_routes, b.segment_groups
FROM (SELECT bucket_start, round_even(sum(co2_sum), 3) AS total_co2_kg, round_even(sum(distance_sum), 3) AS total_distance_km,
        count(*) AS segment_groups FROM mbuck GROUP BY bucket_start) b
JOIN (SELECT bucket_start, count(DISTINCT trip_id) AS active_trips, count(DISTINCT route_id) AS active_routes FROM mseg GROUP BY bucket_start) c
  ON b.bucket_start = c.bucket_start"""
    ),
)
def q_time_slices(spark, sf_dir):
    """A15 / R8."""
    t = _map(spark, sf_dir)["time_slices"]
    return t.select(
        ts_text("bucket_start"), "bucket_label", "total_co2_kg", "total_distance_km", "active_trips", "active_routes",
        F.size("segments").cast("long").alias("segment_groups"),
    )


@register(
    "route_emission_days",
    O.with_map(
        """SELECT d.route_id, CAST(d.event_date AS VARCHAR) AS event_date, strftime(d.bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_key,
  CAST(round_even(d.bucket_co2, 4) AS DOUBLE) AS co2_kg_exact, CAST(round_even(d.cumulative, 4) AS DOUBLE) AS co2_kg_cumulative,
  d.total_co2_kg, d.total_distance_km, a.active_trip_count, o.route_trip_count
FROM mday d
LEFT JOIN mactive a ON d.event_date = a.event_date AND d.route_id = a.route_id
LEFT JOIN mown o ON d.event_date = o.event_date AND d.route_id = o.route_id"""
    ),
)
def q_route_emission_days(spark, sf_dir):
    """A16 / W7 / U3 / F17, one row per (day, route, bucket)."""
    d = _map(spark, sf_dir)["route_emission_days"]
    z = F.arrays_zip("bucket_keys", "co2_kg_exact", "co2_kg_cumulative")
    return d.select("route_id", "event_date", F.explode(z).alias("b"), "total_co2_kg", "total_distance_km", "active_trip_count", "route_trip_count").select(
        "route_id",
        "event_date",
        F.date_format("b.bucket_keys", "yyyy-MM-dd HH:mm:ss").alias("bucket_key"),
        F.col("b.co2_kg_exact").alias("co2_kg_exact"),
        F.col("b.co2_kg_cumulative").alias("co2_kg_cumulative"),
        "total_co2_kg",
        "total_distance_km",
        "active_trip_count",
        "route_trip_count",
    )


@register(
    "trip_paths",
    O.with_map("SELECT trip_id, route_id, distance_km, co2_kg_est, point_count_raw, point_count_view FROM mpath"),
)
def q_trip_paths(spark, sf_dir):
    """A18."""
    p = _map(spark, sf_dir)["trip_paths"]
    return p.select("trip_id", "route_id", "distance_km", "co2_kg_est", "point_count_raw", "point_count_view")


@register("route_geometries", O.with_map("SELECT route_id, trip_id, point_count_view FROM mgeo"))
def q_route_geometries(spark, sf_dir):
    """A17."""
    return _map(spark, sf_dir)["route_geometries"].select("route_id", "trip_id", "point_count_view")


@register(
    "route_snapshot",
    O.with_map(
        """SELECT route_id, round(co2, 6) AS co2, round(CASE WHEN mx > 0 THEN co2 / mx ELSE 0 END, 6) AS share_of_max,
  round(city, 6) AS city_co2_kg, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, max(co2) OVER () AS mx, sum(co2) OVER () AS city, row_number() OVER (ORDER BY co2 DESC, route_id) AS rk FROM (
    SELECT d.route_id, coalesce(CAST(round_even(d.cumulative, 4) AS DOUBLE), 0) AS co2 FROM (
      SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY bucket_start) AS pos FROM mday
      WHERE event_date = (SELECT min(event_date) FROM mday)) d
    JOIN mgeo g ON d.route_id = g.route_id
    WHERE d.pos = 1 AND g.point_count_view > 1))"""
    ),
)
def q_route_snapshot(spark, sf_dir):
    """First day, bucket position 0, cumulative CO2."""
    from .operators.mapdata import route_snapshot

    m = _map(spark, sf_dir)
    snap = route_snapshot(m["route_emission_days"], m["route_geometries"], day="FIRST", bucket_index=0)
    return snap.select("route_id", r6("co2"), r6("share_of_max"), r6("city_co2_kg"), F.col("rank").cast("long").alias("rank"))


@register(
    "filter_values",
    O.with_map(
        "SELECT 'day' AS kind, CAST(event_date AS VARCHAR) AS value FROM mday GROUP BY event_date "
        "UNION ALL SELECT 'route' AS kind, route_id AS value FROM mday GROUP BY route_id"
    ),
)
def q_filter_values(spark, sf_dir):
    """A24."""
    from .operators.mapdata import filter_values

    return filter_values(_map(spark, sf_dir)["route_emission_days"])


# ------------------------------------------------------------ raw sources


# Columns of the raw copies, per format and layout: target -> own name.
RAW_LAYOUTS = {
    "csv/a": {"event_time": "timestamp", "bus_id": "vehicle_id", "route_id": "route", "latitude": "lat", "longitude": "lon", "speed_kmh": "speed"},
    "csv/b": {"longitude": "lng", "bus_id": "plate", "event_time": "recorded_at", "latitude": "y", "speed_kmh": "velocity", "route_id": "line"},
    "json/a": {"bus_id": "vehicle", "event_time": "datetime", "longitude": "x", "latitude": "y", "speed_kmh": "speed", "route_id": "route"},
    "json/b": {"event_time": "time", "latitude": "latitude", "longitude": "longitude", "bus_id": "imei", "speed_kmh": "velocity", "route_id": "line"},
    "parquet/a": {"event_time": "event_time", "bus_id": "bus_id", "route_id": "route_id", "latitude": "latitude", "longitude": "longitude", "speed_kmh": "speed_kmh"},
    "parquet/b": {"bus_id": "bus_id", "event_time": "ts", "longitude": "lon", "latitude": "lat", "route_id": "route_id", "speed_kmh": "speed"},
}


#: A column of every layout b without a value.
NO_VALUES = "note"


def _write_raw_copies(spark, sf_dir) -> str:
    """Write the driver pings once per format into a fresh folder, even event
    ids in layout a and odd ones in layout b, two files each: other names,
    another order, ISO text, epoch seconds or timestamps. Some rows of csv/a
    have no latitude, some of json/a a time beyond any range; layouts b have a
    column without values. A layout is two tasks, so all are written at once."""
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    from .session import scratch_path
    from .sources import driver

    root = scratch_path(spark, f"raw-copies-{uuid.uuid4().hex[:12]}")
    p = driver.raw_pings(spark, sf_dir).withColumnRenamed("route_raw", "route_id")
    iso = F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    epoch = F.when((F.col("event_id") % 103 == 0) & (F.col("event_id") % 2 == 0), F.lit(1e306)).otherwise(F.col("t").cast("double"))
    time = {"csv/a": iso, "csv/b": F.col("t"), "json/a": epoch, "json/b": iso, "parquet/a": F.timestamp_seconds("t"), "parquet/b": F.timestamp_seconds("t")}

    def write(name: str, names: dict[str, str]) -> None:
        fmt, layout = name.split("/")
        rows = p.where(F.col("event_id") % 2 == (0 if layout == "a" else 1)).withColumn("event_time", time[name])
        if name == "csv/a":
            rows = rows.withColumn("latitude", F.when(F.col("event_id") % 101 != 0, F.col("latitude")))
        cols = [F.col(target).alias(own) for target, own in names.items()]
        if name == "json/a":
            cols = [F.struct(*cols[:-1]).alias("msgBusWayPoint"), cols[-1]]
        if layout == "b":
            cols.append(F.lit(None).cast("string").alias(NO_VALUES))
        writer = rows.repartition(2).select(*cols).write.format(fmt).option("ignoreNullFields", False)
        if fmt == "csv":
            writer = writer.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.save(f"{root}/{name}")

    with ThreadPoolExecutor(len(RAW_LAYOUTS)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write), *layout) for layout in RAW_LAYOUTS.items()]:
            done.result()
    return root


@register(
    "read_raw_mapped",
    O.with_base(
        """SELECT f.fmt, p.bus_id, p.t, p.route_raw AS route_id, p.latitude, p.longitude, p.speed_kmh
FROM ping p, (SELECT 'csv' AS fmt UNION ALL SELECT 'json' UNION ALL SELECT 'parquet') f
WHERE NOT (event_id % 2 = 0 AND (fmt = 'csv' AND event_id % 101 = 0 OR fmt = 'json' AND event_id % 103 = 0))"""
    ),
)
def q_read_raw_mapped(spark, sf_dir):
    """Mixed raw files read back, flattened, mapped by
    candidate names, times parsed (epoch or ISO per file), complete rows."""
    from .operators.normalize import drop_incomplete
    from .sources.raw import read_mapped

    root = _write_raw_copies(spark, sf_dir)
    ev = drop_incomplete(read_mapped(spark, root))
    fmt = F.regexp_extract("source_file", r"/(csv|json|parquet)/", 1)
    return ev.select(
        fmt.alias("fmt"), "bus_id", F.unix_timestamp("event_time").alias("t"), "route_id", "latitude", "longitude", "speed_kmh"
    )


# ---------------------------------------------------------------- streaming


def _numbered_pings(spark, sf_dir):
    """Pings with their partition and offset, which numbers them in event-id
    order."""
    from .sources import driver

    return driver.ping_events(spark, sf_dir).withColumns({"partition": F.lit(0), "offset": F.col("event_id") * 2 + F.col("copy_no")})


def _wire(numbered):
    """Numbered pings as Kafka-style rows: key, JSON value, partition, offset."""
    from .operators.normalize import to_events, to_keyed_json

    beside = ("partition", "offset")
    return to_keyed_json(to_events(numbered, beside), beside)


def _wire_key():
    """Row key of a wire row, from its offset."""
    return ["bus_id", F.expr("offset div 2").alias("event_id"), F.expr("cast(offset % 2 as int)").alias("copy_no")]


def _stream_silver(spark, sf_dir, n_files: int = 5, order=("offset",)):
    """Run the stream on the wire rows, one file (where rows are many: one
    slice of files) a micro-batch; returns the root of its tables and its
    metrics."""
    import uuid

    from .session import scratch_path
    from .streaming.stream import BatchMetrics, read_ping_stream, replay_as_stream, run_stream, wire_events

    root = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    pings = _numbered_pings(spark, sf_dir)
    files = replay_as_stream(pings, f"{root}/landing", n_files, order_cols=order, shape=_wire)
    stream = read_ping_stream(spark, f"{root}/landing", "json", schema=_wire(pings).schema, max_files_per_trigger=files)
    metrics = BatchMetrics()
    q = run_stream(
        stream, f"{root}/bronze", f"{root}/silver", f"{root}/carry", f"{root}/checkpoint", metrics=metrics, late_root=f"{root}/late", prepare=wire_events
    )
    q.awaitTermination()
    return root, metrics


STREAM_SQL = O.with_base("SELECT bus_id, event_id, copy_no, trip_id, " + O.r6("segment_distance_m", "segment_distance_m") + " FROM silver")


@register("stream_silver", STREAM_SQL)
def q_stream_silver(spark, sf_dir):
    """ST1-ST6, ST10, S7, K1, K2, N6-N8: the pings as keyed JSON, replayed as
    5 files in offset order and streamed one file per micro-batch; Silver with
    carried trips equals the batch Silver."""
    root, _ = _stream_silver(spark, sf_dir)
    return spark.read.parquet(f"{root}/silver").select(*_wire_key(), "trip_id", r6("segment_distance_m"))


@register("stream_late_repair", STREAM_SQL)
def q_stream_late_repair(spark, sf_dir):
    """ST7: the same rows in an order that makes many of them late; after the
    repair of the buses with late rows Silver equals the batch Silver."""
    from .streaming.stream import apply_late_repair, read_silver

    root, _ = _stream_silver(spark, sf_dir, 4, order=(F.col("offset") % 5, "offset"))
    apply_late_repair(spark, f"{root}/bronze", f"{root}/silver", f"{root}/late", f"{root}/carry")
    return read_silver(spark, f"{root}/silver").select(*_wire_key(), "trip_id", r6("segment_distance_m"))


@register(
    "bronze_payloads",
    O.with_base("SELECT bus_id, event_id, copy_no, route_raw AS payload_route, latitude FROM ping"),
)
def q_bronze_payloads(spark, sf_dir):
    """K1: Bronze read back, with a field taken from the kept payload."""
    root, _ = _stream_silver(spark, sf_dir, 2)
    bronze = spark.read.parquet(f"{root}/bronze")
    return bronze.select(*_wire_key(), F.get_json_object("json_payload", "$.route_id").alias("payload_route"), "latitude")


@register(
    "batch_metrics",
    O.with_base("SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(count(*) FILTER (WHERE is_valid_gps) AS BIGINT) AS valid_rows FROM silver_all"),
)
def q_batch_metrics(spark, sf_dir):
    """A22 / ST5: rows in and valid rows out, summed over the micro-batches."""
    _, metrics = _stream_silver(spark, sf_dir)
    rows = [(int(m["input_rows"]), int(m["valid_rows"])) for m in metrics.history]
    df = spark.createDataFrame(rows, "input_rows long, valid_rows long")
    return df.agg(F.sum("input_rows").cast("long").alias("input_rows"), F.sum("valid_rows").cast("long").alias("valid_rows"))


# ------------------------------------------------------ sampling, ordering

SAMPLE_N = 1000
UNIFORM_N = 500


@register(
    "sample_even",
    O.with_base(
        f"""SELECT bus_id, event_id, copy_no, pos AS sample_pos FROM (
  SELECT *, row_number() OVER (ORDER BY t, event_id, copy_no) - 1 AS pos FROM ping) x
WHERE pos IN (SELECT DISTINCT least(CAST(floor(r.i * (c.n / CAST({SAMPLE_N} AS DOUBLE))) AS BIGINT), c.n - 1)
              FROM (SELECT range AS i FROM range({SAMPLE_N})) r, (SELECT count(*) AS n FROM ping) c)"""
    ),
)
def q_sample_even(spark, sf_dir):
    """M1: 1000 pings evenly spaced over time (global position from the
    range-partitioned ordered scan)."""
    from .operators.sampling import sample_even

    s = sample_even(flows.bronze(spark, sf_dir), SAMPLE_N, ["event_time", "event_id", "copy_no"])
    return s.select(*ROW_KEY, "sample_pos")


@register(
    "sample_uniform",
    O.with_base(
        f"""SELECT bus_id, event_id, copy_no, md5(concat_ws('|', '42', bus_id, CAST(event_id AS VARCHAR), CAST(copy_no AS VARCHAR))) AS sample_hash
FROM ping ORDER BY sample_hash LIMIT {UNIFORM_N}"""
    ),
)
def q_sample_uniform(spark, sf_dir):
    """M2: repeatable uniform sample of 500 pings, in time order."""
    from .operators.sampling import sample_uniform

    s = sample_uniform(flows.bronze(spark, sf_dir), UNIFORM_N, ROW_KEY, seed="42", order_cols=["event_time", *ROW_KEY])
    return s.select(*ROW_KEY, "sample_hash")


@register("order_events", O.with_base("SELECT bus_id, event_id, copy_no, t FROM ping"))
def q_order_events(spark, sf_dir):
    """All pings in time order (range-partitioned sort)."""
    from .operators.normalize import order_events

    return order_events(flows.bronze(spark, sf_dir), ["event_id", "copy_no"]).select(*ROW_KEY, F.unix_timestamp("event_time").alias("t"))


# ---------------------------------------------------------------- profiling


@register(
    "quality_summary",
    O.with_base(
        """SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT unnest(list_filter([
    CASE WHEN t IS NULL THEN 'bad_time' END,
    CASE WHEN NOT coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false) THEN 'bad_range' END,
    CASE WHEN coalesce(is_duplicate, false) THEN 'duplicate' END,
    CASE WHEN segment_duration_s <= 0 THEN 'non_positive_duration' END,
    CASE WHEN derived_speed_kmh > 120 THEN 'speed' END,
    CASE WHEN segment_distance_m > 2000 THEN 'jump' END], lambda x: x IS NOT NULL)) AS reason FROM silver_all) q
GROUP BY reason
UNION ALL SELECT 'all_rows', CAST(count(*) AS BIGINT) FROM silver_all"""
    ),
)
def q_quality_summary(spark, sf_dir):
    """Rows per quality reason."""
    from .operators.profile import quality_summary

    return quality_summary(flows.silver_all(spark, sf_dir))


def _own_columns(name: str) -> dict[str, str]:
    """Column names of a raw layout as read: nested ones by dotted path."""
    own = RAW_LAYOUTS[name]
    out = {t: f"msgBusWayPoint.{c}" if name == "json/a" and t != "route_id" else c for t, c in own.items()}
    return out | ({"": NO_VALUES} if name.endswith("b") else {})


def _null_sql(target: str, name: str) -> str:
    if target == "speed_kmh":
        return "count(*) FILTER (WHERE speed_kmh IS NULL)"
    if target == "latitude" and name == "csv/a":
        return "count(*) FILTER (WHERE event_id % 101 = 0)"
    return "0" if target else "count(*)"


def _profile_sql() -> str:
    parts = []
    for name in RAW_LAYOUTS:
        fmt, layout = name.split("/")
        for target, column in _own_columns(name).items():
            parts.append(f"SELECT '{name}' AS layout, '{fmt}' AS file_type, '{column}' AS column_name, count(*) AS n_rows, CAST({_null_sql(target, name)} AS BIGINT) AS nulls FROM ping WHERE event_id % 2 = {0 if layout == 'a' else 1}")
    return O.with_base(" UNION ALL ".join(parts))


def _files_of(column: str) -> int:
    """Raw files (two a layout) that have the lower-cased column."""
    return sum(2 for n in RAW_LAYOUTS if column in {c.lower() for c in _own_columns(n).values()})


RAW_COLUMNS = sorted({c.lower() for n in RAW_LAYOUTS for c in _own_columns(n).values()})


@register("profile_files", _profile_sql())
def q_profile_files(spark, sf_dir):
    """Rows and NULLs of every column that a raw file has, per layout."""
    from .operators.profile import profile_files
    from .sources.raw import raw_file_columns, read_raw_frames

    root = _write_raw_copies(spark, sf_dir)
    layout = F.regexp_extract("source_file", r"/((?:csv|json|parquet)/[ab])/", 1)
    files = profile_files(read_raw_frames(spark, root), raw_file_columns(spark, root)).withColumn("layout", layout)
    return files.groupBy("layout", "file_type", "column_name").agg(F.sum("rows").alias("n_rows"), F.sum(F.round(F.col("null_ratio") * F.col("rows")).cast("long")).alias("nulls"))


@register("column_frequency", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', CAST({_files_of(c)} AS BIGINT))" for c in RAW_COLUMNS) + ") x(column_name, files)")
def q_column_frequency(spark, sf_dir):
    """Files per lower-cased column, from headers, keys and footers."""
    from .operators.profile import column_frequency
    from .sources.raw import raw_file_columns

    return column_frequency(raw_file_columns(spark, _write_raw_copies(spark, sf_dir)))


@register(
    "schema_drift",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', CAST({_files_of(c)} AS BIGINT), CAST({2 * len(RAW_LAYOUTS) - _files_of(c)} AS BIGINT))" for c in RAW_COLUMNS if _files_of(c) < 2 * len(RAW_LAYOUTS))
    + ") x(column_name, files_with, files_without)",
)
def q_schema_drift(spark, sf_dir):
    """Columns some files lack."""
    from .operators.profile import schema_drift
    from .sources.raw import raw_file_columns

    return schema_drift(raw_file_columns(spark, _write_raw_copies(spark, sf_dir)))


def _write_faulty_copies(spark, sf_dir) -> str:
    """Pings as raw files that are partly broken: JSON lines with a cut line
    for every 50th ping and a bare number for every 70th; a document that is no
    JSON; one whose array holds texts beside objects; a CSV file with a value
    too many for every 60th ping; files without a byte or without a row; text
    under a Parquet name."""
    import uuid

    from .session import scratch_path
    from .sources import driver

    root = scratch_path(spark, f"raw-faulty-{uuid.uuid4().hex[:12]}")
    p = driver.raw_pings(spark, sf_dir)
    json = F.to_json(F.struct("event_id", "copy_no", F.col("bus_id").alias("vehicle")))
    every = lambda n: F.col("event_id") % n == 0
    line = F.when(every(50), F.substring(json, 1, 12)).when(every(70), F.lit("17")).otherwise(json)
    # One file each, in a folder of its own, with the reader's ending.
    texts = {
        "lines": (p.where("event_id > 0").orderBy("event_id", "copy_no").select(line.alias("value")), "json"),
        "document": (p.where("event_id < 5").select(F.concat(F.lit("{"), json).alias("value")), "json"),
        "array": (p.where("event_id < 40").select(F.concat(F.lit("["), json, F.lit(","), F.concat(F.lit('"'), "bus_id", F.lit('"')), F.lit("]")).alias("value")).limit(1), "json"),
        "wide": (p.select(F.concat_ws(",", "event_id", "bus_id", F.when(every(60), F.lit("more"))).alias("value")), "csv"),
        "nothing": (p.where("event_id < 0").select(F.col("bus_id").alias("value")), "json"),
        "no-parquet": (p.where("event_id < 9").select(F.col("bus_id").alias("value")), "parquet"),
    }
    fs = _hadoop_folder(spark, root)[0]
    for name, (rows, ending) in texts.items():
        rows = rows.coalesce(1)
        if name == "wide":
            rows = rows.select(F.col("value").alias("value")).sortWithinPartitions("value")
            head = spark.createDataFrame([("event_id,vehicle",)], "value string")
            rows = head.unionByName(rows).coalesce(1)
        rows.write.text(f"{root}/{name}-text")
        kept = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        fs.mkdirs(kept)
        made = [s.getPath() for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}-text")) if s.getPath().getName().startswith("part-")]
        for i, f in enumerate(made):
            fs.rename(f, spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{i}.{ending}"))
    p.where("event_id < 100").select("event_id", "bus_id").coalesce(1).write.parquet(f"{root}/parquet")
    return root


def _hadoop_folder(spark, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


_HEALTH_CASES = """SELECT 'lines' AS folder, 'json' AS file_type, CAST(count(*) AS BIGINT) AS lines, CAST(count(*) FILTER (WHERE event_id % 50 <> 0 AND event_id % 70 <> 0) AS BIGINT) AS records,
  CAST(count(*) FILTER (WHERE event_id % 50 = 0 OR event_id % 70 = 0) AS BIGINT) AS rejected, CAST(count(*) FILTER (WHERE event_id % 50 = 0 OR event_id % 70 = 0) AS BIGINT) AS bad_lines, NULL AS error, false AS empty FROM ping WHERE event_id > 0
UNION ALL SELECT 'document', 'json', CAST(count(*) AS BIGINT), 0, 1, 0, 'not JSON', false FROM ping WHERE event_id < 5
UNION ALL SELECT 'array', 'json', 1, 1, 1, 0, NULL, false
UNION ALL SELECT 'wide', 'csv', CAST(count(*) AS BIGINT) + 1, CAST(count(*) FILTER (WHERE event_id % 60 <> 0) AS BIGINT), CAST(count(*) FILTER (WHERE event_id % 60 = 0) AS BIGINT), CAST(count(*) FILTER (WHERE event_id % 60 = 0) AS BIGINT), NULL, false FROM ping
UNION ALL SELECT 'nothing', 'json', 0, 0, 0, 0, NULL, true
UNION ALL SELECT 'no-parquet', 'parquet', 0, 0, 1, 0, 'no readable footer', false
UNION ALL SELECT 'parquet', 'parquet', 0, CAST(count(*) AS BIGINT), 0, 0, NULL, false FROM ping WHERE event_id < 100"""


@register("file_health", O.with_base(_HEALTH_CASES))
def q_file_health(spark, sf_dir):
    """Lines, records, rejected records and errors of partly broken files."""
    from .operators.profile import file_health

    found = file_health(spark, _write_faulty_copies(spark, sf_dir))
    return found.select(F.regexp_extract("source_file", r"/([a-z-]+)/[^/]*$", 1).alias("folder"), "file_type", "lines", "records", "rejected", "bad_lines", "error", "empty")


@register(
    "rejected_records",
    O.with_base(
        """SELECT 'lines' AS folder, 'json' AS file_type, CASE WHEN event_id % 50 = 0 THEN 'not JSON' ELSE 'not an object' END AS reason,
  CASE WHEN event_id % 50 = 0 THEN substr('{"event_id":' || event_id, 1, 12) ELSE '17' END AS raw FROM ping WHERE event_id > 0 AND (event_id % 50 = 0 OR event_id % 70 = 0)
UNION ALL SELECT 'wide', 'csv', 'more fields than the header', event_id || ',' || bus_id || ',more' FROM ping WHERE event_id % 60 = 0
UNION ALL SELECT 'no-parquet', 'parquet', 'no readable footer', NULL"""
    ),
)
def q_rejected_records(spark, sf_dir):
    """The raw records that the readers leave out, with their reasons
    (documents apart: their text is the whole file)."""
    from .sources.raw import rejected_records

    found = rejected_records(spark, _write_faulty_copies(spark, sf_dir))
    folder = F.regexp_extract("source_file", r"/([a-z-]+)/[^/]*$", 1)
    return found.select(folder.alias("folder"), "file_type", "reason", "raw").where("folder not in ('document', 'array')")


# ------------------------------------------------------ wire and W3 trips


@register(
    "decode_events",
    O.with_base("SELECT bus_id, t, route_raw AS route_id, latitude, longitude, speed_kmh FROM ping"),
)
def q_decode_events(spark, sf_dir):
    """Pings to wire events, keyed JSON (Kafka layout),
    decoded with the fixed schema and normalized back."""
    from .operators.normalize import decode_events, normalize_events, to_events, to_keyed_json

    wire = to_keyed_json(to_events(flows.bronze(spark, sf_dir)))
    kafka_like = wire.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp"))
    ev = normalize_events(decode_events(kafka_like))
    return ev.select("bus_id", F.unix_timestamp("event_time").alias("t"), "route_id", "latitude", "longitude", "speed_kmh")


TPR_SQL = O.with_base(
    f"""
, pn AS (SELECT *, {O.norm_route('route_raw')} AS route_n FROM ping),
pl AS (SELECT *, lag(t) OVER w AS prev_t, lag(route_n) OVER w AS prev_rn
       FROM pn WINDOW w AS (PARTITION BY bus_id ORDER BY t, event_id, copy_no)),
pt AS (SELECT *, CAST(sum(CASE WHEN prev_t IS NULL OR t - prev_t > 900 OR route_n <> prev_rn THEN 1 ELSE 0 END)
         OVER (PARTITION BY bus_id ORDER BY t, event_id, copy_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS seq
       FROM pl),
pr AS (SELECT bus_id || '_' || CAST(seq AS VARCHAR) AS trip_id, bus_id, route_n AS route_id,
         min(make_timestamp(t * 1000000) + INTERVAL 7 HOUR) AS trip_start, count(*) AS point_count
       FROM pt GROUP BY 1, 2, 3)
SELECT r.trip_id, r.bus_id, r.route_id, r.point_count, strftime(r.trip_start, '%Y-%m-%d %H:%M:%S') AS trip_start, c.route_name
FROM (SELECT * FROM pr ORDER BY point_count DESC, trip_start DESC, trip_id, route_id LIMIT 80) r
LEFT JOIN catalog c ON r.route_id = c.route_id"""
)


@register("trip_point_rank", TPR_SQL.replace("\n, pn AS", ",\npn AS", 1))
def q_trip_point_rank(spark, sf_dir):
    """Trips cut on raw events with the route normalized
    first (NULL/blank is UNKNOWN), ranked by point count then latest start."""
    from .operators.emissions import localize
    from .operators.segments import enrich_segments

    b = flows.bronze(spark, sf_dir).withColumn("route_id", normalize_route_id("route_id"))
    pts = localize(enrich_segments(b))
    r = reports.trip_point_rank(pts, flows.catalog(spark, sf_dir))
    return r.select("trip_id", "bus_id", "route_id", "point_count", ts_text("trip_start"), "route_name")


@register(
    "dashboard_top_buses",
    O.with_base(
        """SELECT CAST(b.bus_id AS VARCHAR) AS bus_id, coalesce(d.dominant_route_id, '') AS route_id,
  coalesce(c.route_name, '') AS route_name, round(coalesce(b.distance_km, 0), 2) AS distance_km,
  round(coalesce(b.co2_kg_est, 0), 2) AS co2_kg_est
FROM (SELECT * FROM bus_tot ORDER BY co2_kg_est DESC NULLS LAST, bus_id LIMIT 10) b
LEFT JOIN dom d ON b.bus_id = d.bus_id
LEFT JOIN catalog c ON d.dominant_route_id = c.route_id"""
    ),
)
def q_dashboard_top_buses(spark, sf_dir):
    """K9: the top-bus table as the dashboard shows it (rounded, blank-filled)."""
    ts, rh, bd = _gold(spark, sf_dir)
    cat = flows.catalog(spark, sf_dir)
    tables = reports.dashboard_tables(
        reports.top_buses(bd, ts, cat), reports.top_routes(rh, ts, cat), reports.trip_outliers(ts, cat)
    )
    return tables["top_buses_table"]


@register(
    "stream_hourly",
    O.with_base(
        "SELECT strftime(make_timestamp((t - t % 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, route_raw AS route_id, count(*) AS pings FROM ping GROUP BY 1, 2"
    ),
)
def q_stream_hourly(spark, sf_dir):
    """ST11: hourly pings per route on the replayed stream, in update mode
    with a watermark, so that closed windows leave the state. Each batch writes
    the windows that it changed; the newest row of a window is its total."""
    import uuid

    from .session import scratch_path
    from .sources import driver
    from .streaming.stream import read_ping_stream, replay_as_stream, stream_hourly

    root = scratch_path(spark, f"hourly-{uuid.uuid4().hex[:12]}")
    events = driver.ping_events(spark, sf_dir)
    files = replay_as_stream(events, f"{root}/landing", 3, order_cols=("event_time", "event_id", "copy_no"))
    stream = read_ping_stream(spark, f"{root}/landing", "json", schema=events.schema, max_files_per_trigger=files)
    q = (
        stream_hourly(stream, watermark="1 hour")
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch}"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    rows = spark.read.parquet(f"{root}/out").groupBy("window", "route_id").agg(F.max_by("pings", "batch_id").alias("pings"))
    return rows.select(ts_text("window.start", "window_start"), "route_id", "pings")


# ------------------------------------------------ map arrays, point by point


@register(
    "trip_path_points",
    O.with_map(
        """SELECT m.trip_id, m.view_idx, round_even(m.latitude, 6) AS latitude, round_even(m.longitude, 6) AS longitude,
  strftime(make_timestamp((m.t + 25200) * 1000000), '%Y-%m-%dT%H:%M:%S') AS ts, s.co2_kg_r4 AS segment_co2_kg, s.distance_km_r4 AS segment_distance_km
FROM mthin m JOIN mtrips t ON m.trip_id = t.trip_id LEFT JOIN mseg s ON m.trip_id = s.trip_id AND m.view_idx + 1 = s.segment_idx"""
    ),
)
def q_trip_path_points(spark, sf_dir):
    """The four arrays of each path, one row per kept point."""
    p = _map(spark, sf_dir)["trip_paths"]
    z = p.select("trip_id", F.posexplode(F.arrays_zip("coordinates", "timestamps", "segment_co2_kg", "segment_distance_km")).alias("view_idx", "z"))
    return z.select(
        "trip_id",
        F.col("view_idx").cast("long").alias("view_idx"),
        F.col("z.coordinates")[0].alias("latitude"),
        F.col("z.coordinates")[1].alias("longitude"),
        F.col("z.timestamps").alias("ts"),
        F.col("z.segment_co2_kg").alias("segment_co2_kg"),
        F.col("z.segment_distance_km").alias("segment_distance_km"),
    )


@register(
    "route_geometry_points",
    O.with_map(
        """SELECT g.route_id, m.view_idx, round_even(m.latitude, 6) AS latitude, round_even(m.longitude, 6) AS longitude
FROM mgeo g JOIN mthin m ON g.trip_id = m.trip_id"""
    ),
)
def q_route_geometry_points(spark, sf_dir):
    """The coordinates of each route's path, one row per point."""
    g = _map(spark, sf_dir)["route_geometries"].select("route_id", F.posexplode("coordinates").alias("view_idx", "c"))
    return g.select("route_id", F.col("view_idx").cast("long").alias("view_idx"), F.col("c")[0].alias("latitude"), F.col("c")[1].alias("longitude"))


MANY_POINTS = 6


@register(
    "thin_trips_short",
    O.with_map(
        f"""SELECT trip_id, point_idx, point_count_raw FROM mpts WHERE point_count_raw <= {MANY_POINTS}
   OR list_contains(list_transform(range({MANY_POINTS}), lambda i: CAST(round_even(i * ((point_count_raw - 1) / CAST({MANY_POINTS - 1} AS DOUBLE)), 0) AS BIGINT)), point_idx)"""
    ),
)
def q_thin_trips_short(spark, sf_dir):
    """M3 with a limit of six points, which most trips exceed."""
    from .operators.mapdata import thin_trips

    points = _map(spark, sf_dir)["points"].drop("point_idx", "point_count_raw", "view_idx", "point_count_view")
    return thin_trips(points, MANY_POINTS).select("trip_id", "point_idx", F.col("point_count_raw").cast("long").alias("point_count_raw"))


# ------------------------------------------- dashboard tables, prose, sinks


def _dashboard(spark, sf_dir):
    ts, rh, bd = _gold(spark, sf_dir)
    cat = flows.catalog(spark, sf_dir)
    return reports.dashboard_tables(reports.top_buses(bd, ts, cat), reports.top_routes(rh, ts, cat), reports.trip_outliers(ts, cat))


@register(
    "dashboard_top_routes",
    O.with_base(
        """SELECT r.route_id, coalesce(c.route_name, '') AS route_name, coalesce(c.duration_min, '') AS duration_min,
  round(coalesce(c.distance_km_ref, 0), 2) AS distance_km_ref, coalesce(c.stops_inbound_outbound, '') AS stops_inbound_outbound,
  coalesce(c.connected_metro1, '') AS connected_metro1, round(coalesce(r.distance_km, 0), 2) AS distance_km,
  round(coalesce(r.co2_kg_est, 0), 2) AS co2_kg_est, CAST(coalesce(u.unique_active_buses, 0) AS BIGINT) AS unique_active_buses
FROM (SELECT * FROM route_tot ORDER BY co2_kg_est DESC NULLS LAST, route_id LIMIT 10) r
LEFT JOIN rub u ON r.route_id = u.route_id LEFT JOIN catalog c ON r.route_id = c.route_id"""
    ),
)
def q_dashboard_top_routes(spark, sf_dir):
    """K9: the top-route table as the dashboard shows it."""
    return _dashboard(spark, sf_dir)["top_routes_table"]


@register(
    "dashboard_trip_outliers",
    O.with_base(
        """SELECT o.trip_id, o.bus_id, o.route_id, coalesce(c.route_name, '') AS route_name, round(coalesce(o.distance_km, 0), 2) AS distance_km,
  round(coalesce(o.co2_kg_est, 0), 2) AS co2_kg_est, round(coalesce(o.co2_kg_per_km, 0), 3) AS co2_kg_per_km
FROM (SELECT *, co2_kg_est / CASE WHEN distance_km <> 0 THEN distance_km END AS co2_kg_per_km FROM ts
      WHERE distance_km >= 1 ORDER BY co2_kg_per_km DESC NULLS LAST, trip_id, route_id LIMIT 15) o
LEFT JOIN catalog c ON o.route_id = c.route_id"""
    ),
)
def q_dashboard_trip_outliers(spark, sf_dir):
    """K9: the trip-outlier table as the dashboard shows it."""
    return _dashboard(spark, sf_dir)["trip_outliers_table"]


def _sink_root(spark) -> str:
    import uuid

    from .session import scratch_path

    return scratch_path(spark, f"sinks-{uuid.uuid4().hex[:12]}")


@register("gold_trip_read_back", SQL["trip_summary"])
def q_gold_trip_read_back(spark, sf_dir):
    """Gold written and the trip table read back."""
    from .sources.sinks import write_gold
    from .sources.tables import read_table

    root = _sink_root(spark)
    write_gold(flows.gold_tables(spark, sf_dir), root)
    t = read_table(spark, f"{root}/trip_summary")
    return t.select("trip_id", "bus_id", "route_id", ts_text("trip_start"), ts_text("trip_end"), r6("distance_km"), r6("fuel_liter_est"), r6("co2_kg_est"))


@register("gold_hourly_read_back", SQL["route_hourly_emissions"])
def q_gold_hourly_read_back(spark, sf_dir):
    """The hourly Gold table, partitioned by date, read back."""
    from .sources.sinks import write_gold
    from .sources.tables import read_table

    root = _sink_root(spark)
    write_gold({"route_hourly_emissions": flows.gold_tables(spark, sf_dir)["route_hourly_emissions"]}, root)
    t = read_table(spark, f"{root}/route_hourly_emissions")
    return t.select("route_id", d_text("event_date"), "event_hour", r6("distance_km"), r6("fuel_liter_est"), r6("co2_kg_est"), "active_buses")


@register("reports_read_back", SQL["peak_hours"])
def q_reports_read_back(spark, sf_dir):
    """K6: a report written as CSV and read back."""
    from .sources.sinks import write_reports

    root = _sink_root(spark)
    report = QUERIES["peak_hours"](spark, sf_dir)
    write_reports({"peak_hours": report}, root)
    return spark.read.schema(report.schema).option("header", True).csv(f"{root}/peak_hours")


@register("kpis_read_back", SQL["kpi_summary"])
def q_kpis_read_back(spark, sf_dir):
    """K7: the key figures written as JSON and read back."""
    from .sources.sinks import write_kpis

    root = _sink_root(spark)
    kpis = QUERIES["kpi_summary"](spark, sf_dir)
    write_kpis(kpis, root)
    return spark.read.schema(kpis.schema).json(f"{root}/kpi_summary")


@register("map_read_back", SQL["route_emission_days"])
def q_map_read_back(spark, sf_dir):
    """K8: a map dataset written as JSON lines and read back."""
    from .sources.sinks import write_map

    root = _sink_root(spark)
    days = QUERIES["route_emission_days"](spark, sf_dir)
    write_map({"days": days}, root)
    return spark.read.schema(days.schema).json(f"{root}/days")


@register("event_cache_read_back", O.with_base("SELECT bus_id, t, route_raw AS route_id, latitude, longitude, speed_kmh FROM ping"))
def q_event_cache_read_back(spark, sf_dir):
    """Pings written as an event cache and found there, since
    no Silver table lies where it is looked for first."""
    from .operators.normalize import to_events
    from .sources.sinks import write_event_cache
    from .sources.tables import resolve_points

    root = _sink_root(spark)
    write_event_cache(to_events(flows.bronze(spark, sf_dir)), f"{root}/cache")
    _, ev = resolve_points(spark, silver=f"{root}/no-silver", cache=f"{root}/cache")
    return ev.select("bus_id", F.unix_timestamp("event_time").alias("t"), "route_id", "latitude", "longitude", "speed_kmh")


@register("profile_read_back", SQL["profile_files"])
def q_profile_read_back(spark, sf_dir):
    """The profile written as JSON lines and read back."""
    from .sources.sinks import write_profile

    root = _sink_root(spark)
    profile = QUERIES["profile_files"](spark, sf_dir)
    write_profile(profile, f"{root}/profile")
    return spark.read.schema(profile.schema).json(f"{root}/profile")


@register(
    "top_trips_of_route",
    O.with_base("SELECT trip_id, bus_id, round(distance_km, 6) AS distance_km FROM ts WHERE route_id = '12' ORDER BY distance_km DESC NULLS LAST, co2_kg_est DESC NULLS LAST, trip_id LIMIT 20"),
)
def q_top_trips_of_route(spark, sf_dir):
    """Q9: the longest trips of one route."""
    ts, _, _ = _gold(spark, sf_dir)
    return reports.top_trips(ts, flows.catalog(spark, sf_dir), k=20, route="12").select("trip_id", "bus_id", r6("distance_km"))


@register(
    "insight_text",
    SQL["insight_values"].replace("SELECT r.route_id AS top_route_id", "SELECT printf('Route %s has the highest CO2: %.2f kg over %.2f km and %d buses.', top_route_id, top_route_co2_kg, top_route_distance_km, top_route_unique_buses) AS route_finding, printf('Peak hour %s:00 emits %.2f kg CO2.', peak_hour, peak_hour_co2_kg) AS hour_finding, printf('Highest day %s reaches %.2f kg CO2.', peak_day, peak_day_co2_kg) AS day_finding, printf('Bus %s emits the most: %.2f kg CO2.', top_bus_id, top_bus_co2_kg) AS bus_finding FROM (SELECT r.route_id AS top_route_id", 1) + ") x",
)
def q_insight_text(spark, sf_dir):
    """The findings in words."""
    return reports.insight_text(QUERIES["insight_values"](spark, sf_dir))


# --------------------------------------------- progress, layout, small cases


@register(
    "stream_progress",
    O.with_base(
        """SELECT CAST(floor((event_id % 5) / 2) AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS input_rows,
  CASE WHEN min(event_id % 5) < 2 THEN NULL ELSE CAST(floor(min(event_id % 5) / 2) - 1 AS BIGINT) END AS start_offset, CAST(floor(min(event_id % 5) / 2) AS BIGINT) AS end_offset
FROM ping GROUP BY floor((event_id % 5) / 2)"""
    ),
)
def q_stream_progress(spark, sf_dir):
    """ST5 / ST2: progress reports as a table: five files of pings under a
    limit of two files a batch, so three batches; rows and offsets of each."""
    from .sources import driver
    from .streaming.stream import progress_report, progress_table, read_ping_stream

    root = _sink_root(spark)
    events = driver.ping_events(spark, sf_dir)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = _hadoop_folder(spark, root)[0]
    fs.mkdirs(Path(f"{root}/landing"))
    for k in range(5):  # a file each, of rising times
        events.where(F.col("event_id") % 5 == k).coalesce(1).write.json(f"{root}/part-{k}")
        made = next(s.getPath() for s in fs.listStatus(Path(f"{root}/part-{k}")) if s.getPath().getName().startswith("part-"))
        fs.rename(made, Path(f"{root}/landing/{k}.json"))
        fs.setTimes(Path(f"{root}/landing/{k}.json"), 1_700_000_000_000 + 10_000 * k, -1)
    stream = read_ping_stream(spark, f"{root}/landing", "json", schema=events.schema, max_files_per_trigger=2)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/rows")
    query.awaitTermination()
    reports_ = [progress_report(p) for p in query.recentProgress if p.numInputRows]
    offset = lambda c: F.get_json_object(c, "$.logOffset").cast("long").alias(c)
    return progress_table(spark, reports_).select("batch_id", "input_rows", offset("start_offset"), offset("end_offset"))


def _laid_out(spark, sf_dir):
    """Silver written by day and bus and read back, and the 20 Gold trips of
    the most CO2."""
    from .session import materialize
    from .sources.sinks import write_silver
    from .sources.tables import read_table

    root = _sink_root(spark)
    ts, _, _ = _gold(spark, sf_dir)
    top = ts.orderBy(F.desc_nulls_last("co2_kg_est"), "trip_id", "route_id").limit(20)
    write_silver(flows.silver(spark, sf_dir), root)
    return read_table(spark, f"{root}/silver"), materialize(top, "top-trips")


@register(
    "trip_points",
    O.with_base("SELECT bus_id, event_id, copy_no, trip_id, t FROM silver WHERE trip_id IN (SELECT trip_id FROM (SELECT trip_id FROM ts ORDER BY co2_kg_est DESC NULLS LAST, trip_id, route_id LIMIT 20) x)"),
)
def q_trip_points(spark, sf_dir):
    """Points of the top trips out of Silver by day and bus."""
    from .settings import REPORT_TIMEZONE
    from .sources.tables import trip_points

    silver, top = _laid_out(spark, sf_dir)
    points = trip_points(silver, top, REPORT_TIMEZONE, [*ROW_KEY, "event_time"])
    return points.select(*ROW_KEY, "trip_id", F.unix_timestamp("event_time").alias("t"))


@register(
    "dashboard_daily_trend",
    O.with_base(
        """SELECT CAST(event_date AS VARCHAR) AS label, round(coalesce(co2_kg_est, 0), 2) AS value, CAST(row_number() OVER (ORDER BY event_date) - 1 AS INTEGER) AS place
FROM (SELECT event_date, sum(co2_kg_est) AS co2_kg_est FROM bd WHERE event_date IS NOT NULL GROUP BY event_date) x"""
    ),
)
def q_dashboard_daily_trend(spark, sf_dir):
    """K9: CO2 per day, in date order, with its place."""
    _, rh, bd = _gold(spark, sf_dir)
    return reports.dashboard_series(bd, rh)["daily_trend"]


@register(
    "dashboard_peak_hours",
    O.with_base(
        """SELECT lpad(CAST(event_hour AS VARCHAR), 2, '0') AS label, round(coalesce(co2_kg_est, 0), 2) AS value, CAST(row_number() OVER (ORDER BY event_hour) - 1 AS INTEGER) AS place
FROM (SELECT event_hour, sum(co2_kg_est) AS co2_kg_est FROM rh WHERE event_hour IS NOT NULL GROUP BY event_hour) x"""
    ),
)
def q_dashboard_peak_hours(spark, sf_dir):
    """K9: CO2 per hour, in order of the hour, with its place."""
    _, rh, bd = _gold(spark, sf_dir)
    return reports.dashboard_series(bd, rh)["peak_hours"]


@register(
    "insight_missing_route",
    O.with_base(
        """SELECT n AS trip_route_missing_count, round(share * 100, 2) AS missing_percent,
  printf('%d trips (%.2f%% of all) have no route; rankings by route leave them out.', n, round(share * 100, 2)) AS missing_route_finding
FROM (SELECT CAST(count(*) FILTER (WHERE route_id = 'UNKNOWN') AS BIGINT) AS n, round(count(*) FILTER (WHERE route_id = 'UNKNOWN') / greatest(count(*), 1), 4) AS share FROM ts) x"""
    ),
)
def q_insight_missing_route(spark, sf_dir):
    """The finding on trips without a route."""
    ts, rh, bd = _gold(spark, sf_dir)
    return reports.missing_route_finding(reports.kpi_summary(bd, rh, ts))


@register(
    "bucket_first_points",
    O.with_map(
        """SELECT strftime(bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start, route_id, lat1_r4, lon1_r4, lat2_r4, lon2_r4,
  round_even(lat1, 5) AS start_lat, round_even(lon1, 5) AS start_lon, round_even(lat2, 5) AS end_lat, round_even(lon2, 5) AS end_lon,
  round_even((lat1 + lat2) / 2, 5) AS mid_lat, round_even((lon1 + lon2) / 2, 5) AS mid_lon
FROM (SELECT *, round_even(lat1, 4) AS lat1_r4, round_even(lon1, 4) AS lon1_r4, round_even(lat2, 4) AS lat2_r4, round_even(lon2, 4) AS lon2_r4,
  row_number() OVER (PARTITION BY bucket_start, route_id, round_even(lat1, 4), round_even(lon1, 4), round_even(lat2, 4), round_even(lon2, 4) ORDER BY trip_id, segment_idx) AS nth FROM mseg) x
WHERE nth = 1"""
    ),
)
def q_bucket_first_points(spark, sf_dir):
    """Per bucket segment the ends and the midpoint of the one seen
    first."""
    b = _map(spark, sf_dir)["bucket_segments"]
    points = [F.col(c)[i].alias(f"{name}_{axis}") for c, name in (("start", "start"), ("end", "end"), ("midpoint", "mid")) for i, axis in enumerate(("lat", "lon"))]
    return b.select(ts_text("bucket_start"), "route_id", "lat1_r4", "lon1_r4", "lat2_r4", "lon2_r4", *points)


@register(
    "time_slice_order",
    O.with_map(
        """SELECT strftime(bucket_start, '%Y-%m-%d %H:%M:%S') AS bucket_start, CAST(row_number() OVER (PARTITION BY bucket_start ORDER BY co2 DESC) - 1 AS INTEGER) AS place, co2 AS co2_kg_est
FROM (SELECT bucket_start, round_even(co2_sum, 4) AS co2 FROM mbuck) x"""
    ),
)
def q_time_slice_order(spark, sf_dir):
    """The nested segments of each time slice in their order."""
    t = _map(spark, sf_dir)["time_slices"]
    return t.select("bucket_start", F.posexplode("segments").alias("place", "s")).select(ts_text("bucket_start"), "place", F.col("s.co2_kg_est").alias("co2_kg_est"))


@register(
    "read_raw_with_mapping",
    O.with_base("SELECT p.bus_id, p.t, CASE WHEN trim(p.route_raw) = '' THEN m.route_no ELSE p.route_raw END AS route_id, p.latitude FROM ping p LEFT JOIN mapping m ON p.bus_id = m.vehicle"),
)
def q_read_raw_with_mapping(spark, sf_dir):
    """Raw pings without a route get that of their bus from the mapping
    while they are read."""
    from .sources import driver
    from .sources.raw import read_mapped

    root = _sink_root(spark)
    p = driver.raw_pings(spark, sf_dir)
    p.select("bus_id", F.col("t").alias("ts"), F.when(F.trim("route_raw") != "", F.col("route_raw")).alias("route_id"), "latitude", "longitude").write.option("header", True).csv(f"{root}/raw")
    ev = read_mapped(spark, f"{root}/raw", mapping=flows.mapping(spark, sf_dir))
    return ev.select("bus_id", F.unix_timestamp("event_time").alias("t"), "route_id", "latitude")


@register("mapping_with_gaps", O.with_base("SELECT vehicle, route_no AS mapped_route_id FROM mapping"))
def q_mapping_with_gaps(spark, sf_dir):
    """Mapping rows without a vehicle or a route count for nothing."""
    from .sources import driver
    from .sources.tables import vehicle_route_map

    raw = driver.vehicle_mapping_raw(spark, sf_dir)
    gaps = [raw.select(F.lit(None).cast("string").alias("vehicle"), F.lit("000").alias("route_no")), raw.select("vehicle", F.lit(None).cast("string").alias("route_no")), raw.select("vehicle", F.lit(" ").alias("route_no"))]
    every = raw
    for g in gaps:
        every = every.unionByName(g)
    return vehicle_route_map(every)


FIRST_N = 200


@register(
    "first_rows_of_files",
    O.with_base(
        f"SELECT f.fmt, CAST(event_id AS VARCHAR) AS event_id, CAST(copy_no AS VARCHAR) AS copy_no FROM (SELECT event_id, copy_no FROM ping ORDER BY event_id, copy_no LIMIT {FIRST_N}) x, (SELECT 'csv' AS fmt UNION ALL SELECT 'json' UNION ALL SELECT 'parquet') f"
    ),
)
def q_first_rows_of_files(spark, sf_dir):
    """M4: the first rows of each raw file; here one ordered file a format."""
    from .operators.profile import first_rows
    from .sources import driver
    from .sources.raw import read_raw_frames

    root = _sink_root(spark)
    p = driver.raw_pings(spark, sf_dir).select("event_id", "copy_no", "bus_id").orderBy("event_id", "copy_no").coalesce(1)
    for fmt in ("csv", "json", "parquet"):
        p.write.format(fmt).option("header", True).save(f"{root}/{fmt}")
    fmt = F.regexp_extract("source_file", r"/(csv|json|parquet)/", 1).alias("fmt")
    frames = [f.select(fmt, "event_id", "copy_no") for f in first_rows(read_raw_frames(spark, root), FIRST_N)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register(
    "read_parquet_layouts",
    O.with_base(
        """SELECT CAST(event_id AS VARCHAR) AS event_id, copy_no, CASE WHEN event_id % 3 = 0 THEN CAST(CAST(speed_kmh AS INTEGER) AS DOUBLE) ELSE speed_kmh END AS speed,
  CASE WHEN event_id % 3 = 0 THEN strftime(make_timestamp((t - t % 86400) * 1000000), '%Y-%m-%d %H:%M:%S') ELSE strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') END AS seen,
  CASE WHEN event_id % 3 = 2 THEN bus_id END AS bus_id FROM ping"""
    ),
)
def q_read_parquet_layouts(spark, sf_dir):
    """Three Parquet layouts that disagree on three columns' types, two
    files each: numbers widen to double, dates to timestamps, the rest to
    text; a column that only one layout has is NULL elsewhere."""
    from .sources import driver
    from .sources.raw import read_parquet

    root = _sink_root(spark)
    p = driver.raw_pings(spark, sf_dir)
    time = F.timestamp_seconds("t")
    layouts = [
        [F.col("event_id"), F.col("copy_no"), F.col("speed_kmh").cast("int").alias("speed"), F.to_date(time).alias("seen")],
        [F.col("event_id").cast("int"), F.col("copy_no"), F.col("speed_kmh").alias("speed"), time.alias("seen")],
        [F.col("event_id").cast("string"), F.col("copy_no"), F.col("speed_kmh").cast("float").alias("speed"), time.alias("seen"), F.col("bus_id")],
    ]
    for k, columns in enumerate(layouts):
        p.where(F.col("event_id") % 3 == k).repartition(2).select(*columns).write.parquet(f"{root}/raw/{k}")
    got = read_parquet(spark, f"{root}/raw")
    return got.select("event_id", "copy_no", "speed", ts_text("seen"), "bus_id")
