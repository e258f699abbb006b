"""Rankings, totals and key figures over the Gold tables (N14, A4-A13,
A19, R1-R7, K9, K12).

pandas rules are made explicit: NULL keys are dropped from groupings, sums
of nothing are 0, descending sorts put NULL last and every sort has a
tie-break (F21). Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
a per-partition top-k plus a merge (no global sort)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.routes import normalize_route_id
from ..settings import UNKNOWN_ROUTE
from .emissions import trip_intensity

SUMS3 = ("distance_km", "fuel_liter_est", "co2_kg_est")


def _total(c: str):
    """A sum that skips NULL and NaN; of nothing it is 0."""
    return F.coalesce(F.sum(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))), F.lit(0.0))


def _sum0(c: str):
    return _total(c).alias(c)


def prepare_gold(route_hourly: DataFrame | None = None, trip_summary: DataFrame | None = None, bus_daily: DataFrame | None = None):
    """Dates as dates, hour NULL to 0 as int, route ids normalized."""
    out = {}
    if route_hourly is not None:
        out["route_hourly"] = route_hourly.withColumn("event_date", F.to_date("event_date")).withColumn(
            "event_hour", F.coalesce(F.col("event_hour"), F.lit(0)).cast("int")
        ).withColumn("route_id", normalize_route_id("route_id"))
    if trip_summary is not None:
        out["trip_summary"] = trip_summary.withColumn("route_id", normalize_route_id("route_id"))
    if bus_daily is not None:
        out["bus_daily"] = bus_daily.withColumn("event_date", F.to_date("event_date"))
    return out


def bus_totals(bus_daily: DataFrame) -> DataFrame:
    """A4."""
    return bus_daily.filter(F.col("bus_id").isNotNull()).groupBy("bus_id").agg(*[_sum0(c) for c in SUMS3])


def route_totals(route_hourly: DataFrame) -> DataFrame:
    """A5 (route ids already normalized, so UNKNOWN is one group)."""
    return route_hourly.filter(F.col("route_id").isNotNull()).groupBy("route_id").agg(*[_sum0(c) for c in SUMS3])


def peak_hours(route_hourly: DataFrame) -> DataFrame:
    """Totals per hour of day, largest CO2 first."""
    return (
        route_hourly.filter(F.col("event_hour").isNotNull())
        .groupBy("event_hour")
        .agg(_sum0("distance_km"), _sum0("co2_kg_est"))
        .orderBy(F.desc_nulls_last("co2_kg_est"), F.asc("event_hour"))
    )


def hour_series(route_hourly: DataFrame) -> DataFrame:
    """K9: the same totals in the order of the hours, for a chart."""
    return peak_hours(route_hourly).orderBy("event_hour")


def daily_totals(bus_daily: DataFrame) -> DataFrame:
    """Totals per local date, in date order."""
    return (
        bus_daily.filter(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(*[_sum0(c) for c in SUMS3])
        .orderBy("event_date")
    )


def bus_route_counts(trip_summary: DataFrame) -> DataFrame:
    """Gold trip rows per bus and known route."""
    return (
        trip_summary.filter((F.col("route_id") != UNKNOWN_ROUTE) & F.col("bus_id").isNotNull())
        .groupBy("bus_id", "route_id")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )


def dominant_route(trip_summary: DataFrame) -> DataFrame:
    """The route a bus runs most; ties go to the smallest route id."""
    # Lexicographic minimum of (-count, route): largest count, then smallest id.
    rank_key = F.struct((-F.col("trip_count")).alias("n"), F.col("route_id").alias("r"))
    return (
        bus_route_counts(trip_summary)
        .groupBy("bus_id")
        .agg(F.min_by("route_id", rank_key).alias("dominant_route_id"), F.max("trip_count").alias("trip_count"))
    )


def route_unique_buses(trip_summary: DataFrame) -> DataFrame:
    """A10: distinct buses per known route."""
    return (
        trip_summary.filter((F.col("route_id") != UNKNOWN_ROUTE) & F.col("bus_id").isNotNull())
        .groupBy("route_id")
        .agg(F.countDistinct("bus_id").alias("unique_active_buses"))
    )


def top_buses(bus_daily: DataFrame, trip_summary: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """Top buses by CO2 with their dominant route and name."""
    top = bus_totals(bus_daily).orderBy(F.desc_nulls_last("co2_kg_est"), F.asc("bus_id")).limit(k)
    # Only the trips of the k chosen buses are aggregated.
    chosen = trip_summary.join(F.broadcast(top.select("bus_id")), "bus_id", "left_semi")
    dom = dominant_route(chosen).select("bus_id", "dominant_route_id")
    names = catalog.select(F.col("route_id").alias("dominant_route_id"), F.col("route_name").alias("dominant_route_name"))
    return top.join(F.broadcast(dom), "bus_id", "left").join(names, "dominant_route_id", "left").select(
        "bus_id", *SUMS3, "dominant_route_id", "dominant_route_name"
    )


def top_routes(route_hourly: DataFrame, trip_summary: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """Top routes by CO2 with distinct buses and catalog data."""
    top = route_totals(route_hourly).orderBy(F.desc_nulls_last("co2_kg_est"), F.asc("route_id")).limit(k)
    chosen = trip_summary.join(F.broadcast(top.select("route_id")), "route_id", "left_semi")
    return (
        top.join(F.broadcast(route_unique_buses(chosen)), "route_id", "left")
        .join(catalog, "route_id", "left")
        .select(
            "route_id",
            *SUMS3,
            "unique_active_buses",
            "route_name",
            "duration_min",
            "distance_km_ref",
            "stops_inbound_outbound",
            "connected_metro1",
        )
    )


def trip_outliers(trip_summary: DataFrame, catalog: DataFrame, k: int = 15, min_km: float = 1.0) -> DataFrame:
    """Trips of at least ``min_km`` by CO2 per km."""
    ranked = (
        trip_intensity(trip_summary)
        .filter(F.col("distance_km") >= F.lit(float(min_km)))
        .orderBy(F.desc_nulls_last("co2_kg_per_km"), F.asc("trip_id"), F.asc("route_id"))
        .limit(k)
        .select("trip_id", "bus_id", "route_id", "distance_km", "co2_kg_est", "co2_kg_per_km")
    )
    return ranked.join(catalog.select("route_id", "route_name"), "route_id", "left").select(
        "trip_id", "bus_id", "route_id", "distance_km", "co2_kg_est", "co2_kg_per_km", "route_name"
    )


def top_trips(trip_summary: DataFrame, catalog: DataFrame, k: int = 80, route: str | None = None) -> DataFrame:
    """The longest trips (distance, then CO2, then id) with route
    name, of one normalized ``route`` or of all; the trips the map shows."""
    rows = trip_summary if route is None else trip_summary.filter(F.col("route_id") == F.lit(route))
    ranked = rows.orderBy(
        F.desc_nulls_last("distance_km"), F.desc_nulls_last("co2_kg_est"), F.asc("trip_id"), F.asc("route_id")
    ).limit(k)
    return ranked.select("trip_id", "bus_id", "route_id", "distance_km", "co2_kg_est", "trip_start", "trip_end").join(
        catalog.select("route_id", "route_name"), "route_id", "left"
    )


def trip_point_rank(points: DataFrame, catalog: DataFrame, k: int = 80) -> DataFrame:
    """Trips by point count, then latest start; ``points`` has
    ``trip_id, bus_id, route_id, event_time_local`` (raw or cached events
    with trips assigned, W3)."""
    per_trip = points.groupBy("trip_id", "bus_id", "route_id").agg(
        F.min("event_time_local").alias("trip_start"),
        F.max("event_time_local").alias("trip_end"),
        F.count("event_time_local").alias("point_count"),
    )
    ranked = per_trip.orderBy(
        F.desc_nulls_last("point_count"), F.desc_nulls_last("trip_start"), F.asc("trip_id"), F.asc("route_id")
    ).limit(k)
    return (
        ranked.join(catalog.select("route_id", "route_name"), "route_id", "left")
        .withColumn("distance_km", F.lit(0.0))
        .withColumn("co2_kg_est", F.lit(0.0))
    )


def kpi_summary(bus_daily: DataFrame, route_hourly: DataFrame, trip_summary: DataFrame) -> DataFrame:
    """One row of key figures. Each table is reduced to one row
    by a global aggregate; the three rows are combined positionally by a
    one-row join on a constant (not a cross product of data)."""
    b = bus_daily.agg(
        F.round(_total("distance_km"), 2).alias("total_distance_km"),
        F.round(_total("fuel_liter_est"), 2).alias("total_fuel_liter"),
        F.round(_total("co2_kg_est"), 2).alias("total_co2_kg"),
        F.countDistinct("bus_id").alias("active_buses"),
        F.min("event_date").cast("string").alias("date_from"),
        F.max("event_date").cast("string").alias("date_to"),
    )
    r = route_hourly.agg(F.countDistinct("route_id").alias("active_routes"))
    unknown = F.sum(F.when(F.col("route_id") == UNKNOWN_ROUTE, 1).otherwise(0))
    t = trip_summary.agg(
        F.countDistinct("trip_id").alias("total_trips"),
        F.coalesce(unknown, F.lit(0)).cast("long").alias("trip_route_missing_count"),
        F.round(F.coalesce(unknown, F.lit(0)) / F.greatest(F.count(F.lit(1)), F.lit(1)), 4).alias("trip_route_missing_ratio"),
    )
    one = F.lit(1)
    return (
        b.withColumn("_k", one)
        .join(r.withColumn("_k", one), "_k")
        .join(t.withColumn("_k", one), "_k")
        .select(
            "total_distance_km",
            "total_fuel_liter",
            "total_co2_kg",
            "active_buses",
            "active_routes",
            "total_trips",
            "trip_route_missing_count",
            "trip_route_missing_ratio",
            "date_from",
            "date_to",
        )
    )


def insight_values(bus_daily: DataFrame, route_hourly: DataFrame, trip_summary: DataFrame, catalog: DataFrame) -> DataFrame:
    """The values the insight sentences quote - top route, peak
    hour, peak day, top bus - as one row (``max_by`` over the rankings)."""
    routes = top_routes(route_hourly, trip_summary, catalog, k=1)
    hours = peak_hours(route_hourly).limit(1)
    days = daily_totals(bus_daily).orderBy(F.desc_nulls_last("co2_kg_est"), F.asc("event_date")).limit(1)
    buses = bus_totals(bus_daily).orderBy(F.desc_nulls_last("co2_kg_est"), F.asc("bus_id")).limit(1)
    one = F.lit(1)
    r = routes.select(
        one.alias("_k"),
        F.col("route_id").alias("top_route_id"),
        F.round("co2_kg_est", 2).alias("top_route_co2_kg"),
        F.round("distance_km", 2).alias("top_route_distance_km"),
        F.coalesce(F.col("unique_active_buses"), F.lit(0)).cast("long").alias("top_route_unique_buses"),
    )
    h = hours.select(one.alias("_k"), F.lpad(F.col("event_hour").cast("string"), 2, "0").alias("peak_hour"), F.round("co2_kg_est", 2).alias("peak_hour_co2_kg"))
    d = days.select(one.alias("_k"), F.col("event_date").cast("string").alias("peak_day"), F.round("co2_kg_est", 2).alias("peak_day_co2_kg"))
    b = buses.select(one.alias("_k"), F.col("bus_id").alias("top_bus_id"), F.round("co2_kg_est", 2).alias("top_bus_co2_kg"))
    base = bus_daily.sparkSession.range(1).select(one.alias("_k"))
    return base.join(r, "_k", "left").join(h, "_k", "left").join(d, "_k", "left").join(b, "_k", "left").drop("_k")


def insight_text(values: DataFrame) -> DataFrame:
    """The finding sentences built from ``insight_values`` with
    ``format_string`` (wording is ours; values are the reference's)."""
    return values.select(
        F.format_string("Route %s has the highest CO2: %.2f kg over %.2f km and %d buses.", "top_route_id", "top_route_co2_kg", "top_route_distance_km", "top_route_unique_buses").alias("route_finding"),
        F.format_string("Peak hour %s:00 emits %.2f kg CO2.", "peak_hour", "peak_hour_co2_kg").alias("hour_finding"),
        F.format_string("Highest day %s reaches %.2f kg CO2.", "peak_day", "peak_day_co2_kg").alias("day_finding"),
        F.format_string("Bus %s emits the most: %.2f kg CO2.", "top_bus_id", "top_bus_co2_kg").alias("bus_finding"),
    )


def dashboard_tables(top_bus: DataFrame, top_route: DataFrame, outliers: DataFrame) -> dict[str, DataFrame]:
    """K9: report tables rounded and blank-filled as the dashboard shows them."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    r2 = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 2)
    return {
        "top_buses_table": top_bus.select(
            F.col("bus_id").cast("string").alias("bus_id"),
            blank("dominant_route_id").alias("route_id"),
            blank("dominant_route_name").alias("route_name"),
            r2("distance_km").alias("distance_km"),
            r2("co2_kg_est").alias("co2_kg_est"),
        ),
        "top_routes_table": top_route.select(
            F.col("route_id"),
            blank("route_name").alias("route_name"),
            blank("duration_min").alias("duration_min"),
            r2("distance_km_ref").alias("distance_km_ref"),
            blank("stops_inbound_outbound").alias("stops_inbound_outbound"),
            blank("connected_metro1").alias("connected_metro1"),
            r2("distance_km").alias("distance_km"),
            r2("co2_kg_est").alias("co2_kg_est"),
            F.coalesce(F.col("unique_active_buses"), F.lit(0)).cast(T.LongType()).alias("unique_active_buses"),
        ),
        "trip_outliers_table": outliers.select(
            "trip_id",
            "bus_id",
            "route_id",
            blank("route_name").alias("route_name"),
            r2("distance_km").alias("distance_km"),
            r2("co2_kg_est").alias("co2_kg_est"),
            F.round(F.coalesce(F.col("co2_kg_per_km"), F.lit(0.0)), 3).alias("co2_kg_per_km"),
        ),
    }


def dashboard_series(bus_daily: DataFrame, route_hourly: DataFrame) -> dict[str, DataFrame]:
    """K9: the two series the dashboard draws, as labels and values with their
    place: CO2 per day in date order, CO2 per hour in order of the hour."""
    co2 = F.round(F.coalesce("co2_kg_est", F.lit(0.0)), 2).alias("value")
    place = lambda c: (F.row_number().over(Window.orderBy(c)) - 1).cast("int").alias("place")  # noqa: E731  a row per day or hour
    days = daily_totals(bus_daily).select(F.col("event_date").cast("string").alias("label"), co2, place("event_date"))
    hours = peak_hours(route_hourly).select(F.lpad(F.col("event_hour").cast("string"), 2, "0").alias("label"), co2, place("event_hour"))
    return {"daily_trend": days, "peak_hours": hours}


def missing_route_finding(kpis: DataFrame) -> DataFrame:
    """The finding on trips without a route, from the key figures."""
    share = F.round(F.col("trip_route_missing_ratio") * 100, 2)
    text = F.format_string("%d trips (%.2f%% of all) have no route; rankings by route leave them out.", "trip_route_missing_count", share)
    return kpis.select("trip_route_missing_count", share.alias("missing_percent"), text.alias("missing_route_finding"))
