"""Gold aggregates (A1-A3). Each is one hash aggregate; sums, min and max
are combined map-side, so a trip or bus with a third of all rows shuffles
one partial row per input partition, not its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = ("distance_km", "fuel_liter_est", "co2_kg_est")


def _sums():
    return [F.sum(c).alias(c) for c in SUMS]


def trip_summary(enriched: DataFrame) -> DataFrame:
    """A1: one row per (trip, bus, route) - a trip whose route changes after
    the fill has one row per route, as in the reference (F23)."""
    return enriched.groupBy("trip_id", "bus_id", "route_id").agg(
        F.min("event_time_local").alias("trip_start"),
        F.max("event_time_local").alias("trip_end"),
        *_sums(),
    )


def route_hourly_emissions(enriched: DataFrame) -> DataFrame:
    """A2: per route, local date and hour; exact distinct buses."""
    return enriched.groupBy("route_id", "event_date", "event_hour").agg(
        *_sums(), F.countDistinct("bus_id").alias("active_buses")
    )


def bus_daily_emissions(enriched: DataFrame) -> DataFrame:
    """A3: per bus and local date."""
    return enriched.groupBy("bus_id", "event_date").agg(*_sums())
