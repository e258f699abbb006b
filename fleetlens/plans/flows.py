"""Compositions used by the registered queries: driver tables to Silver,
Silver to the enriched Gold input, and the three Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold
from ..operators.emissions import estimate_emissions, fill_route
from ..operators.segments import build_silver, enrich_segments
from ..settings import Settings
from .ordered_scan import SLOT_ROWS
from ..sources import driver
from ..sources.tables import route_catalog, vehicle_route_map

DEFAULT = Settings()


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver.ping_events(spark, sf_dir)


def silver_all(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT, slot_rows: int | None = SLOT_ROWS) -> DataFrame:
    """Every ping with segments, flags and trips (before the validity filter)."""
    return enrich_segments(bronze(spark, sf_dir), quality=settings.quality, slot_rows=slot_rows)


def silver(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT, slot_rows: int | None = SLOT_ROWS) -> DataFrame:
    return build_silver(bronze(spark, sf_dir), quality=settings.quality, slot_rows=slot_rows)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_route_map(driver.vehicle_mapping_raw(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_catalog(driver.route_catalog_raw(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT, slot_rows: int | None = SLOT_ROWS) -> DataFrame:
    """Silver with the route filled from the mapping and the emission model."""
    s = silver(spark, sf_dir, settings, slot_rows)
    s = fill_route(s, mapping(spark, sf_dir))
    return estimate_emissions(s, settings.emission, settings.report_timezone)


def gold_tables(spark: SparkSession, sf_dir: str, settings: Settings = DEFAULT, slot_rows: int | None = SLOT_ROWS) -> dict[str, DataFrame]:
    e = enriched(spark, sf_dir, settings, slot_rows)
    return {
        "trip_summary": gold.trip_summary(e),
        "route_hourly_emissions": gold.route_hourly_emissions(e),
        "bus_daily_emissions": gold.bus_daily_emissions(e),
    }
