"""Sinks: Gold tables, reports, key figures, map data, event cache,
profiles (K3, K5-K8, K10). All overwrite their target (idempotent)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_gold(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """The three Gold tables; hourly and daily partitioned by
    ``event_date`` (partition pruning for date filters), rows sorted within
    files by the reference's output order (no global sort)."""
    order = {
        "trip_summary": ["trip_start"],
        "route_hourly_emissions": ["event_date", "event_hour"],
        "bus_daily_emissions": ["event_date"],
    }
    for name, df in tables.items():
        w = df.sortWithinPartitions(*order.get(name, [])).write.mode("overwrite").format(fmt)
        if name in ("route_hourly_emissions", "bus_daily_emissions"):
            w = w.partitionBy("event_date")
        w.save(f"{root}/{name}")


def write_silver(silver: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Silver laid out for lookups by day and bus: a folder per UTC day, and
    within a file the rows of a bus together. Tasks get ranges of (day, bus,
    time), so that neither a long day nor a busy bus is one file, and a reader
    skips folders by day and row groups by bus."""
    by = ["event_date", "bus_id", "event_time"]
    rows = silver.withColumn("event_date", F.to_date("event_time")).repartitionByRange(*by).sortWithinPartitions(*by)
    rows.write.mode("overwrite").format(fmt).partitionBy("event_date").save(f"{root}/silver")


def write_reports(tables: dict[str, DataFrame], folder: str) -> None:
    """K6: report tables as CSV with header (each is small: a top-k or a
    per-hour/day rollup), one file per table."""
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_kpis(kpis: DataFrame, folder: str) -> None:
    """K7: the one-row key figures as JSON."""
    kpis.coalesce(1).write.mode("overwrite").json(f"{folder}/kpi_summary")


def write_map(datasets: dict[str, DataFrame], folder: str) -> None:
    """K8: each map dataset (nested arrays and structs) as JSON lines."""
    for name, df in datasets.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def write_event_cache(events: DataFrame, path: str) -> None:
    """K5: normalized events as JSON lines (the replay cache)."""
    events.write.mode("overwrite").json(path)


def write_profile(profile: DataFrame, path: str) -> None:
    """The dataset profile as JSON lines."""
    profile.write.mode("overwrite").json(path)


def write_kafka(keyed: DataFrame, topic: str, servers: str) -> None:
    """K4: keyed JSON events to a Kafka topic (needs the Kafka connector on
    the cluster)."""
    keyed.select(F.col("key"), F.col("value")).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
