"""Fleet inputs derived from the driver's test tables.

The test data has no GPS table, so pings, the vehicle-to-route mapping and
the route catalog are deterministic projections of ``events``, ``customer``
and ``nation`` (the projection is fixed; see FIXTURES.md §2). Every clause
plants one case the pipeline must handle: blank routes, a route change inside
a trip, an invalid latitude, missing speeds, idle pings and exact copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the projection: the time axis is shifted to 2025-03-20
# 10:00 UTC and compressed by 60 so trips span several pings.
BASE_EPOCH_S = 1742464800
EVENTS_EPOCH_US = 1704067200000000
TIME_COMPRESSION_US = 60000000.0


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` projected to raw pings: ``event_id, copy_no, bus_id, t``
    (epoch seconds), ``route_raw, latitude, longitude, speed_kmh``.

    Copies come from an ``explode`` of a one- or two-element array, so no
    join is needed; the projection is narrow and fully pushed to the scan.
    """
    ev = read_driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    uid = F.col("user_id")
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return (
        ev.select(
            eid,
            F.explode(F.when(eid % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy_no"),
            F.concat(F.lit("B"), uid.cast("string")).alias("bus_id"),
            (F.lit(BASE_EPOCH_S) + F.floor((us - F.lit(EVENTS_EPOCH_US)) / F.lit(TIME_COMPRESSION_US)).cast("bigint")).alias("t"),
            F.when(uid % 5 == 0, F.lit("  "))
            .when(eid % 50 == 0, F.lit("99"))
            .otherwise(F.lpad((uid % 20).cast("string"), 3, "0"))
            .alias("route_raw"),
            F.when(eid % 97 == 0, F.lit(95.0))
            .otherwise(F.lit(10.70) + (uid % 20).cast("double") * F.lit(0.01) + ((eid * 37) % 200).cast("double") * F.lit(0.0001))
            .alias("latitude"),
            (F.lit(106.60) + (uid % 13).cast("double") * F.lit(0.01) + ((eid * 53) % 150).cast("double") * F.lit(0.0001)).alias("longitude"),
            F.when(eid % 29 == 0, F.lit(None).cast("double")).otherwise(F.greatest(k - 15, F.lit(0)).cast("double")).alias("speed_kmh"),
        )
    )


def ping_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pings as normalized events (the Bronze layout) plus the tie key
    ``event_id, copy_no`` used to order equal timestamps."""
    return raw_pings(spark, sf_dir).select(
        F.timestamp_seconds("t").alias("event_time"),
        "bus_id",
        F.col("route_raw").alias("route_id"),
        "latitude",
        "longitude",
        "speed_kmh",
        F.lit(None).cast("double").alias("heading"),
        F.lit("events").alias("source_file"),
        F.lit(None).cast("timestamp").alias("ingest_time"),
        "event_id",
        "copy_no",
    )


def vehicle_mapping_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping file rows (``vehicle, route_no``) with duplicate vehicles and
    vehicles without a row, as a mapping CSV would have them."""
    cust = read_driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    vehicle = F.concat(F.lit("B"), F.col("c_custkey").cast("string"))
    base = cust.filter(F.col("c_custkey") % 7 != 0).select(
        vehicle.alias("vehicle"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("route_no")
    )
    extra = cust.filter(F.col("c_custkey") % 11 == 0).select(vehicle.alias("vehicle"), F.lit("42").alias("route_no"))
    return base.unionByName(extra)


def route_catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route catalog rows as the catalog CSV holds them (all text)."""
    n = read_driver_table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(
        F.lpad(key.cast("string"), 3, "0").alias("route_no"),
        F.col("n_name").alias("route_name"),
        F.when(key % 4 == 0, F.lit(None).cast("string")).otherwise((F.lit(15) + key).cast("string")).alias("duration_min"),
        F.when(key % 9 == 0, F.lit("n/a")).otherwise((F.lit(5) + key).cast("string")).alias("distance_km"),
        F.lit(None).cast("string").alias("stops_inbound_outbound"),
        F.when(F.col("n_regionkey") == 0, F.lit("Y")).alias("connected_metro1"),
    )
