"""Table scans: Silver/Gold tables, the vehicle mapping, the route catalog,
the event cache and point lookups for a set of trips (S8-S12)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.routes import normalize_route_id
from ..settings import EVENT_WIRE_DDL

CATALOG_COLUMNS = ["route_id", "route_name", "duration_min", "distance_km_ref", "stops_inbound_outbound", "connected_metro1"]


def read_table(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """Read a written table, with a clear error when nothing is there."""
    try:
        return spark.read.format(table_format).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            raise FileNotFoundError(f"table not found at {path}; run the job that writes it first") from exc
        raise


def read_mapping_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """Optional mapping file; ``None`` when it does not exist."""
    try:
        return spark.read.option("header", True).csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def vehicle_route_map(raw: DataFrame) -> DataFrame:
    """S9 with the Gold rule: route is ``coalesce(route_no, route_id)`` per
    row (either column may be missing), a trimmed blank counts as missing,
    rows without vehicle or route are dropped, and each vehicle keeps its
    smallest route (deterministic, F12)."""
    cols = set(raw.columns)
    parts = [F.col(c).cast("string") for c in ("route_no", "route_id") if c in cols]
    if not parts or "vehicle" not in cols:
        raise ValueError("mapping needs a vehicle column and route_no or route_id")
    route = F.coalesce(*parts) if len(parts) > 1 else parts[0]
    route = F.when(F.trim(route) == "", F.lit(None)).otherwise(route)
    return (
        raw.select(F.col("vehicle").cast("string").alias("vehicle"), route.alias("mapped_route_id"))
        .dropna(subset=["vehicle", "mapped_route_id"])
        .groupBy("vehicle")
        .agg(F.min("mapped_route_id").alias("mapped_route_id"))
    )


def route_catalog(raw: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """Route id normalized, text columns blank-filled, reference distance
    as double (bad text to NULL), first row per route id (smallest name on
    ties, deterministic). An empty catalog with the same schema when the
    file is missing."""
    if raw is None:
        schema = T.StructType(
            [T.StructField(c, T.DoubleType() if c == "distance_km_ref" else T.StringType()) for c in CATALOG_COLUMNS]
        )
        return spark.createDataFrame([], schema)

    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in raw.columns else F.lit("")

    rows = raw.select(
        normalize_route_id(F.col("route_no")).alias("route_id"),
        text("route_name").alias("route_name"),
        text("duration_min").alias("duration_min"),
        F.expr("try_cast(distance_km as double)").alias("distance_km_ref"),
        text("stops_inbound_outbound").alias("stops_inbound_outbound"),
        text("connected_metro1").alias("connected_metro1"),
    )
    return rows.groupBy("route_id").agg(
        *[F.min_by(c, F.struct("route_name", "duration_min", "stops_inbound_outbound")).alias(c) for c in CATALOG_COLUMNS[1:]]
    )


def read_event_cache(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines event cache with the wire schema; ``ValueError`` when
    the files lack a required column (the columns they have are inferred)."""
    required = {"event_time", "bus_id", "latitude", "longitude"}
    if missing := required - set(spark.read.json(path).columns):
        raise ValueError(f"event cache lacks {sorted(missing)}")
    return spark.read.schema(EVENT_WIRE_DDL).json(path)


def resolve_points(spark: SparkSession, silver: str | None = None, cache: str | None = None, raw: str | None = None, table_format: str = "parquet") -> tuple[str, DataFrame]:
    """Points from the first source that is there: the Silver table, else
    the event cache, else the raw files (mapped). Returns which one it was;
    the columns are those of the events, and trips where Silver has them."""
    from ..operators.normalize import drop_incomplete, normalize_events
    from .raw import read_mapped

    tries = (
        ("silver", silver, lambda p: spark.read.format(table_format).load(p)),
        ("cache", cache, lambda p: normalize_events(read_event_cache(spark, p))),
        ("raw", raw, lambda p: read_mapped(spark, p)),
    )
    for kind, path, read in tries:
        if path is None:
            continue
        try:
            return kind, drop_incomplete(read(path))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
                raise
        except (ValueError, FileNotFoundError):  # a cache without the columns, a folder without files
            continue
    raise FileNotFoundError("no Silver table, event cache or raw files to read points from")


#: So many chosen trips go into the scan's filters; more are joined only.
MOST_LISTED = 1000


def trip_points(silver: DataFrame, trips: DataFrame, timezone: str, columns: list[str] | None = None) -> DataFrame:
    """The points of chosen Gold trips (trip_id, bus_id, trip_start
    and trip_end in local time), from Silver as ``write_silver`` lays it out. A
    repeated trip id does not repeat points. The chosen trips, a top-k list,
    say which days and buses can hold their points: those go into the scan's
    filters, so that other folders and row groups are not read."""
    sel = silver if columns is None else silver.select(*dict.fromkeys([*columns, "trip_id", "bus_id", "event_date"]))
    utc = lambda c: F.to_date(F.to_utc_timestamp(c, timezone))
    days = trips.select("trip_id", "bus_id", F.explode(F.sequence(utc("trip_start"), utc("trip_end"))).alias("day"))
    listed = days.limit(MOST_LISTED + 1).collect()
    if len(listed) <= MOST_LISTED:
        sel = sel.where(F.col("event_date").isin(sorted({r.day for r in listed})) & F.col("bus_id").isin(sorted({r.bus_id for r in listed})))
    return sel.join(F.broadcast(trips.select("trip_id").distinct()) if len(listed) <= MOST_LISTED else trips.select("trip_id").distinct(), "trip_id", "left_semi")
