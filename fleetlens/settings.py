"""Run parameters as one dataclass.

Every operator takes plain keyword arguments; ``Settings`` only bundles the
defaults so a job can pass one object around. Nothing here is read from the
environment.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's behaviour for equal results:
# column candidates (first hit wins, case-insensitive), quality limits,
# emission coefficients and the report time zone.
BUS_ID_CANDIDATES = ("bus_id", "vehicle_id", "plate", "imei", "msgBusWayPoint.vehicle")
ROUTE_ID_CANDIDATES = ("route_id", "route", "tuyến", "line")
EVENT_TIME_CANDIDATES = ("event_time", "timestamp", "ts", "time", "recorded_at", "datetime", "msgBusWayPoint.datetime")
LATITUDE_CANDIDATES = ("latitude", "lat", "y", "msgBusWayPoint.y")
LONGITUDE_CANDIDATES = ("longitude", "lon", "lng", "x", "msgBusWayPoint.x")
SPEED_CANDIDATES = ("speed", "speed_kmh", "velocity", "msgBusWayPoint.speed")
HEADING_CANDIDATES = ("heading", "bearing", "msgBusWayPoint.heading")

TRIP_GAP_MINUTES = 15
MAX_SPEED_KMH = 120.0
MAX_JUMP_METERS = 2000.0
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)

FUEL_LITER_PER_KM = 0.28
IDLE_LITER_PER_MINUTE = 0.03
CO2_KG_PER_LITER = 2.68
IDLE_SPEED_KMH = 1.0

REPORT_TIMEZONE = "Asia/Ho_Chi_Minh"
BUCKET_MINUTES = 30
MAX_TRIPS = 80
MAX_POINTS_PER_TRIP = 180
EPOCH_NUMERIC_RATIO = 0.8
UNKNOWN_ROUTE = "UNKNOWN"

# Normalized event layout (the wire schema of the stream).
EVENT_COLUMNS = (
    "event_time",
    "bus_id",
    "route_id",
    "latitude",
    "longitude",
    "speed_kmh",
    "heading",
    "source_file",
    "ingest_time",
)
EVENT_WIRE_DDL = (
    "event_time string, bus_id string, route_id string, latitude double, longitude double, "
    "speed_kmh double, heading double, source_file string, ingest_time string"
)


@dataclass(frozen=True)
class Candidates:
    event_time: tuple[str, ...] = EVENT_TIME_CANDIDATES
    bus_id: tuple[str, ...] = BUS_ID_CANDIDATES
    route_id: tuple[str, ...] = ROUTE_ID_CANDIDATES
    latitude: tuple[str, ...] = LATITUDE_CANDIDATES
    longitude: tuple[str, ...] = LONGITUDE_CANDIDATES
    speed_kmh: tuple[str, ...] = SPEED_CANDIDATES
    heading: tuple[str, ...] = HEADING_CANDIDATES


@dataclass(frozen=True)
class Quality:
    trip_gap_minutes: float = TRIP_GAP_MINUTES
    max_speed_kmh: float = MAX_SPEED_KMH
    max_jump_meters: float = MAX_JUMP_METERS
    min_latitude: float = LAT_RANGE[0]
    max_latitude: float = LAT_RANGE[1]
    min_longitude: float = LON_RANGE[0]
    max_longitude: float = LON_RANGE[1]


@dataclass(frozen=True)
class Emission:
    fuel_liter_per_km: float = FUEL_LITER_PER_KM
    idle_liter_per_minute: float = IDLE_LITER_PER_MINUTE
    co2_kg_per_liter: float = CO2_KG_PER_LITER
    idle_speed_kmh: float = IDLE_SPEED_KMH


@dataclass(frozen=True)
class Settings:
    candidates: Candidates = field(default_factory=Candidates)
    quality: Quality = field(default_factory=Quality)
    emission: Emission = field(default_factory=Emission)
    report_timezone: str = REPORT_TIMEZONE
    bucket_minutes: int = BUCKET_MINUTES
    max_trips: int = MAX_TRIPS
    max_points_per_trip: int = MAX_POINTS_PER_TRIP
    table_format: str = "parquet"
