"""Schema mapping, time parsing, coercion and event shaping (N1-N9, Q2,
R11, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.routes import null_if_nan_token
from ..plans.joins import join_dimension
from ..session import materialize
from ..settings import EPOCH_NUMERIC_RATIO, EVENT_COLUMNS, EVENT_WIRE_DDL, Candidates

CRITICAL = ("event_time", "bus_id", "latitude", "longitude")
TARGETS = ("event_time", "bus_id", "route_id", "latitude", "longitude", "speed_kmh", "heading")


def present(columns: list[str], candidates) -> list[str]:
    """The columns that are candidates, in the candidates' order, whatever
    their case."""
    by_name: dict[str, list[str]] = {}
    for c in columns:
        by_name.setdefault(c.lower(), []).append(c)
    return [c for name in candidates for c in by_name.get(name.lower(), [])]


def try_double(c) -> F.Column:
    """Numeric coercion; bad text becomes NULL (ANSI-safe, F15)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string").try_cast("double")


def parse_event_time(df: DataFrame, col: str = "event_time", by: str = "source_file", ratio: float = EPOCH_NUMERIC_RATIO) -> DataFrame:
    """Per source file, when more than ``ratio`` of the values are
    numeric they are epoch seconds (fractions kept to the microsecond), else
    ISO text; what does not parse, or lies beyond the range of a timestamp,
    becomes NULL. The ratio is one aggregate per file, written and joined back:
    a join of known size, for which the rows don't meet by file."""
    text = F.col(col).cast("string")
    num = text.try_cast("double")
    stats = df.groupBy(by).agg(F.avg(F.when(num.isNotNull(), 1.0).otherwise(0.0)).alias("_num_ratio"))
    epoch = F.timestamp_micros(F.round(F.nanvl(num, F.lit(None).cast("double")) * 1_000_000).try_cast("long"))
    parsed = F.when(F.col("_num_ratio") > F.lit(float(ratio)), epoch).otherwise(F.try_to_timestamp(text))
    return join_dimension(df, materialize(stats, "time-ratios"), by, "left").withColumn(col, parsed).drop("_num_ratio")


def map_schema(df: DataFrame, candidates: Candidates = Candidates(), mapping: DataFrame | None = None) -> DataFrame:
    """N1/N2/N4/N5 (+J2): raw columns to the normalized event layout.

    A target is the first candidate that has a value, so rows of files with
    different column names, united by name, are each mapped by their own.
    Required fields need a candidate column, else ``ValueError``; optional
    ones become NULL; ``source_file`` defaults to ``unknown``. With a mapping
    (``vehicle, mapped_route_id``) an empty route takes the vehicle's."""
    cols = df.columns
    found = {t: present(cols, getattr(candidates, t)) for t in TARGETS}
    if missing := [t for t in CRITICAL if not found[t]]:
        raise ValueError(f"no column for {', '.join(missing)} among {cols}")
    value = {t: F.coalesce(*(F.col(f"`{c}`").cast("string") for c in own)) if own else F.lit(None).cast("string") for t, own in found.items()}
    for t in ("latitude", "longitude", "speed_kmh", "heading"):
        value[t] = try_double(value[t])
    value["route_id"] = null_if_nan_token(value["route_id"])
    value["source_file"] = F.coalesce(F.col("source_file").cast("string"), F.lit("unknown")) if "source_file" in cols else F.lit("unknown")
    out = parse_event_time(df.select(*(v.alias(t) for t, v in value.items())))
    if mapping is not None:
        m = mapping.select(F.col("vehicle").alias("_v"), F.col("mapped_route_id").alias("_r"))
        out = join_dimension(out, m, F.col("bus_id") == F.col("_v"), "left")
        out = out.withColumn("route_id", F.coalesce(F.when(F.col("route_id") != "", F.col("route_id")), F.col("_r")))
    return out.select(*TARGETS, "source_file")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Q2: rows lacking time, bus or position are dropped."""
    return df.dropna(subset=list(CRITICAL))


def order_events(df: DataFrame, tie_cols: list[str] | None = None) -> DataFrame:
    """Events in time order (a range-partitioned global sort)."""
    return df.orderBy("event_time", *(tie_cols or ["bus_id"]))


def to_events(df: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """The 9-field wire event with ISO text times and ``ingest_time``;
    the columns ``beside`` come along unchanged."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    return df.select(
        F.date_format("event_time", iso).alias("event_time"),
        "bus_id",
        "route_id",
        "latitude",
        "longitude",
        "speed_kmh",
        "heading",
        F.coalesce(F.col("source_file"), F.lit("unknown")).alias("source_file"),
        F.date_format(F.current_timestamp(), iso).alias("ingest_time"),
        *beside,
    )


def to_keyed_json(events: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """K4: ``key`` = bus id, ``value`` = the event as JSON (Kafka layout);
    the columns ``beside`` stay out of the JSON."""
    value = F.to_json(F.struct(*[F.col(c) for c in events.columns if c not in beside]))
    return events.select(F.col("bus_id").cast("string").alias("key"), value.alias("value"), *beside)


def decode_events(stream: DataFrame) -> DataFrame:
    """Kafka-style rows (``value`` bytes or text, ``timestamp``)
    to parsed fields plus ``json_payload`` and ``kafka_ingest_ts``; a corrupt
    payload gives all-NULL fields. ``NaN`` route tokens become NULL."""
    cols = stream.columns
    ts = F.col("timestamp") if "timestamp" in cols else F.current_timestamp()
    raw = stream.select(F.col("value").cast("string").alias("json_payload"), ts.alias("kafka_ingest_ts"), *[c for c in ("partition", "offset") if c in cols])
    parsed = raw.select(F.from_json("json_payload", EVENT_WIRE_DDL).alias("x"), "*").select("x.*", *raw.columns)
    return parsed.withColumn("route_id", null_if_nan_token("route_id"))


def normalize_events(df: DataFrame) -> DataFrame:
    """Typed times and numbers with ANSI-safe parsing."""
    out = df
    for c in ("event_time", "ingest_time"):
        if c in out.columns and not isinstance(out.schema[c].dataType, T.TimestampType):
            out = out.withColumn(c, F.try_to_timestamp(F.col(c).cast("string")))
    for c in ("latitude", "longitude", "speed_kmh", "heading"):
        if c in out.columns and not isinstance(out.schema[c].dataType, T.DoubleType):
            out = out.withColumn(c, try_double(c))
    return out


__all__ = [
    "EVENT_COLUMNS",
    "decode_events",
    "drop_incomplete",
    "map_schema",
    "normalize_events",
    "order_events",
    "parse_event_time",
    "present",
    "to_events",
    "to_keyed_json",
]
