"""DuckDB SQL that recomputes each registered query from the driver tables.

The SQL is written independently of the Spark code (plain windows and
aggregates) and is the correctness oracle. Floats are rounded to 6 places
and timestamps rendered as text in both engines so values hash equally.
"""

from __future__ import annotations

# The ping projection of FIXTURES.md §2, then Silver, mapping, Gold input.
PING = """
ping AS (
  SELECT event_id, c.copy_no,
    concat('B', CAST(user_id AS VARCHAR)) AS bus_id,
    1742464800 + CAST(floor((epoch_us(ts) - 1704067200000000) / CAST(60000000 AS DOUBLE)) AS BIGINT) AS t,
    CASE WHEN user_id % 5 = 0 THEN '  ' WHEN event_id % 50 = 0 THEN '99'
         ELSE lpad(CAST(user_id % 20 AS VARCHAR), 3, '0') END AS route_raw,
    CASE WHEN event_id % 97 = 0 THEN CAST(95 AS DOUBLE)
         ELSE CAST(10.70 AS DOUBLE) + (user_id % 20) * CAST(0.01 AS DOUBLE)
            + ((event_id * 37) % 200) * CAST(0.0001 AS DOUBLE) END AS latitude,
    CAST(106.60 AS DOUBLE) + (user_id % 13) * CAST(0.01 AS DOUBLE)
            + ((event_id * 53) % 150) * CAST(0.0001 AS DOUBLE) AS longitude,
    CASE WHEN event_id % 29 = 0 THEN NULL
         ELSE CAST(greatest(CAST(json_extract_string(props, '$.k') AS INTEGER) - 15, 0) AS DOUBLE) END AS speed_kmh
  FROM events
  JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1) c ON c.copy_no = 0 OR event_id % 40 = 0
)"""

SILVER = """
lagged AS (
  SELECT *, lag(t) OVER w AS prev_t, lag(latitude) OVER w AS prev_lat,
         lag(longitude) OVER w AS prev_lon, lag(route_raw) OVER w AS prev_route
  FROM ping WINDOW w AS (PARTITION BY bus_id ORDER BY t, event_id, copy_no)
),
hav AS (
  SELECT *, pow(sin(radians(latitude - prev_lat) / 2), 2)
            + cos(radians(prev_lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - prev_lon) / 2), 2) AS hav_a
  FROM lagged
),
seg AS (
  SELECT *, t - prev_t AS segment_duration_s,
    coalesce(CAST(6371000 AS DOUBLE) * (atan2(sqrt(hav_a), sqrt(1 - hav_a)) * 2), CAST(0 AS DOUBLE)) AS segment_distance_m,
    CASE WHEN prev_t IS NULL OR t - prev_t > 900 OR route_raw <> prev_route THEN 1 ELSE 0 END AS new_trip,
    (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND t IS NOT NULL) AS is_valid_gps
  FROM hav
),
seg2 AS (
  SELECT *,
    CAST(sum(new_trip) OVER (PARTITION BY bus_id ORDER BY t, event_id, copy_no
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS trip_seq,
    CASE WHEN segment_duration_s > 0 THEN segment_distance_m / segment_duration_s * CAST(3.6 AS DOUBLE) END AS derived_speed_kmh
  FROM seg
),
silver_all AS (
  SELECT *, bus_id || '_' || CAST(trip_seq AS VARCHAR) AS trip_id,
    (t = prev_t AND latitude = prev_lat AND longitude = prev_lon) AS is_duplicate,
    (segment_duration_s <= 0 OR segment_distance_m > 2000 OR derived_speed_kmh > 120) AS is_outlier
  FROM seg2
),
silver AS (SELECT * FROM silver_all WHERE is_valid_gps),
mapping AS (
  SELECT vehicle, min(route_no) AS route_no FROM (
    SELECT concat('B', CAST(c_custkey AS VARCHAR)) AS vehicle,
           lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS route_no
    FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL
    SELECT concat('B', CAST(c_custkey AS VARCHAR)), '42' FROM customer WHERE c_custkey % 11 = 0) m
  GROUP BY vehicle
),
catalog_raw AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS route_no, n_name AS route_name,
    CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(15 + n_nationkey AS VARCHAR) END AS duration_min,
    CASE WHEN n_nationkey % 9 = 0 THEN 'n/a' ELSE CAST(5 + n_nationkey AS VARCHAR) END AS distance_km,
    CAST(NULL AS VARCHAR) AS stops_inbound_outbound,
    CASE WHEN n_regionkey = 0 THEN 'Y' END AS connected_metro1
  FROM nation
),
catalog AS (
  SELECT {norm_route_no} AS route_id, coalesce(route_name, '') AS route_name,
    coalesce(duration_min, '') AS duration_min, TRY_CAST(distance_km AS DOUBLE) AS distance_km_ref,
    coalesce(stops_inbound_outbound, '') AS stops_inbound_outbound,
    coalesce(connected_metro1, '') AS connected_metro1
  FROM catalog_raw
),
filled AS (
  SELECT s.*, coalesce(CASE WHEN trim(s.route_raw) = '' THEN NULL ELSE s.route_raw END, m.route_no) AS route_id
  FROM silver s LEFT JOIN mapping m ON s.bus_id = m.vehicle
),
enriched AS (
  SELECT *, fuel_liter_est * CAST(2.68 AS DOUBLE) AS co2_kg_est FROM (
    SELECT *, distance_km * CAST(0.28 AS DOUBLE) + idle_min * CAST(0.03 AS DOUBLE) AS fuel_liter_est FROM (
      SELECT *, coalesce(segment_distance_m, CAST(0 AS DOUBLE)) / CAST(1000 AS DOUBLE) AS distance_km,
        CASE WHEN coalesce(speed_kmh, CAST(0 AS DOUBLE)) <= CAST(1 AS DOUBLE)
             THEN segment_duration_s / CAST(60 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS idle_min,
        make_timestamp(t * 1000000) + INTERVAL 7 HOUR AS event_time_local
      FROM filled) a) b
),
enriched_t AS (
  SELECT *, CAST(event_time_local AS DATE) AS event_date, CAST(hour(event_time_local) AS INTEGER) AS event_hour FROM enriched
),
g_trip AS (
  SELECT trip_id, bus_id, route_id, min(event_time_local) AS trip_start, max(event_time_local) AS trip_end,
    sum(distance_km) AS distance_km, sum(fuel_liter_est) AS fuel_liter_est, sum(co2_kg_est) AS co2_kg_est
  FROM enriched_t GROUP BY trip_id, bus_id, route_id
),
g_hour AS (
  SELECT route_id, event_date, event_hour, sum(distance_km) AS distance_km, sum(fuel_liter_est) AS fuel_liter_est,
    sum(co2_kg_est) AS co2_kg_est, count(DISTINCT bus_id) AS active_buses
  FROM enriched_t GROUP BY route_id, event_date, event_hour
),
g_day AS (
  SELECT bus_id, event_date, sum(distance_km) AS distance_km, sum(fuel_liter_est) AS fuel_liter_est,
    sum(co2_kg_est) AS co2_kg_est
  FROM enriched_t GROUP BY bus_id, event_date
),
ts AS (SELECT * REPLACE ({norm_route_id} AS route_id) FROM g_trip),
rh AS (SELECT * REPLACE ({norm_route_id} AS route_id, CAST(coalesce(event_hour, 0) AS INTEGER) AS event_hour) FROM g_hour),
bd AS (SELECT * FROM g_day),
bus_tot AS (
  SELECT bus_id, coalesce(sum(distance_km), 0) AS distance_km, coalesce(sum(fuel_liter_est), 0) AS fuel_liter_est,
    coalesce(sum(co2_kg_est), 0) AS co2_kg_est FROM bd WHERE bus_id IS NOT NULL GROUP BY bus_id
),
route_tot AS (
  SELECT route_id, coalesce(sum(distance_km), 0) AS distance_km, coalesce(sum(fuel_liter_est), 0) AS fuel_liter_est,
    coalesce(sum(co2_kg_est), 0) AS co2_kg_est FROM rh WHERE route_id IS NOT NULL GROUP BY route_id
),
brc AS (
  SELECT bus_id, route_id, count(*) AS trip_count FROM ts
  WHERE route_id <> 'UNKNOWN' AND bus_id IS NOT NULL GROUP BY bus_id, route_id
),
dom AS (
  SELECT bus_id, route_id AS dominant_route_id, trip_count FROM (
    SELECT *, row_number() OVER (PARTITION BY bus_id ORDER BY trip_count DESC, route_id) AS rn FROM brc) x
  WHERE rn = 1
),
rub AS (
  SELECT route_id, count(DISTINCT bus_id) AS unique_active_buses FROM ts
  WHERE route_id <> 'UNKNOWN' AND bus_id IS NOT NULL GROUP BY route_id
)"""


def norm_route(expr: str) -> str:
    """N10 in SQL: NULL/blank to UNKNOWN, trim, upper, digits lose leading zeros."""
    x = f"upper(regexp_replace({expr}, '^\\s+|\\s+$', '', 'g'))"
    return (
        f"(CASE WHEN {expr} IS NULL OR {x} = '' THEN 'UNKNOWN' "
        f"WHEN regexp_full_match({x}, '[0-9]+') THEN coalesce(nullif(ltrim({x}, '0'), ''), '0') "
        f"ELSE {x} END)"
    )


def with_base(select_sql: str) -> str:
    ctes = PING + "," + SILVER.format(norm_route_no=norm_route("route_no"), norm_route_id=norm_route("route_id"))
    return "WITH " + ctes + "\n" + select_sql


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def ts_text(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


# Map CTEs: ranked trips, de-duplicated points, thinning, segments, buckets.
MAP = """,
mtop AS (
  SELECT o.*, c.route_name,
    row_number() OVER (ORDER BY o.distance_km DESC NULLS LAST, o.co2_kg_est DESC NULLS LAST, o.trip_id, o.route_id) AS rnk
  FROM (SELECT * FROM ts ORDER BY distance_km DESC NULLS LAST, co2_kg_est DESC NULLS LAST, trip_id, route_id LIMIT 80) o
  LEFT JOIN catalog c ON o.route_id = c.route_id
),
mtrips AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY rnk) AS rn FROM mtop) WHERE rn = 1),
mpts0 AS (
  SELECT s.trip_id, s.t, s.latitude, s.longitude, s.speed_kmh, s.event_id, s.copy_no,
    row_number() OVER (PARTITION BY s.trip_id, s.t, s.latitude, s.longitude ORDER BY s.event_id, s.copy_no) AS dn
  FROM silver s WHERE s.trip_id IN (SELECT trip_id FROM mtrips) AND s.t IS NOT NULL AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL
),
mpts AS (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY t, event_id, copy_no) - 1 AS point_idx,
    count(*) OVER (PARTITION BY trip_id) AS point_count_raw
  FROM mpts0 WHERE dn = 1
),
mkeep AS (
  SELECT trip_id, point_count_raw,
    CASE WHEN point_count_raw <= 180 THEN range(point_count_raw)
         ELSE list_distinct(list_transform(range(180), lambda i:
           least(CAST(round_even(i * ((point_count_raw - 1) / CAST(179 AS DOUBLE)), 0) AS BIGINT), point_count_raw - 1))) END AS keep
  FROM (SELECT DISTINCT trip_id, point_count_raw FROM mpts)
),
mthin AS (
  SELECT p.*, len(k.keep) AS point_count_view,
    row_number() OVER (PARTITION BY p.trip_id ORDER BY p.point_idx) - 1 AS view_idx
  FROM mpts p JOIN mkeep k ON p.trip_id = k.trip_id WHERE list_contains(k.keep, p.point_idx)
),
mlag AS (
  SELECT *, lag(latitude) OVER w AS lat1, lag(longitude) OVER w AS lon1, lag(t) OVER w AS t1
  FROM mthin WINDOW w AS (PARTITION BY trip_id ORDER BY view_idx)
),
mseg0 AS (
  SELECT m.trip_id, m.view_idx AS segment_idx, tr.route_id, coalesce(tr.route_name, '') AS route_name,
    m.lat1, m.lon1, m.latitude AS lat2, m.longitude AS lon2,
    CAST(6371 AS DOUBLE) * 2 * atan2(sqrt(ha), sqrt(1 - ha)) AS distance_km,
    greatest((m.t - m.t1) / CAST(60 AS DOUBLE), CAST(0 AS DOUBLE)) AS duration_min,
    m.speed_kmh, m.t
  FROM (SELECT *, pow(sin(radians(latitude - lat1) / 2), 2)
          + cos(radians(lat1)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon1) / 2), 2) AS ha FROM mlag) m
  LEFT JOIN mtrips tr ON m.trip_id = tr.trip_id
  WHERE m.view_idx > 0
),
mseg AS (
  SELECT *, (distance_km * CAST(0.28 AS DOUBLE) + idle_min * CAST(0.03 AS DOUBLE)) * CAST(2.68 AS DOUBLE) AS co2_kg_est,
    round_even(distance_km, 4) AS distance_km_r4,
    round_even((distance_km * CAST(0.28 AS DOUBLE) + idle_min * CAST(0.03 AS DOUBLE)) * CAST(2.68 AS DOUBLE), 4) AS co2_kg_r4,
    make_timestamp(((t + 25200) // 1800) * 1800 * 1000000) AS bucket_start
  FROM (SELECT *, CASE WHEN speed_kmh IS NOT NULL AND NOT isnan(speed_kmh) AND speed_kmh <= 1 THEN duration_min
                       ELSE CAST(0 AS DOUBLE) END AS idle_min FROM mseg0)
),
mbuck AS (
  SELECT bucket_start, route_id, round_even(lat1, 4) AS lat1_r4, round_even(lon1, 4) AS lon1_r4,
    round_even(lat2, 4) AS lat2_r4, round_even(lon2, 4) AS lon2_r4,
    sum(co2_kg_est) AS co2_sum, sum(distance_km) AS distance_sum, count(*) AS segment_count,
    round_even(sum(co2_kg_est), 4) AS co2_kg_est, round_even(sum(distance_km), 4) AS distance_km
  FROM mseg GROUP BY ALL
),
mday0 AS (
  SELECT CAST(bucket_start AS DATE) AS event_date, route_id, bucket_start,
    sum(CAST(co2_kg_est AS DECIMAL(20,4))) AS bucket_co2, sum(CAST(distance_km AS DECIMAL(20,4))) AS bucket_distance
  FROM mbuck GROUP BY ALL
),
mday AS (
  SELECT *, sum(bucket_co2) OVER (PARTITION BY event_date, route_id ORDER BY bucket_start
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative,
    CAST(round_even(sum(bucket_co2) OVER (PARTITION BY event_date, route_id), 3) AS DOUBLE) AS total_co2_kg,
    CAST(round_even(sum(bucket_distance) OVER (PARTITION BY event_date, route_id), 3) AS DOUBLE) AS total_distance_km
  FROM mday0
),
mactive AS (
  SELECT CAST(rb.bucket_start AS DATE) AS event_date, rb.route_id, count(DISTINCT bt.trip_id) AS active_trip_count
  FROM (SELECT DISTINCT route_id, bucket_start FROM mseg) rb
  JOIN (SELECT DISTINCT bucket_start, trip_id FROM mseg) bt ON rb.bucket_start = bt.bucket_start
  GROUP BY ALL
),
mown AS (
  SELECT CAST(bucket_start AS DATE) AS event_date, route_id, count(DISTINCT trip_id) AS route_trip_count FROM mseg GROUP BY ALL
),
mpath AS (
  SELECT tr.trip_id, tr.route_id,
    CASE WHEN round_even(coalesce(tr.distance_km, 0), 2) <= 0 THEN round_even(coalesce(s.km, 0), 2)
         ELSE round_even(coalesce(tr.distance_km, 0), 2) END AS distance_km,
    CASE WHEN round_even(coalesce(tr.co2_kg_est, 0), 2) <= 0 THEN round_even(coalesce(s.co2, 0), 2)
         ELSE round_even(coalesce(tr.co2_kg_est, 0), 2) END AS co2_kg_est,
    p.point_count_raw, p.point_count_view
  FROM mtrips tr
  JOIN (SELECT trip_id, max(point_count_raw) AS point_count_raw, max(point_count_view) AS point_count_view FROM mthin GROUP BY trip_id) p
    ON tr.trip_id = p.trip_id
  LEFT JOIN (SELECT trip_id, CAST(sum(CAST(distance_km_r4 AS DECIMAL(24,4))) AS DOUBLE) AS km,
                          CAST(sum(CAST(co2_kg_r4 AS DECIMAL(24,4))) AS DOUBLE) AS co2 FROM mseg GROUP BY trip_id) s ON tr.trip_id = s.trip_id
),
mgeo AS (
  SELECT route_id, trip_id, point_count_view FROM (
    SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY point_count_view DESC, trip_id) AS rn FROM mpath) WHERE rn = 1
)"""


def with_map(select_sql: str) -> str:
    ctes = PING + "," + SILVER.format(norm_route_no=norm_route("route_no"), norm_route_id=norm_route("route_id")) + MAP
    return "WITH " + ctes + "\n" + select_sql
