"""Independent DuckDB SQL for every registered query.

Written from the specification (FIXTURES adapters + the value rules), not
generated from the Spark plans, so a bug on one side shows as a mismatch.
Fragments are shared CTEs; each key gets one complete statement.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INT)"

# events -> bronze-shaped readings (typed times already applied where the
# silver layer types them; text forms are built where a query needs text).
FEED = f"""
ev AS (SELECT *, {K} AS k FROM events),
feed AS (
  SELECT event_id, ts, user_id, k, value, event_type,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS generated_text,
    ts AS generated,
    CASE WHEN k % 10 <> 0 THEN CAST(CAST(user_id % 30 AS INT) AS VARCHAR) END AS routeShortName,
    CASE WHEN k % 10 <> 0 THEN CAST(event_id AS INT) END AS tripId,
    CASE WHEN k % 10 <> 0 THEN CAST(user_id % 30 AS INT) END AS routeId,
    CASE WHEN k % 7 <> 0 THEN event_type END AS headsign,
    'Customer#' || lpad(CAST(user_id * 15 AS VARCHAR), 9, '0') AS vehicleCode,
    'svc-' || CAST(user_id % 7 AS VARCHAR) AS vehicleService,
    CAST(user_id AS INT) AS vehicleId,
    greatest(k - 30, 0) AS speed,
    (k * 37) % 360 AS direction,
    CASE WHEN k <> 99 THEN CAST(floor(value * 4) - 100 AS INT) END AS delay,
    CASE WHEN k % 10 <> 0 THEN date_trunc('hour', ts) END AS scheduledTripStartTime,
    CAST(CASE WHEN k = 50 THEN 0.0
              ELSE CAST(541000 + ((k * 37) % 100) * 60 AS DOUBLE) / 10000.0 END AS FLOAT) AS lat,
    CAST(CASE WHEN k = 50 THEN 0.0
              ELSE CAST(182000 + ((k * 53) % 100) * 90 AS DOUBLE) / 10000.0 END AS FLOAT) AS lon,
    k % 4 AS gpsQuality,
    date_trunc('hour', ts) AS lastUpdate,
    CAST(user_id % 4 AS INT) AS "partition",
    event_id AS "offset",
    ts AS enqueued_ts,
    ts AS event_time
  FROM ev
)"""

DELAY_MIN = "CAST(sign(delay) * ((abs(delay) * 2 + 6) // 12) AS DOUBLE) / 10.0"
BUCKET = ("CASE WHEN delay < -60 THEN 'early' WHEN delay <= 120 THEN 'on_time' "
          "ELSE 'delayed' END")
LOCAL = "timezone('Europe/Warsaw', timezone('UTC', {c}))"
BOX = ("CAST(lat AS DOUBLE) BETWEEN 54.2 AND 54.6 "
       "AND CAST(lon AS DOUBLE) BETWEEN 18.3 AND 19.0")

DERIVED = f"""
  {DELAY_MIN} AS delay_min,
  tripId IS NOT NULL AS has_trip,
  {BUCKET} AS delay_bucket,
  delay > 120 AS is_delayed,
  speed = 0 AS is_stopped,
  speed > 0 AS is_moving,
  gpsQuality > 0 AS gps_ok,
  {LOCAL.format(c='event_time')} AS event_time_local,
  {LOCAL.format(c='scheduledTripStartTime')} AS scheduled_start_local"""

CLEAN = f"""
clean AS (
  SELECT *, {DERIVED}
  FROM feed
  QUALIFY row_number() OVER (PARTITION BY vehicleId, generated
                             ORDER BY enqueued_ts, "partition", "offset") = 1
),
clean_box AS (SELECT * FROM clean WHERE {BOX})"""

ROUTES_DIM = """
routes_dim AS (
  SELECT n_nationkey AS gtfs_route_id, n_regionkey AS route_type,
         n_name AS route_color, 'FFFFFF' AS route_text_color
  FROM nation
)"""

VEHICLES_DIM = """
vehicles_dim AS (
  SELECT c_name AS vehicleCode,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Autobus'
         WHEN c_mktsegment = 'MACHINERY' THEN 'Tramwaj'
         ELSE c_mktsegment END AS transportationType,
    'class-' || CAST(c_custkey % 3 AS VARCHAR) AS vehicleCharacteristics,
    c_mktsegment AS brand,
    c_name AS model,
    1990 + c_custkey % 30 AS productionYear,
    CAST(10 + c_custkey % 9 AS DOUBLE) AS length,
    20 + c_custkey % 25 AS seats,
    40 + c_custkey % 60 AS standingPlaces,
    CASE WHEN c_custkey % 2 = 0 THEN 'low' ELSE 'high' END AS floorHeight,
    CASE WHEN c_custkey % 4 = 0 THEN 'electric' ELSE 'diesel' END AS driveType,
    CAST(c_nationkey AS VARCHAR) AS carrier,
    c_custkey % 2 = 0 AS airConditioning,
    c_custkey % 3 <> 0 AS wheelchairsRamp,
    c_custkey % 5 <> 0 AS ticketMachine,
    c_custkey % 7 = 0 AS usb
  FROM customer
)"""

SILVER = f"""
silver AS (
  SELECT s.* EXCLUDE (transportationType),
    CASE WHEN s.transportationType = 'Autobus' THEN 'Bus'
         WHEN s.transportationType = 'Tramwaj' THEN 'Tram'
         ELSE s.transportationType END AS transportationType
  FROM (
    SELECT c.*, r.route_type, r.route_color, r.route_text_color,
           v.* EXCLUDE (vehicleCode)
    FROM clean_box c
    LEFT JOIN routes_dim r ON c.routeId = r.gtfs_route_id
    LEFT JOIN vehicles_dim v ON c.vehicleCode = v.vehicleCode
  ) s
),
silver_t AS (
  SELECT *, CAST(round(delay_min * 10) AS BIGINT) AS tenths FROM silver
)"""

FLEET = """
fleet AS (
  SELECT vehicleId, vehicleCode, routeShortName, headsign, lat, lon, delay,
         delay_min, delay_bucket, speed, is_moving, transportationType, model,
         event_time, event_time_local
  FROM silver
  QUALIFY row_number() OVER (PARTITION BY vehicleId
      ORDER BY event_time DESC NULLS LAST, enqueued_ts DESC NULLS LAST,
               "partition" DESC NULLS LAST, "offset" DESC NULLS LAST) = 1
),
fleet_t AS (SELECT *, CAST(round(delay_min * 10) AS BIGINT) AS tenths FROM fleet)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def mean_tenths(s: str, n: str) -> str:
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((abs({s}) * 20 + {n}) // (2 * {n})) "
            f"AS DOUBLE) / 100.0 END")


def mean_int(s: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST((200 * {s} + {n}) // (2 * {n}) AS DOUBLE) / 100.0 END"


def pct(t: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST((2000 * {t} + {n}) // (2 * {n}) AS DOUBLE) / 10.0 END"


SILVER_ALL = (FEED, CLEAN, ROUTES_DIM, VEHICLES_DIM, SILVER)

SILVER_COLUMNS = (
    "vehicleCode", "generated", "routeShortName", "tripId", "routeId", "headsign",
    "vehicleService", "vehicleId", "speed", "direction", "delay",
    "scheduledTripStartTime", "lat", "lon", "gpsQuality", "lastUpdate",
    "partition", "offset", "enqueued_ts", "event_time",
    "delay_min", "has_trip", "delay_bucket", "is_delayed", "is_stopped", "is_moving",
    "gps_ok", "event_time_local", "scheduled_start_local",
    "route_type", "route_color", "route_text_color",
    "transportationType", "vehicleCharacteristics", "brand", "model",
    "productionYear", "length", "seats", "standingPlaces", "floorHeight",
    "driveType", "carrier", "airConditioning", "wheelchairsRamp",
    "ticketMachine", "usb",
)


def _q(c: str) -> str:
    return f'"{c}"'


def core_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["typed_timestamps"] = with_(FEED) + """
SELECT event_id, generated_text AS generated, CAST(generated_text AS TIMESTAMP) AS event_time
FROM feed"""
    q["local_time"] = with_(FEED) + f"""
SELECT event_id, event_time, {LOCAL.format(c='event_time')} AS event_time_local FROM feed"""
    q["delay_buckets"] = with_(FEED) + f"""
SELECT event_id, delay, {DELAY_MIN} AS delay_min, {BUCKET} AS delay_bucket FROM feed"""
    q["status_flags"] = with_(FEED) + """
SELECT event_id, tripId IS NOT NULL AS has_trip, delay > 120 AS is_delayed,
       speed = 0 AS is_stopped, speed > 0 AS is_moving, gpsQuality > 0 AS gps_ok
FROM feed"""
    q["bbox_filter"] = with_(FEED) + f"""
SELECT event_id, lat, lon FROM feed WHERE {BOX}"""
    q["dedup_readings"] = with_(FEED) + """,
feed_dup AS (
  SELECT vehicleId, generated, "partition", "offset", 0 AS copy, enqueued_ts FROM feed
  UNION ALL
  SELECT vehicleId, generated, "partition", "offset", 1 AS copy,
         enqueued_ts + INTERVAL 1 SECOND AS enqueued_ts
  FROM feed WHERE k % 5 = 0
)
SELECT vehicleId, generated, "offset" AS event_id, copy, enqueued_ts
FROM feed_dup
QUALIFY row_number() OVER (PARTITION BY vehicleId, generated
                           ORDER BY enqueued_ts, "partition", "offset") = 1"""
    q["silver_clean"] = with_(FEED, CLEAN) + """
SELECT "offset" AS event_id, vehicleId, generated, lastUpdate, scheduledTripStartTime,
       delay_min, has_trip, delay_bucket, is_delayed, is_stopped, is_moving, gps_ok,
       event_time_local, scheduled_start_local
FROM clean_box"""
    q["dim_routes"] = with_(ROUTES_DIM) + "SELECT * FROM routes_dim"
    q["dim_vehicles"] = with_(VEHICLES_DIM) + "SELECT * FROM vehicles_dim"
    q["enrich_routes"] = with_(FEED, CLEAN, ROUTES_DIM) + """
SELECT c."offset" AS event_id, c.routeId, r.route_type, r.route_color, r.route_text_color
FROM clean_box c LEFT JOIN routes_dim r ON c.routeId = r.gtfs_route_id"""
    q["enrich_vehicles"] = with_(FEED, CLEAN, VEHICLES_DIM) + """
SELECT c."offset" AS event_id, c.vehicleCode, v.brand, v.model, v.carrier
FROM clean_box c LEFT JOIN vehicles_dim v ON c.vehicleCode = v.vehicleCode"""
    q["type_normalise"] = with_(*SILVER_ALL) + """
SELECT "offset" AS event_id, vehicleCode, transportationType FROM silver"""
    q["silver_enriched"] = with_(*SILVER_ALL) + "SELECT " + ", ".join(
        _q(c) for c in SILVER_COLUMNS) + " FROM silver"
    q["period_summary"] = with_(*SILVER_ALL) + """,
p AS (
  SELECT count(DISTINCT vehicleId) AS total_vehicles, count(*) AS total_readings,
    CAST(sum(CASE WHEN has_trip THEN tenths END) AS BIGINT) AS s_d,
    count(CASE WHEN has_trip THEN tenths END) AS n_d,
    max(CASE WHEN has_trip THEN tenths END) AS max_d,
    CAST(sum(CAST(is_delayed AS INT)) AS BIGINT) AS t_x, count(is_delayed) AS n_x,
    CAST(sum(CASE WHEN is_moving THEN speed END) AS BIGINT) AS s_s,
    count(CASE WHEN is_moving THEN speed END) AS n_s
  FROM silver_t)
""" + f"""
SELECT total_vehicles, total_readings, {mean_tenths('s_d', 'n_d')} AS avg_delay_min,
  max_d / 10.0 AS max_delay_min, {pct('t_x', 'n_x')} AS delayed_reading_pct,
  {mean_int('s_s', 'n_s')} AS avg_speed
FROM p"""
    q["route_summary"] = with_(*SILVER_ALL) + f""",
g AS (
  SELECT routeId, routeShortName, transportationType,
    count(DISTINCT vehicleId) AS active_vehicles,
    CAST(sum(CASE WHEN has_trip THEN tenths END) AS BIGINT) AS s_d,
    count(CASE WHEN has_trip THEN tenths END) AS n_d,
    max(CASE WHEN has_trip THEN tenths END) AS max_d,
    CAST(sum(CASE WHEN is_moving THEN speed END) AS BIGINT) AS s_s,
    count(CASE WHEN is_moving THEN speed END) AS n_s,
    count(DISTINCT CASE WHEN is_delayed THEN vehicleId END) AS delayed_vehicles,
    count(DISTINCT CASE WHEN is_stopped THEN vehicleId END) AS stopped_vehicles
  FROM silver_t WHERE routeId IS NOT NULL
  GROUP BY routeId, routeShortName, transportationType)
SELECT routeId, routeShortName, transportationType, active_vehicles,
  {mean_tenths('s_d', 'n_d')} AS avg_delay_min, max_d / 10.0 AS max_delay_min,
  {mean_int('s_s', 'n_s')} AS avg_speed, delayed_vehicles, stopped_vehicles
FROM g"""
    q["delay_distribution"] = with_(*SILVER_ALL) + """
SELECT delay_bucket, transportationType, count(*) AS records_count,
       count(DISTINCT vehicleId) AS vehicles_count
FROM silver WHERE has_trip GROUP BY delay_bucket, transportationType"""
    q["destination_summary"] = with_(*SILVER_ALL) + f""",
g AS (
  SELECT routeShortName, headsign, transportationType,
    count(DISTINCT vehicleId) AS active_vehicles,
    CAST(sum(tenths) AS BIGINT) AS s_d, count(tenths) AS n_d,
    CAST(sum(CASE WHEN is_moving THEN speed END) AS BIGINT) AS s_s,
    count(CASE WHEN is_moving THEN speed END) AS n_s,
    count(DISTINCT CASE WHEN is_delayed THEN vehicleId END) AS delayed_vehicles
  FROM silver_t WHERE has_trip AND headsign IS NOT NULL
  GROUP BY routeShortName, headsign, transportationType)
SELECT routeShortName, headsign, transportationType, active_vehicles,
  {mean_tenths('s_d', 'n_d')} AS avg_delay_min, {mean_int('s_s', 'n_s')} AS avg_speed,
  delayed_vehicles
FROM g"""
    q["fleet_current"] = with_(*SILVER_ALL, FLEET) + "SELECT * FROM fleet"
    q["live_kpi"] = with_(*SILVER_ALL, FLEET) + f""",
k AS (
  SELECT max(event_time) AS snapshot_time,
    count(DISTINCT vehicleId) AS active_vehicles,
    count(DISTINCT CASE WHEN is_moving = false THEN vehicleId END) AS stopped_vehicles,
    count(DISTINCT CASE WHEN delay > 120 THEN vehicleId END) AS delayed_vehicles,
    CAST(sum(tenths) AS BIGINT) AS s_d, count(tenths) AS n_d, max(tenths) AS max_d
  FROM fleet_t)
SELECT snapshot_time, active_vehicles, stopped_vehicles, delayed_vehicles,
  {mean_tenths('s_d', 'n_d')} AS avg_delay_min, max_d / 10.0 AS max_delay_min
FROM k"""
    return q


def serving_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_(*SILVER_ALL, FLEET)
    q["dash_map_points"] = base + """
SELECT delay_bucket, lat, lon, routeShortName, transportationType, delay_min, speed FROM fleet"""
    q["dash_vehicle_table"] = base + """
SELECT vehicleId, routeShortName, headsign, transportationType, model, delay_min, speed
FROM fleet ORDER BY delay_min DESC NULLS LAST, vehicleId"""
    q["dash_counters"] = f"""
SELECT f.last_update_local, f.fleet_rows, k.*
FROM (SELECT max(event_time_local) AS last_update_local, count(*) AS fleet_rows
      FROM ({core_sql()["fleet_current"]})) f,
  (SELECT count(*) AS kpi_rows, CAST(sum(active_vehicles) AS BIGINT) AS active_vehicles,
     CAST(sum(stopped_vehicles) AS BIGINT) AS stopped_vehicles,
     CAST(sum(delayed_vehicles) AS BIGINT) AS delayed_vehicles, sum(avg_delay_min) AS avg_delay_min
   FROM ({core_sql()["live_kpi"]})) k"""
    q["top_delayed_routes"] = core_sql()["route_summary"] + """
ORDER BY avg_delay_min DESC NULLS LAST, routeId, routeShortName, transportationType
LIMIT 10"""
    q["top_destinations"] = core_sql()["destination_summary"] + """
ORDER BY active_vehicles DESC NULLS LAST, routeShortName, headsign, transportationType
LIMIT 10"""
    q["recent_rows"] = with_(FEED) + """
SELECT "offset" AS event_id, vehicleId, generated_text AS generated, enqueued_ts
FROM feed ORDER BY enqueued_ts DESC, "partition" DESC, "offset" DESC LIMIT 20"""
    snap = with_(FEED) + """,
snap AS (SELECT * FROM feed WHERE lastUpdate = (SELECT max(lastUpdate) FROM feed))
"""
    q["map_markers"] = snap + """
SELECT lat, lon, CASE WHEN delay > 120 THEN 'red' ELSE 'green' END AS color,
  coalesce(routeShortName, 'None') || ' | Delay: ' || coalesce(CAST(delay AS VARCHAR), 'None')
    || ' s' AS popup
FROM snap"""
    q["map_legend"] = snap + """
SELECT count(*) AS total, count(*) FILTER (WHERE delay > 120) AS delayed,
  count(*) - count(*) FILTER (WHERE delay > 120) AS on_time
FROM snap"""
    return q


ISO_HOUR = "strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ')"
FLAT = f"""
SELECT vehicleId, generated_text AS generated, {ISO_HOUR} AS lastUpdate, routeShortName,
       delay, lat, lon"""


def io_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_parse"] = with_(FEED) + """
SELECT "offset" AS event_id, vehicleId, tripId, routeId, headsign, delay, speed, lat, lon,
       generated_text AS generated, "partition", enqueued_ts, event_time, 'stream' AS _source
FROM feed"""
    q["publish_payload"] = with_(FEED) + f"""
SELECT event_id, vehicleId, tripId, headsign, delay,
  CASE WHEN k % 10 <> 0 THEN {ISO_HOUR} END AS scheduledTripStartTime,
  CAST(17 AS INT) AS n_keys
FROM feed"""
    q["snapshot_name"] = """
SELECT event_id, 'gps_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS file_name FROM events"""
    q["snapshot_flatten"] = with_(FEED) + FLAT + " FROM feed"
    q["latest_snapshot_file"] = with_(FEED) + FLAT + """
FROM feed WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM feed)"""
    q["roster_unwrap"] = with_(VEHICLES_DIM.replace("AS carrier", "AS carrirer")) + """
SELECT vehicleCode, transportationType, brand, model, carrirer, seats FROM vehicles_dim"""
    q["roster_preview"] = with_(VEHICLES_DIM) + """
SELECT vehicleCode, transportationType, brand, model, productionYear, seats,
       standingPlaces, floorHeight, 'vehicles.json' AS source_file, true AS stamped
FROM vehicles_dim ORDER BY vehicleCode LIMIT 20"""
    q["csv_roundtrip"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
    q["json_roundtrip"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
    q["load_metadata"] = """
SELECT n_nationkey, n_name, n_regionkey, 'nation.csv' AS source_file, true AS stamped
FROM nation"""
    q["merge_insert_only"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_acctbal < 5000
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer
WHERE NOT (c_acctbal < 5000)"""
    q["catalog_merge"] = """
SELECT *, 'created' AS first_load, 'merged' AS second_load FROM (""" + q["merge_insert_only"] + ")"
    q["merge_composite_key"] = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
            FROM lineitem),
first AS (SELECT * FROM li WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT * FROM first
UNION ALL
SELECT * FROM li s WHERE NOT EXISTS (
  SELECT 1 FROM first t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)"""
    q["overwrite_schema"] = """
SELECT n_nationkey, n_name, n_regionkey, CAST(length(n_name) AS INT) AS n_name_length FROM nation"""
    q["load_report"] = """
SELECT 'bronze_gtfs_routes' AS table_name, count(*) AS row_count, 'merged' AS action,
       'route_id' AS merge_key FROM nation
UNION ALL SELECT 'bronze_gtfs_stops', count(*), 'merged', 'stop_id' FROM supplier
UNION ALL SELECT 'bronze_gtfs_trips', count(*), 'merged', 'trip_id' FROM orders
UNION ALL SELECT 'bronze_gtfs_stop_times', count(*), 'merged', 'trip_id, stop_sequence' FROM lineitem
UNION ALL SELECT 'bronze_gtfs_calendar_dates', count(*), 'merged', 'service_id, date' FROM orders
UNION ALL SELECT 'bronze_gtfs_agency', count(*), 'merged', 'agency_id' FROM region
UNION ALL SELECT 'bronze_vehicles', count(*), 'merged', 'vehicleCode' FROM customer"""
    return q


EVOLUTION = f"""
demo AS (
  SELECT *,
    ts >= TIMESTAMP '2024-01-11' AS v2_payload,
    CASE WHEN ts >= TIMESTAMP '2024-01-21'
         THEN ['LOW', 'MEDIUM', 'HIGH'][k % 3 + 1] END AS occupancy
  FROM feed
)"""


def stream_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_ingest_stream"] = with_(FEED) + """
SELECT "offset" AS event_id, vehicleId, delay, generated_text AS generated, "partition",
       enqueued_ts, event_time, 'stream' AS _source
FROM feed"""
    q["schema_evolution"] = with_(FEED, EVOLUTION) + """
SELECT event_id, occupancy, v2_payload AS payload_has_occupancy FROM demo"""
    q["rescued_search"] = with_(FEED, EVOLUTION) + """
SELECT event_id, vehicleCode, ['LOW', 'MEDIUM', 'HIGH'][k % 3 + 1] AS occupancy_text
FROM demo WHERE v2_payload"""
    q["evolved_rows"] = with_(FEED, EVOLUTION) + """
SELECT event_id, vehicleCode, routeShortName, occupancy, event_time
FROM demo WHERE occupancy IS NOT NULL"""
    q["occupancy_counts"] = with_(FEED, EVOLUTION) + """
SELECT occupancy, count(*) AS count FROM demo GROUP BY occupancy"""
    q["stream_dedup"] = with_(FEED) + """
SELECT vehicleId, generated, event_id, lat, lon, enqueued_ts FROM feed"""
    q["stream_enrich"] = with_(*SILVER_ALL) + """
SELECT "offset" AS event_id, vehicleCode, routeId, route_color, brand, transportationType,
       delay_bucket, event_time_local
FROM silver"""
    q["stream_fleet_current"] = with_(*SILVER_ALL, FLEET) + "SELECT * FROM fleet"
    q["stream_changing_routes"] = with_(*SILVER_ALL) + """
SELECT "offset" AS event_id, routeId,
       CASE WHEN routeId <= 5 OR event_time >= TIMESTAMP '2024-01-16' THEN route_color END AS route_color
FROM silver"""
    q["bronze_table_stream"] = with_(FEED) + """
SELECT "offset" AS event_id, vehicleId, delay,
       CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN ['LOW', 'MEDIUM', 'HIGH'][k % 3 + 1] END AS occupancy,
       event_time, 'stream' AS _source
FROM feed"""
    return q


def chain_sql(core: dict[str, str]) -> dict[str, str]:
    """Row counts of the tables the chain writes, from the per-table SQL."""
    tables = {"gps_positions_silver": with_(*SILVER_ALL) + "SELECT * FROM silver",
              "gold_period_summary": core["period_summary"],
              "gold_route_summary": core["route_summary"],
              "gold_delay_distribution": core["delay_distribution"],
              "gold_destination_summary": core["destination_summary"],
              "gold_fleet_current": core["fleet_current"],
              "gold_live_kpi": core["live_kpi"]}
    return {"medallion_chain": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM ({sql})"
        for name, sql in tables.items())}


def oracle_queries() -> dict[str, str]:
    from fleetpulse.plans.io_queries import CHAIN_TABLES
    q = core_sql()
    q.update(serving_sql())
    q.update(io_sql())
    q.update(stream_sql())
    q.update(chain_sql(q))
    q["route_summary_incremental"] = q["route_summary"]
    q["chain_incremental"] = q["route_summary"]
    q["route_summary_approximate"] = f"""
SELECT routeId, routeShortName, transportationType, avg_delay_min, max_delay_min, avg_speed,
       TRUE AS active_vehicles_near, TRUE AS delayed_vehicles_near, TRUE AS stopped_vehicles_near
FROM ({q["route_summary"]})"""
    q["medallion_contents"] = "\nUNION ALL\n".join(
        f"SELECT concat_ws('|', '{table}'" + "".join(f", coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
        + f") AS row_name, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({q[table[len('gold_'):]]})"
        for table, (keys, measures) in CHAIN_TABLES.items() for m in measures)
    q["merge_pruned"] = q["merge_composite_key"]
    q["silver_compacted"] = q["stream_dedup"]
    return q
