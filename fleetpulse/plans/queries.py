"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame.

Each query derives its input from the driver's tables through the adapters
in ``fleetpulse.sources.adapters`` and runs one reference job or operator
over the whole input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import scalar as S
from fleetpulse.operators import clean, enrich, gold, serving
from fleetpulse.plans.medallion import Store
from fleetpulse.plans.silver import build_silver
from fleetpulse.session import scratch_path
from fleetpulse.sources import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- shared inputs -----------------------------------------------------------

def silver(spark: SparkSession, sf: str) -> DataFrame:
    return build_silver(A.feed(spark, sf), A.routes_bronze(spark, sf),
                        A.vehicles_bronze(spark, sf))


def clean_box(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_clean(A.feed(spark, sf))


# --- scalar derivations --------------------------------------------------------

@register("typed_timestamps")
def q_typed_timestamps(spark, sf):
    return A.feed(spark, sf).select(F.col("offset").alias("event_id"), "generated",
                                    S.utc_time("generated").alias("event_time"))


@register("local_time")
def q_local_time(spark, sf):
    return A.feed(spark, sf).select(F.col("offset").alias("event_id"), "event_time",
                                    S.local_time("event_time").alias("event_time_local"))


@register("delay_buckets")
def q_delay_buckets(spark, sf):
    return A.feed(spark, sf).select(F.col("offset").alias("event_id"), "delay",
                                    S.delay_min("delay").alias("delay_min"),
                                    S.delay_bucket("delay").alias("delay_bucket"))


@register("status_flags")
def q_status_flags(spark, sf):
    return A.feed(spark, sf).select(
        F.col("offset").alias("event_id"),
        S.has_trip().alias("has_trip"), S.is_delayed().alias("is_delayed"),
        S.is_stopped().alias("is_stopped"), S.is_moving().alias("is_moving"),
        S.gps_ok().alias("gps_ok"))


@register("bbox_filter")
def q_bbox_filter(spark, sf):
    return clean.bbox_filter(A.feed(spark, sf)).select(
        F.col("offset").alias("event_id"), "lat", "lon")


@register("dedup_readings")
def q_dedup_readings(spark, sf):
    # every fifth reading is delivered twice; the first landed copy survives
    typed = clean.typed_timestamps(A.feed_dup(spark, sf))
    return clean.dedup_readings(typed).select(
        "vehicleId", "generated", F.col("offset").alias("event_id"), "copy", "enqueued_ts")


@register("silver_clean")
def q_silver_clean(spark, sf):
    return clean_box(spark, sf).select(
        F.col("offset").alias("event_id"), "vehicleId", "generated", "lastUpdate",
        "scheduledTripStartTime", "delay_min", "has_trip", "delay_bucket", "is_delayed",
        "is_stopped", "is_moving", "gps_ok", "event_time_local", "scheduled_start_local")


# --- dimensions and joins ------------------------------------------------------

@register("dim_routes")
def q_dim_routes(spark, sf):
    # the route file is loaded twice: dedup must give one row per route
    return enrich.dim_routes(A.routes_bronze(spark, sf, copies=2))


@register("dim_vehicles")
def q_dim_vehicles(spark, sf):
    v = A.vehicles_bronze(spark, sf)
    return enrich.dim_vehicles(v.unionByName(v))


@register("enrich_routes")
def q_enrich_routes(spark, sf):
    routes = A.routes_bronze(spark, sf)
    dim, shuffled = enrich.prepared_dim(enrich.dim_routes(routes), routes,
                                        enrich.DEFAULT_BROADCAST_MAX_ROWS)
    return enrich.enrich_routes(clean_box(spark, sf), dim, shuffled).select(
        F.col("offset").alias("event_id"), "routeId", "route_type", "route_color",
        "route_text_color")


@register("enrich_vehicles")
def q_enrich_vehicles(spark, sf):
    veh = A.vehicles_bronze(spark, sf)
    dim, shuffled = enrich.prepared_dim(enrich.dim_vehicles(veh), veh,
                                        enrich.DEFAULT_BROADCAST_MAX_ROWS)
    return enrich.enrich_vehicles(clean_box(spark, sf), dim, shuffled).select(
        F.col("offset").alias("event_id"), "vehicleCode", "brand", "model", "carrier")


@register("type_normalise")
def q_type_normalise(spark, sf):
    return silver(spark, sf).select(F.col("offset").alias("event_id"), "vehicleCode",
                                    "transportationType")


SILVER_OUT = (
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


@register("silver_enriched")
def q_silver_enriched(spark, sf):
    # all silver columns except raw_value, _source and the ingest clock
    return silver(spark, sf).select(*SILVER_OUT)


# --- gold ----------------------------------------------------------------------

@register("period_summary")
def q_period_summary(spark, sf):
    return gold.period_summary(silver(spark, sf))


@register("route_summary")
def q_route_summary(spark, sf):
    return gold.route_summary(silver(spark, sf))


@register("delay_distribution")
def q_delay_distribution(spark, sf):
    return gold.delay_distribution(silver(spark, sf))


@register("destination_summary")
def q_destination_summary(spark, sf):
    return gold.destination_summary(silver(spark, sf))


@register("fleet_current")
def q_fleet_current(spark, sf):
    return gold.fleet_current(silver(spark, sf))


@register("live_kpi")
def q_live_kpi(spark, sf):
    return gold.live_kpi(gold.fleet_current(silver(spark, sf)))


# --- serving: dashboard, map, top-k -------------------------------------------

def fleet(spark, sf):
    return gold.fleet_current(silver(spark, sf))


@register("dash_map_points")
def q_dash_map_points(spark, sf):
    return serving.dash_map_points(fleet(spark, sf))


@register("dash_vehicle_table")
def q_dash_vehicle_table(spark, sf):
    return serving.dash_vehicle_table(fleet(spark, sf))


@register("dash_counters")
def q_dash_counters(spark, sf):
    """Over the written fleet and KPI tables, as the dashboard reads them."""
    store = Store(root=scratch_path(spark, "dashboard"))
    store.write(fleet(spark, sf), "gold_fleet_current")
    now = store.read(spark, "gold_fleet_current")
    store.write(gold.live_kpi(now), "gold_live_kpi")
    return serving.dash_counters(now, store.read(spark, "gold_live_kpi"))


@register("top_delayed_routes")
def q_top_delayed_routes(spark, sf):
    return serving.top_delayed_routes(gold.route_summary(silver(spark, sf)), 10)


@register("top_destinations")
def q_top_destinations(spark, sf):
    return serving.top_destinations(gold.destination_summary(silver(spark, sf)), 10)


@register("recent_rows")
def q_recent_rows(spark, sf):
    return serving.recent_rows(A.feed(spark, sf), 20).select(
        F.col("offset").alias("event_id"), "vehicleId", "generated", "enqueued_ts")


@register("map_markers")
def q_map_markers(spark, sf):
    return serving.map_markers(serving.latest_snapshot(A.feed(spark, sf), "lastUpdate"))


@register("map_legend")
def q_map_legend(spark, sf):
    return serving.map_legend(A.feed(spark, sf), "lastUpdate")
