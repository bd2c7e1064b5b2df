"""Registered streaming queries.

Each replays readings derived from the driver's tables into a landing
folder, drains the stream (``availableNow``) into a fresh location under
the shared scratch root and returns the batch read-back, so the result can
be checked like any batch query.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from fleetpulse.config import PipelineConfig
from fleetpulse.plans.queries import register
from fleetpulse.schemas import EVENT_V1, EVENT_V2
from fleetpulse.session import scratch_path
from fleetpulse.sources import adapters as A
from fleetpulse.sources.events import parse_events
from fleetpulse.streaming import incremental as INC
from fleetpulse.streaming.ingest import (bronze_rows, drain, land, read_bronze,
                                         read_source, start_ingest)

V1 = EVENT_V1.fieldNames()
V2 = EVENT_V2.fieldNames()

# The replayed month is split where the producer upgrades to
# the v2 contract and where the consumer restarts on it.
PRODUCER_V2_FROM = "2024-01-11"
CONSUMER_V2_FROM = "2024-01-21"


def _cfg(spark, name: str, tag: str = "stream") -> PipelineConfig:
    root = scratch_path(spark, name)
    return PipelineConfig(source="files", source_tag=tag,
                          landing_path=f"{root}/landing", bronze_path=f"{root}/bronze",
                          checkpoint_path=f"{root}/_checkpoint")


@register("bronze_ingest_stream")
def q_bronze_ingest_stream(spark, sf):
    cfg = _cfg(spark, "ingest")
    land(A.feed(spark, sf), cfg.landing_path, V1)
    drain(start_ingest(spark, cfg, EVENT_V1))
    drain(start_ingest(spark, cfg, EVENT_V1))   # restart: nothing new, adds no rows
    return read_bronze(spark, cfg.bronze_path, EVENT_V1).select(
        F.col("offset").alias("event_id"), "vehicleId", "delay", "generated", "partition",
        "enqueued_ts", "event_time", "_source")


def evolution_demo(spark, sf):
    """v1 consumer on v1 events, then v2 events arrive (rescued in
    ``raw_value`` only), then the consumer restarts on v2 with the same
    checkpoint and the new column fills."""
    cfg = _cfg(spark, "evolution", tag="stream-demo")
    ts = F.col("enqueued_ts")
    v1 = A.feed(spark, sf, version=1)
    v2 = A.feed(spark, sf, version=2)
    land(v1.filter(ts < F.lit(PRODUCER_V2_FROM).cast("timestamp_ntz")), cfg.landing_path, V1)
    drain(start_ingest(spark, cfg, EVENT_V1))
    land(v2.filter((ts >= F.lit(PRODUCER_V2_FROM).cast("timestamp_ntz"))
                   & (ts < F.lit(CONSUMER_V2_FROM).cast("timestamp_ntz"))), cfg.landing_path, V2)
    drain(start_ingest(spark, cfg, EVENT_V1))
    land(v2.filter(ts >= F.lit(CONSUMER_V2_FROM).cast("timestamp_ntz")), cfg.landing_path, V2)
    drain(start_ingest(spark, cfg, EVENT_V2))
    return read_bronze(spark, cfg.bronze_path)


@register("schema_evolution")
def q_schema_evolution(spark, sf):
    return evolution_demo(spark, sf).select(
        F.col("offset").alias("event_id"), "occupancy",
        F.col("raw_value").contains("occupancy").alias("payload_has_occupancy"))


@register("rescued_search")
def q_rescued_search(spark, sf):
    demo = evolution_demo(spark, sf)
    return demo.filter("raw_value like '%occupancy%'").select(
        F.col("offset").alias("event_id"), "vehicleCode",
        F.get_json_object("raw_value", "$.occupancy").alias("occupancy_text"))


@register("evolved_rows")
def q_evolved_rows(spark, sf):
    demo = evolution_demo(spark, sf)
    return demo.select(F.col("offset").alias("event_id"), "vehicleCode", "routeShortName",
                       "occupancy", "event_time").filter("occupancy is not null")


@register("occupancy_counts")
def q_occupancy_counts(spark, sf):
    return evolution_demo(spark, sf).groupBy("occupancy").count()


def scattered_copies(spark, sf) -> list:
    """Deliveries of the month's readings in an order that suits nobody: first
    later-delivered copies that lie outside the area, alone; then the newer
    half, delivered before those of the first landing; then the older half
    with re-deliveries."""
    dup = A.feed_dup(spark, sf)
    late = F.coalesce(F.col("event_time") >= F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    first = F.col("copy") == 0
    outside = dup.filter(~first).withColumns({"lat": F.lit(0.0).cast("float"), "lon": F.lit(0.0).cast("float")})
    return [outside, dup.filter(first & late), dup.filter(~first | ~late)]


def _silver_stream(spark, sf, name, enrich=True):
    """Land the scattered copies, draining after each landing; return the store."""
    cfg = _cfg(spark, name)
    store = INC.SilverStore(cfg.bronze_path)

    def dims(session):
        return A.routes_bronze(session, sf), A.vehicles_bronze(session, sf)

    for part in scattered_copies(spark, sf):
        land(part, cfg.landing_path, V1)
        parsed = parse_events(read_source(spark, cfg), EVENT_V1, cfg.source_tag)
        drain(INC.start_silver(parsed, store, cfg.checkpoint_path, dims if enrich else None))
    return store


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    store = _silver_stream(spark, sf, "stream-dedup", enrich=False)
    return INC.read_silver(spark, store).select(
        "vehicleId", "generated", F.col("offset").alias("event_id"), "lat", "lon", "enqueued_ts")


@register("stream_enrich")
def q_stream_enrich(spark, sf):
    store = _silver_stream(spark, sf, "stream-enrich")
    return INC.read_silver(spark, store).select(
        F.col("offset").alias("event_id"), "vehicleCode", "routeId", "route_color",
        "brand", "transportationType", "delay_bucket", "event_time_local")


@register("stream_fleet_current")
def q_stream_fleet_current(spark, sf):
    return INC.read_latest(spark, _silver_stream(spark, sf, "stream-fleet"))


@register("silver_compacted")
def q_silver_compacted(spark, sf):
    """Streaming silver whose closed days are compacted, and purged of their
    small folders, between landings that still bring late copies for them."""
    cfg = _cfg(spark, "compacted")
    store = INC.SilverStore(cfg.bronze_path)
    for n, part in enumerate(scattered_copies(spark, sf)):
        land(part, cfg.landing_path, V1)
        parsed = parse_events(read_source(spark, cfg), EVENT_V1, cfg.source_tag)
        drain(INC.start_silver(parsed, store, cfg.checkpoint_path))
        INC.compact(spark, store, date(2024, 1, 10 + 5 * n), files_per_day=2)
        INC.purge(spark, store)
    return INC.read_silver(spark, store).select(
        "vehicleId", "generated", F.col("offset").alias("event_id"), "lat", "lon", "enqueued_ts")


@register("stream_changing_routes")
def q_stream_changing_routes(spark, sf):
    """One running query over two landings; routes from the sixth on are added
    between its batches, and only the second batch's readings have them."""
    cfg = _cfg(spark, "stream-routes")
    store, routes = INC.SilverStore(cfg.bronze_path), scratch_path(spark, "routes-now")
    feed = A.feed(spark, sf)
    late = F.coalesce(F.col("event_time") >= F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    A.routes_bronze(spark, sf).filter("route_id <= 5").write.parquet(routes)
    land(feed.filter(~late), cfg.landing_path, V1)
    query = INC.start_silver(
        parse_events(read_source(spark, cfg), EVENT_V1, cfg.source_tag), store, cfg.checkpoint_path,
        lambda session: (session.read.parquet(routes), A.vehicles_bronze(session, sf)), trigger_interval="1 second")
    try:
        query.processAllAvailable()
        A.routes_bronze(spark, sf).filter("route_id > 5").write.mode("append").parquet(routes)
        land(feed.filter(late), cfg.landing_path, V1)
        query.processAllAvailable()
    finally:
        query.stop()
    return INC.read_silver(spark, store).select(F.col("offset").alias("event_id"), "routeId", "route_color")


@register("bronze_table_stream")
def q_bronze_table_stream(spark, sf):
    """Bronze as a catalog table that the stream creates; the v2 contract adds
    its column to the table, and the table is read by name."""
    db = "fleet_" + uuid.uuid4().hex[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, 'bronze-db')}'")
    root = scratch_path(spark, "bronze-table")
    cfg = PipelineConfig(database=db, source="files", landing_path=f"{root}/landing",
                         checkpoint_path=f"{root}/_checkpoint")
    ts, split = F.col("enqueued_ts"), F.lit(CONSUMER_V2_FROM).cast("timestamp_ntz")
    land(A.feed(spark, sf, version=1).filter(ts < split), cfg.landing_path, V1)
    drain(start_ingest(spark, cfg, EVENT_V1))
    land(A.feed(spark, sf, version=2).filter(ts >= split), cfg.landing_path, V2)
    drain(start_ingest(spark, cfg, EVENT_V2))
    return bronze_rows(spark, cfg).select(F.col("offset").alias("event_id"), "vehicleId", "delay",
                                          "occupancy", "event_time", "_source")


@register("chain_incremental")
def q_chain_incremental(spark, sf):
    """The whole chain run after each of three landings, each run reading only
    new bronze; the route summary after the last one."""
    from fleetpulse.plans.medallion import Store, run_chain
    cfg = _cfg(spark, "chain")
    store = Store(root=scratch_path(spark, "chain-tables"))
    store.write(A.routes_bronze(spark, sf), cfg.routes_table)
    store.write(A.vehicles_bronze(spark, sf), cfg.vehicles_table)
    for part in scattered_copies(spark, sf):
        land(part, cfg.landing_path, V1)
        run_chain(spark, cfg, store)
    return store.read(spark, "gold_route_summary")
