"""Parsing edge rows, dedup, enrichment and gold invariants."""

import datetime as dt
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetpulse.operators import clean, enrich, gold
from fleetpulse.schemas import EVENT_V1, EVENT_V2
from fleetpulse.sources import adapters as A
from fleetpulse.sources.events import (parse_events, roster_unwrap,
                                       snapshot_flatten)
from tests.conftest import SF001

GOOD = {"generated": "2024-01-01T10:00:00Z", "routeShortName": "6", "tripId": 7,
        "routeId": 6, "headsign": "Zaspa", "vehicleCode": "1001", "vehicleService": "s",
        "vehicleId": 1001, "speed": 20, "direction": 90, "delay": 30,
        "scheduledTripStartTime": None, "lat": 54.35, "lon": 18.64, "gpsQuality": 3,
        "lastUpdate": "2024-01-01T10:00:00Z"}


def envelope(spark, payloads):
    rows = [(p, 0, i, dt.datetime(2024, 1, 1, 10, 0, i)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "value string, partition int, offset long, timestamp timestamp")


def test_parse_edge_rows(spark):                           # FN1, STR7
    bad_field = dict(GOOD, vehicleId="x")
    overflow = dict(GOOD, delay=2**40)
    fractional = dict(GOOD, speed=1.5)
    missing = {k: v for k, v in GOOD.items() if k != "headsign"}
    extra = dict(GOOD, occupancy="HIGH")
    payloads = ["not json", json.dumps(bad_field), json.dumps(overflow), json.dumps(fractional),
                json.dumps(missing), json.dumps(extra), json.dumps(dict(GOOD, delay=None)),
                json.dumps(dict(GOOD, generated="yesterday"))]
    out = parse_events(envelope(spark, payloads), EVENT_V1).orderBy("offset").collect()
    assert out[0]["vehicleId"] is None and out[0]["raw_value"] == "not json"
    assert out[1]["vehicleId"] is None and out[1]["speed"] == 20     # only that field
    assert out[2]["delay"] is None and out[2]["vehicleId"] == 1001
    assert out[3]["speed"] is None and out[3]["delay"] == 30
    assert out[4]["headsign"] is None and out[4]["vehicleId"] == 1001
    assert "occupancy" not in out[5].asDict() and "occupancy" in out[5]["raw_value"]
    assert out[6]["delay"] is None
    assert out[7]["event_time"] is None and out[7]["generated"] == "yesterday"
    assert out[6]["event_time"] == dt.datetime(2024, 1, 1, 10, 0)
    v2 = parse_events(envelope(spark, [json.dumps(extra)]), EVENT_V2).first()
    assert v2["occupancy"] == "HIGH"


def test_bronze_column_order(spark):
    cols = parse_events(envelope(spark, [json.dumps(GOOD)]), EVENT_V1).columns
    assert cols[:16] == EVENT_V1.fieldNames()
    assert cols[16:] == ["raw_value", "partition", "offset", "enqueued_ts", "event_time",
                         "_source", "ingestion_ts"]


def test_snapshot_flatten_lenient_last_update(spark):     # SRC8
    snap = spark.createDataFrame(
        [("2024-01-01T10:00:00Z", [(1, "a"), (2, "b")])],
        "lastUpdate string, vehicles array<struct<vehicleId:int, headsign:string>>")
    out = snapshot_flatten(snap).collect()
    assert [tuple(r) for r in out] == [(1, "a", "2024-01-01T10:00:00Z"), (2, "b", "2024-01-01T10:00:00Z")]
    no_stamp = snap.drop("lastUpdate")
    assert snapshot_flatten(no_stamp).first()["lastUpdate"] is None


def test_roster_unwrap(spark):                             # SRC9
    pay = spark.createDataFrame([([("D1", "Autobus"), ("D2", "Tramwaj")],)],
                                "results array<struct<vehicleCode:string, transportationType:string>>")
    assert roster_unwrap(pay).count() == 2


def test_dedup_first_delivery_wins_and_nulls_group(spark):  # DED1, V9
    df = spark.createDataFrame(
        [(1, "t1", dt.datetime(2024, 1, 1, 0, 0, 2), 0, 5, "late"),
         (1, "t1", dt.datetime(2024, 1, 1, 0, 0, 1), 0, 9, "first"),
         (None, None, dt.datetime(2024, 1, 1), 0, 1, "n1"),
         (None, None, dt.datetime(2024, 1, 1), 0, 2, "n2")],
        "vehicleId int, generated string, enqueued_ts timestamp_ntz, partition int, offset long, tag string")
    out = sorted(r["tag"] for r in clean.dedup_readings(df).collect())
    assert out == ["first", "n1"]


def test_feed_dup_dedups_to_feed(spark):
    dup = A.feed_dup(spark, SF001)
    base = A.feed(spark, SF001)
    assert dup.count() > base.count()
    deduped = clean.dedup_readings(clean.typed_timestamps(dup))
    assert deduped.count() == base.count()
    assert deduped.filter(F.col("copy") == 1).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 50)),
                min_size=0, max_size=30))
def test_dedup_idempotent(spark, data):                     # property
    df = spark.createDataFrame(
        [(v, f"g{g}", dt.datetime(2024, 1, 1), 0, o) for v, g, o in data],
        "vehicleId int, generated string, enqueued_ts timestamp_ntz, partition int, offset long")
    once = clean.dedup_readings(df)
    twice = clean.dedup_readings(once)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == len({(v, g) for v, g, _ in data})


def test_enrichment_preserves_rows(spark):                  # V17, JON4
    cleaned = clean.silver_clean(A.feed(spark, SF001))
    routes = A.routes_bronze(spark, SF001, copies=3)         # duplicated dims
    veh = A.vehicles_bronze(spark, SF001)
    veh = veh.unionByName(veh)
    enriched = enrich.enrich(cleaned, routes, veh)
    assert enriched.count() == cleaned.count()
    assert "carrier" in enriched.columns and "gtfs_route_id" not in enriched.columns
    assert enriched.columns[0] == "vehicleCode"


def test_broadcast_size_check_falls_back(spark):
    small = spark.range(10)
    assert enrich.is_bounded(small, 100)
    assert not enrich.is_bounded(spark.range(1000), 100)
    assert enrich.prepared_dim(small, spark.range(1000), 100) == (small, True)
    # few rows but wide ones: the byte bound refuses them
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("pad"))
    assert enrich.is_bounded(wide, 100)
    assert not enrich.is_bounded(wide, 100, max_bytes=5_000)


def test_gold_empty_input_one_row(spark):                    # V15
    cleaned = clean.silver_clean(A.feed(spark, SF001)).limit(0)
    silver = enrich.enrich(cleaned, A.routes_bronze(spark, SF001), A.vehicles_bronze(spark, SF001))
    p = gold.period_summary(silver).collect()
    assert len(p) == 1 and p[0]["total_vehicles"] == 0 and p[0]["total_readings"] == 0
    assert p[0]["avg_delay_min"] is None
    k = gold.live_kpi(gold.fleet_current(silver)).collect()
    assert len(k) == 1 and k[0]["active_vehicles"] == 0 and k[0]["snapshot_time"] is None


def test_bucket_records_sum_to_trip_rows(spark):
    from fleetpulse.plans.queries import silver
    s = silver(spark, SF001)
    dist = gold.delay_distribution(s)
    assert dist.agg(F.sum("records_count")).first()[0] == s.filter("has_trip").count()


def test_live_kpi_negative_speed_counts_as_stopped(spark):   # V4
    fleet = spark.createDataFrame(
        [(1, -1, False, 0.5, 30, dt.datetime(2024, 1, 1)),
         (2, None, None, 1.0, 200, dt.datetime(2024, 1, 2)),
         (3, 0, False, -0.5, -30, dt.datetime(2024, 1, 3))],
        "vehicleId int, speed int, is_moving boolean, delay_min double, delay int, event_time timestamp_ntz")
    k = gold.live_kpi(fleet).first()
    assert (k["active_vehicles"], k["stopped_vehicles"], k["delayed_vehicles"]) == (3, 2, 1)
    assert k["avg_delay_min"] == 0.33 and k["max_delay_min"] == 1.0


def test_fleet_current_unique_and_latest(spark):            # WIN1
    from fleetpulse.plans.queries import silver
    s = silver(spark, SF001)
    f = gold.fleet_current(s)
    assert f.count() == f.select("vehicleId").distinct().count()
    latest = s.groupBy("vehicleId").agg(F.max("event_time").alias("m"))
    assert f.join(latest, "vehicleId").filter(F.col("event_time") != F.col("m")).count() == 0


def test_shuffled_enrichment_equals_broadcast(spark):       # null-key bypass
    cleaned = clean.silver_clean(A.feed(spark, SF001))
    routes, veh = A.routes_bronze(spark, SF001), A.vehicles_bronze(spark, SF001)
    small = enrich.enrich(cleaned, routes, veh)
    forced = enrich.enrich(cleaned, routes, veh, max_rows=1)   # proof fails -> shuffle path
    assert forced.columns == small.columns
    key = [c for c in small.columns if c != "ingestion_ts"]     # clock column
    assert sorted(map(tuple, forced.select(key).collect())) == \
        sorted(map(tuple, small.select(key).collect()))
    assert cleaned.filter(F.col("routeId").isNull()).count() > 0


def test_left_join_null_keys_bypass(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x")], "k int, w string")
    out = sorted(tuple(r) for r in enrich.left_join(left, right, "k", "k", shuffled=True)
                 .fillna(-1, ["k"]).collect())
    assert out == [(-1, "b", None), (1, "a", "x"), (2, "c", None)]
