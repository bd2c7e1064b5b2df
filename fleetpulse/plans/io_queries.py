"""Registered queries for sources and sinks (parse, publish, files, loads).

Queries that write go to a fresh location under the shared scratch root
(``fleetpulse.session.scratch_path``) and return the batch read-back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fleetpulse.functions.scalar import utc_time
from fleetpulse.config import GTFS_SPECS, VEHICLES_SPEC, ReferenceSpec
from fleetpulse.plans.queries import register
from fleetpulse.schemas import EVENT_V1
from fleetpulse.session import scratch_path
from fleetpulse.sources import adapters as A
from fleetpulse.sources import events as EV
from fleetpulse.sources import reference as R
from fleetpulse.sources.tables import read_table

V1_FIELDS = EVENT_V1.fieldNames()


@register("bronze_parse")
def q_bronze_parse(spark, sf):
    env = EV.to_envelope(A.feed(spark, sf), V1_FIELDS)
    parsed = EV.parse_events(env, EVENT_V1, source_tag="stream")
    return parsed.select(F.col("offset").alias("event_id"), "vehicleId", "tripId", "routeId",
                         "headsign", "delay", "speed", "lat", "lon", "generated",
                         "partition", "enqueued_ts", "event_time", "_source")


@register("publish_payload")
def q_publish_payload(spark, sf):
    readings = A.feed(spark, sf)
    msg = EV.to_payload(readings.select(F.col("offset").alias("event_id"), *V1_FIELDS))
    back = F.from_json("value", "event_id BIGINT, " + EVENT_V1.simpleString()[7:-1].replace(":", " "))
    return msg.select(back.alias("m"), F.size(F.json_object_keys("value")).alias("n_keys")).select(
        "m.event_id", "m.vehicleId", "m.tripId", "m.headsign", "m.delay",
        "m.scheduledTripStartTime", "n_keys")


@register("snapshot_name")
def q_snapshot_name(spark, sf):
    return read_table(spark, sf, "events").select(
        "event_id", EV.snapshot_file_name(F.col("ts")).alias("file_name"))


def _flat_snapshot_columns(df):
    return df.select("vehicleId", "generated", "lastUpdate", "routeShortName", "delay",
                     "lat", "lon")


@register("snapshot_flatten")
def q_snapshot_flatten(spark, sf):
    path = scratch_path(spark, "snapshots")
    EV.nest_snapshots(A.feed(spark, sf)).drop("page").write.mode("overwrite").json(path)
    schema = (f"lastUpdate STRING, vehicles ARRAY<STRUCT<"
              + ", ".join(f"{f.name}: {f.dataType.simpleString()}"
                          for f in EVENT_V1.fields if f.name != "lastUpdate") + ">>")
    landed = spark.read.schema(schema).json(path)
    return _flat_snapshot_columns(EV.snapshot_flatten(landed))


@register("roster_unwrap")
def q_roster_unwrap(spark, sf):
    path = scratch_path(spark, "roster")
    A.roster_pages(spark, sf).drop("page").write.mode("overwrite").json(path)
    # NDJSON pages: one payload per line, splittable
    return EV.roster_unwrap(spark.read.option("multiLine", "false").json(path)).select(
        "vehicleCode", "transportationType", "brand", "model", "carrirer", "seats")


NATION = "n_nationkey INT, n_regionkey INT"    # named by header, in any order


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "nation-csv")
    read_table(spark, sf, "nation").write.option("header", "true").csv(path)
    spec = ReferenceSpec("nation.csv", "bronze_nation", ("n_nationkey",), schema=NATION)
    return R.read_reference(spark, path, spec)


@register("json_roundtrip")
def q_json_roundtrip(spark, sf):
    path = scratch_path(spark, "nation-json")
    read_table(spark, sf, "nation").write.json(path)
    spec = ReferenceSpec("nation.json", "bronze_nation", ("n_nationkey",), fmt="json",
                         schema="n_nationkey INT, n_name STRING, n_regionkey INT",
                         options={"multiLine": "false"})
    return R.read_reference(spark, path, spec)


@register("load_metadata")
def q_load_metadata(spark, sf):
    path = scratch_path(spark, "nation-csv")
    read_table(spark, sf, "nation").write.option("header", "true").csv(path)
    spec = ReferenceSpec("nation.csv", "bronze_nation", ("n_nationkey",), schema=NATION)
    df = R.add_load_metadata(R.read_reference(spark, path, spec), "nation.csv")
    # the two clock columns are checked for type and non-NULL only
    return df.select("n_nationkey", "n_name", "n_regionkey", "source_file",
                     (F.col("ingestion_timestamp").isNotNull()
                      & F.col("load_date").isNotNull()).alias("stamped"))


@register("roster_preview")
def q_roster_preview(spark, sf):
    roster = R.add_load_metadata(A.vehicles_bronze(spark, sf).drop("source_file"),
                                 VEHICLES_SPEC.file_name)
    view = "roster_" + uuid.uuid4().hex[:12]
    roster.createOrReplaceTempView(view)
    # the load instant is checked for presence only (a clock column)
    return R.preview(spark, view).select(
        *[c for c in R.PREVIEW_COLUMNS if c != "ingestion_timestamp"],
        F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@register("merge_insert_only")
def q_merge_insert_only(spark, sf):
    target = R.PATH_PREFIX + scratch_path(spark, "customer-merge")
    cu = read_table(spark, sf, "customer")
    first = cu.filter(F.col("c_acctbal") < 5000)          # first delivery
    second = cu.withColumn("c_acctbal", F.col("c_acctbal") + 1)  # all rows, changed
    R.insert_only_merge(spark, first, target, ["c_custkey"])
    R.insert_only_merge(spark, second, target, ["c_custkey"])
    return R.read_target(spark, target)


@register("catalog_merge")
def q_catalog_merge(spark, sf):
    """The insert-only merge into a catalog table: the schema is created if
    missing, the first load creates the table, the second merges into it.
    The database lives in the shared scratch space, not the warehouse."""
    db = "fleet_" + uuid.uuid4().hex[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    table = f"{db}.bronze_customers"
    cu = read_table(spark, sf, "customer")
    first = R.insert_only_merge(spark, cu.filter(F.col("c_acctbal") < 5000), table, ["c_custkey"])
    second = R.insert_only_merge(spark, cu.withColumn("c_acctbal", F.col("c_acctbal") + 1),
                                 table, ["c_custkey"])
    return spark.read.table(table).select(
        "*", F.lit(first).alias("first_load"), F.lit(second).alias("second_load"))


@register("merge_composite_key")
def q_merge_composite_key(spark, sf):
    target = R.PATH_PREFIX + scratch_path(spark, "lineitem-merge")
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    R.insert_only_merge(spark, li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")),
                        target, ["l_orderkey", "l_linenumber"])
    R.insert_only_merge(spark, li, target, ["l_orderkey", "l_linenumber"])
    return R.read_target(spark, target)


@register("overwrite_schema")
def q_overwrite_schema(spark, sf):
    path = scratch_path(spark, "nation-overwrite")
    nation = read_table(spark, sf, "nation")
    nation.write.mode("overwrite").parquet(path)
    # recomputed from the source (a table is never overwritten from itself)
    nation.withColumn("n_name_length", F.length("n_name")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_reference_files(spark, sf) -> str:
    """Land the transit files (CSV) and the vehicle roster (NDJSON)."""
    base = scratch_path(spark, "reference-files")
    for name, df in A.gtfs_frames(spark, sf).items():
        df.write.option("header", "true").csv(f"{base}/{name}")
    A.vehicles_bronze(spark, sf).drop("source_file").write.json(f"{base}/{VEHICLES_SPEC.file_name}")
    return base


@register("load_report")
def q_load_report(spark, sf):
    base = write_reference_files(spark, sf)
    tables = scratch_path(spark, "reference-tables")
    specs = [*GTFS_SPECS, VEHICLES_SPEC]
    target = lambda s: f"{R.PATH_PREFIX}{tables}/{s.table}"
    R.load_reference(spark, base, specs, target)            # first load: created
    return R.load_reference(spark, base, specs, target)     # second load: merged, no-op


@register("medallion_chain")
def q_medallion_chain(spark, sf):
    """The ordered chain (silver, then the six gold tables) written to the
    scratch store; one row per written table with its row count."""
    from fleetpulse.plans.medallion import GOLD_TABLES, Store, run_medallion
    store = Store(root=scratch_path(spark, "medallion"))
    run_medallion(spark, A.feed(spark, sf), A.routes_bronze(spark, sf),
                  A.vehicles_bronze(spark, sf), store, silver_name="gps_positions_silver")
    names = ("gps_positions_silver", *GOLD_TABLES)
    return R.load_report(spark, {n: store.read(spark, n) for n in names})


# Keys and measures of the tables that the chain writes.
CHAIN_TABLES = {
    "gold_period_summary": ((), ("total_vehicles", "total_readings", "avg_delay_min", "max_delay_min",
                                 "delayed_reading_pct", "avg_speed")),
    "gold_route_summary": (("routeId", "routeShortName", "transportationType"),
                           ("active_vehicles", "avg_delay_min", "max_delay_min", "avg_speed", "delayed_vehicles",
                            "stopped_vehicles")),
    "gold_delay_distribution": (("delay_bucket", "transportationType"), ("records_count", "vehicles_count")),
    "gold_destination_summary": (("routeShortName", "headsign", "transportationType"),
                                 ("active_vehicles", "avg_delay_min", "avg_speed", "delayed_vehicles")),
    "gold_fleet_current": (("vehicleId", "vehicleCode", "routeShortName", "headsign", "delay_bucket",
                            "transportationType", "model"), ("lat", "lon", "delay", "delay_min", "speed", "is_moving")),
    "gold_live_kpi": ((), ("active_vehicles", "stopped_vehicles", "delayed_vehicles", "avg_delay_min", "max_delay_min")),
}


@register("medallion_contents")
def q_medallion_contents(spark, sf):
    """Every measure of every row of the six gold tables that the chain writes."""
    from fleetpulse.plans.medallion import Store, run_medallion
    store = Store(root=scratch_path(spark, "medallion"))
    run_medallion(spark, A.feed(spark, sf), A.routes_bronze(spark, sf), A.vehicles_bronze(spark, sf), store)
    parts = None
    for table, (keys, measures) in CHAIN_TABLES.items():
        name = F.concat_ws("|", F.lit(table), *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        rows = store.read(spark, table).select(name.alias("row_name"), F.inline(pairs))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@register("route_summary_incremental")
def q_route_summary_incremental(spark, sf):
    """Route summary refreshed in two runs over disjoint halves of the
    month's readings (before / from the 16th); equals the one-shot summary."""
    from fleetpulse.plans.medallion import Store, refresh_gold
    from fleetpulse.plans.queries import silver
    store = Store(root=scratch_path(spark, "incremental"))
    s = silver(spark, sf)
    early = F.coalesce(F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"),
                       F.lit(False))
    refresh_gold(spark, s.filter(early), store, 0, ("route_summary",))
    for _ in range(2):                       # a repeated batch counts once
        refresh_gold(spark, s.filter(~early), store, 1, ("route_summary",))
    return store.read(spark, "gold_route_summary")


@register("route_summary_approximate")
def q_route_summary_approximate(spark, sf):
    """The route summary from vehicle sketches, refreshed in two runs: vehicle
    counts within three standard errors of the exact ones, the rest exact."""
    from fleetpulse.operators import gold
    from fleetpulse.plans.medallion import Store, refresh_gold
    from fleetpulse.plans.queries import silver
    store = Store(root=scratch_path(spark, "approximate"))
    s = silver(spark, sf)
    early = F.coalesce(F.col("event_time") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    refresh_gold(spark, s.filter(early), store, 0, ("route_summary",), approximate=True)
    refresh_gold(spark, s.filter(~early), store, 1, ("route_summary",), approximate=True)
    keys = gold.PARTIAL_SPECS["route_summary"][0]
    counts = ("active_vehicles", "delayed_vehicles", "stopped_vehicles")
    exact = gold.route_summary(s).select(*[F.col(k).alias(f"_{k}") for k in keys],
                                         *[F.col(c).alias(f"_{c}") for c in counts])
    got = store.read(spark, "gold_route_summary")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    near = [(F.abs(F.col(c) - F.col(f"_{c}")) <= 3 * gold.SKETCH_ERROR * F.col(f"_{c}") + 0.5).alias(f"{c}_near")
            for c in counts]
    return got.join(exact, same, "left").select(*keys, "avg_delay_min", "max_delay_min", "avg_speed", *near)


@register("merge_pruned")
def q_merge_pruned(spark, sf):
    """The insert-only merge by composite key into a target laid out by a hash
    of the key; the second load reads only the parts that its keys fall into."""
    target = R.PATH_PREFIX + scratch_path(spark, "lineitem-parts")
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    R.insert_only_merge(spark, li.filter(early), target, ["l_orderkey", "l_linenumber"], parts=16)
    R.insert_only_merge(spark, li, target, ["l_orderkey", "l_linenumber"])
    return R.read_target(spark, target)


@register("latest_snapshot_file")
def q_latest_snapshot_file(spark, sf):
    """Rows of the newest landed snapshot, by the records of their arrival;
    each arrived when it was last updated."""
    path = scratch_path(spark, "landing")
    EV.land_snapshots(A.feed(spark, sf), path, arrived=utc_time("lastUpdate"))
    return _flat_snapshot_columns(EV.newest_snapshot(spark, path))
