"""Map the driver's tables onto the telemetry data model.

The test tables hold no vehicle data, so these adapters derive vehicle
events and reference tables from them with deterministic expressions that
any SQL engine can evaluate the same way (integer arithmetic, exact decimal
positions).  Every derived row comes from a source row, so the work grows
with the tables.

* ``feed``          events -> one vehicle reading per event (bronze shape)
* ``feed_dup``      feed plus re-delivered copies of some readings
* ``routes_bronze`` nation -> route reference rows
* ``vehicles_bronze`` customer -> vehicle roster rows
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.sources.tables import read_table

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_HOUR = "yyyy-MM-dd'T'HH':00:00Z'"


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def feed_columns(version: int = 1) -> dict[str, Column]:
    """Event fields derived from an ``events`` row that has ``k`` added."""
    k = F.col("k")
    on_trip = (k % 10) != 0
    route = F.when(on_trip, (F.col("user_id") % 30).cast("int"))
    lat = F.when(k == 50, F.lit(0.0)).otherwise(
        (F.lit(541000) + ((k * 37) % 100) * 60) / F.lit(10000.0))
    lon = F.when(k == 50, F.lit(0.0)).otherwise(
        (F.lit(182000) + ((k * 53) % 100) * 90) / F.lit(10000.0))
    hour = F.date_format("ts", ISO_HOUR)        # pure NTZ formatting, no zone
    cols = {
        "generated": F.date_format("ts", ISO_MICROS),
        "routeShortName": route.cast("string"),
        "tripId": F.when(on_trip, F.col("event_id").cast("int")),
        "routeId": route,
        "headsign": F.when(k % 7 != 0, F.col("event_type")),
        "vehicleCode": F.concat(F.lit("Customer#"),
                                F.lpad((F.col("user_id") * 15).cast("string"), 9, "0")),
        "vehicleService": F.concat(F.lit("svc-"), (F.col("user_id") % 7).cast("string")),
        "vehicleId": F.col("user_id").cast("int"),
        "speed": F.greatest(k - 30, F.lit(0)),
        "direction": (k * 37) % 360,
        "delay": F.when(k != 99, (F.floor(F.col("value") * 4) - 100).cast("int")),
        "scheduledTripStartTime": F.when(on_trip, hour),
        "lat": lat.cast("float"),
        "lon": lon.cast("float"),
        "gpsQuality": k % 4,
        "lastUpdate": hour,
    }
    if version >= 2:
        cols["occupancy"] = F.element_at(
            F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), (k % 3 + 1).cast("int"))
    return cols


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").withColumn("k", _k())


def readings(ev: DataFrame, version: int = 1, source_tag: str = "stream",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze-shaped readings from ``events`` rows (with ``k``).

    ``offset`` stands in for the broker offset (= event_id), ``partition``
    is the vehicle's partition, ``enqueued_ts`` the landing time (= ts).
    ``raw_value`` is the event as JSON text with NULL fields kept.
    """
    fields = feed_columns(version)
    staged = ev.select("event_id", "ts", "user_id", *keep,
                       *[v.alias(n) for n, v in fields.items()])
    payload = F.to_json(F.struct(*fields.keys()), {"ignoreNullFields": "false"})
    return staged.select(
        *fields.keys(),
        payload.alias("raw_value"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("enqueued_ts"),
        F.col("ts").alias("event_time"),   # = utc_time(generated), exactly
        F.lit(source_tag).alias("_source"),
        F.current_timestamp().alias("ingestion_ts"),
        *keep,
    )


def feed(spark: SparkSession, sf_dir: str, version: int = 1,
         source_tag: str = "stream") -> DataFrame:
    """One bronze reading per ``events`` row."""
    return readings(events_with_k(spark, sf_dir), version, source_tag)


def feed_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feed`` with ``copy`` = 0, plus a re-delivery (``copy`` = 1, landed
    one second later) of every reading whose k is a multiple of 5."""
    ev = events_with_k(spark, sf_dir)
    first = ev.withColumn("copy", F.lit(0))
    again = (ev.filter(F.col("k") % 5 == 0).withColumn("copy", F.lit(1))
             .withColumn("ts_landed", F.col("ts") + F.expr("INTERVAL 1 SECOND")))
    both = first.withColumn("ts_landed", F.col("ts")).unionByName(again)
    out = readings(both, keep=("copy", "ts_landed"))
    return out.withColumn("enqueued_ts", F.col("ts_landed")).drop("ts_landed")


def routes_bronze(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """Route reference rows from ``nation`` (optionally repeated)."""
    n = read_table(spark, sf_dir, "nation")
    one = n.select(
        F.col("n_nationkey").alias("route_id"),
        F.col("n_regionkey").alias("route_type"),
        F.col("n_name").alias("route_color"),
        F.lit("FFFFFF").alias("route_text_color"),
        F.lit("routes.txt").alias("source_file"),
    )
    out = one
    for _ in range(copies - 1):
        out = out.unionByName(one)
    return out


def vehicles_bronze(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Vehicle roster rows from ``customer``."""
    cu = read_table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    key = F.col("c_custkey")
    return cu.select(
        F.col("c_name").alias("vehicleCode"),
        F.when(seg == "BUILDING", "Autobus").when(seg == "MACHINERY", "Tramwaj")
         .otherwise(seg).alias("transportationType"),
        F.concat(F.lit("class-"), (key % 3).cast("string")).alias("vehicleCharacteristics"),
        seg.alias("brand"),
        F.col("c_name").alias("model"),
        (F.lit(1990) + key % 30).alias("productionYear"),
        (F.lit(10) + key % 9).cast("double").alias("length"),
        (F.lit(20) + key % 25).alias("seats"),
        (F.lit(40) + key % 60).alias("standingPlaces"),
        F.when(key % 2 == 0, "low").otherwise("high").alias("floorHeight"),
        F.when(key % 4 == 0, "electric").otherwise("diesel").alias("driveType"),
        F.col("c_nationkey").cast("string").alias("carrirer"),
        (key % 2 == 0).alias("airConditioning"),
        (key % 3 != 0).alias("wheelchairsRamp"),
        (key % 5 != 0).alias("ticketMachine"),
        (key % 7 == 0).alias("usb"),
        F.lit("vehicles.json").alias("source_file"),
        *([key] if with_key else []),
    )


def _hms(seconds: Column) -> Column:
    """Seconds -> ``HH:MM:SS`` text; hours may pass 24 (after-midnight trips)."""
    return F.concat_ws(":", F.lpad((seconds / 3600).cast("long").cast("string"), 2, "0"),
                       F.lpad(((seconds % 3600) / 60).cast("long").cast("string"), 2, "0"),
                       F.lpad((seconds % 60).cast("string"), 2, "0"))


def gtfs_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Transit reference files derived from the order/part tables."""
    t = lambda n: read_table(spark, sf_dir, n)
    nation, supplier, orders, lineitem, region = (
        t("nation"), t("supplier"), t("orders"), t("lineitem"), t("region"))
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    return {
        "routes.txt": nation.select(
            F.col("n_nationkey").alias("route_id"),
            F.col("n_regionkey").cast("string").alias("agency_id"),
            F.col("n_name").alias("route_short_name"),
            F.col("n_regionkey").alias("route_type"),
            F.col("n_name").alias("route_color"),
            F.lit("FFFFFF").alias("route_text_color")),
        "stops.txt": supplier.select(
            F.col("s_suppkey").cast("string").alias("stop_id"),
            F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("stop_code"),
            F.col("s_name").alias("stop_name"),
            ((F.lit(542000) + (F.col("s_suppkey") % 400) * 10) / F.lit(10000.0)).alias("stop_lat"),
            ((F.lit(183000) + (F.col("s_suppkey") % 700) * 10) / F.lit(10000.0)).alias("stop_lon")),
        "trips.txt": orders.select(
            (F.col("o_custkey") % 30).cast("int").alias("route_id"),
            ymd.alias("service_id"),
            F.col("o_orderkey").cast("string").alias("trip_id"),
            F.col("o_orderpriority").alias("trip_headsign"),
            (F.col("o_orderkey") % 2).cast("int").alias("direction_id")),
        "stop_times.txt": lineitem.select(
            F.col("l_orderkey").cast("string").alias("trip_id"),
            _hms(F.col("l_partkey") % 93600).alias("arrival_time"),
            _hms(F.col("l_partkey") % 93600 + 30).alias("departure_time"),
            F.col("l_suppkey").cast("string").alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence")),
        "calendar_dates.txt": orders.select(
            F.col("o_orderpriority").alias("service_id"), ymd.alias("date"),
            F.lit(1).alias("exception_type")),
        "agency.txt": region.select(
            F.col("r_regionkey").cast("string").alias("agency_id"),
            F.col("r_name").alias("agency_name"),
            F.concat(F.lit("https://agency.example/"), F.col("r_regionkey").cast("string"))
             .alias("agency_url"),
            F.lit("Europe/Warsaw").alias("agency_timezone")),
    }


def roster_pages(spark: SparkSession, sf_dir: str, page_size: int = 256) -> DataFrame:
    """Vehicle roster as API payload pages ``{results: [..]}`` of at most
    ``page_size`` records each (cut on the customer key)."""
    veh = vehicles_bronze(spark, sf_dir, with_key=True).drop("source_file")
    fields = [c for c in veh.columns if c != "c_custkey"]
    return (veh.groupBy(F.floor(F.col("c_custkey") / page_size).alias("page"))
               .agg(F.collect_list(F.struct(*fields)).alias("results")))
