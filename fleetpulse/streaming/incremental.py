"""Incremental (streaming) twins of the batch silver and latest-position steps.

Each equals its batch twin on the same input, in whatever order and in however
many batches it arrives:

* ``start_silver``  - every micro-batch is deduplicated and compared with a
                      ledger of all readings seen so far, inside the service
                      area or not: a reading's copy that was delivered first
                      wins, whenever it lands
* ``read_silver``   - the enriched rows of the winners that lie in the area
* ``read_latest``   - the latest reading per vehicle, kept up by every batch

A batch writes, each to a folder of its own, the ledger entries of its new
winners, the earlier winners that these replace, the enriched rows, and a new
version of the latest positions; a record put last makes them current.  A batch
that is run again after a failure starts from the record before it and
replaces its folders.  Late readings are kept: there is no watermark.

A batch reads the ledger of the event dates it touches and the latest
positions, so its work follows the batch, these dates and the fleet.  Only
where an earlier winner is replaced, which needs an earlier copy that lands
later, the latest positions of the vehicles concerned come from silver again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, DateType, LongType, StructField, StructType

from fleetpulse.functions.scalar import normalise_type
from fleetpulse.operators.clean import DELIVERY_ORDER, bbox_filter, dedup_readings, derive, typed_timestamps
from fleetpulse.operators.enrich import (DEFAULT_BROADCAST_MAX_ROWS,
                                         dim_routes, dim_vehicles,
                                         enrich_routes, enrich_vehicles,
                                         prepared_dim)
from fleetpulse.operators.gold import FLEET_COLUMNS
from fleetpulse.sources.versions import SLOTS, Journal, read_known

BATCH, DAY = "batch_id", "event_date"
KEY = ("vehicleId", "generated")
EPOCH = date(1970, 1, 1)
BASED = ("rows", "ledger")          # what compaction rewrites
BASES = f"{DAY} date, upto bigint"
FILE_ROWS = 200_000                 # readings of a day and batch that go to one task and file

# Both dimensions, read anew for every micro-batch.
Dimensions = Callable[[SparkSession], tuple[DataFrame, DataFrame]]


def with_field(schema: StructType, name: str, kind: DataType) -> StructType:
    return StructType([*schema.fields, StructField(name, kind)])


@dataclass(frozen=True)
class SilverStore:
    """Where a silver stream keeps its rows, ledger, replaced winners, latest
    positions and records.  It belongs to one checkpoint."""

    root: str

    def folder(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}"

    def of_batch(self, kind: str, batch_id: int) -> str:
        return f"{self.folder(kind)}/{BATCH}={batch_id}"

    def latest_of(self, batch_id: int) -> str:
        return f"{self.folder('latest')}/slot={batch_id % SLOTS}"

    @property
    def journal(self) -> Journal:
        return Journal(self.folder("records"))

    @property
    def compactions(self) -> Journal:
        return Journal(self.folder("compactions"))

    def row_schema(self, spark: SparkSession) -> StructType:
        """Columns of the silver rows, as the last batch wrote them."""
        return spark.read.parquet(self.folder("schema")).schema

    def closed(self, spark: SparkSession) -> tuple[int, int, date] | None:
        """Number, last batch and end of days of the last compaction."""
        last = self.compactions.last(spark)
        return (last[0], last[1]["batch"], EPOCH + timedelta(days=last[1]["day"])) if last else None

    def bases(self, spark: SparkSession, number: int) -> DataFrame:
        """Each compacted day and the batch up to which it was compacted."""
        return spark.read.schema(BASES).parquet(f"{self.folder('bases')}/slot={number % SLOTS}")

    def read(self, spark: SparkSession, kind: str, schema: StructType, upto: int) -> DataFrame:
        """What the batches up to ``upto`` wrote of one kind.  Compacted days
        come from their base, with only the batches after it."""
        rows = read_known(spark, self.folder(kind), with_field(schema, BATCH, LongType()))
        rows = rows.filter(F.col(BATCH) <= upto)
        closed = self.closed(spark)
        if closed is None:
            return rows
        number, batch, day = closed
        rows = rows.filter(F.col(DAY).isNull() | (F.col(DAY) >= F.lit(day)) | (F.col(BATCH) > batch))
        if kind not in BASED:
            return rows
        base = read_known(spark, self.folder(f"base_{kind}"), with_field(schema, "upto", LongType()))
        # one row for each calendar day
        base = base.join(F.broadcast(self.bases(spark, number)), [DAY, "upto"])
        return rows.unionByName(base.withColumnRenamed("upto", BATCH).select(*rows.columns))


@dataclass(frozen=True)
class SilverBatch:
    """What a micro-batch changed: its rows, and the vehicles of rows it replaced
    (None if there are none); ``silver`` is all rows up to this batch."""

    batch_id: int
    rows: DataFrame
    replaced: DataFrame | None
    silver: DataFrame
    latest: DataFrame


def delivery() -> Column:
    """The delivery order as one comparable value (nulls last)."""
    return F.struct(*[x for c in DELIVERY_ORDER for x in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c))])


def same_key(left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & left[c].eqNullSafe(right[c])
    return out


def ledger_schema(readings: StructType) -> StructType:
    return with_field(StructType([readings[c] for c in (*KEY, *DELIVERY_ORDER)]), DAY, DateType())


def read_ledger(spark: SparkSession, store: SilverStore, readings: StructType, days: list, before: int) -> DataFrame:
    """The winner of every reading of ``days`` seen before batch ``before``."""
    known = store.read(spark, "ledger", ledger_schema(readings), before - 1)
    wanted = F.col(DAY).isin([d for d in days if d is not None])
    if None in days:
        wanted = wanted | F.col(DAY).isNull()
    return (known.filter(wanted).groupBy(*KEY, DAY).agg(F.min(delivery()).alias("_held")))


def compared(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """The batch's readings that win, with the delivery of the winner that each
    replaces (``_held``, null for a reading not seen before)."""
    k = known.select(*[F.col(c).alias(f"_{c}") for c in (*KEY, DAY)], "_held")
    same = F.lit(True)
    for c in (*KEY, DAY):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return (fresh.join(k, same, "left").drop(*[f"_{c}" for c in (*KEY, DAY)])
            .filter(F.col("_held").isNull() | (delivery() < F.col("_held"))))


def fleet_latest(silver: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Latest reading per vehicle via ``max_by`` (stream-safe form of the
    ``row_number`` window; same rows)."""
    order = F.struct(*[F.col(c) for c in ("event_time", *DELIVERY_ORDER)])
    columns = [*FLEET_COLUMNS, *keep]
    payload = F.struct(*[F.col(c) for c in columns if c != "vehicleId"])
    return (silver.groupBy("vehicleId")
                  .agg(F.max_by(payload, order).alias("_latest"))
                  .select("vehicleId", "_latest.*")
                  .select(*columns))


# What the kept latest positions need besides the serving columns.
LATEST_KEEP = ("generated", *DELIVERY_ORDER)


def without_replaced(rows: DataFrame, replaced: DataFrame) -> DataFrame:
    columns = (*KEY, *DELIVERY_ORDER)
    return rows.join(replaced.select(*columns), same_key(rows, replaced, columns), "left_anti")


def silver_until(spark: SparkSession, store: SilverStore, batch_id: int, replaced: int,
                 schema: StructType | None = None) -> DataFrame:
    """Silver rows of the batches up to ``batch_id``; ``replaced`` of their
    winners lost against later batches' copies."""
    schema = schema or store.row_schema(spark)
    rows = store.read(spark, "rows", with_field(schema, DAY, DateType()), batch_id)
    if replaced:
        rows = without_replaced(rows, store.read(spark, "replaced", ledger_schema(schema), batch_id))
    return rows.drop(BATCH)


def read_silver(spark: SparkSession, store: SilverStore) -> DataFrame:
    """The current silver rows."""
    seq, entries = store.journal.last(spark)
    return silver_until(spark, store, seq, entries["replaced"])


def read_latest(spark: SparkSession, store: SilverStore) -> DataFrame:
    """The current latest reading per vehicle."""
    seq, _ = store.journal.last(spark)
    return spark.read.parquet(store.latest_of(seq)).select(*FLEET_COLUMNS)


def update_latest(held: DataFrame | None, rows: DataFrame, replaced: DataFrame | None,
                  silver: DataFrame | None) -> DataFrame:
    """Latest positions after a batch, from those before it and the batch's
    rows.  Vehicles whose latest row was replaced are looked up in ``silver``."""
    columns = [*FLEET_COLUMNS, *LATEST_KEEP]
    parts = rows.select(*columns)
    if held is not None:
        if replaced is not None:
            gone = held.join(replaced, same_key(held, replaced, KEY), "left_semi").select("vehicleId")
            held = held.join(gone, same_key(held, gone, ("vehicleId",)), "left_anti")
            again = silver.join(gone, same_key(silver, gone, ("vehicleId",)), "left_semi")
            parts = parts.unionByName(again.select(*columns))
        parts = held.select(*columns).unionByName(parts)
    return fleet_latest(parts, LATEST_KEEP)


def by_day(rows: DataFrame, days: list, least: int = 1) -> DataFrame:
    """Rows dealt so that a day's folder gets one file for each FILE_ROWS of
    its readings, or ``least`` files: ``days`` holds each day and how many it
    has.  Every task has readings of one file, so none grows with the batch."""
    places, total = [], 0
    for day, n in days:
        parts = max(least, -(-n // FILE_ROWS))
        places.append((day, total, parts))
        total += parts
    # one row for each calendar day
    of_day = F.broadcast(rows.sparkSession.createDataFrame(places, "_day date, _first int, _parts int"))
    dealt = rows.join(of_day, F.col(DAY).eqNullSafe(F.col("_day")))
    spread = F.pmod(F.xxhash64(*KEY), F.col("_parts")).cast("int")
    return dealt.repartitionById(max(1, total), F.col("_first") + spread).drop("_day", "_first", "_parts")


def take_batch(batch: DataFrame, batch_id: int, store: SilverStore, dimensions: Dimensions | None,
               tz: str = "Europe/Warsaw", broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               after: Callable[[SilverBatch], None] | None = None) -> None:
    """Bring one batch of parsed readings into silver."""
    spark = batch.sparkSession
    # a stream's session has it off; no operator here keeps state, and the
    # tables that a batch writes should not have a file for each shuffle partition
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    before = store.journal.last(spark, before=batch_id)
    fresh = dedup_readings(typed_timestamps(batch)).withColumn(DAY, F.to_date("event_time")).persist()
    won = fresh
    try:
        days = fresh.groupBy(DAY).count().collect()                              # calendar days
        won = fresh.withColumn("_held", F.lit(None).cast(fresh.select(delivery()).schema[0].dataType))
        if before:
            won = compared(fresh, read_ledger(spark, store, fresh.schema, [d[0] for d in days], batch_id))
        won = by_day(won, days).persist()
        won.select(*KEY, *DELIVERY_ORDER, DAY).write.mode("overwrite").partitionBy(DAY).parquet(
            store.of_batch("ledger", batch_id))
        lost = won.filter(F.col("_held").isNotNull()).select(
            *KEY, *[F.col(f"_held.{c}").alias(c) for c in DELIVERY_ORDER], DAY)
        if before:
            lost.write.mode("overwrite").partitionBy(DAY).parquet(store.of_batch("replaced", batch_id))
        out = won.drop("_held")
        if dimensions is not None:
            routes, vehicles = dimensions(spark)
            r, r_shuf = prepared_dim(dim_routes(routes), routes, broadcast_max_rows)
            v, v_shuf = prepared_dim(dim_vehicles(vehicles), vehicles, broadcast_max_rows)
            out = enrich_vehicles(enrich_routes(bbox_filter(derive(out, tz)), r, r_shuf), v, v_shuf)
            out = out.withColumn("transportationType", normalise_type("transportationType"))
        plain = out.drop(DAY).schema
        if before is None or store.row_schema(spark).simpleString() != plain.simpleString():
            spark.createDataFrame([], plain).write.mode("overwrite").parquet(store.folder("schema"))
        out.write.mode("overwrite").partitionBy(DAY).parquet(store.of_batch("rows", batch_id))
    finally:
        fresh.unpersist()
        won.unpersist()
    # from here on, what was written is read
    schema = out.schema
    mine = read_known(spark, store.of_batch("rows", batch_id), schema)
    gone = read_known(spark, store.of_batch("replaced", batch_id), ledger_schema(schema))
    n_gone, n_rows = gone.count() if before else 0, mine.count()
    held = before[1] if before else {"replaced": 0, "rows": 0}
    replaced = held["replaced"] + n_gone
    gone = gone if n_gone else None
    silver = silver_until(spark, store, batch_id, replaced, plain)
    latest = None
    if set(FLEET_COLUMNS) <= set(schema.fieldNames()):
        kept = mine.select(*FLEET_COLUMNS, *LATEST_KEEP).schema
        old = spark.read.schema(kept).parquet(store.latest_of(before[0])) if before else None
        update_latest(old, mine, gone, silver).write.mode("overwrite").parquet(store.latest_of(batch_id))
        latest = spark.read.schema(kept).parquet(store.latest_of(batch_id)).select(*FLEET_COLUMNS)
    if after is not None:
        after(SilverBatch(batch_id, mine, gone, silver, latest))
    store.journal.put(spark, batch_id, {"replaced": replaced, "rows": held["rows"] + n_rows})


def start_silver(parsed: DataFrame, store: SilverStore, checkpoint: str, dimensions: Dimensions | None = None,
                 tz: str = "Europe/Warsaw", broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                 trigger_interval: str | None = None,
                 after: Callable[[SilverBatch], None] | None = None) -> StreamingQuery:
    """Take a parsed stream into silver.  Without dimensions the rows are
    deduplicated only; with them, every batch reads both anew.  ``after`` runs
    for each batch before it becomes current, and again if the batch does."""
    def take(batch: DataFrame, batch_id: int) -> None:
        take_batch(batch, batch_id, store, dimensions, tz, broadcast_max_rows, after)

    trigger = {"processingTime": trigger_interval} if trigger_interval else {"availableNow": True}
    return (parsed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def compact(spark: SparkSession, store: SilverStore, before: date, files_per_day: int = 1) -> list[date]:
    """Rewrite the many small folders of days before ``before`` into a few files
    for each day (``files_per_day``, more for a day of more readings than go to
    these), without replaced rows; return the days rewritten.

    Only days with new batches since the last compaction are rewritten, and
    never the last batch, which may still be run again.  What is current
    changes by one record at the end, so a failure leaves all as it was.  Run
    it between the stream's runs; ``purge`` then removes the old folders.
    """
    last = store.journal.last(spark)
    if last is None or last[0] < 1:
        return []
    upto, closed = last[0] - 1, store.closed(spark)
    number = closed[0] + 1 if closed else 0
    day = max(before, closed[2]) if closed else before
    readings = store.row_schema(spark)
    ledger = store.read(spark, "ledger", ledger_schema(readings), upto).filter(F.col(DAY) < F.lit(day))
    old = store.bases(spark, closed[0]) if closed else spark.createDataFrame([], BASES)
    # a day that is all in its base has nothing later than that
    stale = (ledger.groupBy(DAY).agg(F.max(BATCH).alias("newest"), F.count(F.lit(1)).alias("readings")).join(old, DAY, "left")
             .filter(F.col("upto").isNull() | (F.col("newest") > F.col("upto"))).select(DAY, "readings"))
    sizes = [tuple(r) for r in stale.collect()]                             # calendar days
    days = [day for day, _ in sizes]
    if not days:
        return []
    in_days = F.col(DAY).isin(days)
    winners = ledger.filter(in_days).groupBy(*KEY, DAY).agg(F.min(delivery()).alias("_held")).select(
        *KEY, *[F.col(f"_held.{c}").alias(c) for c in DELIVERY_ORDER], DAY)
    rows = silver_until(spark, store, upto, last[1]["replaced"]).filter(in_days)
    for kind, df in (("ledger", winners), ("rows", rows)):
        (by_day(df, sizes, files_per_day).write.mode("overwrite").partitionBy(DAY)
         .parquet(f"{store.folder(f'base_{kind}')}/upto={upto}"))
    bases = old.filter(~in_days).unionByName(
        spark.createDataFrame([(d, upto) for d in days], BASES))
    bases.coalesce(1).write.mode("overwrite").parquet(f"{store.folder('bases')}/slot={number % SLOTS}")
    store.compactions.put(spark, number, {"batch": upto, "day": (day - EPOCH).days})
    return sorted(days)


def purge(spark: SparkSession, store: SilverStore) -> int:
    """Remove the folders of days that the last compaction took over, and bases
    that newer ones replaced; return how many.  Readers that began before the
    compaction must have ended."""
    closed = store.closed(spark)
    if closed is None:
        return 0
    number, batch, day = closed
    current = {(r[0], r.upto) for r in store.bases(spark, number).collect()}      # calendar days
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(store.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders(path: str) -> list[str]:
        at = hadoop.Path(path)
        return [s.getPath().toString() for s in files.listStatus(at) if s.isDirectory()] if files.exists(at) else []

    gone = []
    for kind in (*BASED, "replaced", *(f"base_{k}" for k in BASED)):
        for run in folders(store.folder(kind)):
            of = int(run.rsplit("=", 1)[1])
            for path in folders(run):
                try:
                    own = date.fromisoformat(path.rsplit("=", 1)[1])
                except ValueError:                          # readings without a time stay where they are
                    continue
                if (own, of) not in current if kind.startswith("base_") else own < day and of <= batch:
                    gone.append(path)
    return sum(files.delete(hadoop.Path(p), True) for p in gone)
