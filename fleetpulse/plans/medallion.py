"""The ordered chain: bronze -> silver table -> six gold tables.

Silver is written once and read back, which cuts the lineage: the gold
steps scan the compact silver files instead of recomputing parse, dedup and
joins six times, and a lost executor re-runs at most one stage of one step.
``fleet_current`` is written before the live KPI, which reads it back.

``run_chain`` takes only new bronze rows into silver and folds them into the
gold tables; ``run_medallion`` rebuilds all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.config import PipelineConfig
from fleetpulse.operators import gold
from fleetpulse.operators.enrich import DEFAULT_BROADCAST_MAX_ROWS
from fleetpulse.plans.silver import build_silver
from fleetpulse.schemas import EVENT_V1
from fleetpulse.sources.tables import path_exists
from fleetpulse.sources.versions import Journal, slot
from fleetpulse.streaming.incremental import DAY, SilverBatch, SilverStore, read_silver, start_silver
from fleetpulse.streaming.ingest import bronze_rows, drain, settle, start_ingest, stream_bronze

# Serving table names.
GOLD_TABLES = ("gold_period_summary", "gold_route_summary", "gold_delay_distribution",
               "gold_destination_summary", "gold_fleet_current", "gold_live_kpi")


@dataclass(frozen=True)
class Store:
    """Where tables live: a storage root (``root``) or a catalog database.

    ``write`` replaces a table.  ``stage`` writes a numbered version of one
    beside the current version, and ``switch`` makes staged versions current
    together: ``read`` goes by the newest record, and in a catalog the table's
    name is a view that follows it.
    """

    root: str | None = None
    database: str | None = None

    def _place(self, name: str) -> str:
        if self.root:
            return f"{self.root.rstrip('/')}/{name}"
        return f"{self.database}.{name}" if self.database else name

    def _save(self, df: DataFrame, name: str) -> None:
        if self.root:
            df.write.mode("overwrite").parquet(self._place(name))
        else:
            df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(self._place(name))

    def _load(self, spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
        if self.root:
            return (spark.read.schema(schema) if schema else spark.read).parquet(self._place(name))
        spark.catalog.refreshTable(self._place(name))
        return spark.read.table(self._place(name))

    def journal(self, spark: SparkSession) -> Journal:
        base = self.root or spark.catalog.getDatabase(self.database or spark.catalog.currentDatabase()).locationUri
        return Journal(f"{base.rstrip('/')}/_versions")

    def versions(self, spark: SparkSession) -> dict[str, int]:
        """The current version of each staged table, and what ``switch`` noted."""
        last = self.journal(spark).last(spark)
        return last[1] if last else {}

    def write(self, df: DataFrame, name: str) -> None:
        """Full overwrite, schema included (a recomputed table)."""
        spark = df.sparkSession
        current = self.versions(spark)
        if name in current:                     # from now on a plain table again
            self._record(spark, {k: v for k, v in current.items() if k != name})
            if not self.root:
                spark.sql(f"DROP VIEW IF EXISTS {self._place(name)}")
        self._save(df, name)

    def exists(self, spark: SparkSession, name: str) -> bool:
        if name in self.versions(spark):
            return True
        if not self.root:
            return spark.catalog.tableExists(self._place(name))
        return path_exists(spark, self._place(name))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        version = self.versions(spark).get(name)
        return self._load(spark, name) if version is None else self.staged(spark, name, version)

    def stage(self, df: DataFrame, name: str, version: int) -> DataFrame:
        """Write a version of a table that nobody reads yet, and read it back."""
        self._save(df, slot(name, version))
        return self.staged(df.sparkSession, name, version, df.schema)

    def staged(self, spark: SparkSession, name: str, version: int, schema: StructType | None = None) -> DataFrame:
        return self._load(spark, slot(name, version), schema)

    def _record(self, spark: SparkSession, entries: dict[str, int]) -> None:
        journal = self.journal(spark)
        last = journal.last(spark)
        journal.put(spark, last[0] + 1 if last else 0, entries)

    def switch(self, spark: SparkSession, versions: dict[str, int], notes: dict[str, int] | None = None) -> None:
        """Make staged versions current, all by one record."""
        self._record(spark, {**self.versions(spark), **versions, **(notes or {})})
        if not self.root:
            for name, version in versions.items():
                if spark.catalog.tableExists(self._place(name)) and \
                        spark.catalog.getTable(self._place(name)).tableType != "VIEW":
                    spark.sql(f"DROP TABLE {self._place(name)}")
                spark.sql(f"CREATE OR REPLACE VIEW {self._place(name)} AS "
                          f"SELECT * FROM {self._place(slot(name, version))}")


def run_medallion(spark: SparkSession, bronze: DataFrame, routes: DataFrame,
                  vehicles: DataFrame, store: Store, tz: str = "Europe/Warsaw",
                  silver_name: str = "gps_positions_silver",
                  broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> dict[str, int]:
    """Build silver and the gold tables; return the row count per table."""
    store.write(build_silver(bronze, routes, vehicles, tz, broadcast_max_rows), silver_name)
    silver = store.read(spark, silver_name)
    steps = {
        "gold_period_summary": gold.period_summary,
        "gold_route_summary": gold.route_summary,
        "gold_delay_distribution": gold.delay_distribution,
        "gold_destination_summary": gold.destination_summary,
        "gold_fleet_current": gold.fleet_current,
    }
    for name, fn in steps.items():
        store.write(fn(silver), name)
    store.write(gold.live_kpi(store.read(spark, "gold_fleet_current")), "gold_live_kpi")
    return {name: store.read(spark, name).count() for name in (silver_name, *GOLD_TABLES)}


def base_and_next(current: dict[str, int], table: str, batch_id: int) -> tuple[int | None, int]:
    """The version of a summary that a batch adds to (None: nothing yet) and
    the one it makes.  A batch that is folded again starts where it did."""
    last, version = current.get(f"{table}:batch"), current.get(f"{table}_partials", 0)
    if last is None:
        return None, 0
    if last > batch_id:
        raise ValueError(f"batch {batch_id} comes after a later one")
    if last == batch_id:
        return (version - 1 if version else None), version
    return version, version + 1


def refresh_gold(spark: SparkSession, new_silver: DataFrame, store: Store, batch_id: int,
                 tables: tuple[str, ...] = tuple(gold.PARTIAL_SPECS), replaced: DataFrame | None = None,
                 silver: DataFrame | None = None, others: dict[str, DataFrame] | None = None,
                 approximate: bool = False) -> None:
    """Fold a batch of new silver rows into the gold summaries.

    Each summary keeps a partial table, one row per (group, vehicle) of
    mergeable sums and maxima (``approximate``: one row per group, with vehicle
    sketches).  A refresh aggregates only the new rows, merges them into the
    partials and re-derives the summary from the partials, so its cost follows
    the batch and the fleet, not the whole silver history.  Batches must be
    disjoint and their ids must grow; the last batch may be folded again (a
    retry after a failure) and then replaces what it gave before.

    ``replaced`` names vehicles (``vehicleId``) that had earlier rows replaced:
    sums and maxima cannot give rows back, so their partials are made again
    from ``silver``, all rows up to this batch (approximate partials, which
    keep no vehicles, are made again as a whole).

    Partials, summaries and ``others`` (tables to switch with them) are staged
    beside the current ones and become current by one record at the end: a
    refresh that fails on the way leaves the old tables readable and can be
    run again.
    """
    current = store.versions(spark)
    versions, notes = {}, {}
    fold = gold.Approximate if approximate else gold.Exact
    for table in tables:
        base, new = base_and_next(current, table, batch_id)
        name = f"{table}_partials"
        if replaced is not None and not fold.by_vehicle:
            merged = fold.partials(silver, table)
        else:
            merged = fold.partials(new_silver, table)
            if base is not None:
                merged = fold.merge(store.staged(spark, name, base, merged.schema).unionByName(merged), table)
            if replaced is not None:
                ids = replaced.select(F.col("vehicleId").alias("_changed")).distinct()
                changed = F.col("vehicleId").eqNullSafe(F.col("_changed"))
                merged = merged.join(ids, changed, "left_anti").unionByName(
                    fold.partials(silver.join(ids, changed, "left_semi"), table))
        store.stage(fold.result(store.stage(merged, name, new), table), f"gold_{table}", new)
        versions |= {name: new, f"gold_{table}": new}
        notes[f"{table}:batch"] = batch_id
    for name, df in (others or {}).items():
        last, version = current.get(f"{name}:batch"), current.get(name, -1)
        new = version if last == batch_id else version + 1
        store.stage(df, name, new)
        versions[name], notes[f"{name}:batch"] = new, batch_id
    store.switch(spark, versions, notes)


def refresh_fleet(spark: SparkSession, store: Store, batch: SilverBatch) -> None:
    """All six gold tables after one silver batch."""
    replaced = batch.replaced.select("vehicleId") if batch.replaced is not None else None
    refresh_gold(spark, batch.rows, store, batch.batch_id, replaced=replaced, silver=batch.silver,
                 others={"gold_fleet_current": batch.latest, "gold_live_kpi": gold.live_kpi(batch.latest)})


def silver_store(spark: SparkSession, cfg: PipelineConfig, store: Store) -> SilverStore:
    """The incremental chain's silver, beside the store's tables."""
    base = store.root or spark.catalog.getDatabase(store.database or spark.catalog.currentDatabase()).locationUri
    return SilverStore(f"{base.rstrip('/')}/{cfg.silver_table}_stream")


def run_chain(spark: SparkSession, cfg: PipelineConfig, store: Store,
              event_schema: StructType = EVENT_V1, rebuild: bool = False) -> dict[str, int]:
    """Ingest -> silver -> gold, in order, in one driver program.

    The ingest step drains the source into bronze (``availableNow``) and is
    restartable on its checkpoint; the reference tables come from the store
    (loaded by ``sources.reference``) and are read anew for every batch.

    Silver is a stream over bronze with a checkpoint of its own, the record of
    the bronze files it has taken, so a run reads only what is new, and folds
    its batches into the gold tables.  Silver rows are read with
    ``chain_silver``.  ``rebuild`` makes silver and gold from all of bronze
    instead, as plain tables.
    """
    settle(start_ingest(spark, cfg, event_schema), cfg)

    def dimensions(session: SparkSession) -> tuple[DataFrame, DataFrame]:
        return store.read(session, cfg.routes_table), store.read(session, cfg.vehicles_table)

    if rebuild:
        return run_medallion(spark, bronze_rows(spark, cfg, event_schema), *dimensions(spark), store, cfg.local_tz,
                             cfg.silver_table, cfg.broadcast_max_rows)
    target = silver_store(spark, cfg, store)
    drain(start_silver(stream_bronze(spark, cfg, event_schema), target, target.folder("_checkpoint"),
                       dimensions, cfg.local_tz, cfg.broadcast_max_rows,
                       after=lambda batch: refresh_fleet(batch.rows.sparkSession, store, batch)))
    counts = {name: store.read(spark, name).count() for name in GOLD_TABLES}
    return {cfg.silver_table: chain_silver(spark, cfg, store).count(), **counts}


def chain_silver(spark: SparkSession, cfg: PipelineConfig, store: Store) -> DataFrame:
    """The silver rows of the incremental chain, without their event date."""
    return read_silver(spark, silver_store(spark, cfg, store)).drop(DAY)


def dashboard_dataset(spark: SparkSession, store: Store, table: str) -> DataFrame:
    """A dashboard dataset: every column of a serving table."""
    return store.read(spark, table).select("*")
