"""Streaming bronze ingest: source -> parse -> checkpointed append.

Progress lives in the checkpoint, so a restart (on the same checkpoint)
continues where the last run stopped and never repeats rows; a lost
executor only re-runs its task.  A restart may use an evolved event schema:
old files stay as written and new files carry the new column; readers of a
path merge the schemas, a catalog table gets the column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetpulse.config import PipelineConfig
from fleetpulse.schemas import ENVELOPE_TEXT, EVENT_V1
from fleetpulse.sources.events import parse_events, to_envelope
from fleetpulse.sources.kafka import read_kafka_stream


def read_source(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Envelope stream: Kafka in production, a landing folder otherwise."""
    if cfg.source == "kafka":
        return read_kafka_stream(spark, cfg)
    if not cfg.landing_path:
        raise ValueError("landing_path is required for source='files'")
    return spark.readStream.schema(ENVELOPE_TEXT).parquet(cfg.landing_path)


def land(readings: DataFrame, landing_path: str, fields: list[str]) -> None:
    """Append readings to a landing folder as envelope records (a replay
    of what a producer would publish)."""
    to_envelope(readings, fields).write.mode("append").parquet(landing_path)


def add_missing_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    """Add to an existing table the columns that ``schema`` has and it lacks;
    rows written before read them as NULL."""
    spark.catalog.refreshTable(table)
    held = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in held]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def start_ingest(spark: SparkSession, cfg: PipelineConfig,
                 schema: StructType = EVENT_V1) -> StreamingQuery:
    """Append the parsed source to bronze: a path, or without one the catalog
    table ``cfg.bronze_table``, which is created at the first start and gets
    the new columns of an evolved contract."""
    parsed = parse_events(read_source(spark, cfg), schema, cfg.source_tag)
    writer = (parsed.writeStream.format("parquet")
              .option("checkpointLocation", cfg.checkpoint_path)
              .outputMode("append"))
    if cfg.trigger_interval:
        writer = writer.trigger(processingTime=cfg.trigger_interval)
    else:
        writer = writer.trigger(availableNow=True)
    if cfg.bronze_path:
        return writer.option("path", cfg.bronze_path).start()
    table = cfg.table(cfg.bronze_table)
    if spark.catalog.tableExists(table):
        add_missing_columns(spark, table, parsed.schema)
    return writer.toTable(table)


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow run to finish, however long its backlog takes;
    with ``timeout_s``, stop it then and raise."""
    finished = query.awaitTermination(timeout_s) if timeout_s else (query.awaitTermination() or True)
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.id} did not finish within {timeout_s}s")
    if query.exception():
        raise RuntimeError(str(query.exception()))


def settle(query: StreamingQuery, cfg: PipelineConfig) -> None:
    """Let an ingest run take in all that is there now: a drained one ends by
    itself, one with a processing-time trigger is stopped afterwards."""
    if not cfg.trigger_interval:
        return drain(query)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def bronze_schema(spark: SparkSession, event_schema: StructType = EVENT_V1) -> StructType:
    """Schema of bronze rows parsed under ``event_schema`` (no data read)."""
    empty = spark.createDataFrame([], ENVELOPE_TEXT)
    return parse_events(empty, event_schema).schema


def read_bronze(spark: SparkSession, path: str,
                event_schema: StructType | None = None) -> DataFrame:
    """Batch read of a bronze path; evolved columns appear, NULL in older rows.

    With the event contract known (``event_schema``) the bronze schema is
    given to the reader, so no file footer is read to plan the scan; files
    written before a column was added read it as NULL.  Without it, the
    schemas of all files are merged, which reads every footer.
    """
    if event_schema is not None:
        return spark.read.schema(bronze_schema(spark, event_schema)).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def bronze_rows(spark: SparkSession, cfg: PipelineConfig, event_schema: StructType = EVENT_V1) -> DataFrame:
    """Batch read of a job's bronze, by path or by table name."""
    if cfg.bronze_path:
        return read_bronze(spark, cfg.bronze_path, event_schema)
    table = cfg.table(cfg.bronze_table)
    spark.catalog.refreshTable(table)
    return spark.read.table(table)


def stream_bronze(spark: SparkSession, cfg: PipelineConfig, event_schema: StructType = EVENT_V1) -> DataFrame:
    """A job's bronze as a stream of its new rows."""
    path = cfg.bronze_path
    if not path:
        about = spark.sql(f"DESCRIBE FORMATTED {cfg.table(cfg.bronze_table)}")
        path = about.filter("col_name = 'Location'").first()["data_type"]
    return spark.readStream.schema(bronze_schema(spark, event_schema)).parquet(path)
