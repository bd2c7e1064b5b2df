"""Kafka source and sink options (production transport).

The Kafka connector is not on this container's classpath, so these paths
are exercised only on a cluster; tests use the landing-folder source,
which yields the same envelope columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.config import PipelineConfig


def kafka_options(cfg: PipelineConfig) -> dict[str, str]:
    if not cfg.kafka_bootstrap or not cfg.kafka_topic:
        raise ValueError("kafka_bootstrap and kafka_topic are required for source='kafka'")
    opts = {
        "kafka.bootstrap.servers": cfg.kafka_bootstrap,
        "subscribe": cfg.kafka_topic,
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.kafka_security_protocol:
        opts["kafka.security.protocol"] = cfg.kafka_security_protocol
    if cfg.kafka_sasl_mechanism:
        opts["kafka.sasl.mechanism"] = cfg.kafka_sasl_mechanism
    if cfg.kafka_jaas_config:
        opts["kafka.sasl.jaas.config"] = cfg.kafka_jaas_config
    if cfg.kafka_group_id:
        opts["kafka.group.id"] = cfg.kafka_group_id
    if cfg.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.kafka_min_partitions:
        opts["minPartitions"] = str(cfg.kafka_min_partitions)
    return opts


def read_kafka_stream(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**kafka_options(cfg)).load()
    return raw.select("value", "partition", "offset", "timestamp")


def write_kafka(payload: DataFrame, cfg: PipelineConfig) -> None:
    """Publish rows with a ``value`` column (see ``events.to_payload``)."""
    opts = {k: v for k, v in kafka_options(cfg).items()
            if k.startswith("kafka.") and k != "kafka.group.id"}
    payload.write.format("kafka").options(**opts).option("topic", cfg.kafka_topic).save()
