"""Readers for the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet path can be read; only its absence counts as missing,
    any other failure (rights, network, damaged files) is raised."""
    try:
        spark.read.parquet(path).limit(0).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; its schema is learned once per path, so later
    reads skip the footer-reading job (the files are read-only)."""
    path = table_path(sf_dir, name)
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)
