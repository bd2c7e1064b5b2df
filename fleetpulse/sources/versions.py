"""Small numbered records that say which data is current.

A job that replaces several tables writes them to new places first and puts
one record last; readers go by the newest record, so they see all of a run's
tables or none.  Records and the places they name rotate through SLOTS slots:
the newest state and the one before it stay whole while the next is written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLOTS = 3
RECORD = "seq long, entries map<string,bigint>"


def read_known(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Parquet files under ``path`` with a known schema; none, where there are
    no files or no folder yet.  Any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def slot(name: str, version: int) -> str:
    """The place of a version of ``name``."""
    return f"{name}__{version % SLOTS}"


class Journal:
    """Records under one path."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def records(self, spark: SparkSession) -> list[tuple[int, dict[str, int]]]:
        """The last records (at most SLOTS), newest first."""
        rows = read_known(spark, self.path, RECORD + ", slot int").collect()
        return sorted(((r.seq, dict(r.entries or {})) for r in rows), key=lambda r: -r[0])

    def last(self, spark: SparkSession, before: int | None = None) -> tuple[int, dict[str, int]] | None:
        """The newest record, or the newest one numbered below ``before``."""
        return next((r for r in self.records(spark) if before is None or r[0] < before), None)

    def put(self, spark: SparkSession, seq: int, entries: dict[str, int]) -> None:
        pairs = [x for k, v in entries.items() for x in (F.lit(k), F.lit(v).cast("long"))]
        made = F.create_map(*pairs) if pairs else F.lit(None)
        (spark.range(1).select(F.lit(seq).cast("long").alias("seq"), made.cast("map<string,bigint>").alias("entries"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/slot={seq % SLOTS}"))
