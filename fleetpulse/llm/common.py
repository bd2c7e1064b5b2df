"""Helpers the text operators share: table reads, shared scratch tables, row keys."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Arrow batches hold whole texts; fewer rows a batch bound what one task
# holds at a time when texts are long.
ARROW_ROWS = "2000"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``text`` of the whole table; other columns never enter."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Prepare the session for operators that run Python in their tasks: bound
    the rows of an Arrow batch, unless the session already does, and let
    workers that share the driver's files find this package (elsewhere it is
    installed or shipped with the application)."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    root = str(Path(__file__).parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{root}".strip(":")


def give_back() -> None:
    """Return the worker's free memory to the system, where the C library can:
    workers outlive their tasks, and later stages need the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_tasks(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose tasks give their memory back at the end."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: later steps, and re-runs after a lost executor, read
    the files instead of computing the step again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id falls in fold 0)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % n, F.lit(0)).cast("int")


def text_hash(text: Column | str = "text") -> Column:
    """64-bit hash of the text; with the id it names a row (nulls: as empty)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(col, F.lit("")))


def id_key(doc_id: Column | str = "doc_id") -> Column:
    """The id as a join key that also matches null ids."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(col.cast("long"), F.lit(-(2**63)))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` has
    it (in any case), so that added columns replace none of the user's."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
