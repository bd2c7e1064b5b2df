"""The corpus pipeline: toxicity, near-duplicates, decontamination, personal
data, byte-level BPE.  Each stage takes (spark, docs, sf_dir) and returns a
DataFrame, which is written and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm.bpe import tokens_stage
from fleetpulse.llm.common import stored
from fleetpulse.llm.decontaminate import decontaminate_stage
from fleetpulse.llm.near_dedup import dedup_stage
from fleetpulse.llm.pii import pii_stage
from fleetpulse.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontaminate_stage),
    ("pii", pii_stage),
    ("byte_bpe", tokens_stage),
]

# A character model, sketches and BPE merges are beyond SQL; tests compare the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
