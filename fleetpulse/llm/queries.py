"""Registry of the training-data queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import ann, negatives
from fleetpulse.llm.align import op11_align
from fleetpulse.llm.ann import op12_ann
from fleetpulse.llm.bpe import op4_byte_bpe
from fleetpulse.llm.decontaminate import op5_decontamination
from fleetpulse.llm.language_id import op1_language_id
from fleetpulse.llm.licenses import op3_licenses
from fleetpulse.llm.near_dedup import op6_near_dedup
from fleetpulse.llm.negatives import op13_hard_negatives
from fleetpulse.llm.pii import op2_pii
from fleetpulse.llm.ppm import op7_ppm
from fleetpulse.llm.secrets import op10_secrets
from fleetpulse.llm.simhash import op9_simhash
from fleetpulse.llm.toxicity import op8_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_pii, op3_licenses, op4_byte_bpe, op5_decontamination, op6_near_dedup, op7_ppm,
    op8_toxicity, op9_simhash, op10_secrets, op11_align, op12_ann, op13_hard_negatives,
)}

# DuckDB SQL for the queries that SQL can express over whole tables
SQL: dict[str, str] = {"op12_ann": ann.SQL, "op13_hard_negatives": negatives.SQL}
