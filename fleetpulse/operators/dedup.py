"""Keyed deduplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                own_exchange: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order``.

    ``row_number() = 1`` lets Spark insert a map-side WindowGroupLimit, so
    each task ships at most one row per key into the shuffle; a key holding
    a third of all rows costs one row per map task, not a third of the data
    in one reducer.  NULL keys form one group (as ``dropDuplicates`` does).

    ``own_exchange``: the window is partitioned by ``keys`` plus a hash of
    them (the same groups), so a later join on ``keys`` does not reuse
    this partitioning and gets its own shuffle.  AQE splits a skewed join
    partition only when both join inputs come straight from a shuffle.
    """
    part = [F.col(k) for k in keys]
    if own_exchange:
        part.append(F.xxhash64(*keys))
    w = Window.partitionBy(*part).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
