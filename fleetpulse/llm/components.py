"""Connected components of a link table, as a distributed job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the links (``a``, ``b``); the root
    is the least node that can be reached.

    Each round links every node's neighbours to the least of them and itself
    (larger neighbours first, then smaller ones), which shortens all paths
    and keeps the components, until nothing changes.  Every round is written,
    so a lost executor costs one round at most.  Sums per node are taken
    before the shuffle; a node with very many links is never one task's list.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    while True:
        large = _round(edges, True)
        small = stored(_round(large, False), "links")
        # a and b of both rounds as sets: a different sum means a different set
        if _state(small) == _state(edges):
            break
        edges = small
    return (small.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(small.select("b", "b")).groupBy("node").agg(F.min("root").alias("root")))


def _round(edges: DataFrame, larger: bool) -> DataFrame:
    """Link a node's larger neighbours (or its smaller ones and itself) to the
    least of its neighbours and itself.  Edges run from larger to smaller."""
    if larger:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                     F.bit_xor(F.xxhash64("b", "a"))).first()
