"""Nearest neighbours by cross-polytope hashing.

Each table turns all vectors by pseudo-rotations, three rounds of random signs
and a fast Hadamard transform, and assigns each to the nearest signed axis; a
hash joins as many axes as make a bucket hold about BUCKET_ROWS rows, the last
rotations keeping only some of their axes.  A query looks into the PROBES
buckets of each table whose axes it is nearest to.  All rows of these buckets
are compared with it on the original vectors, and the nearest of all tables
are ranked.  Where the probes cover all buckets, one table is enough and the
result is exact; else the number of tables grows with the number of buckets to
the power RHO, the rate that keeps the recall of neighbours whose distance
stays a fixed part of that of unrelated vectors.

A bucket's rows stream past its queries, of which a task holds at most a
share of all.  Buckets with more than a ten-thousandth of all rows or probes
(and more than CHUNK) are split: their rows and queries are dealt into parts
and every part of rows meets every part of queries.  Scores are sums of
products in the order of the components.

Cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without an id, take no part; shorter vectors count as
ending in zeros; rows of one id are one candidate, with its best score; equal
scores go to the smaller id; equal vectors share all buckets; a query without
candidates gives no rows; other columns never enter; an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import python_tasks, stored, table
from fleetpulse.llm.vectors import finite, first_of_each, matrix

BUCKET_ROWS = 512          # rows that a bucket should hold
PROBES = 24                # buckets of a table that a query looks into
TABLES, AT_BUCKETS, RHO = 4, 128, 0.38     # so many tables for so many buckets
ROUNDS = 3                 # of signs and Hadamard transform in a rotation
CHUNK = 8192               # rows or probes of a bucket that are never split
HOT_PARTS = 10_000         # larger ones are split above this part of all rows or probes
CLOSE = 12                 # digits by which tasks choose; the final order uses all
QUERY_BLOCK, FIRST_ROWS = 1024, 128        # of one comparison in a task
TASK_ROWS = 200_000        # rows and probes that a task should get


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row, whose length is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, width)
        half *= 2
    return x / math.sqrt(width)


class Hashing:
    """Tables of joined cross-polytope hashes for vectors of one width."""

    def __init__(self, width: int, buckets: int, seed: int = 12):
        self.width = width
        self.padded = 1 << max(1, (width - 1).bit_length())
        bits = max(0, math.ceil(math.log2(max(1, buckets))))
        most = self.padded.bit_length()                    # 2 * padded signed axes
        parts = -(-bits // most)
        # signed axes of each joined hash, as powers of two
        self.bits = [bits // parts + (i < bits % parts) for i in range(parts)]
        self.buckets = 1 << bits
        self.probes = min(PROBES, self.buckets)
        self.tables = 1 if self.probes == self.buckets else math.ceil(TABLES * (self.buckets / AT_BUCKETS) ** RHO)
        rng = np.random.default_rng(seed)
        self.signs = rng.choice([-1.0, 1.0], (self.tables, parts, ROUNDS, self.padded))

    def axes(self, unit: np.ndarray, t: int, part: int) -> np.ndarray:
        """Each vector's products with the signed axes of one hash."""
        x = np.zeros((len(unit), self.padded))
        x[:, : self.width] = unit
        for signs in self.signs[t, part]:
            x = hadamard(x * signs)
        half = x[:, : max(1, 1 << self.bits[part] >> 1)]
        return np.concatenate((half, -half), axis=1)

    def bucket(self, unit: np.ndarray, t: int) -> np.ndarray:
        """The bucket of each vector: its nearest signed axes."""
        out = np.zeros(len(unit), dtype=np.int64)
        for part, bits in enumerate(self.bits):
            out = (out << bits) + self.axes(unit, t, part).argmax(axis=1)
        return out

    def probed(self, unit: np.ndarray, t: int) -> np.ndarray:
        """The buckets that a query looks into, likeliest first: those whose
        axes' products fall least short of the largest ones."""
        keys, loss = np.zeros((len(unit), 1), dtype=np.int64), np.zeros((len(unit), 1))
        for part, bits in enumerate(self.bits):
            y = self.axes(unit, t, part)
            short = (y.max(axis=1, keepdims=True) - y) ** 2
            loss = (loss[:, :, None] + short[:, None, :]).reshape(len(unit), -1)
            keys = ((keys << bits)[:, :, None] + np.arange(1 << bits)).reshape(len(unit), -1)
            best = np.argsort(loss, axis=1, kind="stable")[:, : self.probes]
            loss, keys = np.take_along_axis(loss, best, 1), np.take_along_axis(keys, best, 1)
        return keys


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish;
    this leaves every cosine as it is."""
    _, power = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -power)


def summed(x: np.ndarray) -> np.ndarray:
    """Row sums, from the first component to the last."""
    return np.cumsum(x, axis=1)[:, -1] if x.shape[1] else np.zeros(len(x))


def hashed(rows: DataFrame, h: Hashing, is_query: Column) -> DataFrame:
    """Each row's bucket in every table (``buckets``) and, for queries, the
    buckets they look into (``probes``, table by table)."""
    kind = rows.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(matrix(batch.column("embedding"), h.width))
            unit = x / np.sqrt(summed(x * x))[:, None]
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            buckets = np.stack([h.bucket(unit, t) for t in range(h.tables)], axis=1)
            probes = np.concatenate([h.probed(unit[asks], t) for t in range(h.tables)], axis=1)
            ends = np.concatenate(([0], np.cumsum(asks * probes.shape[1])))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"),
                "buckets": pa.array(list(buckets), pa.list_(pa.int64())),
                "probes": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(probes.ravel()))})

    return rows.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asks")).mapInArrow(
        run, f"vec_id long, embedding {kind}, buckets array<long>, probes array<long>")


def met(index: DataFrame, h: Hashing, t: int) -> DataFrame:
    """Rows and probes of table ``t`` by bucket (``part`` 0 for queries, 1 for
    rows), those of large buckets by parts of them."""
    rows = index.select(F.element_at("buckets", t + 1).alias("bucket"), F.lit(1).alias("part"), "vec_id", "embedding")
    asks = index.filter(F.size("probes") > 0).select(
        F.explode(F.slice("probes", t * h.probes + 1, h.probes)).alias("bucket"), F.lit(0).alias("part"),
        "vec_id", "embedding")
    sizes = (rows.select("bucket", "part").union(asks.select("bucket", "part")).groupBy("bucket")
             .agg(F.sum("part").alias("n"), F.sum(1 - F.col("part")).alias("q")))
    # at most HOT_PARTS buckets each have more than that part of all rows, or of all probes
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("q"), F.lit(0)).alias("q"),
                      F.max("n").alias("top_n"), F.max("q").alias("top_q")).first()
    most_n, most_q = (max(CHUNK, x // HOT_PARTS) for x in (total.n, total.q))
    if (total.top_n or 0) <= most_n and (total.top_q or 0) <= most_q:
        return rows.union(asks).withColumns({"r": F.lit(0), "q": F.lit(0)})
    large = sizes.filter((F.col("n") > most_n) | (F.col("q") > most_q)).select(
        "bucket", F.ceil(F.col("n") / most_n).cast("int").alias("rs"), F.ceil(F.col("q") / most_q).cast("int").alias("qs"))

    def dealt(side: DataFrame, own: str, other: str, own_parts: str, other_parts: str) -> DataFrame:
        """A row goes to one part of its side and meets all of the other's."""
        out = side.join(F.broadcast(large), "bucket", "left")
        mine = F.pmod(F.xxhash64("vec_id"), F.greatest(F.coalesce(own_parts, F.lit(1)), F.lit(1))).cast("int")
        theirs = F.sequence(F.lit(0), F.greatest(F.coalesce(other_parts, F.lit(1)), F.lit(1)) - 1)
        out = out.withColumn(own, mine).withColumn(other, F.explode(theirs))
        return out.select("bucket", "part", "vec_id", "embedding", "r", "q")

    return dealt(rows, "r", "q", "rs", "qs").union(dealt(asks, "q", "r", "qs", "rs"))


class Cell:
    """Queries of a part of a bucket and the nearest rows they met so far."""

    def __init__(self, asking: list[tuple[np.ndarray, np.ndarray]], k: int):
        self.k = k
        self.ids = np.concatenate([ids for ids, _ in asking])
        self.vectors = np.concatenate([v for _, v in asking])
        self.norm = np.sqrt(summed(self.vectors * self.vectors))
        self.unit = self.vectors / self.norm[:, None]
        # a query with k found needs nothing farther than the last of them
        self.floor = np.full(len(self.ids), -2.0)
        self.place, self.near = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Compare rows with all queries, in blocks; the first few rows set the floors."""
        size = np.sqrt(summed(x * x))
        unit = (x / size[:, None]).T
        few = 0 if len(self.place) else min(FIRST_ROWS, len(ids))
        for lo, hi in ((0, few), (few, len(ids))):
            for at in range(0, len(self.ids) if hi > lo else 0, QUERY_BLOCK):
                rough = np.round(self.unit[at:at + QUERY_BLOCK] @ unit[:, lo:hi], CLOSE)
                q, v = np.nonzero(rough >= self.floor[at:at + QUERY_BLOCK, None])
                score, q, v = rough[q, v], q + at, v + lo
                other = self.ids[q] != ids[v]
                q, v, score = q[other], v[other], score[other]
                first = first_of_each(q, score, ids[v], self.k)
                q, v = q[first], v[first]
                self.add(q, ids[v], summed(self.vectors[q] * x[v]) / (self.norm[q] * size[v]))

    def add(self, place: np.ndarray, near: np.ndarray, score: np.ndarray) -> None:
        place, near, score = (np.concatenate(p) for p in (
            (self.place, place), (self.near, near), (self.score, score)))
        first = first_of_each(place, np.round(score, CLOSE), near, self.k)
        self.place, self.near, self.score = place[first], near[first], score[first]
        last = np.full(len(self.ids), np.inf)
        np.minimum.at(last, self.place, np.round(self.score, CLOSE))
        n = np.bincount(self.place, minlength=len(self.ids))
        self.floor = np.where(n >= self.k, last - 10.0 ** -CLOSE, -2.0)

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"query_id": pa.array(self.ids[self.place]), "vec_id": pa.array(self.near),
                                           "score": pa.array(self.score)})


def compared(meeting: DataFrame, parts: int, width: int, k: int) -> DataFrame:
    """The ``k`` nearest of each part of a bucket to each of its queries."""
    placed = (meeting.repartition(parts, "bucket", "r", "q")
              .sortWithinPartitions("bucket", "r", "q", "part", "vec_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, asking, cell = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "r", "q", "part")], axis=1)
            ids, vectors = batch.column("vec_id").to_numpy(), scaled(matrix(batch.column("embedding"), width))
            cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
                if lo == hi:
                    continue
                *place, part = key[lo].tolist()
                if place != here:
                    if cell:
                        yield cell.found()
                    here, asking, cell = place, [], None
                if part == 0:
                    asking.append((ids[lo:hi], vectors[lo:hi]))
                elif asking:
                    cell = cell or Cell(asking, k)
                    cell.meet(ids[lo:hi], vectors[lo:hi])
        if cell:
            yield cell.found()

    return placed.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = 5, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The ``k`` nearest found of each query among (``vec_id``, ``embedding``)."""
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.col("vec_id").isNotNull() & finite("embedding")
        & F.exists("embedding", lambda x: x.cast("double") != 0))
    size = whole.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    h = Hashing(size.width or 1, math.ceil(size.n / bucket_rows))
    index = stored(hashed(whole, h, is_query), "index")
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(size.n * (1 + h.probes / 50) / TASK_ROWS))
    near = None
    for t in range(h.tables):
        found = stored(compared(met(index, h, t), parts, h.width, k), "near")
        near = found if near is None else near.union(found)
    once = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (once.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op12_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50."""
    python_tasks(spark)
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# All pairs; equal to the query where the probes cover all buckets, as on
# tables of up to PROBES * BUCKET_ROWS / 2 rows.
SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.e, c.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
  FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
