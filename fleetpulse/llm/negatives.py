"""Hard negatives by threshold joins.

A threshold join finds, for each probe (an anchor's vector, a lower and an
upper bound of the score, whether the label must be the anchor's or another),
the ``k`` highest scores between the bounds.  Rows form blocks with their
dimensions in order of falling energy.  For the least lower bound of a block
of anchors, the norm of a row's last dimensions bounds what these can still
add, so the block's inverted index leaves them out; partial scores accumulate
dimension by dimension over the postings, pairs whose partial score and
remaining norms cannot reach the bound are pruned, and the left-out dimensions
complete the others.  Joins start at a high lower bound, and the probes whose
windows aren't full go on with a lower one, until the bound is the window's
own: so results are exact, however full the windows are.

Positives are the first of the anchor's label, with no bound to the window;
negatives lie between LOWEST and HIGHEST percent of each positive's score.
Anchors go through Spark in chunks of about CHUNK, the only rows that are
collected and broadcast; every chunk's join reads all rows where they are,
without a shuffle, and a task gives at most ``k`` rows for each probe.

Scores are integers, exact up to 64 bits: sums that doubles hold exactly use
doubles, others Python's integers, and scores outside 64 bits end there.

Cases: rows without id, label or vector, and those with a null or non-finite
component, take no part; shorter vectors count as ending in zeros; rows of one
id count once among an anchor's, by their best score, and an anchor of several
rows is the one with the least label and vector; ties go to the smaller id; an
anchor without positives, and a positive whose window is empty, as for every
score below zero, give no rows; other columns never enter; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import python_tasks, stored, table
from fleetpulse.llm.vectors import finite, first_of_each, matrix

POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95   # percent of the positive's score
STEP = 256                 # of the quantised components
CHUNK = 4096               # anchors of one broadcast, on average (it holds less than twice as many)
BLOCK = 256                # anchors that meet a batch of rows at once
GROUP = 16                 # dimensions between two prunings
# lower bounds of the joins for positives, as parts of the product of the
# anchor's and the largest norm, and for negatives, of the positive's score
POSITIVE_LEVELS = (0.6, 0.45, 0.34, 0.25, 0.15)
NEGATIVE_LEVELS = (0.9, 0.8, 0.65)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
EXACT = float(1 << 53)


class Probes(NamedTuple):
    """Anchors of a chunk and the probes into their scores."""

    ids: np.ndarray            # of anchors, ascending
    labels: np.ndarray
    vectors: np.ndarray
    anchor: np.ndarray         # place of each probe's anchor, ascending
    probe: np.ndarray          # each probe's name within its anchor
    low: np.ndarray
    high: np.ndarray
    same: bool                 # whether the label is to be the anchor's


def quantised(x: np.ndarray) -> np.ndarray:
    """Integers, as doubles."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(STEP * x), -1e300, 1e300)


def tails(x: np.ndarray) -> np.ndarray:
    """Norm of each vector from each dimension on, a little too large; the
    last column is zero."""
    with np.errstate(over="ignore"):
        squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.concatenate((np.sqrt(squares) * (1 + 1e-9), np.zeros((len(x), 1))), axis=1)


def big_scores(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Scores beyond exact doubles, in Python's integers."""
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(y).T, LEAST, MOST).astype(np.int64)


class Index:
    """A block of rows, dimensions by falling energy, for threshold joins."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.order = np.argsort(-(vectors * vectors).sum(axis=0), kind="stable")
        self.ids, self.labels, self.y = ids, labels, vectors[:, self.order]
        self.tails = tails(self.y)
        self.largest = np.abs(vectors).max(initial=0.0)

    def pairs(self, a: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of an anchor of ``a`` and a row whose score is at least
        the anchor's ``low``: places of both, scores."""
        a = a[:, self.order]
        width = a.shape[1]
        if width * self.largest * np.abs(a).max(initial=0.0) >= EXACT:
            score = big_scores(a, self.y)
            i, j = np.nonzero(score >= low[:, None])
            return i, j, score[i, j]
        a_tails, floor = tails(a), low.astype(np.float64)
        # a row's dimensions from `kept` on can't reach the least bound by themselves
        kept = (self.tails * a_tails[:, 0].max(initial=0.0) >= max(floor.min(), 1.0)).sum(axis=1)
        if floor.min() <= 0:
            kept[:] = width                       # no bound: nothing can be left out
        rows = np.flatnonzero(kept)
        rows = rows[np.argsort(-kept[rows], kind="stable")]         # longest postings first
        kept = kept[rows]
        partial = np.zeros((len(a), len(rows)))
        for at in range(0, width, GROUP):
            to = min(at + GROUP, width)
            n = int(np.searchsorted(-kept, -at))                    # rows with postings from here on
            if not n:
                break
            partial[:, :n] += a[:, at:to] @ self.y[rows[:n], at:to].T
            if to < width and floor.min() > 0:
                rest = a_tails[:, to, None] * self.tails[rows, to]
                alive = (partial[:, :n] + rest[:, :n] >= floor[:, None])
                # rows past their postings have their own remaining norm
                keep = np.ones(len(rows), dtype=bool)
                keep[:n] = alive.any(axis=0)
                if keep.sum() < 0.9 * len(rows):
                    rows, kept, partial = rows[keep], kept[keep], partial[:, keep]
        # postings end at a multiple of GROUP, or with the dimensions
        done = np.minimum(-(-kept // GROUP) * GROUP, width)
        rest = a_tails[:, done] * self.tails[rows, done]
        i, j = np.nonzero(partial + rest >= floor[:, None])
        score = partial[i, j]
        open_ = np.flatnonzero(done[j] < width)                     # complete what was left out
        for p in np.array_split(open_, -(-len(open_) // 65536)) if len(open_) else ():
            left = np.arange(width) >= done[j[p], None]
            score[p] += np.einsum("pd,pd->p", a[i[p]] * left, self.y[rows[j[p]]])
        good = score >= floor[i]
        return i[good], rows[j[good]], score[good].astype(np.int64)


def joined(index: Index, p: Probes, k: int, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each probe's first ``k`` of a block of rows: places of probes, ids, scores."""
    out = []
    for at in range(0, len(p.ids), BLOCK):
        first, last = np.searchsorted(p.anchor, (at, at + BLOCK))
        if first == last:
            continue
        least = np.full(min(BLOCK, len(p.ids) - at), MOST)
        np.minimum.at(least, p.anchor[first:last] - at, low[first:last])
        asked = np.flatnonzero(least < MOST)
        i, j, score = index.pairs(p.vectors[at + asked], least[asked])
        i = asked[i] + at
        fits = ((p.labels[i] == index.labels[j]) == p.same) & (p.ids[i] != index.ids[j])
        i, j, score = i[fits], j[fits], score[fits]
        # an anchor has few probes: the n-th of each in turn
        start, end = np.searchsorted(p.anchor, i), np.searchsorted(p.anchor, i, side="right")
        for n in range(int((end - start).max(initial=0))):
            has = np.flatnonzero(start + n < end)
            probe = start[has] + n
            fits = (score[has] >= low[probe]) & (score[has] <= p.high[probe])
            probe, has = probe[fits], has[fits]
            best = first_of_each(probe, score[has], index.ids[j[has]], k)
            out.append((probe[best], index.ids[j[has[best]]], score[has[best]]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def threshold_join(rows: DataFrame, probes: Probes, k: int) -> DataFrame:
    """The first ``k`` rows of every probe, as found by each task."""
    shared = rows.sparkSession.sparkContext.broadcast(probes)
    width = probes.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        low, held = p.low.copy(), (np.empty(0, np.int64),) * 3
        for batch in batches:
            index = Index(batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(),
                          quantised(matrix(batch.column("embedding"), width)))
            probe, near, score = (np.concatenate(x) for x in zip(held, joined(index, p, k, low)))
            first = first_of_each(probe, score, near, k)
            held = probe[first], near[first], score[first]
            # a full window needs nothing below its last
            n = np.bincount(held[0], minlength=len(low))
            last = np.full(len(low), MOST)
            np.minimum.at(last, held[0], held[2])
            low = np.where(n >= k, last, low)
        yield pa.RecordBatch.from_pydict({
            "anchor_id": pa.array(p.ids[p.anchor[held[0]]]), "probe": pa.array(p.probe[held[0]]),
            "vec_id": pa.array(held[1]), "score": pa.array(held[2])})

    return rows.mapInArrow(run, "anchor_id long, probe long, vec_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each probe over all tasks."""
    once = found.groupBy("anchor_id", "probe", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("anchor_id", "probe").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def filled(rows: DataFrame, anchors: DataFrame, windows: DataFrame, chunks: int, same: bool, k: int,
           levels: list[Column], width: int) -> DataFrame:
    """The first ``k`` rows of each of ``windows`` (``anchor_id``, ``chunk``,
    ``probe``, ``floor``, ``high`` and what ``levels`` need), by joins with
    falling lower bounds."""
    spark, out = rows.sparkSession, None
    for n in range(len(levels) + 1):
        low = F.greatest(levels[n], "floor") if n < len(levels) else F.col("floor")
        asked = windows.withColumn("low", low)
        hits = None
        for c in range(chunks):
            own = asked.filter(F.col("chunk") == c).select("anchor_id", "probe", "low", "high").toPandas()
            own = own.sort_values(["anchor_id", "probe"])
            if not len(own):
                continue
            some = (anchors.filter(F.col("chunk") == c).select("vec_id", "label", "embedding").toArrow()
                    .combine_chunks().sort_by("vec_id").to_batches()[0])
            ids = some.column("vec_id").to_numpy()
            probes = Probes(ids, some.column("label").to_numpy(), quantised(matrix(some.column("embedding"), width)),
                            np.searchsorted(ids, own["anchor_id"].to_numpy()), own["probe"].to_numpy(np.int64),
                            own["low"].to_numpy(np.int64), own["high"].to_numpy(np.int64), same)
            part = stored(threshold_join(rows, probes, k), "joined")
            hits = part if hits is None else hits.union(part)
        if hits is None:
            break
        first = stored(ranked(hits, k), "ranked")
        full = first.groupBy("anchor_id", "probe").agg(F.count("*").alias("n"))
        state = asked.join(full, ["anchor_id", "probe"], "left")
        done = (F.coalesce("n", F.lit(0)) >= k) | (F.col("low") <= F.col("floor"))
        ended = first.join(state.filter(done).select("anchor_id", "probe"), ["anchor_id", "probe"])
        out = ended if out is None else out.union(ended)
        windows = stored(state.filter(~done).drop("n", "low"), "windows")
    if out is None:
        return spark.createDataFrame([], "anchor_id long, probe long, vec_id long, score long, rank int")
    return out


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, chunk: int = CHUNK) -> DataFrame:
    """Positives and their hard negatives for each anchor of (``vec_id``,
    ``embedding``, ``label``)."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding",
                       F.col("label").cast("long").alias("label"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding"))
    part = F.transform("embedding", lambda x: F.floor(x.cast("double") * STEP).cast("double"))
    norm = F.sqrt(F.aggregate(part, F.lit(0.0), lambda a, x: a + x * x))
    size = rows.agg(F.max(F.size("embedding")).alias("width"), F.max(norm).alias("norm"),
                    F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    width, chunks = size.width or 1, max(1, math.ceil(size.anchors / chunk))
    anchors = stored(
        rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("own"))
        .select("vec_id", "own.label", "own.embedding",
                F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).alias("chunk")), "anchors")
    top = min(float(size.norm or 0.0), 1e300)
    windows = anchors.select(F.col("vec_id").alias("anchor_id"), "chunk", F.lit(0).cast("long").alias("probe"),
                             F.lit(LEAST).cast("long").alias("floor"), F.lit(MOST).cast("long").alias("high"),
                             norm.alias("norm"))
    bound = F.col("norm") * F.lit(top)
    near = filled(rows, anchors, windows, chunks, True, positives,
                  [F.ceil(F.least(bound * part, F.lit(float(1 << 62)))).cast("long") for part in POSITIVE_LEVELS], width)
    near = stored(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                  "positives")
    s = F.col("positive_score").cast("decimal(38,0)")
    windows = stored(
        near.join(anchors.select(F.col("vec_id").alias("anchor_id"), "chunk"), "anchor_id")
        .withColumns({"probe": F.col("positive_id"), "floor": F.ceil(s * LOWEST / 100).cast("long"),
                      "high": F.floor(s * HIGHEST / 100).cast("long")})
        .filter(F.col("floor") <= F.col("high")).select("anchor_id", "chunk", "probe", "floor", "high", "positive_score"),
        "windows")
    levels = [F.ceil(F.col("positive_score") * part).cast("long") for part in NEGATIVE_LEVELS]
    far = filled(rows, anchors, windows, chunks, False, negatives, levels, width)
    return (far.withColumnRenamed("probe", "positive_id").join(near, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor, whose id is divisible by 50."""
    python_tasks(spark)
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS n
  FROM s WHERE same),
r AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INT) AS rank
  FROM p JOIN s ON p.n <= 5 AND s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3"""
