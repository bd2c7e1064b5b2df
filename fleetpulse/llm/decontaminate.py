"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of word shingles, in powers of
two.  For a partition with at most u shingles, documents are seen as windows
of 2u shingles that start every u, so any passage of an item's length lies in
one window whole, and an item contained to 0.8 has a Jaccard similarity of at
least 0.19 with it however long the document is.  Each MinHash sample is a
band of its own: with 64 samples such a window is missed with a probability
of at most 2e-6.  Filters of the items' samples and shingles, sized by their
number, tell the tasks what to send on; a join on the samples gives candidate
pairs of document and item, and these are verified by all shingles of the
whole document, wherever they stand.  An item of fewer words than a shingle
is one shingle of its own length, looked up among the documents' word runs of
that length.

Words are runs of digits, A-Z in either case and non-ASCII characters.

Cases: null and empty texts, and texts without words, contain nothing and
items without words are found nowhere; repeated rows give equal results,
repeated items count each by their id and text; very long texts are read whole;
a text's columns besides id and text don't matter; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, free_names, id_key, in_tasks, python_tasks, stored, table, text_hash
from fleetpulse.llm.words import ALNUM, Words, chunks, list_column, longs, minima, mix, multipliers, raw_texts

SAMPLES = 64
K = 5                      # words in a shingle
CONTAINED = 0.8
# Flags of a filter for each of its keys, as a power of two overall within these
# bounds: 2^28 flags (32 MB) let through under a tenth of unrelated windows up
# to some 80,000 items; the joins on the keys reject the rest.
FLAGS_PER_KEY, LEAST_BITS, MOST_BITS = 50, 16, 28


def size_class(n: np.ndarray) -> np.ndarray:
    """log2 of the least power of two that is not below ``n``."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def sample_keys(samples: np.ndarray, level: int) -> np.ndarray:
    """The key of each sample: its value, number and size partition."""
    k = np.arange(len(samples), dtype=np.uint64)[:, None]
    return mix((samples.astype(np.uint64) << np.uint64(16)) + (k << np.uint64(8)) + np.uint64(level))


def item_keys(items: DataFrame, item_id: str) -> DataFrame:
    """(``item``, ``__ith``, ``words``, ``level``, ``keys``, ``shingles``) of every item."""
    a, b = multipliers(SAMPLES, seed=5)
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                words = Words(texts[lo:hi], ALNUM)
                sh, bounds = words.shingles(K)
                rows = []
                for i in np.flatnonzero(np.diff(bounds)):
                    own = np.unique(sh[bounds[i] : bounds[i + 1]])
                    level = int(size_class(np.diff(bounds)[i : i + 1])[0])
                    samples = minima((own >> np.uint64(32)).astype(np.uint32), np.array([0]), a, b)
                    rows.append((lo + i, level, longs(sample_keys(samples, level).ravel()), longs(own)))
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "item": batch.column("item").take(at), "__ith": batch.column("__ith").take(at),
                    "words": pa.array(words.counts[at.to_numpy() - lo].astype(np.int64)),
                    "level": pa.array([r[1] for r in rows], pa.int32()),
                    "keys": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    "shingles": pa.array([r[3] for r in rows], pa.list_(pa.int64()))})

    rows = items.select(F.col(item_id).alias("item"), text_hash().alias("__ith"), "text").distinct()
    return in_tasks(rows, run, f"item {kind}, __ith long, words long, level int, keys array<long>, shingles array<long>")


class KeyFilter:
    """Two flags for each key: no false negatives, a size that follows the keys
    up to a bound."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def _set(self, slots: np.ndarray) -> np.ndarray:
        return (self.words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Flat places of the keys that may be among those of the filter."""
        flat = keys.ravel()
        maybe = np.flatnonzero(self._set(flat >> np.uint64(64 - self.bits)))
        return maybe[self._set(flat[maybe] & np.uint64((1 << self.bits) - 1))]


def key_filter(keys: DataFrame) -> KeyFilter:
    """The filter of a column of keys, made as a table of its 64-bit words."""
    keys = keys.toDF("key")
    bits = int(np.clip(np.ceil(np.log2(FLAGS_PER_KEY * max(1, keys.count()))), LEAST_BITS, MOST_BITS))
    slots = F.array(F.shiftrightunsigned("key", 64 - bits), F.col("key").bitwiseAND(F.lit((1 << bits) - 1)))
    words = (keys.select(F.explode(slots).alias("slot"))
             .groupBy(F.shiftrightunsigned("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS int))")).alias("flags")))
    rows = words.toArrow()                               # at most 2^MOST_BITS / 64 rows
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows["word"].to_numpy()] = rows["flags"].to_numpy()
    return KeyFilter(bits, out.view(np.uint64))


def _blocks(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``size`` in each segment, and each segment's bounds in them."""
    n = np.diff(bounds)
    many = -(-n // size)
    ends = np.concatenate(([0], np.cumsum(many)))
    within = np.arange(ends[-1]) - np.repeat(ends[:-1], many)
    return np.repeat(bounds[:-1], many) + size * within, ends


def window_hits(sh: np.ndarray, bounds: np.ndarray, flt: KeyFilter, levels: list[int],
                a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(texts, keys) of the windows' samples that pass the filter.

    Minima are taken over the smallest blocks once; larger blocks combine them.
    """
    x = (sh >> np.uint64(32)).astype(np.uint32)
    level = levels[0]
    starts, ends = _blocks(bounds, 1 << level)
    if not len(starts):
        return
    mins = minima(x, starts, a, b)
    for target in range(levels[0], levels[-1] + 1):
        if target > level:                          # two blocks of a text make one
            pair, pair_ends = _blocks(ends, 2)
            mins = np.minimum.reduceat(mins, pair, axis=1)
            starts, ends, level = starts[pair], pair_ends, target
        if target not in levels:
            continue
        owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        n = len(owner)
        after = np.minimum(np.arange(n) + 1, ends[owner + 1] - 1)
        keys = sample_keys(np.minimum(mins, mins[:, after]), target)
        held = flt.has(keys)
        yield owner[held % n], keys.ravel()[held]


def grouped(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each of ``n`` texts, and their bounds."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    return keys[new], np.searchsorted(owner[new], np.arange(n + 1))


def promising(docs: DataFrame, samples: KeyFilter, held: KeyFilter, levels: list[int],
              short: list[int]) -> DataFrame:
    """(``__id``, ``__th``, ``keys``, ``shingles``) of the texts that may contain
    an item: the samples of their windows that items may have, and all of their
    shingles that items may have.  ``short`` are the lengths of short items."""
    rows = docs.select(id_key().alias("__id"), text_hash().alias("__th"), "text")
    a, b = multipliers(SAMPLES, seed=5)
    shared = docs.sparkSession.sparkContext.broadcast((samples, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flt, own_flt = shared.value
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                words, n = Words(texts[lo:hi], ALNUM), hi - lo
                sh, bounds = words.shingles(K)
                found = list(window_hits(sh, bounds, flt, levels, a, b)) if len(sh) and levels else []
                own = [(np.repeat(np.arange(n), np.diff(bounds)), sh)]
                for w in short:                          # a text of fewer words gives its whole sequence again
                    part, ends = words.shingles(w)
                    own.append((np.repeat(np.arange(n), np.diff(ends)), part))
                    hit = own_flt.has(part)
                    found.append((own[-1][0][hit], part[hit]))
                found = found or [(np.empty(0, np.int64), sh[:0])]
                keys, ends = grouped(*(np.concatenate(x) for x in zip(*found)), n)
                some = np.flatnonzero(np.diff(ends))
                if not len(some):
                    continue
                owner, all_sh = (np.concatenate(x) for x in zip(*own))
                wanted = np.zeros(n, dtype=bool)
                wanted[some] = True
                at = np.flatnonzero(wanted[owner])
                at = at[own_flt.has(all_sh[at])]
                shingles, cut = grouped(owner[at], all_sh[at], n)
                yield pa.RecordBatch.from_pydict({
                    "__id": batch.column("__id").slice(lo, n), "__th": batch.column("__th").slice(lo, n),
                    "keys": list_column(longs(keys), ends), "shingles": list_column(longs(shingles), cut)}
                ).take(pa.array(some))

    return in_tasks(rows, run, "__id long, __th long, keys array<long>, shingles array<long>")


def contained(docs: DataFrame, items: DataFrame, item_id: str = "item_id", least: float = CONTAINED) -> DataFrame:
    """(``__id``, ``__th``, ``item``, ``n_shared``, ``containment``) of every
    text that contains at least ``least`` of an item's shingles."""
    keyed = stored(item_keys(items, item_id), "items")
    kind = items.schema[item_id].dataType.simpleString()
    # items of the same text are looked for once
    once = keyed.dropDuplicates(["__ith"])
    short = F.col("words") < K
    asked = stored(once.select("__ith", F.explode(F.when(short, F.col("shingles")).otherwise(
        F.array_distinct("keys"))).alias("key")), "asked")
    if asked.isEmpty():
        return docs.sparkSession.createDataFrame(
            [], f"__id long, __th long, item {kind}, n_shared long, containment double")
    levels = sorted(r[0] for r in once.filter(~short).select("level").distinct().collect())      # powers of two
    lengths = sorted(r[0] for r in once.filter(short).select("words").distinct().collect())      # below K
    own = stored(once.select("__ith", F.size("shingles").alias("size"), F.explode("shingles").alias("s")), "item-shingles")
    found = stored(promising(docs, key_filter(asked.select("key")), key_filter(own.select("s")), levels, lengths),
                   "promising").dropDuplicates(["__id", "__th"])
    row = ["__id", "__th"]
    met = (found.select(*row, F.explode("keys").alias("key")).join(asked, "key").select(*row, "__ith").distinct())
    shared = met.join(own, "__ith").join(found.select(*row, F.explode("shingles").alias("s")), [*row, "s"])
    counted = shared.groupBy(*row, "__ith", "size").agg(F.count("*").alias("n_shared"))
    share = F.col("n_shared") / F.col("size")
    good = counted.filter(F.col("n_shared") >= F.ceil(F.round(F.lit(least) * F.col("size"), 6)))
    return (good.join(keyed.select("item", "__ith"), "__ith")
            .groupBy(*row, "item").agg(F.max("n_shared").alias("n_shared"), F.max(share).alias("containment")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (``doc_id``, ``item_id``) with the benchmark item in the document."""
    python_tasks(spark)
    docs = documents(spark, sf_dir)
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    rows = docs.select("doc_id", id_key().alias("__id"), text_hash().alias("__th"))
    return rows.join(contained(docs, items), ["__id", "__th"]).select(
        "doc_id", F.col("item").alias("item_id"), "n_shared", "containment")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: documents that contain no benchmark item."""
    python_tasks(spark)
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    leaks = stored(contained(docs, items).select("__id", "__th").distinct(), "leaks")
    names = free_names(docs, "__id", "__th")
    rows = docs.withColumns(dict(zip(names, (id_key(), text_hash()))))
    return rows.join(leaks.toDF(*names), names, "left_anti").select(*docs.columns)
