"""MinHash near-duplicates with odd sketches.

1. One pass makes, for every text, its set of word shingles (as 64-bit
   hashes), the set's size and hash, MinHash samples, band hashes and an odd
   sketch: a bitmap in which each MinHash sample flips one bit, so the XOR of
   two bitmaps shows how many samples differ.
2. Texts with equal sets are one class; only one row of each class goes on.
3. Classes that share a band are candidates.  Inside a band each class is
   paired with one hub only, never all with all.  Sizes and sketches reject
   most pairs, the full sets confirm the rest.
4. Pairs in one component need no further test.  Where a band still holds
   several components, the classes of different components are candidates as
   well, so no link between components is lost.  Under a hub with few classes
   they are paired, sketched and confirmed.  Under a hub with many, a class is
   described by its difference from the hub (the most popular hub that the
   band's hub shares a band with, or itself): two linked classes, of which at
   least one isn't linked with the hub, must share so much of their differences
   that the rarest parts of these already meet.

With 40 bands of 6 rows a pair of similarity 0.8 misses all bands with a
probability of 5e-6.

Cases: a null or empty text, or one without words, has an empty set, is
linked with nothing and kept; fewer words than a shingle: the whole sequence
is the one shingle; rows with one id count by their own texts; a null id is
never a component's least id unless all its ids are null; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, free_names, id_key, in_tasks, python_tasks, stored, text_hash
from fleetpulse.llm.components import components
from fleetpulse.llm.words import NOT_SPACE, Words, chunks, list_column, longs, minima, mix, multipliers, raw_texts

BANDS, ROWS = 40, 6
SKETCH_BITS = 512
SIMILARITY = 0.8
# Up to so many classes under one hub are paired directly, more by differences.
FEW = 64
# Sampling error of MinHash at the threshold: a sketch rejects only pairs that
# look at least this much less similar (4.5 standard deviations).
MARGIN = 0.15


def sketch_limit(similarity: float) -> int:
    """The most different bits with which two sketches pass."""
    differ = 2 * BANDS * ROWS * (1 - (similarity - MARGIN))
    return int(np.ceil(SKETCH_BITS / 2 * (1 - np.exp(-2 * differ / SKETCH_BITS))))


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (8 longs each) of MinHash samples, one column a text."""
    k, n = samples.shape
    at = mix(samples.astype(np.uint64) + (np.arange(k, dtype=np.uint64) << np.uint64(32))[:, None]
             ) % np.uint64(SKETCH_BITS)
    flips = np.bincount((np.arange(n) * SKETCH_BITS + at.astype(np.int64)).ravel(), minlength=n * SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1).view(np.int64)


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """One hash for each band of samples: (texts, BANDS)."""
    n = samples.shape[1]
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] << np.uint64(40), (BANDS, n)).copy()
    for r in range(ROWS):
        h = mix(h + samples[r::ROWS].astype(np.uint64))
    return h.T.copy()


def distinct_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their bounds."""
    shingles, bounds = Words(texts, NOT_SPACE).shingles(k)
    own = [np.unique(shingles[a:b]) for a, b in zip(bounds, bounds[1:])]
    return (np.concatenate(own) if own else shingles), np.concatenate(([0], np.cumsum([len(x) for x in own])))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(``__id``, ``__th``, ``n``, ``cls``, ``bands``, ``sketch``) of every row."""
    rows = docs.select(id_key().alias("__id"), text_hash().alias("__th"), "text")
    a, b = multipliers(BANDS * ROWS, seed=6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                sets, bounds = distinct_sets(texts[lo:hi], k)
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                cls = np.zeros(hi - lo, dtype=np.uint64)
                bands = np.zeros((0, BANDS), dtype=np.uint64)
                sketch = np.zeros((hi - lo, SKETCH_BITS // 64), dtype=np.int64)
                if len(some):
                    starts = bounds[:-1][some]
                    cls[some] = mix(np.add.reduceat(mix(sets + np.uint64(1)), starts) + n[some].astype(np.uint64))
                    samples = minima((sets >> np.uint64(32)).astype(np.uint32), starts, a, b)
                    bands, sketch[some] = band_hashes(samples), odd_sketches(samples)
                has = np.concatenate(([0], np.cumsum(n > 0)))
                yield pa.RecordBatch.from_pydict({
                    "__id": batch.column("__id").slice(lo, hi - lo), "__th": batch.column("__th").slice(lo, hi - lo),
                    "n": pa.array(n.astype(np.int64)), "cls": pa.array(longs(cls)),
                    "bands": list_column(longs(bands.ravel()), has * BANDS),
                    "sketch": list_column(sketch.ravel(), np.arange(hi - lo + 1) * (SKETCH_BITS // 64))})

    return in_tasks(rows, run, "__id long, __th long, n long, cls long, bands array<long>, sketch array<long>")


def shingle_sets(rows: DataFrame, k: int) -> DataFrame:
    """(``cls``, ``shingles``) of rows with ``cls`` and ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                sets, bounds = distinct_sets(texts[lo:hi], k)
                yield pa.RecordBatch.from_pydict({"cls": batch.column("cls").slice(lo, hi - lo),
                                                  "shingles": list_column(longs(sets), bounds)})

    return in_tasks(rows.select("cls", "text"), run, "cls long, shingles array<long>")


def _similar(similarity: float) -> str:
    """SQL condition on sizes and sketches that every linked pair meets."""
    bits = " + ".join(f"bit_count(a.sketch[{i}] ^ b.sketch[{i}])" for i in range(SKETCH_BITS // 64))
    ratio = round(similarity * 100)
    return (f"100 * least(a.n, b.n) >= {ratio} * greatest(a.n, b.n) AND {bits} <= {sketch_limit(similarity)}")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (``a``, ``b``) pairs whose full sets are similar enough."""
    ratio = round(similarity * 100)
    both = (pairs.join(sets.withColumnsRenamed({"cls": "a", "shingles": "x"}), "a")
            .join(sets.withColumnsRenamed({"cls": "b", "shingles": "y"}), "b")
            .withColumn("both", F.size(F.array_intersect("x", "y"))))
    return both.filter(f"100 * both >= {ratio} * (size(x) + size(y) - both)").select("a", "b")


def by_differences(placed: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Candidates among the classes of a hub, from ``placed`` (``hub``, ``cls``,
    ``root``, distinct): the classes linked with their hub, and the pairs
    (both ``a``, ``b``) of different roots that may be linked.

    With sizes n and h of class and hub and d elements in which they differ,
    they are linked if P*d <= Q*(n + h), where P = 100 + ratio and Q = 100 -
    ratio.  A pair is linked if P*(d1 + d2 - 2*common) <= Q*(n1 + n2), common
    being what its two differences share.  If the other class is far from the
    hub (not linked), then 2*P*common > P*d + Q*(h - n) >= 0; for a far class
    and any other, 2*P*common >= P*d - Q*(n + h) > 0.  So with elements in one
    order, rarest first, the first common one lies among the first d - least
    common + 1 of both, and what follows it bounds all that is common.
    """
    ratio = round(similarity * 100)
    p, q = 100 + ratio, 100 - ratio
    sized = (placed.join(sets.withColumnRenamed("shingles", "x"), "cls")
             .join(sets.withColumnsRenamed({"cls": "hub", "shingles": "y"}), "hub")
             .withColumn("delta", F.concat(F.array_except("x", "y"), F.array_except("y", "x")))
             .withColumns({"n": F.size("x").cast("long"), "h": F.size("y").cast("long"),
                           "d": F.size("delta").cast("long")})
             .withColumn("far", F.expr(f"{p} * d > {q} * (n + h)")).drop("x", "y"))
    sized = stored(sized, "differences")
    parts = sized.select("hub", "cls", "root", "n", "h", "d", "far", F.explode("delta").alias("part"))
    rarity = parts.groupBy("hub", "part").agg(F.count("*").alias("df"))
    reach = F.when(F.col("far"), F.expr(f"d - ceil(({p} * d - {q} * (n + h)) / {2 * p}) + 1")).otherwise(
        F.expr(f"d - floor(({p} * d + {q} * (h - n)) / {2 * p})"))
    ranked = parts.join(rarity, ["hub", "part"]).withColumn(
        "at", F.row_number().over(Window.partitionBy("hub", "cls").orderBy("df", "part")))
    # a part of one class only meets nothing
    first = stored(ranked.filter((F.col("at") <= reach) & (F.col("df") > 1)).drop("h", "df"), "rarest")
    common = "1 + least(a.d - a.at, b.d - b.at)"
    pairs = first.alias("a").join(first.alias("b"), F.expr(
        "a.hub = b.hub AND a.part = b.part AND a.far AND a.root <> b.root AND (NOT b.far OR a.cls < b.cls)"
        f" AND {2 * p} * ({common}) >= {p} * (a.d + b.d) - {q} * (a.n + b.n)"))
    return (sized.filter("NOT far AND cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")),
            pairs.select(F.greatest("a.cls", "b.cls").alias("a"), F.least("a.cls", "b.cls").alias("b")))


def near_duplicates(docs: DataFrame, k: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each distinct (id, text): (``__id``, ``__th``, ``n``,
    ``component``, ``first``), where ``first`` is the struct of the component's
    least id and, among its texts with that id, the least text hash."""
    rows = stored(signatures(docs, k), "signatures").dropDuplicates(["__id", "__th"])
    # a null id's key is the least number; as an order, it comes last
    order = F.struct((F.col("__id") == -(2**63)).alias("none"), F.col("__id").alias("id"), F.col("__th").alias("th"))
    full = rows.filter("n > 0")
    classes = stored(full.groupBy("cls").agg(F.min(order).alias("first"), F.any_value("n").alias("n"),
                                             F.any_value("bands").alias("bands"),
                                             F.any_value("sketch").alias("sketch")), "classes")
    slots = classes.select("cls", F.explode("bands").alias("band"))
    # bands with one class pair nothing; the rest are few
    shared = slots.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(slots.join(shared, "band"), "members")
    # an original stands in the same bands as most of its copies, which differ
    # more from each other than from it: the most popular class is the hub
    popular = members.groupBy("cls").agg(F.sum("size").alias("popular"))
    hubs = stored(members.join(popular, "cls").groupBy("band").agg(F.max(F.struct("popular", "cls")).alias("top"))
                  .select("band", "top.popular", F.col("top.cls").alias("hub")), "hubs")
    stars = members.join(hubs, "band").filter("cls <> hub").select(
        F.greatest("cls", "hub").alias("x"), F.least("cls", "hub").alias("y")).distinct()
    light = classes.select("cls", "n", "sketch")
    needed = members.select("cls").distinct()
    picked = classes.join(needed, "cls").select("cls", F.col("first.id").alias("__id"), F.col("first.th").alias("__th"))
    texts = docs.select(id_key().alias("__id"), text_hash().alias("__th"), "text")
    sets = stored(shingle_sets(texts.join(picked, ["__id", "__th"]).dropDuplicates(["cls"]), k), "sets")

    def tested(pairs: DataFrame) -> DataFrame:
        joined = (pairs.join(light.alias("a"), F.col("a.cls") == F.col("x"))
                  .join(light.alias("b"), (F.col("b.cls") == F.col("y")) & F.expr(_similar(similarity))))
        return confirmed(joined.select(F.col("x").alias("a"), F.col("y").alias("b")), sets, similarity)

    links = stored(tested(stars), "stars")
    found = components(links)
    # a hub's own leader is the most popular hub it shares a band with; bands
    # of one leader are compared together, so few classes come under many
    leaders = (members.join(hubs, "band").groupBy("cls")
               .agg(F.max(F.struct("popular", "hub"))["hub"].alias("leader")).withColumnRenamed("cls", "hub"))
    led = hubs.join(leaders, "hub").select("band", "leader")
    # bands that still hold several components
    placed = (members.join(found.withColumnRenamed("node", "cls"), "cls", "left").join(led, "band")
              .select("band", F.col("leader").alias("hub"), "cls", F.coalesce("root", "cls").alias("root")))
    open_bands = placed.groupBy("band").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p <> q")
    rest = stored(placed.join(open_bands.select("band"), "band"), "open")
    stars_of = rest.select("hub", "cls", "root").distinct()
    many = stars_of.groupBy("hub").agg(F.count("*").alias("size")).filter(F.col("size") > FEW).select("hub")
    linked, far = by_differences(stars_of.join(many, "hub"), sets, similarity)
    few = stored(rest.join(many, "hub", "left_anti").join(classes.select("cls", "n", "sketch", "bands"), "cls"), "few")
    # a pair comes from the first of its common bands only
    once = "array_min(array_intersect(a.bands, b.bands)) = a.band"
    across = (few.alias("a").join(few.alias("b"), F.expr(
        f"a.band = b.band AND a.cls < b.cls AND a.root <> b.root AND {_similar(similarity)} AND {once}"))
              .select(F.col("b.cls").alias("a"), F.col("a.cls").alias("b")))
    more = stored(confirmed(across.union(far).distinct(), sets, similarity).union(linked), "across")
    found = components(links.union(more)) if not more.isEmpty() else found
    named = (classes.select("cls", "first").join(found.withColumnRenamed("node", "cls"), "cls", "left")
             .select("cls", "first", F.coalesce("root", "cls").alias("component")))
    least = named.groupBy("component").agg(F.min("first").alias("first"))
    heads = named.select("cls", "component").join(least, "component")
    return (full.select("__id", "__th", "n", "cls").join(heads, "cls")
            .select("__id", "__th", "n", "component", "first")
            .union(rows.filter("n = 0").select("__id", "__th", "n", F.lit(None).cast("long"), order)))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents over two-word shingles at 0.8."""
    python_tasks(spark)
    docs = documents(spark, sf_dir)
    found = near_duplicates(docs, k=2)
    rows = docs.select("doc_id", id_key().alias("__id"), text_hash().alias("__th"))
    least = F.when(~F.col("first.none"), F.col("first.id")).cast(docs.schema["doc_id"].dataType)
    return rows.join(found, ["__id", "__th"]).select(
        "doc_id", F.col("n").alias("n_shingles"), least.alias("component_id"),
        F.col("doc_id").eqNullSafe(least).alias("kept"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: one document of each component (five-word
    shingles, similarity 0.8), the one with the least id; documents without
    words all stay, and rows repeated in full stay once."""
    python_tasks(spark)
    found = near_duplicates(docs, k=5)
    row_id, row_th, wordless = free_names(docs, "__id", "__th", "__wordless")
    keep = (found.filter((F.col("n") == 0) | (F.col("__id") == F.col("first.id")) & (F.col("__th") == F.col("first.th")))
            .select(F.col("__id").alias(row_id), F.col("__th").alias(row_th), (F.col("n") == 0).alias(wordless)))
    rows = docs.withColumns({row_id: id_key(), row_th: text_hash()}).join(keep, [row_id, row_th])
    empty = rows.filter(wordless).select(*docs.columns)
    return rows.filter(~F.col(wordless)).dropDuplicates([row_id, row_th]).select(*docs.columns).unionByName(empty)
