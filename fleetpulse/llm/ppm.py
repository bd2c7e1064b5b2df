"""Language-model scores: prediction by partial matching over bytes, and a
word unigram baseline.

The byte model is a trie of contexts of up to ORDER bytes with method C
escapes: in a context seen T times with D different symbols, a seen symbol has
count / (T + D), and D / (T + D) escapes to the next shorter context, whose
seen symbols are excluded and the rest rescaled; below the empty context all
256 symbols are equally likely.  A text ends with the byte 255, which UTF-8
never has, and starts after ORDER of them.

A context and a symbol after it are one number, a node of the trie.  Nodes are
counted in the tasks and summed by Spark, so the trie grows with the corpus;
shorter contexts' nodes are sums over longer ones', and probabilities pass from
each length to the next by joins of the nodes with those of one byte less.
Nodes with at least NODE_SHARE of all places (so at most 1 / NODE_SHARE) are
looked up in the tasks; a text's others are joined.

The unigram baseline needs a count for every word of every text.  Words with
at least HOT_SHARE of all training tokens, so at most 1 / HOT_SHARE of them,
are looked up in the tasks; the others are joined, and none of them is
frequent in the training texts.

Cases: a null or empty text has one token, the end; without training rows
every symbol is equally likely and every base score 0; repeated rows count as
often as they stand there and get equal results; very long texts are scored
whole, in parts; an empty table gives no rows.  Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, fold, in_tasks, python_tasks, stored
from fleetpulse.llm.words import NOT_SPACE, Words, chunks, list_column, longs, raw_texts

ORDER = 5                  # bytes of the longest context; with a symbol they fit a long
SYMBOLS = 256
NODE_SHARE = 1e-7          # a node with this share of all places is looked up in the tasks
NODE_BITS = 8 * (ORDER + 1)
TEXT_BITS = 63 - NODE_BITS         # node and text of a place are sorted as one number
TEXTS = 1 << TEXT_BITS             # texts of a chunk, at most
END = 255
HOT_SHARE = 1e-6           # a word with this share of the tokens is looked up in the tasks
END_KEY = 0                # the end of a text, as a word
MANY = 1_000_000           # nodes that a task sums up before it gives them away
PLACES = 1 << 18           # places of texts that are handled at once
# Logarithms are multiples of this, so that sums are exact, in any order, up to
# texts of about a megabyte.
GRAIN = 2.0 ** -34


def nodes(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The node of each place of each text, its end included: the ORDER bytes
    before and the byte there, as one number; and the text of each place.  A
    long text's places come in parts of PLACES."""
    gap = bytes([END] * ORDER)
    data = np.frombuffer(gap + gap.join([t + bytes([END]) for t in texts]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    for lo in range(0, int(ends[-1]), PLACES):
        hi = min(lo + PLACES, int(ends[-1]))
        first, last = np.searchsorted(ends, (lo, hi - 1), side="right")
        cuts = np.concatenate(([lo], ends[first:last], [hi]))
        owner = np.repeat(np.arange(first, last + 1), np.diff(cuts))
        # between two texts there are ORDER places of the gap
        at, to = lo + first * ORDER, hi + last * ORDER
        part = data[at : to + ORDER].astype(np.int64)
        out = part[: to - at].copy()
        for i in range(1, ORDER + 1):
            out <<= 8
            out |= part[i : i + to - at]
        yield out[np.arange(hi - lo) + (owner - first) * ORDER], owner


def text_chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded size and number."""
    for lo, hi in chunks(texts, PLACES):
        for at in range(lo, hi, TEXTS):
            yield at, min(at + TEXTS, hi)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts (one column each) by key."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(n[order], first, axis=0) if len(first) else n[:0]


def node_counts(docs: DataFrame, learns: Column) -> DataFrame:
    """(``node``, ``n``, ``places``): places of each node in the rows that meet
    ``learns`` and in all.  Summed in each task, which gives them away whenever
    it holds very many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.empty(0, np.int64)], [np.empty((0, 2), np.int64)]

        def given(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(key), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pa.RecordBatch.from_pydict({"node": pa.array(key[part]), "n": pa.array(n[part, 0].copy()),
                                                  "places": pa.array(n[part, 1].copy())})

        for batch in batches:
            texts, learn = raw_texts(batch.column("text")), np.array(batch.column("learns").to_pylist(), dtype=bool)
            for lo, hi in text_chunks(texts):
                for node, owner in nodes(texts[lo:hi]):
                    for known in (False, True):
                        key, n = np.unique(node[learn[lo:hi][owner] == known], return_counts=True)
                        keys.append(key)
                        counts.append(np.stack((n * known, n), axis=1))
                    if sum(map(len, keys)) > MANY:
                        key, n = merged(keys, counts)
                        if len(key) > MANY // 2:
                            yield from given(key, n)
                            key, n = key[:0], n[:0]
                        keys, counts = [key], [n]
        yield from given(*merged(keys, counts))

    rows = docs.select("text", F.coalesce(learns, F.lit(False)).alias("learns"))
    return (in_tasks(rows, run, "node long, n long, places long").groupBy("node")
            .agg(F.sum("n").alias("n"), F.sum("places").alias("places")))


def probabilities(counts: DataFrame) -> DataFrame:
    """(``node``, ``p``) for all nodes of (``node``, ``n``): the probability of
    its symbol after its context."""
    levels = [counts.select("node", "n")]
    for k in range(ORDER - 1, -1, -1):
        short = F.col("node").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        levels.insert(0, stored(levels[0].groupBy(short.alias("node")).agg(F.sum("n").alias("n")), f"nodes-{k}"))
    known = None
    for k, level in enumerate(levels):
        if known is None:
            rows = level.withColumn("q", F.lit(1 / SYMBOLS))
        else:
            suffix = F.col("node").bitwiseAND(F.lit((1 << 8 * k) - 1))
            rows = level.withColumn("suffix", suffix).join(
                known.select(F.col("node").alias("suffix"), F.col("p").alias("q")), "suffix")
        # at most SYMBOLS rows a context
        context = Window.partitionBy(F.shiftrightunsigned("node", 8))
        kinds = F.sum((F.col("n") > 0).cast("long")).over(context)
        rows = rows.select("node", "n", "q", F.sum("n").over(context).alias("t"),
                           F.when(kinds < SYMBOLS, kinds).otherwise(F.lit(0)).alias("d"),
                           F.sum(F.when(F.col("n") > 0, F.col("q")).otherwise(0.0)).over(context).alias("seen"))
        p = (F.when(F.col("t") == 0, F.col("q")).when(F.col("n") > 0, F.col("n") / (F.col("t") + F.col("d")))
             .otherwise(F.col("d") / (F.col("t") + F.col("d")) * F.col("q") / (1 - F.col("seen"))))
        known = stored(rows.select("node", p.alias("p")), f"probabilities-{k}")
    return known


def counted(train: DataFrame) -> DataFrame:
    """Training counts of words (``key``, ``n``), summed in each batch before
    they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            keys, counts = [np.array([END_KEY], dtype=np.uint64)], [np.array([len(texts)])]
            for lo, hi in chunks(texts, PLACES):
                h, n = np.unique(Words(texts[lo:hi], NOT_SPACE).hashes, return_counts=True)
                keys.append(h)
                counts.append(n)
            key, n = merged(keys, counts)
            yield pa.RecordBatch.from_pydict({"key": pa.array(longs(key)), "n": pa.array(n)})

    rows = in_tasks(train.select("text"), run, "key long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 0")


Table = tuple[np.ndarray, np.ndarray]          # ascending keys, values


def found(table: Table, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys a table has, and their values (zero for the others)."""
    known, values = table
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    has = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
    return has, np.where(has, values[at], 0.0) if len(known) else np.zeros(len(keys))


def scored(docs: DataFrame, trie: Table, words: Table) -> DataFrame:
    """Each row's tokens, what its hot nodes and words add, and its other nodes
    (``nodes``, ``times``) and words (``cold``)."""
    shared = docs.sparkSession.sparkContext.broadcast((trie, words))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, hot = shared.value
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in text_chunks(texts):
                own, n = texts[lo:hi], hi - lo
                score, pairs, times = np.zeros(n), [], []
                for node, owner in nodes(own):
                    # sorted by node, then text, every node is looked up once
                    both = node << TEXT_BITS | owner
                    both.sort()
                    node, owner = both >> TEXT_BITS, both & (TEXTS - 1)
                    first = np.flatnonzero(np.diff(node, prepend=node[:1] - 1))
                    size = np.diff(np.append(first, len(node)))
                    has, logp = found(trie, node[first])
                    score += np.bincount(owner, weights=np.repeat(logp, size), minlength=n)
                    left = np.flatnonzero(~np.repeat(has, size))
                    pair, often = np.unique(owner[left] << NODE_BITS | node[left], return_counts=True)
                    pairs.append(pair)
                    times.append(often)
                # several parts are those of a single text
                pair, times = np.concatenate(pairs), np.concatenate(times)
                cut = np.searchsorted(pair >> NODE_BITS, np.arange(n + 1))
                w = Words(own, NOT_SPACE)
                known, base = found(hot, w.hashes)
                doc = w.docs()
                cold = np.concatenate(([0], np.cumsum(np.bincount(doc[~known], minlength=n))))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(lo, n),
                    "n_tokens": pa.array(w.counts.astype(np.int64) + 1), "score": pa.array(score),
                    "hot_known": pa.array(np.bincount(doc[known], minlength=n).astype(np.int64)),
                    "hot_base": pa.array(np.bincount(doc, weights=base, minlength=n).astype(np.float64)),
                    "nodes": list_column(pair & ((1 << NODE_BITS) - 1), cut), "times": list_column(times, cut),
                    "cold": list_column(longs(w.hashes[~known]), cold)})

    return in_tasks(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, n_tokens long, score double, hot_known long, hot_base double, "
        "nodes array<long>, times array<long>, cold array<long>")


def as_table(rows: DataFrame, key: str, value: str, unsigned: bool = False) -> Table:
    """Collected rows by ascending key."""
    got = rows.select(key, value).toArrow()
    keys = got[key].to_numpy()
    keys = keys.view(np.uint64) if unsigned else keys
    order = np.argsort(keys)
    return keys[order], got[value].to_numpy()[order]


def score_documents(docs: DataFrame, learns: Column) -> DataFrame:
    """Score all rows of (``doc_id``, ``text``) with what the rows that meet
    ``learns`` teach."""
    vocabulary = stored(counted(docs.filter(learns)), "vocabulary")
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, norm = int(size.n), size.n + 0.5 * (size.v + 1)
    counts = stored(node_counts(docs, learns), "nodes")
    places = counts.agg(F.coalesce(F.sum("places"), F.lit(0)).alias("n")).first().n
    trie = stored(probabilities(counts).join(counts.select("node", "places"), "node")
                  .select("node", (F.rint(F.log10("p") / GRAIN) * GRAIN).alias("logp"), "places"), "trie")
    often = max(1, int(np.ceil(NODE_SHARE * places)))
    least = max(1, int(np.ceil(HOT_SHARE * tokens)))
    logw = F.log10((F.col("n") + F.lit(0.5)) / F.lit(float(norm)))
    # at most 1 / NODE_SHARE and 1 / HOT_SHARE rows
    nodes_often = as_table(trie.filter(F.col("places") >= often), "node", "logp")
    words_often = as_table(vocabulary.filter(F.col("n") >= least).withColumn("logw", logw), "key", "logw", unsigned=True)
    rows = stored(scored(docs, nodes_often, words_often)
                  .withColumn("__row", F.monotonically_increasing_id()), "scored")
    deep = (rows.select("__row", F.inline(F.arrays_zip("nodes", "times")))
            .join(trie.filter(F.col("places") < often), F.col("nodes") == F.col("node"))
            .groupBy("__row").agg(F.sum(F.col("logp") * F.col("times")).alias("deep")))
    rare = vocabulary.filter(F.col("n") < least)
    logp = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.5)) / F.lit(float(norm)))
    cold = (rows.select("__row", F.explode("cold").alias("key")).join(rare, "key", "left")
            .groupBy("__row").agg(F.sum(logp).alias("base"), F.count("n").alias("known")))
    end = vocabulary.filter(F.col("key") == END_KEY).first()
    end_n = end.n if end else 0
    end_log = float(np.log10((end_n + 0.5) / norm))
    return rows.join(cold, "__row", "left").join(deep, "__row", "left").select(
        "doc_id", "n_tokens",
        (F.col("hot_known") + F.coalesce("known", F.lit(0)) + F.lit(int(end_n > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("hot_base") + F.coalesce("base", F.lit(0.0)) + F.lit(end_log)).alias("base_score"),
        (F.col("score") + F.coalesce("deep", F.lit(0.0))).alias("score"))


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the folds that aren't held out."""
    python_tasks(spark)
    docs = documents(spark, sf_dir)
    out = score_documents(docs, fold("doc_id", 5) != 1)
    return out.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
