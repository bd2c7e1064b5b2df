"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  For each bit one binary classifier
over byte n-grams tells the languages with a 1 from those with a 0; a text's
bit margins are compared with all codewords by a loss weighted with how well
each bit serves each language, and the nearest codeword wins.  A second
codeword nearly as close marks the text as ambiguous.

Empty cases: a null text or one without a letter gives ``und`` with score 0;
with no labelled training row every text does; an empty table gives no rows;
repeated rows give equal results; equal losses go to the alphabetically first
language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import fold, python_tasks, table
from fleetpulse.llm.words import LOWER, chunks, raw_texts

BUCKETS = 1 << 14          # hashed n-gram features (fixed size of the model)
ORDERS = (1, 2, 3, 4)      # n-gram lengths in bytes
CALIBRATION_ROWS = 4000    # bound of the labelled sample that weighs the bits
AMBIGUOUS = 0.2            # least lead of the winner's probability
RANDOM_BITS = 10           # bits per log2(language) beyond the exhaustive code
SHARPNESS = 4.0            # scale of the margins per language-bit loss


def codewords(n: int) -> np.ndarray:
    """A codeword of +-1 for each of ``n`` languages.

    Up to 7 languages: all 2^(n-1)-1 different splits.  More: a fixed random
    dense code with rows and columns of both signs.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        splits = [[1] + [1 if s >> i & 1 else -1 for i in range(n - 1)] for s in range(2 ** (n - 1) - 1)]
        return np.array(splits, dtype=float).T
    bits = int(np.ceil(RANDOM_BITS * np.log2(n)))
    rng = np.random.default_rng(n)
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        d = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if d > apart:
            best, apart = code, d
    return best


def gram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature bucket of every byte n-gram, and the text each belongs to.

    White space is one blank, digits and most punctuation are dropped, so
    markup and numbers say nothing about the language.
    """
    keep = np.zeros(256, dtype=np.uint8)
    keep[97:123] = np.arange(97, 123)
    keep[128:] = np.arange(128, 256)
    data = keep[LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends, prepend=0))
    some = (data > 0) | np.concatenate(([False], data[:-1] > 0))    # letters and the blank after them
    data, doc = data[some].astype(np.uint32), doc[some]
    value = np.zeros(len(data), dtype=np.uint32)
    grams, docs = [], []
    for n in range(1, max(ORDERS) + 1):
        value = value[: max(0, len(data) - n + 1)] * np.uint32(257) + data[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            inside = doc[: len(value)] == doc[n - 1 :]
            grams.append(((value * np.uint32(0x9E3779B1)) >> np.uint32(18))[inside])
            docs.append(doc[: len(value)][inside])
    return np.concatenate(grams).astype(np.int64), np.concatenate(docs)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts per language of a partition."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = np.array(batch.column("lang").to_pylist(), dtype=object), raw_texts(batch.column("text"))
        for lang in dict.fromkeys(langs):
            own = [texts[i] for i in np.flatnonzero(langs == lang)]
            total = held.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for a, b in chunks(own):
                total += np.bincount(gram_buckets(own[a:b])[0], minlength=BUCKETS)
    for lang, total in held.items():
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(some), pa.string()),
                                          "gram": pa.array(some.astype(np.int32)), "n": pa.array(total[some])})


class Model:
    """Bit weights per n-gram bucket, codewords and bit weights per language."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.code = codewords(len(langs))
        share = counts + 0.5
        share = share / share.sum(axis=1, keepdims=True)     # each language counts alike
        self.weights = np.empty((BUCKETS, self.code.shape[1]), dtype=np.float32)
        for b in range(self.code.shape[1]):
            one, zero = self.code[:, b] > 0, self.code[:, b] < 0
            self.weights[:, b] = (np.log(share[one].mean(axis=0)) - np.log(share[zero].mean(axis=0))
                                  if zero.any() else 1.0)
        self.trust = np.ones_like(self.code)

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Mean evidence of each bit's classifier for every text."""
        out = np.zeros((len(texts), self.code.shape[1]))
        for a, b in chunks(texts):
            grams, docs = gram_buckets(texts[a:b])
            n = np.bincount(docs, minlength=b - a)
            # one sparse row of counts for each text, times the bit weights
            starts = np.concatenate(([0], np.cumsum(n)))
            order = np.argsort(docs, kind="stable")
            grams = grams[order]
            for i in np.flatnonzero(n):
                own = np.bincount(grams[starts[i] : starts[i + 1]], minlength=BUCKETS)
                some = np.flatnonzero(own)
                out[a + i] = own[some] @ self.weights[some] / n[i]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its probability and its lead over the next one."""
        z = SHARPNESS * margins[:, None, :] * self.code[None]
        loss = (self.trust[None] * np.logaddexp(0, -z)).sum(axis=2)
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        ranked = np.sort(p, axis=1)
        lead = ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0.0)
        return loss.argmin(axis=1), p.max(axis=1), lead


def fit(labelled: DataFrame) -> Model | None:
    """Fit on all rows of (``doc_id``, ``text``, ``lang``) with a text and a lang.

    n-gram counts cover every row; only the weights of the bits come from a
    sample of at most CALIBRATION_ROWS rows (least hashes of the id).
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = (rows.select("lang", "text").mapInArrow(_counts, "lang string, gram int, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    if counted.empty:
        return None
    langs = sorted(counted["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    counts[counted["lang"].map(langs.index), counted["gram"]] = counted["n"]
    model = Model(langs, counts)
    sample = (rows.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id")
              .limit(CALIBRATION_ROWS).select("doc_id").distinct())
    picked = rows.join(F.broadcast(sample), "doc_id", "left_semi").select("lang", "text")
    bits = spark.sparkContext.broadcast(model)

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.sign(bits.value.margins(raw_texts(batch.column("text"))))
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "bits": pa.array(
                m.astype(np.int8).tolist(), pa.list_(pa.int8()))})

    signs = picked.mapInArrow(right, "lang string, bits array<tinyint>")
    # the calibration leaves only a hit count per language and bit
    hits = (signs.select("lang", F.posexplode("bits").alias("bit", "sign"))
            .groupBy("lang", "bit").agg(F.avg((F.col("sign") > 0).cast("double")).alias("up")).toPandas())
    for lang, own in hits.groupby("lang"):
        i = langs.index(lang)
        up = own.sort_values("bit")["up"].to_numpy()
        hit = np.where(model.code[i] > 0, up, 1 - up) + 1e-3
        model.trust[i] = hit / hit.sum() * len(hit)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``ambiguous`` to (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            known = np.array(batch.column("text").is_valid())
            langs, score = np.full(len(known), "und", dtype=object), np.zeros(len(known))
            sure = np.zeros(len(known), dtype=bool)
            if m is not None and known.any():
                best, p, lead = m.decode(m.margins(raw_texts(batch.column("text"))))
                langs = np.where(known, np.array(m.langs, dtype=object)[best], "und")
                score, sure = np.where(known, p, 0.0), known & (lead >= AMBIGUOUS)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "lang_pred": pa.array(langs.tolist(), pa.string()),
                "score": pa.array(score), "ambiguous": pa.array(~sure)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the folds that aren't held out."""
    python_tasks(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(fold("doc_id", 5) != 0))
    return predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"),
                                       "lang_pred", "score", "ambiguous")
