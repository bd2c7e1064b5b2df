"""Toxicity scores with noisy-channel deobfuscation.

Written words hide behind digits and signs for letters, repeated letters and
spaced letters.  Every such stretch becomes a lattice of the characters that
may have been meant; Viterbi finds the likeliest word under a channel model
(how characters are disguised) and a character trigram model of words.  The
plain and the restored words are then scored: words and word beginnings carry
log-odds learnt from labelled texts, as far as a sparse regression needs them,
and a text's score is the logistic of their sum over its different words.

The models learn from all labelled texts: Spark counts their features, and
the regression sums its gradients over the different sets of features that
texts have, in tasks where these are many.  Every text is scored whole.

Cases: a null or empty text, or one without any sign of toxicity, has the
score of the intercept alone, which is low; without labelled rows every text
has; labels that contradict each other for one id both count; repeated rows
get equal results; ties between readings go to the first in alphabetical
order; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, fold, in_tasks, python_tasks, stored, table, text_hash
from fleetpulse.llm.words import raw_texts

KEPT_WORDS = 300_000       # different words that a task counts before it passes them on
BLOCK = 50_000             # feature sets that are summed at a time
SUPPORT, SHARE = 4, 0.02   # toxic texts that a feature needs, and their share of all toxic ones
WEIGHT = 2.0               # least log-odds of a feature
STEPS, PENALTY = 400, 1.0  # of the regression; the penalty is in texts
BEGINNINGS = (4, 5)        # letters of the word beginnings used as features
THRESHOLD = 0.7
KEPT_READINGS = 100_000    # readings a worker remembers

# Signs that stand for letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiou"}
SPACERS = " ._-*"
PUNCTUATION = "@$!|+€(*"

LETTER = r"[^\W\d_]"
SIGNS = r"[0-9@$!|+€(*]"
# Runs that hold signs next to letters, or digits next to other signs.
SIGN = re.compile(rf"(?<={LETTER}){SIGNS}|{SIGNS}(?={LETTER})|[0-9](?=[@$!|+€(*])|(?<=[@$!|+€(*])[0-9]")
SIGN_RUN = re.compile(rf"(?:{LETTER}+|{SIGNS}+)*")
LONG_RUN = re.compile(rf"({LETTER})\1")
# Three or more single characters between spacers; the first pattern tells
# quickly whether there are any.
SINGLE = r"(?:[^\W_]|[@$!|+€(])"
SOME_SPACED = re.compile(rf"[ ._*\-]{SINGLE}[ ._*\-]+{SINGLE}(?![^\W_])")
SPACED = re.compile(rf"(?<![^\W_]){SINGLE}(?:[ ._*-]+{SINGLE}){{2,}}(?![^\W_])")
WORD = re.compile(rf"{LETTER}+")
LOOK = 64                  # characters looked back at first for the beginning of a stretch


class CharModel:
    """Interpolated character trigrams of words; ^ and $ are their ends."""

    def __init__(self, counts: dict[str, float]):
        self.tri, self.bi, self.uni = Counter(), Counter(), Counter()
        self.pairs, self.singles = Counter(), Counter()
        for gram, n in counts.items():
            self.tri[gram] += n
            self.bi[gram[1:]] += n
            self.uni[gram[2]] += n
            self.pairs[gram[:2]] += n
            self.singles[gram[1]] += n
        self.total = sum(self.uni.values())
        self.kept: dict[str, float] = {}

    def logp(self, before: str, char: str) -> float:
        """log probability of a character after two others."""
        gram = before + char
        if gram not in self.kept:
            p1 = (self.uni[char] + 0.1) / (self.total + 10)
            p2 = (self.bi[gram[1:]] + 5 * p1) / (self.singles[before[1]] + 5)
            self.kept[gram] = math.log((self.tri[gram] + 5 * p2) / (self.pairs[before] + 5))
        return self.kept[gram]


def word_grams(word: str) -> Iterator[str]:
    padded = f"^^{word}$"
    for i in range(len(padded) - 2):
        yield padded[i : i + 3]


# What a path through the lattice has meant so far: the letter meant last and
# the path before it.  A path grows by one link, however long it is.
Path = tuple | None


def spelled(path: Path) -> str:
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def restore(written: str, model: CharModel) -> str:
    """The likeliest words behind a written stretch (Viterbi).

    A state is the last two letters meant.  Each character written either is
    a letter (itself or one it disguises), repeats the letter before it, or
    is a spacer, which may also end a word.
    """
    states: dict[str, tuple[float, Path]] = {"^^": (0.0, None)}
    last = ""
    for char in written:
        new: dict[str, tuple[float, Path]] = {}

        def offer(key: str, cost: float, path: Path) -> None:
            held = new.get(key)
            if held is None or cost > held[0] or cost == held[0] and spelled(path) < spelled(held[1]):
                new[key] = (cost, path)

        options = [(c, -0.7) for c in LEET.get(char, "")]
        if char.isalpha():
            options.append((char, -0.1))
        for key, (cost, path) in states.items():
            in_word = path is not None and path[1] != " "
            if char in SPACERS:
                offer(key, cost - 0.5, path)
                if char not in LEET and in_word:
                    offer("^^", cost - 0.5 + model.logp(key, "$"), (path, " "))
            elif char == last and in_word:               # one letter, written again
                offer(key, cost - 0.5, path)
            elif not options:                        # a sign that stands for nothing
                offer(key, cost - 3.0, path)
            for letter, channel in options:
                offer(key[1] + letter, cost + channel + model.logp(key, letter), (path, letter))
        states, last = new, (last if char in SPACERS and char not in LEET else char)
    done = [(-(cost + (0.0 if path and path[1] == " " else model.logp(key, "$"))), spelled(path))
            for key, (cost, path) in states.items()]
    return min(done)[1] if done else ""


def may_mean(words: set[str]) -> re.Pattern:
    """A pattern that every stretch contains behind which one of ``words`` may
    be restored: for each letter a character that may mean it, between them
    only what restoring may drop (that character again, spacers and signs)."""
    tree: dict = {}
    for w in words:
        node = tree
        for letter in w:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict) -> str:
        if "" in node:
            return ""
        parts = []
        for letter, rest in sorted(node.items()):
            chars = re.escape(letter + "".join(c for c, meant in LEET.items() if letter in meant))
            after = written(rest)
            parts.append(f"[{chars}]" + (rf"(?:[{chars}]|[\W_]|[^\x00-\x7f])*{after}" if after else ""))
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    return re.compile(written(tree) if tree else r"(?!)")


class Reader:
    """The telling words of a text, plain and restored: those with a weight."""

    def __init__(self, model: Model):
        self.model, self.chars = model, CharModel(model.grams)
        self.may_tell = may_mean({f.lstrip("^") for f, w in model.weights.items() if w > 0})
        self.plain: dict[str, tuple[str, ...]] = {}
        self.read: dict[str, tuple[str, ...]] = {}

    def telling(self, words: set[str]) -> tuple[str, ...]:
        return tuple(w for w in words if self.model.value(w) > 0)

    def reading(self, written: str) -> tuple[str, ...]:
        """Telling words behind a stretch, which is decoded only if it may mean one."""
        if written not in self.read:
            if len(self.read) >= KEPT_READINGS:
                self.read = {}
            self.read[written] = (self.telling(set(restore(written, self.chars).split()))
                                  if self.may_tell.search(written) else ())
        return self.read[written]

    def word(self, word: str) -> tuple[str, ...]:
        """Telling words of a plain word, which may have letters written again."""
        if word not in self.plain:
            if len(self.plain) >= KEPT_READINGS:
                self.plain = {}
            found = (word,) if self.model.value(word) > 0 else ()
            self.plain[word] = found + self.reading(word) if LONG_RUN.search(word) else found
        return self.plain[word]

    def stretches(self, low: str) -> Iterator[str]:
        """What may be disguised besides plain words: words with signs, spaced ones."""
        end = 0
        for m in SIGN.finditer(low):
            if m.start() < end:
                continue
            look, start = LOOK, m.start()
            while True:                                  # back to the beginning of the run
                back = low[max(end, start - look):start][::-1]
                n = SIGN_RUN.match(back).end()
                if n < len(back) or start - look <= end:
                    break
                look *= 4
            first, end = start - n, SIGN_RUN.match(low, m.start()).end()
            yield low[first:end]
        if SOME_SPACED.search(low):
            yield from (m.group() for m in SPACED.finditer(low))

    def words(self, text: str) -> set[str]:
        low = text.lower()
        found: set[str] = set()
        for w in set(WORD.findall(low)):
            telling = self.plain.get(w)
            if telling is None:
                telling = self.word(w)
            if telling:
                found.update(telling)
        # signs at the ends stand for letters or are punctuation
        for x in set(self.stretches(low)):
            for written in {x, x.strip(PUNCTUATION)}:
                telling = self.read.get(written)
                if telling is None:
                    telling = self.reading(written)
                if telling:
                    found.update(telling)
        return found


def features(words: set[str]) -> set[str]:
    """Words and their beginnings, marked with ^."""
    out = set(words)
    for n in BEGINNINGS:
        out |= {"^" + w[:n] for w in words if len(w) >= n}
    return out


class Model:
    """Feature weights, an intercept and the character model."""

    def __init__(self, weights: dict[str, float], intercept: float, grams: dict[str, float]):
        self.weights, self.intercept, self.grams = weights, intercept, grams

    def reader(self) -> Reader:
        return Reader(self)

    def value(self, word: str) -> float:
        """The weight of a word's strongest feature."""
        get = self.weights.get
        return max(get(word, 0.0), get("^" + word[:4], 0.0), get("^" + word[:5], 0.0))

    def score(self, words: set[str]) -> float:
        total = self.intercept + sum(self.value(w) for w in sorted(words))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, total))))


class Block(NamedTuple):
    """Feature sets with their label and how many texts have them; ``col``
    holds the features of all, ``row`` the set of each."""

    toxic: np.ndarray
    texts: np.ndarray
    col: np.ndarray
    row: np.ndarray

    @property
    def width(self) -> np.ndarray:
        return (np.bincount(self.row, minlength=len(self.texts)) + 1.0) * self.texts


def block(rows: Iterator[tuple]) -> Block:
    """Rows of (``toxic``, ``features``, ``texts``) in a fixed order."""
    rows = sorted((int(t), list(f), int(n)) for t, f, n in rows)
    return Block(np.array([r[0] for r in rows], dtype=float), np.array([r[2] for r in rows], dtype=float),
                 np.array([c for r in rows for c in r[1]], dtype=np.int64),
                 np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows]).astype(np.int64))


def summed_up(sets: DataFrame) -> Callable[[Callable[[Block], np.ndarray]], np.ndarray]:
    """A function that adds up what another one gives for each block of ``sets``:
    here, if they are few enough for one block, or else by a Spark job."""
    n = sets.count()
    if n <= BLOCK:
        one = block(sets.collect())
        return lambda part: part(one)
    blocks = sets.repartition(-(-n // BLOCK)).rdd.mapPartitions(lambda rows: [block(rows)]).cache()
    return lambda part: blocks.map(part).treeReduce(np.add)


def explaining(sets: DataFrame, n: int) -> np.ndarray:
    """Which of ``n`` features a sparse logistic regression keeps: one whose
    toxic texts others explain (rare words of copied texts, say) drops out.
    ``sets`` has the different feature sets (``toxic``, ``features``, ``texts``)."""
    add = summed_up(sets)

    def sizes(b: Block) -> np.ndarray:
        width = b.width
        return np.concatenate(([b.texts.sum(), (b.toxic * b.texts).sum(), width.sum()],
                               np.bincount(b.col, weights=width[b.row], minlength=n)))

    texts, toxic, width, *columns = add(sizes)
    if not texts or not n:
        return np.zeros(n, dtype=bool)
    w, b = np.zeros(n), math.log((toxic + 0.5) / (texts - toxic + 0.5))
    step = 1 / np.maximum(0.25 * np.array(columns), 1e-9)

    def gradient(w: np.ndarray, b: float) -> Callable[[Block], np.ndarray]:
        def part(x: Block) -> np.ndarray:
            at = b + np.bincount(x.row, weights=w[x.col], minlength=len(x.texts))
            over = (1 / (1 + np.exp(-np.clip(at, -50, 50))) - x.toxic) * x.texts
            return np.concatenate(([over.sum()], np.bincount(x.col, weights=over[x.row], minlength=n)))
        return part

    for _ in range(STEPS):
        total = add(gradient(w, b))
        # only signs of toxicity count
        w = np.maximum(w - step * total[1:] - step * PENALTY, 0.0)
        b -= total[0] / (0.25 * width)
    return w > 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Each text of ``docs`` that ``labels`` marks, once, with its different
    labels.  Ids and hashes of texts meet first, so each text moves once."""
    known = labels.filter(F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") != 0).cast("int").alias("toxic"))
    by_text = (docs.select("doc_id", text_hash().alias("th")).join(known.distinct().hint("shuffle_merge"), "doc_id")
               .groupBy("th").agg(F.sort_array(F.collect_set("toxic")).alias("toxic")))
    texts = docs.groupBy(text_hash().alias("th")).agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    return texts.join(by_text.hint("shuffle_merge"), "th").select("text", "toxic")


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts have each feature (``w``), how often
    words hold each character trigram (``g``), and how many texts there are (``n``)."""
    def counted(held: tuple[Counter, Counter], sizes: list[int]) -> pa.RecordBatch:
        grams = Counter()
        for one in held:
            for w, n in one.items():
                if w[0] != "^":
                    for g in word_grams(w):
                        grams[g] += n
        clean, toxic = held
        keys = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_pydict({
            "name": pa.array([f"w{k}" for k in keys] + [f"g{g}" for g in grams] + ["n"], pa.string()),
            "toxic": pa.array([toxic[k] for k in keys] + [0] * len(grams) + [sizes[1]], pa.int64()),
            "clean": pa.array([clean[k] for k in keys] + list(grams.values()) + [sizes[0]], pa.int64())})

    held, sizes = (Counter(), Counter()), [0, 0]       # of clean and of toxic texts
    for batch in batches:
        for text, marks in zip(raw_texts(batch.column("text")), batch.column("toxic").to_pylist()):
            found = features(set(WORD.findall(text.decode().lower())))
            for label in marks:
                held[label].update(found)
                sizes[label] += 1
            if len(held[0]) + len(held[1]) > KEPT_WORDS:
                yield counted(held, sizes)
                held, sizes = (Counter(), Counter()), [0, 0]
    yield counted(held, sizes)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from all ``docs`` (``doc_id``, ``text``) that ``labels`` (``doc_id``,
    ``toxic``) marks; texts that several rows share count once."""
    rows = stored(labelled(docs, labels), "labelled")
    summed = stored(in_tasks(rows, word_counts, "name string, toxic long, clean long")
                    .groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "features")
    sizes = {r.name: r for r in summed.filter("name = 'n'").collect()}.get("n")
    n_toxic, n_clean = (sizes.toxic, sizes.clean) if sizes else (0, 0)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1))
    # few, as each feature needs a share of all toxic texts
    strong = (summed.filter(F.col("name").startswith("w") & (F.col("toxic") >= max(SUPPORT, SHARE * n_toxic))).withColumn("odds", odds)
              .filter(F.col("odds") >= WEIGHT).select("name", "odds").collect())
    # trigrams of letters, not of texts
    grams = {r.name[1:]: float(r.clean) for r in
             summed.filter(F.col("name").startswith("g") & (F.col("clean") >= 3)).collect()}
    odds_of = {r.name[1:]: r.odds for r in strong}
    names = sorted(odds_of)
    place = {name: i for i, name in enumerate(names)}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(place[f] for f in features(set(WORD.findall(t.decode().lower()))) & place.keys())
                     for t in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"),
                                              "features": pa.array(found, pa.list_(pa.int32()))})

    sets = stored(in_tasks(rows, hits, "toxic array<int>, features array<int>")
                  .select(F.explode("toxic").alias("toxic"), "features")
                  .groupBy("toxic", "features").agg(F.count(F.lit(1)).alias("texts")), "feature-sets")
    kept = explaining(sets, len(names))
    weights = {name: odds_of[name] for name, k in zip(names, kept) if k}
    # the words that matter get half of the character model
    toxic_grams = Counter(g for w in weights if w[0] != "^" for g in word_grams(w))
    scale = sum(grams.values()) / max(1, sum(toxic_grams.values()))
    for g, n in toxic_grams.items():
        grams[g] = grams.get(g, 0.0) + n * scale
    # a text without any feature is likelier clean than the labelled texts' share says
    return Model(weights, min(-1.0, math.log((n_toxic + 0.5) / (n_clean + 0.5))) - 1.0, grams)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) as (``doc_id``, ``__th``, ``score``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = m.reader()
        for batch in batches:
            scores = [m.score(reader.words(t.decode())) for t in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "__th": batch.column("__th"),
                                              "score": pa.array(scores, pa.float64())})

    return in_tasks(docs.select("doc_id", text_hash().alias("__th"), "text"), run, f"doc_id {kind}, __th long, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the labels that aren't held out."""
    python_tasks(spark)
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold("doc_id", 3) != 1)
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: documents that score below the threshold."""
    python_tasks(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs.select("doc_id", "text"), labels)
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = m.reader()
        for batch in batches:
            keep = [m.score(reader.words(t.decode())) < THRESHOLD for t in raw_texts(batch.column("text"))]
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)

    return in_tasks(docs, run, docs.schema)
