"""Alignment of two tokenizers' tokens over the bytes of each text.

A is a byte-level BPE (a `tokenizers` file), B a sentencepiece model.  Both
cut the same bytes, a space and the text, so their tokens are two increasing
arrays of end offsets.  Diagonal run skipping walks both at once: while token
i of A and token i + shift of B end together, probes of doubling width compare
whole slices of the two arrays, and halving probes find where the run ends.
There the ends differ: single steps go to the next common end, which closes a
group of several tokens and sets the new shift.

Two tokens are linked where their bytes overlap.  Links are counted by id pair
over the whole corpus; a pair with at least HOT_SHARE of all links (so at most
1 / HOT_SHARE pairs) is looked up in the tasks, the rare ones are joined.

Cases: a null or empty text, and one that either side does not give back byte
by byte (U+2581 reads as a space, say), has no tokens and zeros; invalid UTF-8
counts as such; strings of special tokens are plain text; repeated rows get
equal results and count as often as they stand there; equal counts of a B id
are all its best; very long texts are encoded whole, in a chunk of their own;
an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, in_tasks, python_tasks, stored
from fleetpulse.llm.words import chunks, list_column, raw_texts

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT_SHARE = 1e-6           # a pair with this share of the links is looked up in the tasks
LONG_WORD = re.compile(r"\S{1000}")
FIRST = 4                  # ends that the first probe of a run compares


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for c, b in [*zip(plain, plain), *((0x100 + k, b) for k, b in enumerate(rest))]}


class Tokens(NamedTuple):
    """Tokens of a chunk of texts: ids, end offsets over the whole chunk, and
    each text's bounds in both."""

    ids: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


class Groups(NamedTuple):
    """Tokens of A and of B up to the end of each group, and all links."""

    a_to: np.ndarray
    b_to: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def ranked(a_path: str, byte_of: dict[str, int]) -> tiktoken.Encoding | None:
    """The same vocabulary as ranks, which encodes faster: where texts are cut
    by the byte-level pattern alone and ids follow the order of the merges."""
    with open(a_path, encoding="utf-8") as f:
        rules = json.load(f)
    cuts, model = rules.get("pre_tokenizer") or {}, rules["model"]
    if (rules.get("normalizer") or cuts.get("type") != "ByteLevel" or not cuts.get("use_regex", True)
            or cuts.get("add_prefix_space") or model.get("type") != "BPE"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][x + y] for x, y in pairs]
    special = {t["content"] for t in rules.get("added_tokens", ())}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    single = [i for t, i in ids.items() if len(t) == 1]
    if made != sorted(made) or len(single) != 256 or max(single) > made[0] or len(ids) != 256 + len(set(made)):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in ids.items()}
    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark deals the work
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.ranked = ranked(a_path, byte_characters())
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = byte_characters()
        pieces = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(byte_of[c] for c in p) if all(c in byte_of for c in p) else p.encode() for p in pieces]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        self.sizes = len(self.a_bytes), len(self.b_bytes)
        self.a_len = np.array([len(x) for x in self.a_bytes])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        # a token as text with what follows it: within a group, at its end
        self.text = [f"{i}{mark}" for n, marks in zip(self.sizes, (",|", ",;")) for mark in marks for i in range(n)]

    def a_ids(self, text: str) -> list[int]:
        # by ranks, a very long word would take time with the square of its length
        if self.ranked and not LONG_WORD.search(text):
            return self.ranked.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[bytes]) -> tuple[Tokens, Tokens]:
        """Tokens of both sides; none for texts that either doesn't give back."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        a = [self.a_ids(" " + t) for t in plain]
        b = self.b.encode(plain, num_threads=1)
        for k, t in enumerate(texts):
            want = b" " + t
            if not t or any(b"".join(map(of.__getitem__, ids)) != want
                            for of, ids in ((self.a_bytes, a[k]), (self.b_bytes, b[k]))):
                a[k], b[k] = [], []
        return self._tokens(a, self.a_len), self._tokens(b, self.b_len)

    @staticmethod
    def _tokens(ids: list[list[int]], size: np.ndarray) -> Tokens:
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, bounds[-1])
        return Tokens(flat, np.cumsum(size[flat]), bounds)


def run_lengths(starts: list[int], lengths: list[int]) -> np.ndarray:
    """All places of runs, one after the other."""
    n = np.array(lengths, dtype=np.int64)
    before = np.cumsum(n) - n
    return np.repeat(np.array(starts, dtype=np.int64) - before, n) + np.arange(n.sum())


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """Groups and links of two arrays of increasing ends with the same last one."""
    a, b = a_ends.tolist(), b_ends.tolist()
    a_raw, b_raw, size = a_ends.tobytes(), b_ends.tobytes(), a_ends.itemsize
    n, m, i, j = len(a), len(b), 0, 0
    run_a, run_b, run_n = [], [], []                       # one-to-one stretches
    group_a, group_b, link_a, link_b = [], [], [], []      # irregular groups
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            start, shift, width = i, size * (j - i), FIRST
            while True:                                    # widen while whole slices agree
                at, to = i * size, (i + width) * size
                if i + width > n or a_raw[at:to] != b_raw[at + shift:to + shift]:
                    break
                i += width
                width += width
            while width > 1:                               # then find the last common end
                width >>= 1
                at, to = i * size, (i + width) * size
                if i + width <= n and a_raw[at:to] == b_raw[at + shift:to + shift]:
                    i += width
            run_a.append(start)
            run_b.append(j)
            run_n.append(i - start)
            j += i - start
            if i >= n:
                break
            x, y = a[i], b[j]
        while x != y:                                      # an irregular group
            link_a.append(i)
            link_b.append(j)
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        link_a.append(i)
        link_b.append(j)
        i += 1
        j += 1
        group_a.append(i)
        group_b.append(j)
    assert j == m
    one_a, one_b = run_lengths(run_a, run_n), run_lengths(run_b, run_n)
    return Groups(np.sort(np.concatenate((one_a + 1, np.array(group_a, np.int64)))),
                  np.sort(np.concatenate((one_b + 1, np.array(group_b, np.int64)))),
                  np.concatenate((one_a, np.array(link_a, np.int64))),
                  np.concatenate((one_b, np.array(link_b, np.int64))))


_held: dict[tuple[str, str], Tokenizers] = {}


def loaded(a_path: str, b_path: str) -> Tokenizers:
    """The worker's pair of tokenizers."""
    if (a_path, b_path) not in _held:
        _held[a_path, b_path] = Tokenizers(a_path, b_path)
    return _held[a_path, b_path]


def group_texts(pair: Tokenizers, a: Tokens, b: Tokens, groups: Groups) -> list[str]:
    """Each text's groups as `a1,a2|b1;a3|b2,b3`."""
    size_a, size_b = pair.sizes
    a_n, b_n = np.diff(groups.a_to, prepend=0), np.diff(groups.b_to, prepend=0)
    code = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
    at_a = np.arange(len(a.ids)) + np.repeat(groups.b_to - b_n, a_n)
    at_b = np.arange(len(b.ids)) + np.repeat(groups.a_to, b_n)
    code[at_a], code[at_b] = a.ids, b.ids + 2 * size_a
    code[at_a[groups.a_to - 1]] += size_a
    code[at_b[groups.b_to - 1]] += size_b
    words = list(map(pair.text.__getitem__, code.tolist()))
    ends = (a.bounds + b.bounds).tolist()
    return ["".join(words[lo:hi])[:-1] for lo, hi in zip(ends, ends[1:])]


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each text's token ids of both sides (``a_ids``, ``b_ids``) and, for each
    group, how many tokens of either side stand up to its end (``a_to``, ``b_to``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(a_path, b_path)
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                a, b = pair.encode(texts[lo:hi])
                g = align(a.ends, b.ends)
                cut = np.searchsorted(g.a_to, a.bounds, side="right")
                n = np.diff(cut)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "a_ids": list_column(a.ids.astype(np.int32), a.bounds),
                    "b_ids": list_column(b.ids.astype(np.int32), b.bounds),
                    "a_to": list_column(g.a_to - np.repeat(a.bounds[:-1], n), cut),
                    "b_to": list_column(g.b_to - np.repeat(b.bounds[:-1], n), cut)})

    return in_tasks(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_to array<long>, b_to array<long>")


def linked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each text's counts, group digest, and distinct id pairs (``pairs``: A id
    times the size of B plus B id) with their links (``times``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(a_path, b_path)
        size_a, size_b = pair.sizes
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                a, b = pair.encode(texts[lo:hi])
                g = align(a.ends, b.ends)
                n_a, n_b = np.diff(a.bounds), np.diff(b.bounds)
                of_link = np.searchsorted(a.bounds, g.link_a, side="right") - 1
                key = (of_link * size_a + a.ids[g.link_a]) * size_b + b.ids[g.link_b]
                key, times = np.unique(key, return_counts=True)
                cut = np.searchsorted(key, np.arange(hi - lo + 1) * (size_a * size_b))
                digests = [sha256(t.encode()).hexdigest() if t else "" for t in group_texts(pair, a, b, g)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n_a": pa.array(n_a), "n_b": pa.array(n_b),
                    "n_groups": pa.array(np.diff(np.searchsorted(g.a_to, a.bounds, side="right"))),
                    "n_links": pa.array(np.bincount(of_link, minlength=hi - lo)),
                    "groups_sha256": pa.array(digests, pa.string()),
                    "pairs": list_column(key % (size_a * size_b), cut),
                    "times": list_column(times, cut)})

    return in_tasks(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>")


def link_counts(links: DataFrame, b_size: int) -> DataFrame:
    """Each id pair (``pair``) with its links corpus-wide (``n``), and whether
    no other pair of its B id has more (``best``)."""
    counts = (links.select(F.inline(F.arrays_zip("pairs", "times")))
              .groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
              .withColumn("b", F.col("pair") % b_size))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def looked_up(links: DataFrame, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """What the hot pairs of each row add (``n_best``, ``count_sum``), and its
    other pairs (``pairs``, ``times``)."""
    shared = links.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            cut = np.concatenate(([0], np.cumsum(pairs.value_lengths().to_numpy().astype(np.int64))))
            key = pairs.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            hit = known[at] == key if len(known) else np.zeros(len(key), dtype=bool)
            add, add_best = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            add[hit] = times[hit] * n[at[hit]]
            add_best[hit] = times[hit] * best[at[hit]]
            rest = np.concatenate(([0], np.cumsum(~hit)))[cut]
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in batch.schema.names if c not in ("pairs", "times")},
                "hot_best": pa.array(np.diff(np.concatenate(([0], np.cumsum(add_best)))[cut])),
                "hot_sum": pa.array(np.diff(np.concatenate(([0], np.cumsum(add)))[cut])),
                "pairs": list_column(key[~hit], rest), "times": list_column(times[~hit], rest)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in links.schema
                       if f.name not in ("pairs", "times"))
    return in_tasks(links, run, f"{fields}, hot_best long, hot_sum long, pairs array<long>, times array<long>")


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts, digests and link figures of all rows of (``doc_id``, ``text``)."""
    links = stored(linked(docs, a_path, b_path).withColumn("__row", F.monotonically_increasing_id()), "links")
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    counts = stored(link_counts(links, b_size), "link-counts")
    total = links.agg(F.coalesce(F.sum("n_links"), F.lit(0)).alias("n")).first().n
    least = max(1, math.ceil(HOT_SHARE * total))
    hot = counts.filter(F.col("n") >= least).toPandas().sort_values("pair")      # at most 1 / HOT_SHARE rows
    rows = stored(looked_up(links, (hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64),
                                    hot["best"].to_numpy(np.int64))), "looked-up")
    rare = (rows.select("__row", F.inline(F.arrays_zip("pairs", "times")))
            .join(counts.filter(F.col("n") < least), F.col("pairs") == F.col("pair"))
            .groupBy("__row").agg(F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
                                  F.sum(F.col("times") * F.col("best").cast("long")).alias("rare_best")))
    return rows.join(rare, "__row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("hot_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the public 50k byte vocabulary with the 32k piece model."""
    python_tasks(spark)
    out = align_documents(documents(spark, sf_dir), public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
