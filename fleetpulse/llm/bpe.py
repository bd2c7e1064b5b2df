"""Byte-level BPE encoding and decoding through a sentencepiece model.

A sentencepiece BPE model is written directly from the rank file: every
vocabulary entry becomes one piece whose characters stand for its bytes, with
score minus its rank and no normalisation, so sentencepiece's best-score
merges are the rank merges.  Texts are cut into pre-tokens, each pre-token is
encoded on its own, and ids decode by the inverse mapping.

Empty cases: a null or empty text has no tokens, both hashes are those of an
empty string; repeated rows give equal results; an empty table gives no rows;
any text decodes to its own UTF-8 bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, in_tasks, python_tasks
from fleetpulse.llm.words import chunks, raw_texts

VOCABULARY = "byte_bpe_50k.tiktoken"
FIRST_CHAR = 0x100         # byte b is written as the character FIRST_CHAR + b
CACHED_PRETOKENS = 200_000  # distinct pre-tokens in one generation of a worker's cache

# Field numbers and constants of the public model format.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
BPE_TYPE, NORMAL, UNKNOWN = 2, 1, 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def byte_texts(data: list[bytes]) -> list[str]:
    """Bytes as characters, one each, for a whole list at once."""
    joined = np.frombuffer(b"".join(data), dtype=np.uint8).astype("<u2") + np.uint16(FIRST_CHAR)
    text, out, at = joined.tobytes().decode("utf-16-le"), [], 0
    for d in data:
        out.append(text[at : (at := at + len(d))])
    return out


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """Vocabulary entries and their ranks, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    return sorted(((base64.b64decode(a), int(r)) for a, r in pairs), key=lambda x: x[1])


def model_proto(ranks: list[tuple[bytes, int]]) -> bytes:
    """The vocabulary as a serialised sentencepiece BPE model; piece i + 1 is
    the i-th vocabulary entry, piece 0 the unknown one, which cannot occur
    as every byte is a piece."""
    pieces = [_bytes_field(1, b"<unk>") + _int_field(3, UNKNOWN)]
    for text, (_, rank) in zip(byte_texts([d for d, _ in ranks]), ranks):
        pieces.append(_bytes_field(1, text.encode()) + _varint(2 << 3 | 5)
                      + struct.pack("<f", -float(rank)) + _int_field(3, NORMAL))
    trainer = _int_field(3, BPE_TYPE) + _int_field(4, len(pieces)) + _int_field(40, 0)
    # begin, end and padding pieces: none (-1)
    for number in (41, 42, 43):
        trainer += _int_field(number, (1 << 64) - 1)
    normalizer = _bytes_field(1, b"identity") + b"".join(_int_field(n, 0) for n in (3, 4, 5))
    return (b"".join(_bytes_field(PIECE, p) for p in pieces) + _bytes_field(TRAINER, trainer)
            + _bytes_field(NORMALIZER, normalizer))


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded cache of
    pre-tokens: their ids as text and the bytes these decode to."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.bytes_of = {r: data for data, r in ranks}
        self.piece_of = {data: i + 1 for i, (data, _) in enumerate(ranks)}
        self.piece_rank = [-1, *(r for _, r in ranks)]
        self.piece_text = [str(r) for r in self.piece_rank]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        """Empty the cache."""
        self.ids: dict[str, str] = {}
        self.data: dict[str, bytes] = {}
        self.older: tuple[dict[str, str], dict[str, bytes]] = ({}, {})

    def pieces(self, data: list[bytes]) -> list[list[int]]:
        """sentencepiece ids of pre-tokens: the entry itself if there is one."""
        whole = list(map(self.piece_of.get, data))
        rest = byte_texts([d for d, w in zip(data, whole) if w is None])
        merged = iter(self.model.encode(rest, num_threads=1) if rest else ())
        return [[w] if w is not None else next(merged) for w in whole]

    def encode(self, text: str) -> list[int]:
        rank, tokens = self.piece_rank, self.pattern.findall(text)
        return [rank[i] for ids in self.pieces([t.encode() for t in tokens]) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def learn(self, tokens: set[str]) -> None:
        """Have all of ``tokens`` in the cache, of which two generations stay."""
        if len(self.ids) > CACHED_PRETOKENS:
            self.older, self.ids, self.data = (self.ids, self.data), {}, {}
        new = tokens.difference(self.ids)
        for t in new.intersection(self.older[0]):
            self.ids[t], self.data[t] = self.older[0][t], self.older[1][t]
        new = list(new.difference(self.older[0]))
        text, bytes_of, rank = self.piece_text, self.bytes_of, self.piece_rank
        for t, ids in zip(new, self.pieces([t.encode() for t in new])):
            self.ids[t] = " ".join([text[i] for i in ids])
            self.data[t] = b"".join([bytes_of[rank[i]] for i in ids])

    def coded(self, texts: list[bytes]) -> Iterator[tuple[str, bytes]]:
        """Each text's ids, as text, and the bytes they decode to."""
        for a, b in chunks(texts):
            tokens = [self.pattern.findall(t.decode()) for t in texts[a:b]]
            self.learn(set().union(*tokens))
            for own in tokens:
                yield (" ".join(map(self.ids.__getitem__, own)),
                       b"".join(map(self.data.__getitem__, own)))

    def digest(self, texts: list[bytes]) -> list[tuple[int, str, str]]:
        """Token counts, hashes of the ids, hashes of what the ids decode to."""
        return [(ids.count(" ") + 1 if ids else 0, sha256(ids.encode()).hexdigest(),
                 sha256(data).hexdigest()) for ids, data in self.coded(texts)]


_codecs: dict[tuple[str, str], Codec] = {}


@contextmanager
def codec(path: str, pattern: str) -> Iterator[Codec]:
    """The worker's codec, for one task.  The model stays for the next one; the
    pre-tokens go, as the worker may run other stages from then on."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    held = _codecs[path, pattern]
    try:
        yield held
    finally:
        held.forget()


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Token ids (``ids`` array) of (``doc_id``, ``text``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path, pattern) as c:
            for batch in batches:
                ids = [np.fromstring(i, np.int32, sep=" ") for i, _ in c.coded(raw_texts(batch.column("text")))]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                                  "ids": pa.array(ids, pa.list_(pa.int32()))})

    return in_tasks(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Bytes (``data`` binary) of (``doc_id``, ``ids``)."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path, pattern) as c:
            for batch in batches:
                data = [c.decode(i or []) for i in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                                  "data": pa.array(data, pa.binary())})

    return in_tasks(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, data binary")


def digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode and decode every text; return counts and hashes of both."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path, pattern) as c:
            for batch in batches:
                rows = c.digest(raw_texts(batch.column("text")))
                n, ids, data = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(data, pa.string())})

    return in_tasks(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the public 50k byte vocabulary."""
    python_tasks(spark)
    return digests(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: ids of every document that is left, checked
    by decoding them to the text again."""
    python_tasks(spark)
    path = public_tokenizers.path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with codec(path, public_tokenizers.PATTERN) as c:
            for batch in batches:
                texts = raw_texts(batch.column("text"))
                made = list(c.coded(texts))
                ids = [np.fromstring(i, np.int32, sep=" ") for i, _ in made]
                whole = [data == t for (_, data), t in zip(made, texts)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids": pa.array(ids, pa.list_(pa.int32())), "round_trip": pa.array(whole)})

    return in_tasks(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, n_tokens long, ids array<int>, round_trip boolean")
