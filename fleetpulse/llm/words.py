"""Vectorised words, word hashes, shingles and minima over batches of texts.

Texts of an Arrow column are joined with a separator byte and handled as one
numpy array of UTF-8 bytes, in chunks of bounded size, so the cost per byte
is a few array operations and no Python work per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

# byte -> lower-cased byte (A-Z only)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# words as runs of bytes that are not white space
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, *range(9, 14)]] = False
# words as runs of digits, letters and bytes of non-ASCII characters
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 3))
        out = []
        for base in (MULTIPLIER, INVERSE):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _powers[:] = out
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes (a longer text stands alone)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """Words of a list of texts: hash per word, and each text's range of words."""

    def __init__(self, texts: list[bytes], member: np.ndarray):
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        flags = member[data].view(np.int8)
        step = np.diff(flags, prepend=np.int8(0))
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.bounds = np.searchsorted(self.starts, np.concatenate(([0], ends)))
        self.counts = np.diff(self.bounds)
        up, down = powers(len(data))
        total = np.empty(len(data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * down[self.starts]
        self.hashes = mix(h + (self.ends - self.starts).astype(np.uint64))

    def docs(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words, and each text's bounds in them.

        A text with 1 to ``k - 1`` words gives its whole sequence as one.
        """
        h, n = self.hashes, len(self.hashes)
        mults = powers(k + 1)[0][1 : k + 1]
        lengths = np.where(self.counts >= k, self.counts - k + 1, np.minimum(self.counts, 1))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        if not n:
            return h, bounds
        at = np.repeat(self.bounds[:-1] - bounds[:-1], lengths) + np.arange(bounds[-1])
        total = np.zeros(len(at), dtype=np.uint64)
        for j in range(k):
            total += h[np.minimum(at + j, n - 1)] * mults[j]
        for i in np.flatnonzero((self.counts > 0) & (self.counts < k)):
            own = h[self.bounds[i] : self.bounds[i + 1]]
            total[bounds[i]] = (own * mults[: len(own)]).sum(dtype=np.uint64)
        return mix(total), bounds


def multipliers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` permutations x -> a*x + b of 32-bit numbers."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint32))


def minima(x: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each permutation, the least value of each segment of 32-bit ``x``."""
    out = np.empty((len(a), len(starts)), dtype=np.uint32)
    held = np.empty_like(x)
    for k in range(len(a)):
        np.multiply(x, a[k], out=held)
        held += b[k]
        out[k] = np.minimum.reduceat(held, starts)
    return out


def longs(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's signed ones, bit for bit."""
    return x.view(np.int64)


def list_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
