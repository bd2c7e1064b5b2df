"""Vectors in Spark tables and Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    return F.coalesce(
        F.col(vector).isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows; shorter ones end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def first_of_each(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's first ``k`` by score, highest first, ties to the
    smaller id; an id counts once in its group, by its best score."""
    order = np.lexsort((-score, ids, group))
    own = np.ones(len(order), dtype=bool)
    own[1:] = (group[order][1:] != group[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[own]
    order = order[np.lexsort((ids[order], -score[order], group[order]))]
    g = group[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = g[1:] != g[:-1]
    start = np.flatnonzero(new)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    return order[rank < k]
