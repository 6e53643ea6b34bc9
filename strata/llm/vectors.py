"""Vectors in one array column: which are usable, and as numpy matrices inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds no null, NaN or infinite component."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))

    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def dimension(vectors: DataFrame, column: str) -> int:
    """The greatest length of the vectors in ``column``; 0 if there are none."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 0


def matrix(lists: pa.Array, d: int, kind=np.float64) -> np.ndarray:
    """One row of ``d`` numbers per list; shorter lists end in zeros. No list or item is null."""
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    if (n == d).all():
        return flat.reshape(len(n), d)
    out = np.zeros((len(n), d), kind)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """The rows of ``x`` divided by their Euclidean norms (no row is zero)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def runs(batches: Iterator[pa.RecordBatch], n_keys: int, load: Callable[[pa.RecordBatch], tuple],
         least: int = 2) -> Iterator[tuple]:
    """The runs of at least ``least`` rows equal in the first ``n_keys`` columns, of sorted batches.

    ``load`` turns a batch into arrays of its length; each run gives their slices. Only the
    batch at hand and the run it ends in are held.
    """
    held = None
    for batch in _closed(batches):
        if batch is not None:
            if held is not None and held.num_rows:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
        else:
            batch = held
            if batch is None or not batch.num_rows:
                return
        keys = [batch.column(i).to_numpy() for i in range(n_keys)]
        edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        starts, ends = np.append(0, edge), np.append(edge, batch.num_rows)
        if batch is not held:
            held = batch.slice(starts[-1])
            starts, ends = starts[:-1], ends[:-1]
        long = ends - starts >= least
        if long.any():
            arrays = load(batch)
            for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
                yield tuple(a[s:e] for a in arrays)


def _closed(batches):
    yield from batches
    yield None
