"""Hard negatives by exact integer inner products of anchor and candidate tiles.

Components are scaled and rounded down to integers. Anchors and candidates are dealt
over blocks by a hash of their ids, and each pair of blocks is one group on Spark:
its anchors are held, its candidates streamed past them, and a tile of scores is
one matrix product by Strassen's recursion (seven products of half the size, the
tile padded with zeros to even halves). Everything is 64-bit integer arithmetic, which
is exact modulo 2^64 throughout, so a score is right whenever it fits in 64 bits itself;
tiles in which it might not are refused.

Two rounds over the blocks:

1. within each label, a heap of the best ``n_positives`` rows per anchor;
2. among other labels, a heap of the best ``n_negatives`` rows per anchor and positive
   whose score lies in the positive's window.

A heap holds (score, id) with the highest score first, then the least id. Heaps of
blocks merge by taking the best of both, here by a window over the few rows left of
each. The work is anchors times rows by nature; a block pair's memory is fixed, and
each row is sent once per block of the other side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.store import written
from strata.llm.vectors import matrix, usable

#: tiles with a side of at most this are multiplied directly
LEAF = 256
#: candidates and anchors in one tile of scores
TILE = (1024, 2048)


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices (rows of numbers on both sides) by Strassen's recursion."""
    (m, k), n = a.shape, len(b)
    if min(m, n) <= leaf or k < 16:
        return a @ b.T
    if m % 2 or n % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, n % 2), (0, k % 2)))
        return product(a, b, leaf)[:m, :n]
    r, s, t = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b21, b12, b22 = b[:t, :s], b[:t, s:], b[t:, :s], b[t:, s:]  # quarters of b.T, by rows
    m1 = product(a11 + a22, b11 + b22, leaf)
    m2 = product(a21 + a22, b11, leaf)
    m3 = product(a11, b12 - b22, leaf)
    m4 = product(a22, b21 - b11, leaf)
    m5 = product(a11 + a12, b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:r, t:] = m3 + m5
    out[r:, :t] = m2 + m4
    out[:r, :t] = m1 + m4 - m5 + product(a12 - a22, b21 + b22, leaf)
    out[r:, t:] = m1 - m2 + m3 + product(a21 - a11, b11 + b12, leaf)
    return out


def integers(lists: pa.Array, d: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component as int64; refuses numbers beyond 2^53."""
    x = np.floor(matrix(lists, d) * scale)
    if x.size and np.abs(x).max() > 2.0**53:
        raise ValueError("a scaled component is beyond 2^53")
    return x.astype(np.int64)


def _scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    peak = [int(np.abs(x).max(initial=0)) for x in (a, c)]
    if peak[0] * peak[1] * a.shape[1] >= 2**56:  # windows multiply scores by up to 100
        raise ValueError("inner products may exceed the range of exact scores")
    return product(a, c)


class Heaps:
    """The best ``size`` (score, id) of each of ``n`` rows: higher scores first, then lesser ids."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.row = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.full = np.zeros(n, bool)
        self.worst = np.zeros(n, np.int64)
        self.worst_id = np.zeros(n, np.int64)

    def offer(self, score: np.ndarray, ids: np.ndarray, able: np.ndarray, rows: np.ndarray) -> None:
        """``score`` and ``able`` by heap (numbered ``rows``) and candidate (named ``ids``)."""
        full, worst = self.full[rows, None], self.worst[rows, None]
        able = able & (~full | (score > worst) | ((score == worst) & (ids < self.worst_id[rows, None])))
        if score.shape[1] > 4 * self.size and (loose := ~self.full[rows] & (able.sum(axis=1) > self.size)).any():
            low = np.where(able[loose], score[loose], np.iinfo(np.int64).min)
            able[loose] &= score[loose] >= np.partition(low, -self.size, axis=1)[:, -self.size, None]
        r, c = np.nonzero(able)
        if len(r):
            self.merge(rows[r], score[r, c], ids[c])

    def merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = np.append(self.row, row), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score, row))
        row = row[order]
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        rank = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
        order, row, rank = order[rank < self.size], row[rank < self.size], rank[rank < self.size]
        self.row, self.score, self.id = row, score[order], ids[order]
        last = rank == self.size - 1
        self.full[row[last]] = True
        self.worst[row[last]], self.worst_id[row[last]] = self.score[last], self.id[last]


class _Anchors:
    """The anchors of a block pair in label order, and their heaps."""

    def __init__(self, parts: list[pa.RecordBatch], d: int, scale: int, size: int):
        held = pa.Table.from_batches(parts).sort_by("label").combine_chunks()
        self.key, self.id, self.label = (held.column(c).to_numpy() for c in ("key", "id", "label"))
        self.x = integers(held.column("vector").combine_chunks(), d, scale)
        scores = held.column("scores").to_pylist()
        self.places = max(map(len, scores), default=0)
        self.n_scores = np.array([len(x) for x in scores])
        self.scores = np.array([x + [0] * (self.places - len(x)) for x in scores], np.int64).reshape(len(scores), -1)
        self.heaps = Heaps(len(self.key) * max(self.places, 1), size)


def _positives(held: _Anchors, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
    for label in np.unique(labels):
        lo, hi = np.searchsorted(held.label, [label, label + 1])
        mine = labels == label
        for s in range(lo, hi, TILE[1]):
            rows = np.arange(s, min(s + TILE[1], hi))
            held.heaps.offer(_scores(held.x[rows], x[mine]), ids[mine], ids[mine] != held.id[rows, None], rows)


def _negatives(low: int, high: int) -> Callable:
    def work(held: _Anchors, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        for s in range(0, len(held.key), TILE[1]):
            rows = np.arange(s, min(s + TILE[1], len(held.key)))
            score = _scores(held.x[rows], x)
            other = labels != held.label[rows, None]
            for place in range(held.places):
                has = held.n_scores[rows] > place
                base = held.scores[rows[has], place, None]
                seen = score[has]
                able = other[has] & (seen >= -(-low * base // 100)) & (seen <= high * base // 100)
                held.heaps.offer(seen, ids, able, rows[has] * held.places + place)
    return work


def _mine(d: int, scale: int, size: int, work: Callable) -> Callable:
    """Batches sorted by (pair, side, id), a pair's anchors first, to the heaps of each pair."""

    def ended(held: _Anchors | None) -> Iterator[pa.RecordBatch]:
        if held is not None and len(held.heaps.row):
            h, places = held.heaps, max(held.places, 1)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(held.key[h.row // places]), "place": pa.array((h.row % places).astype(np.int32)),
                "id": pa.array(h.id), "score": pa.array(h.score)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, [], None
        for b in batches:
            pair, side = b.column("pair").to_numpy(), b.column("side").to_numpy()
            edge = np.flatnonzero((pair[1:] != pair[:-1]) | (side[1:] != side[:-1])) + 1
            for s, e in zip(np.append(0, edge), np.append(edge, len(pair)), strict=True):
                if s == e:
                    continue
                if pair[s] != at:
                    yield from ended(held)
                    at, parts, held = pair[s], [], None
                if side[s] == 0:
                    parts.append(b.slice(s, e - s))
                    continue
                if held is None and parts:
                    held = _Anchors(parts, d, scale, size)
                    parts = []
                for o in range(s, e if held is not None else s, TILE[0]):
                    c = b.slice(o, min(TILE[0], e - o))
                    work(held, c.column("id").to_numpy(), c.column("label").to_numpy(),
                         integers(c.column("vector"), d, scale))
        yield from ended(held)

    return run


def _best(heaps: DataFrame, size: int) -> DataFrame:
    """Heaps of the block pairs merged: rank from 1 by anchor (key) and place."""
    order = Window.partitionBy("key", "place").orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def hard_negatives(vectors: DataFrame, anchors: Column | None = None, n_positives: int = 5, n_negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label", anchor_block: int = 16_384,
                   candidate_block: int = 16_384) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` selects the anchor rows (by default ids divisible by 50). The score of two rows
    is the inner product of floor(scale * x). An anchor's positives are its first ``n_positives``
    rows of the same label and another id; the negatives of a positive are the first
    ``n_negatives`` rows of another label with low * positive_score <= 100 * negative_score <=
    high * positive_score. First: higher scores, then lesser ids; fewer where there are fewer.

    Rows with a null id, label or vector, or any null, NaN or infinite component take no part.
    Shorter vectors count as ending in zeros. Every row stands for itself: a repeated row is
    listed as often as it is there, and each copy of an anchor is mined. Scores that might not
    be exact in 64 bits raise an error. Other columns are ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col)))
    chosen = F.col(id_col) % 50 == 0 if anchors is None else anchors
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).alias("vector"), chosen.alias("chosen"))
    asked = written(rows.filter("chosen").select(F.monotonically_increasing_id().alias("key"), "id", "label", "vector"),
                    "anchors")
    n, n_asked, d = rows.agg(F.count(F.lit(1)), F.count_if("chosen"), F.max(F.size("vector"))).first()
    n_a = max(1, math.ceil(n_asked / anchor_block))
    n_c = max(1, math.ceil(n / candidate_block), min(2 * spark.sparkContext.defaultParallelism, n // TILE[0]))

    def mined(asked: DataFrame, size: int, work: Callable, name: str) -> DataFrame:
        """Every anchor block against every candidate block, the heaps of all."""
        columns = ("key", "id", "label", "vector", "scores")
        a = asked.select(F.pmod(F.xxhash64("key"), F.lit(n_a)).alias("a"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("c"), F.lit(0).alias("side"), *columns)
        c = rows.select(F.explode(F.sequence(F.lit(0), F.lit(n_a - 1))).alias("a"),
                        F.pmod(F.xxhash64("id"), F.lit(n_c)).alias("c"), F.lit(1).alias("side"),
                        F.lit(None).cast("long").alias("key"), "id", "label", "vector",
                        F.lit(None).cast("array<long>").alias("scores"))
        both = a.unionByName(c).withColumn("pair", F.col("a") * n_c + F.col("c")).drop("a", "c")
        dealt = both.repartition(min(n_a * n_c, 20_000), "pair").sortWithinPartitions("pair", "side", "id")
        heaps = dealt.mapInArrow(_mine(d or 0, scale, size, work), "key long, place int, id long, score long")
        return written(_best(heaps, size), name)

    none = F.array().cast("array<long>").alias("scores")
    positives = mined(asked.select("*", none), n_positives, _positives, "positives")
    scores = positives.groupBy("key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    negatives = mined(asked.join(scores, "key"), n_negatives, _negatives(low, high), "negatives")
    return (positives.select("key", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
            .join(negatives, ["key", "place"])
            .join(asked.select("key", F.col("id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
