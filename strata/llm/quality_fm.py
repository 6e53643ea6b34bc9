"""Quality classifier: a factorisation machine over hashed words and text statistics.

The features of a text are its words (lower-cased runs of digits, a-z and
non-ASCII characters) hashed to ``WORDS`` slots with length-normalised log
counts, and STATS: structure statistics and the length. The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

where the pair sum is half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 per factor,
so a text is scored in time linear in its features.

It is trained on a bounded sample: per label at most ``sample_docs`` labelled
documents, the first by a hash of the id; only their features reach the driver.
All else covers whole texts. Labels, language, source and id are never inputs.

Null and empty texts have no words and statistics of zero, and get the score
that follows. Without labels every score is 0.5. Rows of several labels count
with each, rows that share an id (repeated ones too) with one text; null labels are ignored; a null id counts as held out. Other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.columns import rows_to_struct, text_column
from strata.llm.store import written
from strata.llm.langid import is_held_out

WORDS = 1 << 14
STATS = ["length", "words", "word_length", "distinct_words", "upper", "digits", "symbols", "newlines",
         "non_ascii", "repeated_lines", "symbol_ends", "single_symbols"]

_UPPER = tx.byte_class(bytes(range(65, 91)))
_DIGIT = tx.byte_class(b"0123456789")
_SYMBOL = tx.NOT_SPACE & ~tx.ALNUM & ~_UPPER
_PLAIN_END = tx.byte_class(b".,;:?\"')")
_FEATURES = pa.struct([("index", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=run[1:])
    return np.diff(run[offsets]).astype(np.float64)


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of every feature that is not 0, ordered by row and slot."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    starts, ends, hashes, first = tx.words(data, offsets, tx.ALNUM)
    row = np.repeat(np.arange(n), np.diff(first))
    keys, counts = np.unique(row * WORDS + (hashes >> np.uint64(50)).astype(np.int64), return_counts=True)
    rows, slots = keys // WORDS, keys % WORDS
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(rows, value * value, n))
    value = value / norm[rows]

    tokens, token_ends = tx.spans(tx.NOT_SPACE[data], offsets)
    token_row = np.searchsorted(offsets, tokens, "right") - 1
    n_tokens = np.bincount(token_row, minlength=n).astype(np.float64)
    last = data[token_ends - 1] if len(tokens) else data[:0]
    odd_end = _SYMBOL[last] & ~_PLAIN_END[last]
    lines, line_ends = tx.spans(data != 10, offsets)
    line_row = np.searchsorted(offsets, lines, "right") - 1
    n_lines = np.bincount(line_row, minlength=n).astype(np.float64)
    pairs = np.unique(np.stack([line_row.astype(np.uint64), tx.span_hashes(data, lines, line_ends)], 1), axis=0)
    distinct_lines = np.bincount(pairs[:, 0].astype(np.int64), minlength=n)
    n_words = np.diff(first).astype(np.float64)
    stats = np.stack([
        np.log1p(size) / 10, np.log1p(n_words) / 10,
        _share(np.bincount(row, ends - starts, n), n_words) / 10,
        _share(np.bincount(rows, minlength=n), n_words),
        3 * _share(_per_row(_UPPER[data], offsets), size), _share(_per_row(_DIGIT[data], offsets), size),
        5 * _share(_per_row(_SYMBOL[data], offsets), size), 10 * _share(_per_row(data == 10, offsets), size),
        _share(_per_row(data >= 128, offsets), size), _share(n_lines - distinct_lines, n_lines),
        2 * _share(np.bincount(token_row, odd_end, n), n_tokens),
        3 * _share(np.bincount(token_row, odd_end & (token_ends - tokens == 1), n), n_tokens)], 1)
    r, s = np.nonzero(stats)
    rows, slots = np.concatenate([rows, r]), np.concatenate([slots, s + WORDS])
    order = np.lexsort((slots, rows))
    return rows[order], slots[order], np.concatenate([value, stats[r, s]])[order]


@dataclass
class Machine:
    """w0, weights w (slots) and factors v (slots, k)."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def margins(self, rows: np.ndarray, slots: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        out = self.w0 + np.bincount(rows, self.w[slots] * values, n)
        for f in range(self.v.shape[1]):
            part = self.v[slots, f] * values
            total = np.bincount(rows, part, n)
            out += 0.5 * (total * total - np.bincount(rows, part * part, n))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(rows: np.ndarray, slots: np.ndarray, values: np.ndarray, labels: np.ndarray, *, factors: int = 4,
          epochs: int = 15, batch: int = 64, rate: float = 0.05, decay: float = 1e-5, seed: int = 5) -> Machine:
    """Minimises the logistic loss by AdaGrad over batches of documents."""
    rng = np.random.default_rng(seed)
    dim, n = WORDS + len(STATS), len(labels)
    m = Machine(0.0, np.zeros(dim), rng.standard_normal((dim, factors)) * 0.01)
    cut = np.searchsorted(rows, np.arange(n + 1))
    g0, gw, gv = 1e-8, np.full(dim, 1e-8), np.full((dim, factors), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            docs = order[k:k + batch]
            at = np.concatenate([np.arange(cut[d], cut[d + 1]) for d in docs])
            if not len(at):
                continue
            local = np.repeat(np.arange(len(docs)), cut[docs + 1] - cut[docs])
            s, x = slots[at], values[at]
            error = (sigmoid(m.margins(local, s, x, len(docs))) - labels[docs]) / len(docs)
            used, back = np.unique(s, return_inverse=True)
            e = error[local] * x
            dw = np.bincount(back, e) + decay * m.w[used]
            gw[used] += dw * dw
            for f in range(factors):
                v = m.v[s, f]
                total = np.bincount(local, v * x, len(docs))
                dv = np.bincount(back, e * (total[local] - v * x)) + decay * m.v[used, f]
                gv[used, f] += dv * dv
                m.v[used, f] -= rate * dv / np.sqrt(gv[used, f])
            m.w[used] -= rate * dw / np.sqrt(gw[used])
            d0 = error.sum()
            g0 += d0 * d0
            m.w0 -= rate * d0 / np.sqrt(g0)
    return m


def features_column(text: Column) -> Column:
    """Struct (index, value) of each text's features."""

    def make():
        def one(column: pa.Array) -> pa.Array:
            index, value, sizes = [], [], []
            for _, _, data, offsets in tx.chunks(column):
                rows, slots, values = features(data, offsets)
                index.append(slots.astype(np.int32))
                value.append(values.astype(np.float32))
                sizes.append(np.bincount(rows, minlength=len(offsets) - 1))
            cut = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32) if sizes else np.zeros(1, np.int32)
            flat = [np.concatenate(v) if v else np.zeros(0, t)
                    for v, t in ((index, np.int32), (value, np.float32))]
            return rows_to_struct(_FEATURES, {
                "index": pa.ListArray.from_arrays(pa.array(cut), pa.array(flat[0])),
                "value": pa.ListArray.from_arrays(pa.array(cut), pa.array(flat[1]))})

        return one

    return text_column(text, "struct<index: array<int>, value: array<float>>", make)


def score_column(spark: SparkSession, text: Column, machine: Machine | None) -> Column:
    """Probability of label 1 of each text."""
    if machine is None:
        return F.lit(0.5)
    shared = spark.sparkContext.broadcast(machine)

    def make():
        def one(column: pa.Array) -> pa.Array:
            out = [sigmoid(shared.value.margins(*features(data, offsets), len(offsets) - 1))
                   for _, _, data, offsets in tx.chunks(column)]
            return pa.array(np.concatenate(out) if out else [], pa.float64())

        return one

    return text_column(text, "double", make)


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample_docs: int = 2500,
        **options) -> Machine | None:
    """The machine for ``labels`` (doc_id, label) of ``docs``; None without both labels."""
    known = (labels.filter(~is_held_out(F.col("doc_id"))).filter(F.col(label).isin(0, 1))
             .select(F.col("doc_id").alias("id"), F.col(label).alias("y"), F.xxhash64("doc_id", F.lit(3)).alias("rank")))
    some = [known.filter(F.col("y") == y).orderBy("rank").limit(sample_docs) for y in (0, 1)]
    picked = F.broadcast(some[0].unionByName(some[1]).distinct())  # 2 * sample_docs rows at most
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"), F.xxhash64("text").alias("h"))
    # of rows that share an id one text is learned from, the one with the least hash
    chosen = written(texts.join(picked, "id").groupBy("id", "rank", "y").agg(F.min("h").alias("h")), "quality-sample")
    rows = (texts.join(F.broadcast(chosen), ["id", "h"]).dropDuplicates(["id", "y"])
            .select("rank", "y", features_column(F.col("text")).alias("f")).collect())
    rows.sort(key=lambda r: (r["rank"], r.y, len(r.f["index"])))
    y = np.array([r.y for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    which = np.repeat(np.arange(len(rows)), [len(r.f["index"]) for r in rows])
    return train(which, np.array([i for r in rows for i in r.f["index"]]),
                 np.array([v for r in rows for v in r.f["value"]]), y, **options)


def score_quality(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    found = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                        score_column(docs.sparkSession, F.col("text"), machine).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
