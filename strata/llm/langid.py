"""Language identification by a bidirectional GRU over bytes.

Every byte position gets a probability for each language from two gated
recurrent passes, one from either side; a document's probabilities are the mean
over its positions that can be letters (ASCII letters and bytes of non-ASCII
characters). The state runs on over words, spaces and punctuation: a text is read in
windows of WINDOW bytes that overlap, cut between characters, so that every position is
labelled once, with CONTEXT bytes or more before and after it (less only at the
ends of the text, where spaces follow). Windows of one length are read together.

The network is trained in numpy by backpropagation through time on a bounded
sample: at most ``sample_docs`` documents per language, the first by a hash of
the id; of each a piece of at most ``sample_chars`` characters; of these
``windows_per_lang`` windows of TRAIN bytes per language. All else covers whole texts.

Null texts and texts without a letter are ``und`` with score 0, as is
everything when there is nothing to learn from. Rows with a null id or language
are not learned from, and a null id counts as held out; of rows that share an id and a
language one is learned from, repeated rows like any. Ties go to the language
first in sorted order. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.columns import rows_to_struct, text_column
from strata.llm.store import broadcast_if_small, written

#: bytes of a window, bytes of context on either side of the positions it labels, bytes of a
#: window in training, unit of the lengths that are read together
WINDOW, CONTEXT, TRAIN, STEP = 284, 24, 64, 32
LETTER = tx.byte_class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
LANG = pa.struct([("lang", pa.string()), ("score", pa.float64())])


@dataclass
class BiGru:
    """``params``: per direction an input table e (256, 3h) and weights u (h, 3h); output w (2h, c), b (c)."""

    langs: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, seed: int) -> BiGru:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {}
        for d in "fb":
            p["e" + d] = normal(256, 3 * hidden, scale=0.3)
            p["u" + d] = normal(hidden, 3 * hidden, scale=hidden ** -0.5)
        p["w"] = normal(2 * hidden, len(langs), scale=(2 * hidden) ** -0.5)
        p["b"] = np.zeros(len(langs), np.float32)
        return cls(langs, p)

    def _pass(self, d: str, x: np.ndarray, keep: bool = False):
        """States (length, batch, h) of one direction over bytes x (length, batch)."""
        e, u = self.params["e" + d], self.params["u" + d]
        h = u.shape[0]
        state = np.zeros((x.shape[1], h), np.float32)
        out, trace = np.empty((*x.shape, h), np.float32), []
        for t in range(len(x)):
            a, g = e[x[t]], state @ u
            zr = a[:, :2 * h]
            zr += g[:, :2 * h]
            np.exp(np.negative(zr, out=zr), out=zr)  # the sigmoid, in place
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :h], zr[:, h:]
            n = r * g[:, 2 * h:]
            n += a[:, 2 * h:]
            np.tanh(n, out=n)
            if keep:
                trace.append((state, z, r, n, g[:, 2 * h:]))
            state = np.subtract(state, n, out=out[t])
            state *= z
            state += n
        return out, trace

    def _back(self, d: str, x: np.ndarray, trace: list, grad: np.ndarray, into: dict) -> None:
        """Backpropagation through time of one direction."""
        u = self.params["u" + d]
        h = u.shape[0]
        e_grad, u_grad = np.zeros_like(self.params["e" + d]), np.zeros_like(u)
        carry = np.zeros_like(grad[0])
        for t in reversed(range(len(x))):
            before, z, r, n, g = trace[t]
            s = grad[t] + carry
            dn = s * (1 - z) * (1 - n * n)
            dz = s * (before - n) * z * (1 - z)
            dr = dn * g * r * (1 - r)
            np.add.at(e_grad, x[t], np.concatenate([dz, dr, dn], 1))
            da = np.concatenate([dz, dr, dn * r], 1)
            u_grad += before.T @ da
            carry = s * z + da @ u.T
        into["e" + d], into["u" + d] = e_grad, u_grad

    def _states(self, d: str, x: np.ndarray) -> np.ndarray:
        """The states of ``_pass``, as (length, h, batch): gates lie side by side in memory."""
        e, u = np.ascontiguousarray(self.params["e" + d].T), np.ascontiguousarray(self.params["u" + d].T)
        h = u.shape[1]
        state = np.zeros((h, x.shape[1]), np.float32)
        out, g = np.empty((len(x), h, x.shape[1]), np.float32), np.empty((3 * h, x.shape[1]), np.float32)
        for t in range(len(x)):
            a = np.take(e, x[t], axis=1)
            np.matmul(u, state, out=g)
            zr, n = a[:2 * h], a[2 * h:]
            zr += g[:2 * h]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            r = g[2 * h:]
            r *= zr[h:]
            n += r
            np.tanh(n, out=n)
            state = np.subtract(state, n, out=out[t])
            state *= zr[:h]
            state += n
        return out

    def labels(self, x: np.ndarray) -> np.ndarray:
        """(length, languages, batch): probabilities of bytes x (length, batch)."""
        w = np.ascontiguousarray(self.params["w"].T)
        h = w.shape[1] // 2
        p = np.matmul(w[:, :h], self._states("f", x))
        p += np.matmul(w[:, h:], self._states("b", x[::-1])[::-1])
        p += self.params["b"][:, None]
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(length, batch, languages) of bytes x (length, batch)."""
        return self.labels(x).transpose(0, 2, 1)

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy over letter positions."""
        forward, tf = self._pass("f", x, keep=True)
        backward, tb = self._pass("b", x[::-1], keep=True)
        states = np.concatenate([forward, backward[::-1]], 2)
        p = _softmax(states @ self.params["w"] + self.params["b"])
        p[:, np.arange(x.shape[1]), y] -= 1
        p *= (LETTER[x] / max(1, int(LETTER[x].sum())))[:, :, None].astype(np.float32)
        h2 = states.shape[2]
        out = {"w": states.reshape(-1, h2).T @ p.reshape(-1, p.shape[2]), "b": p.sum((0, 1))}
        ds = p @ self.params["w"].T
        self._back("f", x, tf, ds[:, :, :h2 // 2], out)
        self._back("b", x[::-1], tb, ds[::-1, :, h2 // 2:], out)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def windows(data: np.ndarray, offsets: np.ndarray, width: int = WINDOW, context: int = CONTEXT
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows over the rows of UTF-8 bytes: (row, start, end, first and last + 1 position to label).

    The positions to label follow one another and cover each row. Edges stand between characters,
    so a window can be up to three bytes longer or shorter than ``width``.
    """
    size = np.diff(offsets)
    core = width - 2 * context
    n = np.where(size <= width, np.minimum(size, 1), -(-size // core))
    row = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    base, top = offsets[:-1][row], offsets[1:][row]
    short = size[row] <= width
    first = base + k * core
    last = np.where(short, top, np.minimum(first + core, top))
    start = np.where(short, base, np.clip(first - context, base, np.maximum(base, top - width)))
    end = np.minimum(start + width, top)
    inside = np.append((data & 0xC0) == 0x80, False)
    out = []
    for edge in (start, end, first, last):
        for _ in range(3):
            edge = edge + (inside[edge] & (edge < top) & (edge > base))
        out.append(edge)
    return row, *out


def _by_length(data: np.ndarray, a: np.ndarray, z: np.ndarray, batch: int):
    """Windows of one length at a time: (their indexes, bytes as (length, batch)). Spaces fill them up to
    a multiple of STEP bytes, so that there are few lengths."""
    n = -(-(z - a) // STEP) * STEP
    for size in np.unique(n).tolist():
        which = np.flatnonzero(n == size)
        for k in range(0, len(which), batch):
            part = which[k:k + batch]
            at = a[part][None, :] + np.arange(size)[:, None]
            yield part, np.where(at < z[part], data[np.minimum(at, len(data) - 1)], np.uint8(32))


def train(texts: list[str], langs: list[str], *, hidden: int = 8, windows_per_lang: int = 5000,
          epochs: int = 3, least_steps: int = 500, batch: int = 96, rate: float = 0.01, seed: int = 7) -> BiGru:
    """Fits the network on (text, language) pairs: up to ``windows_per_lang`` windows drawn per language,
    read ``epochs`` times, or more often where that makes fewer than ``least_steps`` steps."""
    names = sorted(set(langs))
    model, rng = BiGru.fresh(names, hidden, seed), np.random.default_rng(seed)
    data, a, z, y = [], [], [], []
    base = 0
    for k, name in enumerate(names):
        own = [t.encode() for t, x in zip(texts, langs) if x == name]
        flat = np.frombuffer(b"".join(own), np.uint8)
        _, s, e, _, _ = windows(flat, np.concatenate([[0], np.cumsum([len(t) for t in own])]), TRAIN, 0)
        pick = rng.permutation(len(s))[:windows_per_lang]
        data.append(tx.LOWER[flat])
        a.append(s[pick] + base)
        z.append(e[pick] + base)
        y.append(np.full(len(pick), k))
        base += len(flat)
    data, a, z, y = (np.concatenate(v) for v in (data, a, z, y))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.params.items()}
    order = rng.permutation(len(a))
    a, z, y = a[order], z[order], y[order]
    batches = list(_by_length(data, a, z, batch))
    step, epochs = 0, max(epochs, -(-least_steps // len(batches)))
    for epoch in range(epochs):
        for i in rng.permutation(len(batches)):
            which, x = batches[i]
            step += 1
            rate_now = rate * (1 - 0.9 * epoch / max(1, epochs - 1))
            for k, g in model.step(x, y[which]).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.params[k] -= (rate_now * (m / (1 - 0.9 ** step))
                                    / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def position_probabilities(model: BiGru, text: str) -> np.ndarray:
    """(bytes, languages): the probabilities of every byte of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros((len(data), len(model.langs)))
    _, a, z, first, last = windows(data, np.array([0, len(data)]))
    for which, x in _by_length(tx.LOWER[data], a, z, 1 << 10):
        p = model.probabilities(x)
        for j, w in enumerate(which.tolist()):
            out[first[w]:last[w]] = p[first[w] - a[w]:last[w] - a[w], j]
    return out


def position_labels(model: BiGru, text: str) -> list[str]:
    """The language of each byte of a text; white space is ``und``."""
    best = position_probabilities(model, text).argmax(1)
    space = ~tx.NOT_SPACE[np.frombuffer(text.encode(), np.uint8)]
    return ["und" if s else model.langs[k] for k, s in zip(best.tolist(), space.tolist())]


def language_column(spark: SparkSession, text: Column, model: BiGru | None) -> Column:
    """Struct (lang, score) of each text."""
    known = text.rlike(r"\p{L}")
    none = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return none
    shared = spark.sparkContext.broadcast(model)

    def make():
        net = shared.value

        def one(column: pa.Array) -> pa.Array:
            lang, score = [], []
            for _, _, data, offsets in tx.chunks(column):
                data = tx.LOWER[data]
                row, a, z, first, last = windows(data, offsets)
                total = np.zeros((len(offsets) - 1, len(net.langs) + 1))
                for which, x in _by_length(data, a, z, 1 << 9):
                    at = np.arange(len(x))[:, None]
                    letters = LETTER[x] & (at >= (first - a)[which]) & (at < (last - a)[which])
                    p = net.labels(x)
                    p *= letters[:, None, :]
                    np.add.at(total[:, :-1], row[which], p.sum(0).T)
                    np.add.at(total[:, -1], row[which], letters.sum(0))
                best = total[:, :-1].argmax(1)
                lang.extend(net.langs[k] for k in best.tolist())
                top = total[np.arange(len(best)), best] / np.maximum(total[:, -1], 1)
                score.append(np.clip(top, 0, 1))
            return rows_to_struct(LANG, {"lang": lang, "score": np.concatenate(score) if score else []})

        return one

    found = text_column(text, "struct<lang: string, score: double>", make)
    return F.when(F.coalesce(known, F.lit(False)), found).otherwise(none)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def fit(docs: DataFrame, *, sample_docs: int = 400, sample_chars: int = 4000,
        **options) -> BiGru | None:
    """The network for ``docs`` (doc_id, text, lang); None where nothing can be learned."""
    rank = F.xxhash64(F.col("doc_id"), F.lit(11))
    known = (docs.filter(~is_held_out(F.col("doc_id"))).filter("lang is not null")
             .filter(F.col("text").rlike(r"\p{L}")))
    # first the ids alone; then the texts of those few
    first = W.partitionBy("lang").orderBy("rank")
    top = (known.select("lang", rank.alias("rank")).distinct()
           .withColumn("k", F.row_number().over(first)).filter(F.col("k") <= sample_docs))
    start = F.lit(1) + F.pmod(F.col("rank"), F.greatest(F.lit(1), F.length("text") - sample_chars)).cast("int")
    texts = known.select("lang", rank.alias("rank"), "text", F.xxhash64("text").alias("h"))
    # of rows that share an id one text is learned from, the one with the least hash
    chosen = (texts.join(broadcast_if_small(written(top, "languages")), ["lang", "rank"])
              .groupBy("lang", "rank", "k").agg(F.min("h").alias("h")))
    rows = (texts.join(broadcast_if_small(written(chosen, "language-texts")), ["lang", "rank", "h"])
            .dropDuplicates(["lang", "rank"])
            .select("lang", "k", F.col("text").substr(start, F.lit(sample_chars)).alias("part"))
            .orderBy("lang", "k", "part").collect())
    return train([r.part for r in rows], [r.lang for r in rows], **options) if rows else None


def identify(docs: DataFrame, model: BiGru | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``."""
    found = docs.select("doc_id", language_column(docs.sparkSession, F.col("text"), model).alias("x"))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                        F.col("x.lang").alias("lang_pred"), F.col("x.score").alias("score"))
