"""Substring dedup by line hashing.

A unit is a line (text between newlines) of at least ``min_words`` words;
shorter lines are never touched. Units are normalised (A-Z lower-cased, white
space collapsed) and hashed to 128 bits where they are read. The digests are
grouped over all documents with map-side combine; the occurrence with the least
(id, offset) stays and every other is removed. Results carry the removed spans
as code point offsets of the original text. Only digests and offsets of units
are shuffled for the search, the text once for the rewrite; a digest with many
occurrences is one row of the grouped side, and Spark splits the other side.

With ``passages`` (the pipeline; the SQL twin of op2 has lines only) sentences and
paragraphs are units as well, whatever their wrapping: a sentence ends at a word
with a full stop, exclamation or question mark or at a blank line, a paragraph at
a blank line, so lines too short for a unit count as parts of these. Two letters
of a script without spaces count as a word. The same words are one unit where
they are line, sentence and paragraph at once. Removed spans may then overlap and
end inside a line.

Null text stays null and empty text empty. A row's occurrences are known by
(id, text): rows equal in both are one document and are cut alike. Null ids
rank last. Other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.rewrite import without_lines, without_spans

_ENDING, _CLOSING = tx.byte_class(b".!?"), tx.byte_class(b"\"')]")
_UNITS = "id long, h long, start long, end long, d1 long, d2 long"
#: bytes of text cut into units at once: the arrays of words and units take some 50 times that
_BYTES = 1 << 18


def _unspaced(data: np.ndarray) -> np.ndarray:
    """First bytes of letters of scripts without spaces: Thai, Lao, Myanmar, Khmer, kana and Han."""
    follow = np.append(data[1:], np.uint8(0)) if len(data) else data
    return (((data >= 0xE3) & (data <= 0xE9))
            | ((data == 0xE0) & (follow >= 0xB8) & (follow <= 0xBB))
            | ((data == 0xE1) & (((follow >= 0x80) & (follow <= 0x82)) | (follow == 0x9E) | (follow == 0x9F)))
            | ((data == 0xF0) & (follow >= 0xA0) & (follow <= 0xAF)))


def _full_stops(data: np.ndarray) -> np.ndarray:
    """Bytes after a full-width full stop, exclamation or question mark."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    a, b, c = data[:-2], data[1:-1], data[2:]
    return np.flatnonzero(((a == 0xE3) & (b == 0x80) & (c == 0x82))
                          | ((a == 0xEF) & (b == 0xBC) & ((c == 0x81) | (c == 0x9F)))) + 3


def _passages(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words (cut after full-width stops too) and the (first, last + 1) words of sentences and paragraphs."""
    stops = _full_stops(data)
    if len(stops):
        word = np.searchsorted(starts, stops) - 1
        cut = stops[(word >= 0) & (ends[word] > stops)]
        starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    if not len(starts):
        return starts, ends, []
    last = data[ends - 1]
    close = _CLOSING[last] & (ends - starts > 1)
    last = np.where(close, data[np.maximum(ends - 2, 0)], last)
    done = _ENDING[last] | np.isin(ends, stops)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    gap = np.ones(len(starts), bool)  # words after which a paragraph ends: a blank line or the row's end
    gap[:-1] = lines[starts[1:]] - lines[ends[:-1]] > 1
    edge = np.searchsorted(starts, offsets[1:])
    gap[edge[edge > 0] - 1] = True
    out = []
    for end in (gap | done, gap):
        z = np.flatnonzero(end) + 1
        out.append((np.append(0, z[:-1]), z))
    return starts, ends, out


def _units(min_words: int, passages: bool):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in _UNITS.split(", ")])

    def run(batches):
        power, _ = tx._powers()
        for b in batches:
            for lo, hi, data, offsets in tx.chunks(b.column(2), _BYTES):
                a, z = tx.spans(data != 10, offsets)
                starts, ends, hashes, _ = tx.words(data, offsets, tx.NOT_SPACE)
                more = []
                if passages:
                    n = len(starts)
                    starts, ends, more = _passages(data, offsets, starts, ends)
                    if len(starts) > n:
                        hashes = tx.span_hashes(tx.LOWER[data], starts, ends)
                first = np.searchsorted(starts, a)
                n = np.searchsorted(starts, z) - first
                for wa, wz in more:
                    first, n = np.append(first, wa), np.append(n, wz - wa)
                    a, z = np.append(a, starts[wa]), np.append(z, ends[wz - 1])
                if more:  # the same words are one unit, the first kind's
                    _, one = np.unique(first * (len(starts) + 1) + n, return_index=True)
                    a, z, first, n = a[one], z[one], first[one], n[one]
                    letters = np.concatenate([[0], np.cumsum(_unspaced(data))])
                    keep = n + (letters[z] - letters[a]) // 2 >= min_words
                    keep &= n > 0
                else:
                    keep = n >= min_words
                if not keep.any():
                    continue
                a, z, first, n = a[keep], z[keep], first[keep], n[keep]
                d = np.zeros((2, len(a)), np.uint64)
                for layer in _layers(n):
                    f, m = first[layer], n[layer]
                    j = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    at, scale = np.repeat(f, m) + j, power[j % tx.PIECE + 1]
                    for k in range(2):
                        h = hashes[at] if not k else tx.mix(hashes[at] ^ np.uint64(0x5851F42D4C957F2D))
                        d[k, layer] = tx.mix(np.add.reduceat(h * scale, np.cumsum(m) - m) + m.astype(np.uint64))
                lead = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
                row = np.searchsorted(offsets, a, "right") - 1
                base = lead[offsets[row]]
                at = pa.array(row + lo)
                yield tx.batch(schema, id=b.column(0).take(at), h=b.column(1).take(at),
                               start=lead[a] - base, end=lead[z] - base,
                               d1=d[0].view(np.int64), d2=d[1].view(np.int64))

    return run


def _layers(n: np.ndarray):
    """Runs of units of at most a chunk's words or so, or one unit: bounds the memory of overlapping units."""
    total = np.cumsum(n)
    cut = np.flatnonzero(np.diff(total // tx.PIECE)) + 1
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(n))):
        yield slice(int(lo), int(hi))


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = 8, passages: bool = False) -> DataFrame:
    """(id, h, spans): the spans to remove from each document that has any."""
    units = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"),
                         F.col(text_col).alias("text")).mapInArrow(_units(min_words, passages), _UNITS))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "start", "h")
    first = (units.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    extra = units.join(first, ["d1", "d2"]).filter(place != F.col("first"))
    return (extra.select("id", "h", F.struct("start", "end").alias("span")).distinct()
            .groupBy("id", "h").agg(F.sort_array(F.collect_list("span")).alias("spans")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = 8, passages: bool = False) -> tuple[DataFrame, Column, Column]:
    """``docs`` with the spans to remove joined on: (frame, removed spans or null, text without them)."""
    found = repeated_units(docs, id_col, text_col, min_words, passages)
    # renamed on this side only: any column of docs may have these names
    found = found.select(F.col("id").alias("__unit_id"), F.col("h").alias("__unit_h"),
                         F.col("spans").alias("__unit_spans"))
    frame = docs.join(found, docs[id_col].cast("long").eqNullSafe(found["__unit_id"])
                      & (F.xxhash64(docs[text_col]) == found["__unit_h"]), "left")
    cut = without_spans if passages else without_lines
    return frame, found["__unit_spans"], cut(docs[text_col], found["__unit_spans"])
