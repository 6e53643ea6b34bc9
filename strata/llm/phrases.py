"""Document fingerprints by locally consistent parsing.

A text is a sequence of bytes. One level of parsing collapses runs of equal
names into one name, reduces each name to a label of 0 to 5 by deterministic
coin tossing (the lowest bit in which it differs from its left neighbour and
that bit's value, four times), and starts a phrase at every local maximum of the
labels. A phrase is named by a hash of what it holds, and the phrases' names
are the next level's sequence. Where a phrase starts depends on a few
neighbours only, so equal substrings have equal names inside, wherever they
stand.

The fingerprint is a min-wise sketch of the names of levels 2 and up, in
hexadecimal: equal texts have equal fingerprints, and the share of equal
components estimates the likeness of two texts. A text too short for level 2
has its whole as its only name; the empty text (and null) has a fingerprint of
its own, like itself only.

The edited text of a document has its last floor(n/2) code points replaced by
the first as many (or all) of the next document by (id, text), nulls last,
after the last the first. Documents are dealt by ranges of the id and each task
reads its range in order; only the first and the last document of each range
meet in a second, small step. Rows with equal ids follow each other by text.
Other columns are ignored. Memory follows the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.store import written

#: components of a fingerprint, 16 bits each (of minima of 32 bits)
SIZE = 64
_LEVELS = 24
_SCALE = ((tx.mix(np.arange(1, SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
           >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
#: powers for the names of phrases; without runs a phrase is at most 11 names long
_POWER = np.array([pow(0xD1342543DE82EF95, j + 1, 1 << 64) for j in range(64)], np.uint64)


def _run_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where runs of equal names start; ``first``: starts of rows that are not empty."""
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[first] = True
    return np.flatnonzero(new)


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing; neighbours that differ get labels that differ."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = names[first] ^ names.dtype.type(1)
    differ = names ^ left
    lowest = differ & (~differ + differ.dtype.type(1))
    place = np.bitwise_count(lowest - differ.dtype.type(1)).astype(np.uint8)
    bit = ((names & lowest) != 0).astype(np.uint8)
    return (place << 1) | bit


def _phrase_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Local maxima of the labels, and the start of every row."""
    label = names
    for _ in range(4):
        label = _toss(label, first)
    top = np.zeros(len(label), bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    top[first[1:] - 1] = False  # the last of a row has no right neighbour
    top[first] = True
    return np.flatnonzero(top)


def names_by_level(data: np.ndarray, offsets: np.ndarray):
    """For level 1, 2, ...: (rows that have names, start of each in names, names)."""
    rows = np.flatnonzero(np.diff(offsets))
    if not len(rows):
        return
    first = offsets[rows]
    runs = _run_starts(data, first)
    length = np.diff(np.append(runs, len(data)))
    kind = data[runs].astype(np.uint16) | (np.minimum(length - 1, 255).astype(np.uint16) << np.uint16(8))
    at = np.searchsorted(runs, first)
    starts = _phrase_starts(kind, at)
    spots = runs[starts]
    names = tx.span_hashes(data, spots, np.append(spots[1:], len(data)))
    first = np.searchsorted(starts, at)
    for _ in range(_LEVELS):
        yield rows, first, names
        if len(names) == len(rows):
            return
        runs = _run_starts(names, first)
        length = np.diff(np.append(runs, len(names))).astype(np.uint64)
        one = length == 1
        names = np.where(one, names[runs], tx.mix(names[runs] + length * np.uint64(0x9E3779B97F4A7C15)))
        first = np.searchsorted(runs, first)
        starts = _phrase_starts(names, first)
        ends = np.append(starts[1:], len(names))
        inside = np.arange(len(names)) - np.repeat(starts, ends - starts)
        names = tx.mix(np.add.reduceat(names * _POWER[inside & 63], starts))
        first = np.searchsorted(starts, first)


def sketches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, SIZE) 16-bit sketch of each row; all ones for an empty one."""
    n = len(offsets) - 1
    out = np.full((n, SIZE), 0xFFFFFFFF, np.uint32)
    done = np.zeros(n, bool)
    lone = None
    for level, (rows, first, names) in enumerate(names_by_level(data, offsets), 1):
        if level == 1:
            lone = rows
            continue
        count = np.diff(np.append(first, len(names)))
        fresh = (count > 1) | ~done[rows]  # a row with one name has told it already
        done[rows] = True
        if not fresh.any():
            continue
        keep = np.repeat(fresh, count)
        part, at = (names[keep] >> np.uint64(32)).astype(np.uint32), np.concatenate([[0], np.cumsum(count[fresh])[:-1]])
        target = rows[fresh]
        for k in range(SIZE):
            least = np.minimum.reduceat(part * _SCALE[k], at)
            out[target, k] = np.minimum(out[target, k], least)
    if lone is not None:
        rest = lone[~done[lone]]
        if len(rest):
            whole = tx.span_hashes(data, offsets[rest], offsets[rest + 1])
            out[rest] = (whole >> np.uint64(32)).astype(np.uint32)[:, None] * _SCALE[None, :]
    folded = (out ^ (out >> np.uint32(16))).astype(np.uint16)  # minima are small: all bits count
    folded[np.diff(offsets) == 0] = 0xFFFF
    return folded


def sketch_texts(texts: list[str], chunk: int = 1 << 20) -> np.ndarray:
    """Sketches of texts, about ``chunk`` bytes at a time."""
    coded = [t.encode() for t in texts]
    out, lo = [np.zeros((0, SIZE), np.uint16)], 0
    while lo < len(coded):
        hi, size = lo, 0
        while hi < len(coded) and (hi == lo or size + len(coded[hi]) <= chunk):
            size += len(coded[hi])
            hi += 1
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded[lo:hi]])]).astype(np.int64)
        out.append(sketches(np.frombuffer(b"".join(coded[lo:hi]), np.uint8), offsets))
        lo = hi
    return np.concatenate(out)


def packed(sketch: np.ndarray) -> bytes:
    return sketch.astype(">u2").tobytes()


def fingerprint(sketch: np.ndarray) -> str:
    return packed(sketch).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal components; an empty text is like an empty one only."""
    none_a, none_b = (a == 0xFFFF).all(-1), (b == 0xFFFF).all(-1)
    return np.where(none_a | none_b, (none_a & none_b).astype(np.float64), (a == b).mean(-1))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


#: hashes as bytes until the end: half the size on disk
_RESULT = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double")
_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()),
           ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
           ("near_edited", pa.float64()), ("near_next", pa.float64())]
#: rows with a part are the first or last document of a range
_EDGE = _RESULT + ", part int, last boolean, text string"
_EDGE_SCHEMA = pa.schema([*_FIELDS, ("part", pa.int32()), ("last", pa.bool_()), ("text", pa.string())])


def compare(ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> dict:
    """Result columns of documents with the document after each and both sketches."""
    edits = [edited(t, f) for t, f in zip(texts, following)]
    changed = sketch_texts(edits)
    return {"doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode()).digest() for t in edits],
            "fingerprint": [packed(s) for s in own],
            "edited_fingerprint": [packed(s) for s in changed],
            "near_edited": likeness(own, changed), "near_next": likeness(own, after)}


def _in_order(batches):
    """Rows in order: all but the last of this range are compared with the next."""
    part = TaskContext.get().partitionId()
    held = None  # (id, text, sketch) of the last row so far
    blank = {f.name: None for f in _EDGE_SCHEMA}

    def edge(row, last):
        return tx.batch(_EDGE_SCHEMA, **{k: [v] for k, v in (
            blank | {"doc_id": row[0], "text": row[1], "part": part, "last": last}).items()})

    for b in batches:
        ids, column = b.column(0).to_pylist(), b.column(1)
        for lo, hi, data, offsets in tx.chunks(column):
            texts = [t.as_py() or "" for t in column.slice(lo, hi - lo)]
            own = sketch_texts(texts)
            if held is None:
                yield edge((ids[lo], texts[0]), False)
                i, t, s = [], [], own[:0]
            else:
                i, t, s = [held[0]], [held[1]], held[2][None]
            i, t, s = i + ids[lo:hi], t + texts, np.concatenate([s, own])
            held = (i[-1], t[-1], s[-1])
            if len(i) > 1:
                none = [None] * (len(i) - 1)
                yield tx.batch(_EDGE_SCHEMA, **compare(i[:-1], t[:-1], t[1:], s[:-1], s[1:]),
                               part=none, last=none, text=none)
    if held is not None:
        yield edge(held[:2], True)


def _pairs(batches):
    schema = pa.schema(_FIELDS)
    for b in batches:
        ids, texts, following = (b.column(i).to_pylist() for i in range(3))
        yield tx.batch(schema, **compare(ids, texts, following, sketch_texts(texts), sketch_texts(following)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.col("text").asc_nulls_last()]
    found = written(rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
                    .mapInArrow(_in_order, _EDGE), "phrases")
    done = found.filter("part is null").drop("part", "last", "text")
    ends = found.filter("part is not null")
    parts = ends.filter("last").select("part")  # one number per range
    whole = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follow = parts.select("part", F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(whole)).alias("next"))
    firsts = ends.filter(~F.col("last")).select(F.col("part").alias("next"), F.col("text").alias("after"))
    edges = (ends.filter("last").select("part", F.col("doc_id").alias("id"), "text").join(follow, "part")
             .join(firsts, "next").select("id", "text", "after"))
    hashes = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return (done.unionByName(edges.mapInArrow(_pairs, _RESULT))
            .withColumns({c: F.lower(F.hex(c)) for c in hashes}))
