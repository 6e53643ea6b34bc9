"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts and documents are normalised alike: A-Z lower-cased, words are
runs of digits, a-z and non-ASCII characters, joined by single spaces. Every
window of ``window`` consecutive item words is a pattern (a shorter item is one
pattern as a whole). The automaton reads each document once; a hit at a
normalised position leads to its words and through their byte offsets to the
original text, so results carry offsets (code points) of the original.

The benchmark goes to the driver in runs of at most ``automaton_bytes`` (32 MB) of
patterns, which are broadcast; each run is an automaton of its own and a further scan
of the text at hand. A task builds an automaton once and keeps the last HELD. So up to
HELD runs (128 MB of patterns, some millions of items) every automaton is built once per
task; beyond that memory stays bounded by HELD automata, results are the same, and each
chunk of text builds them anew. Nothing is kept when a task ends.

Null, empty and wordless texts have no words and no hits; items without words
match nothing; an item without an id counts under the empty name. Repeated
items and rows are each counted as they are. Other columns of either table are
ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.columns import rows_to_struct, text_column

LEAKS = ("struct<n_words: bigint, items: array<string>, "
         "spans: array<struct<start: bigint, end: bigint, first_word: bigint, last_word: bigint>>>")
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()),
                   ("first_word", pa.int64()), ("last_word", pa.int64())])
_LEAKS = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(_SPAN))])


def normalise(data: np.ndarray, offsets: np.ndarray):
    """Text ` w1 w2 ... wn ` of every row, rows ended by a newline; and where each word is.

    Returns (text, position of each word in it, first word of each row, word starts, word ends).
    """
    low = tx.LOWER[data]
    inside = tx.ALNUM[low]
    starts, ends = tx.spans(inside, offsets)
    first = np.searchsorted(starts, offsets)
    run = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts + 1, out=run[1:])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    at = run[:-1] + 2 * row + 1
    stop = run[first[1:]] + 2 * np.arange(len(offsets) - 1)
    out = np.full(int(run[-1]) + 2 * (len(offsets) - 1), 32, np.uint8)
    hold = np.ones(len(out), bool)
    hold[at - 1] = hold[stop] = hold[stop + 1] = False
    out[hold] = low[inside]
    out[stop + 1] = 10
    return out.tobytes().decode("latin-1"), at, first, starts, ends


def item_windows(text: str | None, window: int) -> list[str]:
    """Patterns of one benchmark item."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    flat, *_ = normalise(data, np.array([0, len(data)]))
    w = flat.split(" ")[1:-1]
    return [f" {' '.join(w[i:i + window])} " for i in range(max(1, len(w) - window + 1))] if w else []


def _patterns(items: DataFrame, id_col: str, text_col: str, window: int,
              limit: int) -> Iterator[dict[str, tuple[int, set[str]]]]:
    """Runs of patterns of bounded size: pattern -> (words, item ids)."""
    found: dict[str, tuple[int, set[str]]] = {}
    size = 0
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    for r in rows.toLocalIterator():
        for p in item_windows(r.text, window):
            if p not in found:
                found[p] = (p.count(" ") - 1, set())
                size += len(p)
            found[p][1].add(r.item or "")
            if size > limit:
                yield found
                found, size = {}, 0
    if found:
        yield found


def _automaton(patterns: dict[str, tuple[int, set[str]]]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for p, value in patterns.items():
        machine.add_word(p, value)
    machine.make_automaton()
    return machine


#: automata that a task holds at a time
HELD = 4


def _machine(held: OrderedDict, k: int, patterns: Callable[[], dict]):
    """The automaton of run ``k`` of the patterns, of the last HELD runs a task has used."""
    if k not in held:
        while len(held) >= HELD:
            held.popitem(last=False)
        held[k] = _automaton(patterns())
    held.move_to_end(k)
    return held[k]


def leak_column(text: Column, items: DataFrame, id_col: str = "item_id", text_col: str = "text", *,
                window: int = 10, automaton_bytes: int = 32 << 20) -> Column:
    """Struct column: n_words, sorted item ids, and merged hit spans [start, end) in code points
    with their first and last word numbers."""
    sc = items.sparkSession.sparkContext
    shared = [sc.broadcast(p) for p in _patterns(items, id_col, text_col, window, automaton_bytes)]

    def make():
        held: OrderedDict = OrderedDict()

        def one(column: pa.Array) -> pa.Array:
            n_words, names, spans = [], [], []
            for _, _, data, offsets in tx.chunks(column):
                flat, at, first, starts, ends = normalise(data, offsets)
                edge = np.zeros(len(at) + 1, np.int64)
                hits: dict[int, set[str]] = {}
                for k, patterns in enumerate(shared):
                    stops, values = [], []
                    for stop, value in _machine(held, k, lambda p=patterns: p.value).iter(flat):
                        stops.append(stop)
                        values.append(value)
                    last = np.searchsorted(at, np.array(stops, np.int64)) - 1
                    rows = np.searchsorted(first, last, "right") - 1
                    for w, row, (size, ids) in zip(last.tolist(), rows.tolist(), values):
                        edge[w - size + 1] += 1
                        edge[w + 1] -= 1
                        hits.setdefault(row, set()).update(ids)
                hit = np.cumsum(edge)[:-1] > 0
                a, b = tx.spans(hit, first)
                row_of = np.searchsorted(first, a, "right") - 1
                where: dict[int, list[dict]] = {}
                for row, i, j in zip(row_of.tolist(), a.tolist(), b.tolist()):
                    base = offsets[row]
                    lead = _lead(data[base:ends[j - 1]])
                    where.setdefault(row, []).append({
                        "start": int(lead[starts[i] - base]), "end": int(lead[ends[j - 1] - base]),
                        "first_word": i - int(first[row]), "last_word": j - 1 - int(first[row])})
                n_words.extend(np.diff(first).tolist())
                names.extend(sorted(hits.get(r, ())) for r in range(len(offsets) - 1))
                spans.extend(where.get(r, []) for r in range(len(offsets) - 1))
            return rows_to_struct(_LEAKS, {"n_words": n_words, "items": names, "spans": spans})

        return one

    return text_column(text, LEAKS, make)


def _lead(data: np.ndarray) -> np.ndarray:
    """Code points before each byte offset."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans) per row of ``docs``."""
    found = docs.select("doc_id", leak_column(F.col("text"), items, **options).alias("x"))
    hit = F.aggregate("x.spans", F.lit(0).cast("long"),
                      lambda s, p: s + p["last_word"] - p["first_word"] + 1)
    return found.select(
        "doc_id", F.col("x.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("x.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("x.items", ","), 256).alias("items_sha256"),
        (F.size("x.spans") > 0).alias("contaminated"),
        F.col("x.items").alias("items"), F.col("x.spans").alias("spans"))
