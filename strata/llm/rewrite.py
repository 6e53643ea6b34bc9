"""Texts without some of their lines or spans."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm.columns import slices


def _without(text: str, starts: set[int]) -> str:
    kept, at = [], 0
    for line in text.split("\n"):
        if at not in starts:
            kept.append(line)
        at += len(line) + 1
    return "\n".join(kept)


def _rewritten(text: Column, spans: Column, one: Callable[[str, list[dict]], str]) -> Column:
    """``one(text, spans)`` where both are there, else the text; a slice of a batch at a time."""

    def run(it: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in it:
            for lo, n in slices(texts):
                yield pa.array([one(t.as_py(), s.as_py()) if s.is_valid and t.is_valid else t.as_py()
                                for t, s in zip(texts.slice(lo, n), found.slice(lo, n))], pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()(text, spans)


def without_lines(text: Column, spans: Column) -> Column:
    """``text`` without the lines that start at the ``start`` of ``spans`` (code points); null spans: as it is."""
    return _rewritten(text, spans, lambda t, s: _without(t, {x["start"] for x in s}))


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    merged: list[list[int]] = []
    for a, z in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(z, merged[-1][1])
        else:
            merged.append([a, z])
    lines, at, i = [], 0, 0
    for line in text.split("\n"):
        end = at + len(line)
        while i < len(merged) and merged[i][1] <= at:
            i += 1
        k, left, kept, touched = i, at, "", False
        while k < len(merged) and merged[k][0] < end:
            piece = text[left:max(left, merged[k][0])]
            kept += piece.lstrip() if touched and (not kept or kept[-1].isspace()) else piece
            left, touched, k = min(end, merged[k][1]), True, k + 1
        if touched:
            piece = text[left:end]
            kept += piece.lstrip() if not kept or kept[-1].isspace() else piece
            if left == end:
                kept = kept.rstrip()
        else:
            kept = line
        if not touched or kept.strip():
            lines.append(kept)
        at = end + 1
    return "\n".join(lines)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without ``spans`` (code points), and without lines that have nothing left; null spans: as it is."""
    return _rewritten(text, spans, lambda t, s: _cut(t, [(x["start"], x["end"]) for x in s]))
