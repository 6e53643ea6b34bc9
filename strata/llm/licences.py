"""Licence scan: texts compared with licence templates by Dice over word bigrams.

Text is normalised as words of digits, a-z (A-Z lower-cased) and non-ASCII
characters. Units are lines, paragraphs of several lines (between blank lines)
and texts of several paragraphs. A unit with a distinct bigrams can reach
similarity t only with templates of t/(2-t) a to (2-t)/t a bigrams, and only if
at least t/(2-t) a of its own bigrams occur in any template: these bounds
leave few units and templates to compare in full. One row per unit whose likest
template is at or above t, with offsets (code points) in the original text.

With ``windows`` also runs of words count that are no unit: any run within one
text, across lines and paragraphs or inside a line, of two words up to (2-t)/t
times the template's words. A run at or above t has at least t/(2-t) of the
template's bigrams, so only stretches as dense as that are searched, but these
exactly: for each last word the first word with the largest 2 * shared - t * own
bigrams. Of overlapping runs the one with the most shared bigrams, less half of
those that only one side has, is reported; the gaps are searched again. A run
inside a unit reported for its licence adds nothing and is left out.

A text of one word has one "bigram", the word. Null, empty and wordless texts
match nothing; repeated rows are reported each. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.columns import text_column

#: fixed values: public licence notices, without names and years
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU Lesser General Public License for more details.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU Lesser General Public License for more details.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU Affero General Public License for more details.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
#: full standard texts, one file per licence
for _file in sorted((resources.files("strata.llm") / "licence_texts").iterdir(), key=lambda f: f.name):
    TEMPLATES.setdefault(_file.name.removesuffix(".txt"), []).append(_file.read_text("utf-8"))

UNITS = ("document", "paragraph", "line")
_MATCH = pa.struct([("licence", pa.string()), ("unit", pa.string()), ("start", pa.int64()),
                    ("end", pa.int64()), ("dice", pa.float64())])


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Hash of each word pair that starts at a word (the last word is paired with nothing)."""
    step = np.uint64(0x9E3779B97F4A7C15)
    follow = np.append(hashes[1:], np.uint64(0)) if len(hashes) else hashes
    return tx.mix(hashes * step + follow)


def _unit_bigrams(hashes: np.ndarray, pairs: np.ndarray, a: int, b: int) -> np.ndarray:
    return pairs[a:b - 1] if b - a > 1 else tx.mix(hashes[a:b])


def _templates(templates: dict[str, list[str]]) -> list[tuple[str, frozenset[int], int]]:
    """(name, bigrams, words) of each template."""
    out = []
    for name, texts in templates.items():
        for t in texts:
            data = np.frombuffer(t.encode(), np.uint8)
            _, _, hashes, _ = tx.words(data, np.array([0, len(data)]), tx.ALNUM)
            out.append((name, frozenset(_unit_bigrams(hashes, bigrams(hashes), 0, len(hashes)).tolist()), len(hashes)))
    return out


def _units(data: np.ndarray, offsets: np.ndarray):
    """(start, end, kind) bytes of texts, paragraphs and lines; a unit equal to its only part is left out."""
    lines = tx.spans(data != 10, offsets)
    blank = np.zeros(len(data), bool)  # newlines of a blank line, seen as ends of paragraphs
    newline = np.flatnonzero(data == 10)
    inner = newline[1:][np.diff(newline) == 1]
    blank[inner] = blank[inner - 1] = True
    paragraphs = tx.spans(~blank, offsets)
    texts = (offsets[:-1], offsets[1:])
    held = None
    for kind, (a, z) in zip((2, 1, 0), (lines, paragraphs, texts)):
        if held is None:
            yield a, z, kind
        else:
            several = np.searchsorted(held, z) - np.searchsorted(held, a) > 1
            yield a[several], z[several], kind
        held = a


def _best_runs(pairs: np.ndarray, mine: np.ndarray, longest: int, usual: int, m: int,
               t: float) -> Iterator[tuple[float, int, int, float]]:
    """(weight, first, last, dice) for each last bigram that ends a run at or above t.

    ``mine`` tells which bigrams the template of m distinct bigrams has, ``longest`` bounds a run's bigrams;
    of first bigrams that are as good (where bigrams repeat) the run nearest to ``usual`` bigrams counts.
    """
    n = len(pairs)
    order = np.argsort(pairs, kind="stable")
    before = np.full(n, -1)  # the last place of the same bigram: it counts for runs that start after it
    same = pairs[order[1:]] == pairs[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    gain = np.zeros(n)
    for e, (last, ours) in enumerate(zip(before.tolist(), mine.tolist())):
        lo = max(0, e - longest + 1)
        gain[max(last + 1, lo):e + 1] += 2 - t if ours else -t
        if not ours:  # a run that ends here is no better than without its last word
            continue
        back = gain[lo:e + 1][::-1]
        most = back.max()
        if most < t * m - 1e-6:
            continue
        ties = np.flatnonzero(back > most - 1e-6)
        s = e - int(ties[np.abs(ties + 1 - usual).argmin()])
        new = before[s:e + 1] < s
        own, shared = int(np.count_nonzero(new)), int(np.count_nonzero(new & mine[s:e + 1]))
        dice = 2 * shared / (own + m)
        if dice >= t:
            yield 2 * shared - (own + m) / 2, s, e, dice


def _dense(at: np.ndarray, row: np.ndarray, need: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """(row, first, last): stretches of bigrams ``at`` where ``need`` stand within ``longest``."""
    if len(at) < need:
        return
    a, z = at[:len(at) - need + 1], at[need - 1:]
    keep = (z - a < longest) & (row[:len(a)] == row[need - 1:])
    a, z, r = a[keep], z[keep], row[:len(keep)][keep]
    if not len(a):
        return
    cut = np.flatnonzero((a[1:] > z[:-1]) | (r[1:] != r[:-1])) + 1
    yield from zip(r[np.append(0, cut)].tolist(), a[np.append(0, cut)].tolist(),
                   z[np.append(cut - 1, len(z) - 1)].tolist())


def _windows(pairs: np.ndarray, at: np.ndarray, hit: np.ndarray, row: np.ndarray, member: np.ndarray,
             named: list[tuple[str, frozenset[int], int]], t: float) -> Iterator[tuple[int, int, int, str, float]]:
    """(row, first word, last word + 1, licence, dice): runs of words at or above t that do not overlap.

    ``hit`` are the bigrams within rows that any template has, ``at`` their columns in ``member``.
    """
    low, high = t / (2 - t), (2 - t) / t
    todo: dict[int, list[tuple[int, int, int]]] = {}
    places = []
    for k, (_, other, length) in enumerate(named):
        mine = hit[member[k, at]]
        places.append(mine)
        need = max(1, int(np.ceil(low * len(other) - 1e-9)))
        for r, a, z in _dense(mine, row[mine], need, int(high * length) - 1):
            todo.setdefault(r, []).append((k, a, z))
    for r, stretches in todo.items():
        taken: list[tuple[int, int]] = []
        while stretches:
            runs = []
            for k, a, z in stretches:
                name, other, length = named[k]
                mine = np.zeros(z - a + 1, bool)
                lo, hi = np.searchsorted(places[k], [a, z + 1])
                mine[places[k][lo:hi] - a] = True
                runs += [(-w, abs(e - s + 2 - length), a + s, a + e + 2, name, dice) for w, s, e, dice
                         in _best_runs(pairs[a:z + 1], mine, int(high * length) - 1, length - 1, len(other), t)]
            found = False
            for _, _, a, z, name, dice in sorted(runs):
                i = bisect_left(taken, (a, z))
                if (i and taken[i - 1][1] > a) or (i < len(taken) and taken[i][0] < z):
                    continue
                insort(taken, (a, z))
                found = True
                yield r, a, z, name, dice
            left = []
            for k, a, z in stretches if found else []:
                inside = taken[max(bisect_left(taken, (a, 0)) - 1, 0):bisect_left(taken, (z + 2, 0))]
                if not any(x < z + 2 and y > a for x, y in inside):
                    continue  # searched in full, and nothing found
                need = low * len(named[k][1]) - 1e-9
                for x, y in zip([a, *(y for _, y in inside)], [*(x for x, _ in inside), z + 2]):
                    lo, hi = np.searchsorted(places[k], [max(a, x), y - 1])
                    if hi - lo >= max(need, 1):
                        left.append((k, int(places[k][lo]), int(places[k][hi - 1])))
            stretches = left


def match_column(text: Column, templates: dict[str, list[str]], threshold: float = 0.8,
                 windows: bool = False) -> Column:
    """array of matches (licence, unit, start, end, dice), sorted by start and unit."""
    full = _templates(templates)
    named = [(name, other) for name, other, _ in full]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = np.array([len(s) for _, s in named])

    def make():
        known = np.array(sorted(set().union(*(s for _, s in named))), np.uint64)
        member = np.array([np.isin(known, np.array(list(s), np.uint64)) for _, s in named])

        def one(column: pa.Array) -> pa.Array:
            found: list[list[dict]] = [[] for _ in range(len(column))]
            for base, _, data, offsets in tx.chunks(column):
                starts, ends, hashes, firsts = tx.words(data, offsets, tx.ALNUM)
                if not len(starts):
                    continue

                def place(row: int, wa: int, wz: int, name: str, unit: str, dice: float) -> dict:
                    chars = np.cumsum((data[offsets[row]:ends[wz - 1]] & 0xC0) != 0x80)
                    begin = int(starts[wa] - offsets[row])
                    return {"licence": name, "unit": unit, "start": int(chars[begin]) - 1, "end": int(chars[-1]),
                            "dice": dice}

                pairs = bigrams(hashes)
                at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                is_hit = known[at] == pairs
                hits = np.concatenate([[0], np.cumsum(is_hit)])
                for a, z, kind in _units(data, offsets):
                    wa, wz = np.searchsorted(starts, a), np.searchsorted(starts, z)
                    n = wz - wa
                    # single words have no pair to count; of others, most must occur in a template.
                    # distinct pairs can be few where a unit repeats itself: bounded by the longest template
                    some = hits[np.maximum(wz - 1, wa)] - hits[wa]
                    able = (n == 1) | ((n > 1) & (some > 0)
                                       & (some >= np.floor(low * np.minimum(n - 1, sizes.min()))))
                    for u in np.flatnonzero(able).tolist():
                        own = frozenset(_unit_bigrams(hashes, pairs, wa[u], wz[u]).tolist())
                        size = len(own)
                        if size > high * sizes.max() or size < low * sizes.min():
                            continue
                        for (name, other), m in zip(named, sizes.tolist()):
                            if not low * m <= size <= high * m:
                                continue
                            dice = 2 * len(own & other) / (size + m)
                            if dice >= threshold:
                                row = int(np.searchsorted(offsets, a[u], "right")) - 1
                                found[base + row].append(place(row, wa[u], wz[u], name, UNITS[kind], dice))
                if windows:
                    is_hit[firsts[1:][firsts[1:] > 0] - 1] = False  # pairs across the ends of rows
                    hit = np.flatnonzero(is_hit)
                    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
                    for row, wa, wz, name, dice in _windows(pairs, at[hit], hit, row_of, member, full, threshold):
                        new = place(row, wa, wz, name, "window", dice)
                        if not any(r["licence"] == name and r["unit"] != "window" and r["start"] <= new["start"]
                                   and r["end"] >= new["end"] for r in found[base + row]):
                            found[base + row].append(new)
            best = []
            for rows in found:
                top: dict[tuple, dict] = {}
                for r in rows:  # several templates of one unit: the likest, then the first name
                    key = (r["start"], r["unit"])
                    if key not in top or (-r["dice"], r["licence"]) < (-top[key]["dice"], top[key]["licence"]):
                        top[key] = r
                best.append([top[k] for k in sorted(top)])
            return pa.array(best, pa.list_(_MATCH))

        return one

    return text_column(text, "array<struct<licence: string, unit: string, start: bigint, end: bigint, dice: double>>",
                       make)


def licence_scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, *, threshold: float = 0.8,
                 windows: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, licence, unit, start, end, dice): one row per matching unit and, if asked for, window."""
    found = docs.select(F.col(id_col), match_column(F.col(text_col), templates, threshold, windows).alias("m"))
    return found.select(F.col(id_col), F.inline("m"))
