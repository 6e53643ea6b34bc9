"""Licence texts inside longer texts: runs of words that are no line, paragraph or text."""

import random

import pytest

from strata.llm import licences as lic
from tests.llm.conftest import prose
from tests.llm.test_documents import dice


def scan(spark, texts):
    rows = lic.licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                            windows=True).collect()
    return [[r for r in rows if r.doc_id == i] for i in range(len(texts))]


def split(text, parts):
    words = text.split()
    k = -(-len(words) // parts)
    return "\n\n".join(" ".join(words[i:i + k]) for i in range(0, len(words), k))


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0", "GPL-3.0"])
def test_exact_text_between_prose(spark, name):
    rng = random.Random(8)
    text = next(t for t in lic.TEMPLATES[name] if 60 < len(t.split()) < 250)
    before, after = prose(rng, 900), prose(rng, 900)
    forms = [split(text, 3), text, text.replace(", ", ",\n")]
    texts = [f"{before}{gap}{form}{gap}{after}" for form in forms for gap in (" ", "\n\n")]
    texts.append(f"{before} {forms[0]} {after} {forms[1]} {before}")
    for t, rows in zip(texts, scan(spark, texts)):
        whole = [r for r in rows if r.licence == name and r.end - r.start > 300]
        assert len(whole) == (2 if t is texts[-1] else 1)
        assert all(dice(t[r.start:r.end], text) == pytest.approx(r.dice) for r in whole)
        assert all(r.dice == 1.0 for r in whole if r.unit == "window")
        at = t.index(text.split()[0] + " " + text.split()[1])
        assert whole[0].start <= at and whole[0].end >= at + len(text) - 1


def test_notice_inside_a_line(spark):
    line = "Copyright Ann Other and others. Released under the MIT License. See the file LICENSE for all of it"
    rows = scan(spark, [line])[0]
    assert [(r.licence, r.unit, line[r.start:r.end], r.dice) for r in rows] == [
        ("MIT", "window", "Released under the MIT License", 1.0)]


def test_found_if_and_only_if_some_run_is_like(spark):
    rng = random.Random(9)
    notices = [t for ts in lic.TEMPLATES.values() for t in ts if len(t.split()) < 30]
    texts = []
    for _ in range(60):
        words = rng.choice(notices).split()
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(["word", "the other", ""])
        texts.append(f"{prose(rng, 12)} {' '.join(words)} {prose(rng, 12)}")
    hits = 0
    for t, rows in zip(texts, scan(spark, texts)):
        words = t.split()
        like = any(dice(" ".join(words[a:z]), x) >= 0.8 for x in notices
                   for a in range(len(words)) for z in range(a + 3, min(len(words), a + 45) + 1))
        assert bool(rows) == like
        assert all(max(dice(t[r.start:r.end], x) for x in lic.TEMPLATES[r.licence]) == pytest.approx(r.dice)
                   for r in rows)
        hits += like
    assert 10 < hits < 60


def test_every_full_text_alone_and_between_prose(spark):
    rng = random.Random(10)
    full = {name: ts[-1] for name, ts in lic.TEMPLATES.items() if len(ts[-1].split()) > 100}
    assert {"Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
            "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0"} <= set(full)
    texts = [t for t in full.values()] + [f"{prose(rng, 300)} {t} {prose(rng, 300)}" for t in full.values()]
    for name, t, rows in zip(list(full) * 2, texts, scan(spark, texts)):
        longest = max(rows, key=lambda r: r.end - r.start)
        assert longest.licence == name
        assert longest.end - longest.start > 0.95 * len(full[name].strip())


@pytest.mark.parametrize("name", ["GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"])
def test_gnu_notices_keep_their_names(spark, name):
    notice = next(t for t in lic.TEMPLATES[name] if 70 < len(t.split()) < 120)
    rows = scan(spark, [f"{prose(random.Random(11), 200)} {notice} {prose(random.Random(12), 200)}"])[0]
    assert max(rows, key=lambda r: r.end - r.start).licence == name
