"""Repeated passages that are no repeated line: short lines, other wrapping, scripts without spaces."""

import random

from strata.llm.line_dedup import dedup_lines
from tests.llm.conftest import prose


def cut(spark, texts):
    frame, _, text = dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
                                 .repartition(3), passages=True)
    return [r.t for r in frame.select("doc_id", text.alias("t")).orderBy("doc_id").collect()]


def own(rng, n):
    return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))


def test_passage_of_short_lines(spark):
    rng = random.Random(1)
    verse = "\n".join(own(rng, 4) + "." for _ in range(20))
    texts = [f"{own(rng, 20)}\n\n{verse}\n\n{own(rng, 20)}" for _ in range(3)]
    got = cut(spark, texts)
    assert got[0] == texts[0]
    for t, g in zip(texts[1:], got[1:]):
        a, _, z = t.split("\n\n")
        assert [x for x in g.split("\n") if x] == [a, z]


def test_scripts_without_spaces(spark):
    rng = random.Random(2)
    han = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(40)) for _ in range(6)]
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2E)) for _ in range(40))
    texts = [han[0] + "\n" + thai, han[1] + "\n" + han[0], han[2] + "\u3002" + han[3] + "\u3002",
             han[4] + "\u3002" + han[3] + "\u3002" + han[5], thai + "\n" + "\u6f22\u5b57", "\u6f22\u5b57"]
    assert cut(spark, texts) == [texts[0], han[1], texts[2], han[4] + "\u3002" + han[5], "\u6f22\u5b57", "\u6f22\u5b57"]


def test_passage_wrapped_otherwise_inside_other_lines(spark):
    rng = random.Random(3)
    sentences = [own(rng, 14) + "." for _ in range(4)]
    words = " ".join(sentences).split()
    wrapped = "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    a, z = own(rng, 12) + ".", own(rng, 12) + "."
    texts = [" ".join(sentences), f"{a} {wrapped} {z}", "  " + own(rng, 9) + ".  " + own(rng, 9)]
    assert cut(spark, texts) == [texts[0], f"{a}\n{z}", texts[2]]


def test_every_repeated_word_run_stays_once(spark):
    rng = random.Random(4)
    pool = [prose(rng, rng.randrange(3, 30)) for _ in range(15)]
    texts = [rng.choice(["\n", "\n\n", " "]).join(rng.choice(pool) for _ in range(rng.randrange(0, 7))) for _ in range(50)]
    got = cut(spark, texts)
    assert len(got) == 50 and any(g != t for g, t in zip(got, texts))
    left = {w for g in got for w in g.lower().split()}
    assert left == {w for t in texts for w in t.lower().split()}


def naive(docs, least=8):
    """Plain Python over ASCII texts: units of lines, sentences and paragraphs, the first of each stays."""
    import re
    units = []
    for i, text in docs:
        words = [(m.start(), m.end()) for m in re.finditer(r"[^ \t\n]+", text)]
        own, at = [], 0
        for line in text.split("\n"):
            inside = [k for k, (a, z) in enumerate(words) if at <= a < at + len(line)]
            if inside:
                own.append((inside[0], inside[-1] + 1, at, at + len(line)))
            at += len(line) + 1
        for blank_only in (False, True):
            first = 0
            for k, (a, z) in enumerate(words):
                after = text[z:words[k + 1][0]] if k + 1 < len(words) else "\n\n"
                stop = re.search(r"[.!?][\"')\]]?$", text[a:z]) and not blank_only
                if stop or after.count("\n") > 1:
                    own.append((first, k + 1, words[first][0], z))
                    first = k + 1
        seen = {}
        for a, z, s, e in own:
            seen.setdefault((a, z), (s, e))
        for (a, z), (s, e) in seen.items():
            if z - a >= least:
                units.append((" ".join(text[p:q] for p, q in words[a:z]).lower(), i, s, e))
    keep = {}
    for norm, i, s, e in units:
        keep[norm] = min(keep.get(norm, (i, s)), (i, s))
    gone = {i: set() for i, _ in docs}
    for norm, i, s, e in units:
        if (i, s) != keep[norm]:
            gone[i].add((s, e))
    return {i: sorted(v) for i, v in gone.items()}


def test_passages_equal_a_plain_model(spark):
    import random

    from strata.llm.line_dedup import dedup_lines
    rng = random.Random(12)
    sentences = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9)}" for _ in range(rng.randrange(3, 14))) + rng.choice([".", "!", "?\"", ""])
                 for _ in range(40)]
    docs = []
    for i in range(80):
        text = ""
        for _ in range(rng.randrange(1, 14)):
            text += rng.choice(sentences) + rng.choice([" ", " ", "\n", "\n\n", "  \n \n"])
        docs.append((i, text.upper() if i % 9 == 0 else text))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    out, spans, _ = dedup_lines(frame, passages=True)
    got = {r.doc_id: [(x["start"], x["end"]) for x in r.s or []] for r in out.select(frame["doc_id"], spans.alias("s")).collect()}
    want = naive(docs)
    assert got == want and sum(map(len, want.values())) > 100


def test_units_take_little_memory_at_once(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from strata.llm import line_dedup

    rng = random.Random(5)
    texts = [prose(rng, 300) + "\n\n" + own(rng, 40) + "." for _ in range(2_000)]
    ids = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["id", "h", "text"])
    assert batch.column(2).nbytes > 4 << 20

    def units():
        found = list(line_dedup._units(8, True)(iter([batch])))
        return pa.Table.from_batches(found).to_pydict()

    got = units()
    assert len(set(got["id"])) == len(texts)
    tracemalloc.start()
    for _ in line_dedup._units(8, True)(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    monkeypatch.setattr(line_dedup, "_BYTES", 1 << 30)
    assert units() == got
