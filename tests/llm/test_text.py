import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.columns import rows_to_struct, text_column
from strata.llm.rewrite import without_lines, without_spans
from tests.llm.conftest import lowered

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \n\t\x0b\x1faAbZ09.é漢€ ", max_size=40)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_match_the_patterns(texts):
    for table, pattern in ((tx.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (tx.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got, hashes = [], {}
        for lo, hi, data, offsets in tx.chunks(pa.array(texts, pa.string())):
            starts, ends, h, first = tx.words(data, offsets, table)
            for a, b in zip(first[:-1], first[1:]):
                w = [tx.LOWER[data[s:e]].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])]
                got.append(w)
                for word, value in zip(w, h[a:b].tolist()):
                    assert hashes.setdefault(word, value) == value
        assert got == [re.findall(pattern, lowered(t)) for t in texts]
        assert len(set(hashes.values())) == len(hashes)


def test_hash_does_not_depend_on_place_or_piece(monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(n)) for n in (1, 5, 40, 3000, 3000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    whole = tx.words(data, np.array([0, len(data)]), tx.NOT_SPACE)[2]
    monkeypatch.setattr(tx, "PIECE", 64)
    pieces = tx.words(data, np.array([0, len(data)]), tx.NOT_SPACE)[2]
    assert whole.tolist() == pieces.tolist()
    alone = [tx.words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]), tx.NOT_SPACE)[2][0] for w in words]
    assert [int(x) for x in alone] == whole.tolist()


def test_shingles_by_words():
    def sets(texts, k):
        data, offsets = tx.utf8(pa.array(texts))
        _, _, h, first = tx.words(data, offsets, tx.NOT_SPACE)
        return [s.tolist() for s in tx.shingles(h, first, k)]

    a, b, c, d, e = sets(["a b c d e f", "b c d e f", "a b", "", "a b"], 5)
    assert len(a) == 2 and a[1:] == b and len(c) == 1 and d == [] and c == e


def test_chunks_cover_all_rows(monkeypatch):
    monkeypatch.setattr(tx, "CHUNK", 10)
    column = pa.array(["abcd", None, "e" * 50, "", "fgh", "ij"])
    parts = list(tx.chunks(column.slice(1)))
    assert [(p[0], p[1]) for p in parts][0][0] == 0 and parts[-1][1] == 5
    assert b"".join(p[2].tobytes() for p in parts).decode() == "e" * 50 + "fghij"
    assert list(tx.chunks(pa.array([], pa.string()))) == []


def test_runs_join_groups_across_batches():
    def b(k, v):
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(v)], ["k", "v"])

    groups = [(g["k"][0].as_py(), g["v"].to_pylist()) for g in
              tx.runs(iter([b([1, 1, 2], [1, 2, 3]), b([2], [4]), b([2, 3], [5, 6])]), ["k"])]
    assert groups == [(1, [1, 2]), (2, [3, 4, 5]), (3, [6])]


def test_memo_is_bounded_and_right():
    memo, asked = tx.Memo(1, np.int64, limit=10), []

    def ask(keys):
        keys = np.array(keys, np.uint64)
        return memo.values(keys, lambda i: (asked.append(len(i)), (keys[i] * np.uint64(3)).astype(np.int64)[:, None])[1])

    assert ask([5, 1, 5])[:, 0].tolist() == [15, 3, 15]
    assert ask([1, 7])[:, 0].tolist() == [3, 21] and asked == [2, 1]
    for x in range(100):
        assert ask([x])[0, 0] == 3 * x
        assert len(memo.keys) <= 10


def test_a_worker_holds_results_of_a_slice_of_a_batch(spark):
    """However many texts Spark puts into a batch, a function gets about CHUNK bytes of them at a time."""
    size = 200_000
    rows = spark.range(60, numPartitions=1).select(
        "id", F.when(F.col("id") % 7 == 3, None).when(F.col("id") % 7 == 5, "").otherwise(
            F.concat(F.col("id").cast("string"), F.lit("\n"), F.lit("x" * size))).alias("text"))
    given = text_column(F.col("text"), "struct<n: int, mb: double, text: string>", lambda: lambda c: rows_to_struct(
        pa.struct([("n", pa.int32()), ("mb", pa.float64()), ("text", pa.string())]),
        {"n": [len(c)] * len(c), "mb": [sum(len(t.as_py() or "") for t in c) / tx.CHUNK] * len(c), "text": c}))
    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length(F.col("id").cast("string")).cast("long").alias("end")))
    spans = F.when(F.col("id") % 2 == 0, span)
    found = rows.select("id", "text", given.alias("x"), without_lines(F.col("text"), spans).alias("lines"),
                        without_spans(F.col("text"), spans).alias("spans")).orderBy("id").collect()
    assert [r.id for r in found] == list(range(60))
    assert max(r.x.mb for r in found) <= 1 and max(r.x.n for r in found) < 60
    for r in found:
        assert r.x.text == r.text
        cut = r.text if r.id % 2 or not r.text else "x" * size
        assert r.lines == cut and r.spans == cut
