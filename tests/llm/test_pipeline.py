import os
import random
import time

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard_join as jj
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.001"


def test_run_equals_the_stages_alone(spark):
    rows = cp.run(spark, FOLDER).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_decisions_take_effect(spark):
    rng = random.Random(4)
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first().text
    train = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("lang = 'en'").limit(30).collect()
    clean = [" ".join(f"{w}{k}" for k, w in enumerate(prose(rng, 80).split())) for _ in range(3)]
    line = "this line of the corpus stands in many documents as it is"
    made = [(1000, clean[0]), (1001, clean[0]), (1002, clean[0] + " more"), (1003, clean[1] + "\n" + line),
            (1004, line + "\n" + clean[2]), (1005, "the " + item + " end"), (1006, None), (1007, "12 34 !!"), (1008, "")]
    rows = [(r.doc_id, r.text, r.lang, 1) for r in train] + [(i, t, None, 2) for i, t in made]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, leaks int")
    left = docs
    kept = []
    for _, stage in cp.STAGES[:-1]:
        left = stage(spark, left, FOLDER)
        assert left.columns == docs.columns
        kept.append({r.doc_id: r.text for r in left.filter("doc_id >= 1000").collect()})
    assert set(kept[0]) == {1000, 1001, 1002, 1003, 1004, 1005}
    assert set(kept[1]) == {1000, 1003, 1004, 1005}
    assert kept[2][1003] == clean[1] + "\n" + line and kept[2][1004] == clean[2] and kept[2][1000] == clean[0]
    assert set(kept[3]) == {1000, 1003, 1004}


@pytest.mark.parametrize("empty", [True, False])
def test_edge_rows(spark, edge_docs, no_docs, empty):
    docs = no_docs if empty else edge_docs
    for name, stage in cp.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        assert out.count() <= docs.count()
        if name == "sentencepiece":
            assert out.filter(~F.col("round_trip")).count() == 0


def test_nothing_goes_where_no_language_is_known(spark):
    """Without any ``lang`` there is nothing to hold against a text that has letters."""
    rng = random.Random(6)
    rows = [(i, prose(rng, 30), None) for i in range(20)] + [(20, "12 34", None), (21, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in cp.language_id(spark, docs, FOLDER).collect()}
    assert kept == set(range(20))


def test_rows_that_share_an_id_are_told_apart(spark):
    rng = random.Random(7)
    a, b = (" ".join(f"{w}{k}" for k, w in enumerate(prose(rng, 60).split())) for _ in range(2))
    rows = [(1, a), (2, a + " end"), (2, b), (2, b), (3, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text) for r in cp.near_duplicates(spark, docs, FOLDER).collect())
    assert kept == sorted([("1", a), ("2", b), ("2", b), ("None", a)])


@pytest.mark.parametrize("count", [1, 2, 12])
def test_clean_texts_stay_whatever_the_number_of_languages(spark, count):
    """Words of each language from its own letters; short and long texts are kept."""
    rng = random.Random(8)
    letters = [[chr(97 + (7 * k + 3 * j) % 26) for j in range(5)] + [chr(0xE0 + k)] for k in range(count)]
    rows = []
    for i in range(40 * count):
        own = letters[i % count]
        words = ["".join(rng.choice(own) for _ in range(rng.randrange(2, 8))) for _ in range(3 if i % 5 == 0 else 60)]
        rows.append((i, " ".join(words), f"l{i % count:02d}"))
    docs = spark.createDataFrame([*rows, (9999, "?! 12", None)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in cp.language_id(spark, docs, FOLDER).select("doc_id").collect()}
    assert 9999 not in kept and len(kept) == len(rows)


def test_near_duplicates_carry_each_text_once(spark, monkeypatch):
    """Texts that come many times: the stage exchanges the shingles of each once and leaves no shuffle files."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}

    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(200)) for _ in range(20)]
    rows = [(i, texts[i % 20]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    tables, written = {}, jj.written
    monkeypatch.setattr(jj, "written", lambda df, name: tables.setdefault(name, written(df, name)))
    before = files()
    left = cp.near_duplicates(spark, docs, FOLDER)
    until = time.time() + 20
    while sum(os.path.getsize(f) for f in files() - before if os.path.exists(f)) > 20_000 and time.time() < until:
        time.sleep(0.2)
    assert sum(os.path.getsize(f) for f in files() - before if os.path.exists(f)) <= 20_000
    assert tables["jaccard-sets"].count() == 0  # no two of the twenty are near copies
    assert {r.doc_id for r in left.collect()} == set(range(20))
