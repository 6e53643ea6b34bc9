"""Corpus pipeline: raw documents to token ids in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``. All but the last keep the
columns of ``documents``, whatever they are:

1. language ID: documents without a recognised language go: those without a
   letter, and those whose best language is hardly likelier than chance (see
   MARGIN). Where no document has a known language to learn from, only those
   without a letter go;
2. n-gram Jaccard join: of each group of near duplicates (similarity 0.75 of
   five-word shingles, linked directly or through others) the least id stays;
3. substring dedup: of lines, sentences and paragraphs that repeat, all but the
   first occurrence are cut (n_chars, where present, follows the text);
4. benchmark decontamination: documents with a benchmark window go;
5. SentencePiece: (doc_id, n_tokens, ids) of each document left, decoded again
   and compared with its text (round_trip).

Null texts have no language and go in stage 1. Rows without an id are compared
by text like others, but none of them goes in stage 2. Rows with equal id and
text are one document, kept as often as it stands there; rows that share an id
but not the text are told apart by a hash of the text, and if both are in the
group that their id stands for, both stay. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.decontaminate import leak_column
from strata.llm.jaccard_join import jaccard_components
from strata.llm.line_dedup import dedup_lines
from strata.llm.pieces import coded_column, load_model
from strata.llm.queries import PIECE_MODEL
from strata.llm.store import broadcast_if_small, written

#: how far the mean probability of the best of c languages must be from 1/c (chance) to 1
MARGIN = 0.05


def _free_name(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    if model is None:  # nothing is known about languages: nothing is held against a text
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = _free_name(docs, "language")
    chance = 1 / len(model.langs)
    marked = docs.withColumn(found, langid.language_column(spark, F.col("text"), model))
    return (marked.filter((F.col(f"{found}.lang") != "und")
                          & (F.col(f"{found}.score") >= chance + MARGIN * (1 - chance) - 1e-6))
            .select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard_components(docs, text_hash=True)
    gone = written(groups.filter("doc_id <> component_id").select("doc_id", "text_hash").distinct(), "near-duplicates")
    gone = broadcast_if_small(gone).select(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash"))
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["__gone_id"])
                     & (F.xxhash64(docs["text"]) == gone["__gone_hash"]), "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frame, _, text = dedup_lines(docs, passages=True)
    new = _free_name(docs, "new_text")
    frame = frame.select(*(docs[c] for c in docs.columns), text.alias(new))
    size = F.length(new).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return frame.select(*(F.col(new).alias(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(c)
                          for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = _free_name(docs, "leaks")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return (docs.withColumn(leaks, leak_column(F.col("text"), items))
            .filter(F.size(f"{leaks}.spans") == 0).select(*docs.columns))


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = docs.select("doc_id", "text", coded_column(spark, F.col("text"), load_model(PIECE_MODEL)).alias("x"))
    return coded.select("doc_id", F.coalesce(F.array_size("x.ids"), F.lit(0)).cast("long").alias("n_tokens"),
                        F.col("x.ids").alias("ids"),
                        F.col("x.decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", sentencepiece_ids),
]

#: a trained network and Viterbi segmentation have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
