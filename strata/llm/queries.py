"""Registered queries of the document operators and their DuckDB twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid, quality_fm
from strata.llm.decontaminate import contamination
from strata.llm.embedding_dedup import near_duplicate_vectors
from strata.llm.hard_negatives import hard_negatives
from strata.llm.jaccard_join import jaccard_components
from strata.llm.licences import licence_scan
from strata.llm.line_dedup import dedup_lines
from strata.llm.phrases import fingerprints
from strata.llm.pieces import encode_decode, load_model
from strata.llm.store import written
from strata.llm.token_counts import length_column, length_histogram, load_ranks, suffix_sums
from strata.llm.warc import new_archive_folder, read_records, write_archives
from strata.llm.whitening import whiten

#: vocabulary files: read on the driver only
TOKENIZERS = os.environ.get("STRATA_TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
BPE_RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
#: split pattern of the byte-level BPE vocabulary
BPE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(_table(spark, sf_dir, "documents"), windows=True)


def _deduplicated(docs: DataFrame, passages: bool) -> DataFrame:
    frame, spans, text = dedup_lines(docs, passages=passages)
    removed = F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return frame.select(docs["doc_id"], F.coalesce(F.size(spans), F.lit(0)).cast("long").alias("n_removed"),
                        F.coalesce(removed, F.lit("")).alias("removed_spans"), text.alias("text"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, sentences and paragraphs, as in the pipeline."""
    return _deduplicated(_table(spark, sf_dir, "documents"), passages=True)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines alone, which SQL can express."""
    return _deduplicated(_table(spark, sf_dir, "documents"), passages=False)


OP2_SQL = r"""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
cut AS (
  SELECT doc_id, text, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i,
         unnest(list_transform(parts, lambda x: length(x))) AS n FROM doc),
placed AS (
  SELECT *, (sum(n + 1) OVER (PARTITION BY doc_id ORDER BY i) - n - 1)::BIGINT AS start,
         list_filter(regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM cut),
unit AS (SELECT *, len(w) >= 8 AS able, array_to_string(w, ' ') AS norm FROM placed),
ranked AS (
  SELECT *, able AND row_number() OVER (PARTITION BY able, norm ORDER BY doc_id, start) > 1 AS gone FROM unit)
SELECT doc_id, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(start || '-' || (start + n), ',' ORDER BY i) FILTER (gone), '') AS removed_spans,
       CASE WHEN any_value(text) IS NOT NULL
            THEN coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS text
FROM ranked GROUP BY doc_id
"""


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return encode_decode(docs, load_model(PIECE_MODEL)).select(
        "doc_id", "n_tokens", "ids", F.length("decoded").cast("long").alias("decoded_chars"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op5_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_fm.score_quality(docs, quality_fm.fit(docs, _table(spark, sf_dir, "labels")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lengths = docs.select(length_column(spark, F.col("text"), load_ranks(BPE_RANKS), BPE_PATTERN).alias("n_tokens"))
    return suffix_sums(written(length_histogram(lengths), "token-lengths"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(_table(spark, sf_dir, "pages"), new_archive_folder(spark))
    return read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


OP8_SQL = """
WITH page AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, url, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM page),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM hashed)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to, url
FROM kept
"""


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["first_word"], s["last_word"]))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                        F.array_join(spans, ",").alias("hit_words"))


OP9_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM pattern),
spot AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size),
found AS (
  SELECT DISTINCT s.doc_id, s.i, s.size, p.item_id
  FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS p FROM spot) s
  JOIN pattern p ON p.size = s.size AND p.p = s.p),
word AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS k FROM found),
island AS (
  SELECT doc_id, min(k) - 1 AS a, max(k) - 1 AS b, count(*) AS n
  FROM (SELECT doc_id, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM word)
  GROUP BY doc_id, g),
hit AS (SELECT doc_id, sum(n)::BIGINT AS n_hit, string_agg(a || '-' || b, ',' ORDER BY a) AS hit_words
        FROM island GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(hit_words, '') AS hit_words
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)
"""


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT doc_id, doc_id AS r FROM doc
          UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON reach.r = link.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH RECURSIVE able AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM able a JOIN able b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
degree AS (SELECT x, count(*) AS n FROM link GROUP BY x),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings
          UNION SELECT reach.vec_id, link.y FROM reach JOIN link ON reach.r = link.x)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(r) AS component_id, min(r) = vec_id AS kept
FROM reach LEFT JOIN degree ON x = vec_id GROUP BY vec_id
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label))


OP12_SQL = """
WITH able AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM able a, able c WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (
         PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_phrase_fingerprints": op4_phrase_fingerprints,
    "op5_quality_fm": op5_quality_fm,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_warc": op8_warc,
    "op9_decontaminate": op9_decontaminate,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op8_warc": OP8_SQL,
    "op9_decontaminate": OP9_SQL,
    "op10_jaccard_join": OP10_SQL,
    "op11_embedding_dedup": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
