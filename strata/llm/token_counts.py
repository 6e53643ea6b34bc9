"""Token counts: the exact histogram of encoded lengths and what follows from it.

Each text's length in byte-level BPE tokens is exact: a text is cut where white
space follows another character and where an ASCII symbol follows an ASCII
letter, where no match of the split pattern can cross (runs of letters, of
digits, of other signs, each with one space before it at most, contractions that
start at their apostrophe, and white space), and each distinct part is encoded
once per task. Documents are aggregated by
length; suffix sums over the histogram answer, for every context limit, the
documents and tokens beyond it, the total after truncation and the quantile.

The suffix sums take two levels (blocks of lengths, then lengths in a block),
so that no window holds the whole histogram. Null and empty texts have length
0. Repeated rows count each. Other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.columns import text_column


def load_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken vocabulary file (on the driver; a vocabulary is of bounded size)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


_ASCII_LETTER = tx.byte_class(bytes(range(65, 91)) + bytes(range(97, 123)))
_ASCII_SYMBOL = tx.NOT_SPACE & ~tx.ALNUM & ~_ASCII_LETTER


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts of texts start: at each text, where an ASCII symbol follows an ASCII letter, and
    where ASCII white space follows a character that is none (three-byte characters of E1-E3 and
    C2 85, C2 A0 count as white space here)."""
    space = tx.SPACES[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    i = np.flatnonzero(cut)
    two, three = data[np.maximum(i - 2, 0)], data[np.maximum(i - 3, 0)]
    doubt = ((two == 0xC2) & np.isin(data[i - 1], (0x85, 0xA0))) | ((three >= 0xE1) & (three <= 0xE3))
    cut[i[doubt]] = False
    cut[1:] |= _ASCII_SYMBOL[data[1:]] & _ASCII_LETTER[data[:-1]]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


def length_column(spark: SparkSession, text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """Number of tokens of each text."""
    shared = spark.sparkContext.broadcast(ranks)

    def make():
        import tiktoken

        coder = tiktoken.Encoding("lengths", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        memo = tx.Memo(1, np.int64)

        def one(column: pa.Array) -> pa.Array:
            out = []
            for _, _, data, offsets in tx.chunks(column):
                starts = part_starts(data, offsets)
                ends = np.append(starts[1:], len(data))
                keys = tx.span_hashes(data, starts, ends)

                def encode(index):
                    text, count = data.tobytes(), coder.encode_ordinary
                    return np.array([len(count(text[a:b].decode())) for a, b in
                                     zip(starts[index].tolist(), ends[index].tolist())], np.int64).reshape(-1, 1)

                run = np.zeros(len(starts) + 1, np.int64)
                np.cumsum(memo.values(keys, encode)[:, 0], out=run[1:])
                out.append(np.diff(run[np.searchsorted(starts, offsets)]))
            return pa.array(np.concatenate(out) if out else [], pa.int64())

        return one

    return text_column(text, "bigint", make)


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """(n_tokens, n_docs), aggregated before the shuffle."""
    return lengths.groupBy(F.col(column).alias("n_tokens")).agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """For each length L as a limit: n_docs and n_tokens of that length exactly, docs_over and
    tokens_over (longer than L), truncated_tokens (every document cut to L), kept_tokens (longer
    documents dropped) and quantile (share of documents of at most L tokens)."""
    h = histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                         F.floor(F.col("n_tokens") / block).alias("block"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    whole = W.orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"),
                           F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
                           F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    inside = W.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, -1)
    docs_over = F.col("d_later") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    tokens_over = F.col("t_later") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    out = h.join(blocks, "block").select("n_tokens", "n_docs", "tokens", "d_all", "t_all",
                                         docs_over.alias("docs_over"), tokens_over.alias("tokens_over"))
    return out.select(
        "n_tokens", "n_docs", "tokens", "docs_over", "tokens_over",
        (F.col("t_all") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias("truncated_tokens"),
        (F.col("t_all") - F.col("tokens_over")).alias("kept_tokens"),
        (1 - F.col("docs_over") / F.col("d_all")).alias("quantile"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, tokens_over, truncated_tokens) for any limits, also between lengths."""
    spark = sums.sparkSession
    ask = spark.createDataFrame([(int(x),) for x in limits], "context_limit long")
    over = F.when(F.col("n_tokens") > F.col("context_limit"), True)
    n, t = F.sum(F.when(over, F.col("n_docs"))), F.sum(F.when(over, F.col("tokens")))
    return (sums.crossJoin(F.broadcast(ask)).groupBy("context_limit")
            .agg(F.coalesce(n, F.lit(0)).alias("docs_over"), F.coalesce(t, F.lit(0)).alias("tokens_over"),
                 F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("truncated_tokens")))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that this share of documents does not exceed."""
    ask = sums.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return (sums.crossJoin(F.broadcast(ask)).filter(F.col("quantile") >= F.col("share"))
            .groupBy("share").agg(F.min("n_tokens").alias("n_tokens")))
