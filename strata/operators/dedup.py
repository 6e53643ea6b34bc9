"""Deduplication: latest row per key, first arrival per key, duplicate keys.

Both keep-one operators are ``row_number() = 1`` over the key. Catalyst turns
that into a partial ``WindowGroupLimit`` before the shuffle and a final one
after, so a hot key sends at most one row per map task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stored

_RN = "__strata_rn"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(df: DataFrame, key: str | Sequence[str] = "event_id",
                   order: str = "event_timestamp",
                   tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``order`` per key.

    NULL times sort last; ties are broken by ``tie_breakers``, then by a hash of
    the whole row, all descending, so the winner does not depend on how rows are
    spread. All rows with a NULL key form one group, as in a plain window.
    """
    sort: list[Column] = [F.col(order).desc_nulls_last()]
    sort += [F.col(c).desc_nulls_last() for c in tie_breakers]
    sort.append(row_hash(hashable(df)).desc())
    w = Window.partitionBy(*_keys(key)).orderBy(*sort)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def hashable(df: DataFrame) -> list[str]:
    """Columns that take part in a row hash (maps have no hash)."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def row_hash(cols: Sequence[str], prefix: str = "") -> Column:
    """Hash of the given columns: the last tie-breaker between rows."""
    return F.xxhash64(*[F.col(f"`{prefix}{c}`") for c in cols])


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """First arrival per key, the key compared as text.

    Rows whose key is NULL, or frames without the key column, pass unchanged.
    Without ``order_by`` the read order (position in the input) decides.
    One pass: a NULL-key row gets a window key of its own (flagged apart from
    every text key), so NULL rows neither collapse nor land in one task.
    """
    if key not in df.columns:
        return df
    text_key = F.col(key).cast("string")
    absent, group, pos = "__strata_absent", "__strata_group", "__strata_pos"
    if not order_by:
        df = df.withColumn(pos, F.monotonically_increasing_id())
        order_by = [pos]
    keyed = df.withColumns({
        absent: text_key.isNull(),
        group: F.coalesce(text_key, F.monotonically_increasing_id().cast("string"))})
    w = Window.partitionBy(absent, group).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return (keyed.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1)
            .drop(_RN, absent, group, pos))


#: repeated digests that are broadcast (8 bytes each); beyond it all keys are grouped in full
SIEVE_DIGESTS = 1_000_000


def duplicate_keys(df: DataFrame, key: str, count_col: str = "dup_count", sieve: bool = False) -> DataFrame:
    """Keys that occur more than once (a NULL key group included), with counts.

    ``sieve`` is for wide keys that are hardly ever repeated. The 64-bit digests of the keys are
    counted first, so that a digest and a count are shuffled for each key of a task instead of the
    key itself; only rows whose digest occurs again, found by a second scan of the key column, are
    then grouped by their full key. Equal keys have equal digests and the last step compares keys,
    so the answer is the same. Where more than ``SIEVE_DIGESTS`` digests repeat, the sieve would
    leave too much and all keys are grouped in full.
    """
    if sieve:
        df = _with_repeated_digest(df.select(key), key)
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def _with_repeated_digest(keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``keys`` whose digest occurs more than once, or all of them."""
    digest, name, n = F.xxhash64(key), "__strata_digest", "__strata_n"
    again = stored(keys.groupBy(digest.alias(name)).agg(F.count(F.lit(1)).alias(n))
                   .filter(F.col(n) > 1).select(name), "repeated_digests")
    if again.limit(SIEVE_DIGESTS + 1).count() > SIEVE_DIGESTS:
        return keys
    return keys.join(F.broadcast(again), digest == again[name], "left_semi")
