"""Column-level operators: naming, audit columns, JSON properties, renames."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import __version__
from strata.functions.strings import normalize_text

# Property keys the event payload carries (the reference's declared keys).
EVENT_PROPERTY_KEYS = ("page_url", "device_type", "session_id")


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case, and turn spaces and hyphens into underscores.

    All names change in one projection. Two raw names that end up equal raise
    ``ValueError`` instead of producing an ambiguous column later.
    """
    names = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {raw!r} both become {new!r}")
        seen[new] = raw
    if names == df.columns:
        return df
    return df.toDF(*names)


def add_ingestion_metadata(df: DataFrame, source_name: str,
                           ingested_at: str | _dt.datetime | None = None,
                           pipeline_version: str = __version__) -> DataFrame:
    """Audit columns ``_ingested_at``, ``_source``, ``_pipeline_version``.

    ``ingested_at`` pins the timestamp (replays, backfills); by default it is
    the query's start time.
    """
    ts = F.current_timestamp() if ingested_at is None else F.lit(str(ingested_at)).cast("timestamp")
    return df.withColumns({
        "_ingested_at": ts,
        "_source": F.lit(source_name),
        "_pipeline_version": F.lit(pipeline_version),
    })


def parse_event_properties(df: DataFrame, keys: Iterable[str] = EVENT_PROPERTY_KEYS,
                           column: str = "properties", keep: bool = False) -> DataFrame:
    """Pull keys of a JSON object column out as string columns.

    Values that are numbers or nested objects come back as their JSON text;
    malformed JSON gives NULL for every key.
    """
    parsed = F.from_json(F.col(column), "map<string,string>")
    out = df.withColumns({k: parsed.getItem(k) for k in keys})
    return out if keep else out.drop(column)


def rename_fields(df: DataFrame, mappings: Mapping[str, str]) -> DataFrame:
    """Rename columns, ``mappings`` is new name -> old name.

    Renames apply simultaneously; an old name that is absent is ignored. A new
    name that already exists is replaced by the renamed column.
    """
    present = {new: old for new, old in mappings.items() if old in df.columns}
    if not present:
        return df
    olds = set(present.values())
    cols = []
    for c in df.columns:
        if c in present:
            cols.append(F.col(present[c]).alias(c))
        elif c not in olds:
            cols.append(F.col(c))
        for new, old in present.items():
            if old == c and new not in df.columns:
                cols.append(F.col(old).alias(new))
    return df.select(*cols)


def normalize_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Lower-case and trim listed string columns; others and absent names untouched."""
    types = dict(df.dtypes)
    todo = {f: normalize_text(F.col(f)) for f in fields if types.get(f) == "string"}
    return df.withColumns(todo) if todo else df
