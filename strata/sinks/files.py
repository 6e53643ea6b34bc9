"""File sinks: NDJSON records, quarantine and dead-letter data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.sources.records import DATA_COLS_META, ENVELOPE, RECORD_ID, RECORD_SOURCE, RECORD_TS


def _or(df: DataFrame, name: str, default):
    return F.col(name) if name in df.columns else default


def records_to_json_struct(records: DataFrame) -> DataFrame:
    """One column ``value``: ``{"ID","Source","Timestamp","Data","Metadata"}`` as JSON.

    Data maps every data column to its text; a NULL field (a column the
    record's source does not have, after a union) is left out of the map, as
    a per-source record would not carry it. Metadata holds row_number and
    file. Envelope NULLs are written as JSON null.
    """
    data_cols = [c for c in records.columns if c not in ENVELOPE]
    data = F.map_filter(
        F.create_map(*[x for c in data_cols for x in (F.lit(c), F.col(c).cast("string"))]),
        lambda k, v: v.isNotNull()) if data_cols else F.create_map().cast("map<string,string>")
    meta_pairs = [x for c, key in DATA_COLS_META if c in records.columns
                  for x in (F.lit(key), F.col(c).cast("string"))]
    meta = F.create_map(*meta_pairs) if meta_pairs else F.create_map().cast("map<string,string>")
    rec = F.struct(
        _or(records, RECORD_ID, F.lit(None).cast("string")).alias("ID"),
        _or(records, RECORD_SOURCE, F.lit(None).cast("string")).alias("Source"),
        _or(records, RECORD_TS, F.current_timestamp()).alias("Timestamp"),
        data.alias("Data"), meta.alias("Metadata"))
    return records.select(F.to_json(rec, {"ignoreNullFields": "false"}).alias("value"))


def write_ndjson(records: DataFrame, path: str) -> dict:
    """Append records as NDJSON lines; returns the observed row count."""
    obs = Observation("ndjson")
    out = records_to_json_struct(records).observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("append").text(path)
    return {"rows_written": int(obs.get["rows"]), "path": path}


def write_quarantine(corrupt: DataFrame, quarantine_root: str, source_name: str) -> dict:
    """Append corrupt rows as parquet under ``{root}/{source}/corrupt/``
    (rebalanced: few rows should not make one file per task)."""
    path = f"{quarantine_root.rstrip('/')}/{source_name}/corrupt/"
    obs = Observation(f"corrupt_{source_name}")
    (corrupt.hint("rebalance").observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").parquet(path))
    return {"rows_quarantined": int(obs.get["rows"]), "path": path}


def write_rejects(rejects: DataFrame, path: str) -> dict:
    """Append rejected input (with its ``_error``) to a dead-letter dataset."""
    obs = Observation("rejects")
    (rejects.hint("rebalance").observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").parquet(path))
    return {"rows_rejected": int(obs.get["rows"]), "path": path}
