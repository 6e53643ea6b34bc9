"""Declared schemas of the raw sources and required columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("status", T.StringType()),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("properties", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

TRANSACTION_COLUMNS = ("customer_id", "amount", "txn_date")


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "frame") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}")
