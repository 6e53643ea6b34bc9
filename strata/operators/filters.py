"""Record filters: eq, neq, contains on text; gt, lt on parsed numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numbers import go_float, numeric_compare
from strata.functions.strings import as_text

OPERATORS = ("eq", "neq", "contains", "gt", "lt")


def record_predicate(df: DataFrame, field: str, operator: str, value: str):
    """The keep-condition of a record filter (never NULL)."""
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator: {operator}")
    if field not in df.columns:
        raise ValueError(f"field {field!r} not found in records")
    text = as_text(F.col(field))
    if operator == "eq":
        return text == F.lit(value)
    if operator == "neq":
        return text != F.lit(value)
    if operator == "contains":
        return text.contains(F.lit(value))
    return numeric_compare(go_float(text), go_float(F.lit(value)), operator)


def filter_records(df: DataFrame, field: str, operator: str, value: str) -> DataFrame:
    """Keep records whose ``field`` satisfies ``operator value``.

    Values are compared as text; for gt and lt both sides are parsed as
    floats, text that does not parse counts as 0, and NaN never matches.
    An unknown operator or missing field raises ``ValueError``.
    """
    return df.filter(record_predicate(df, field, operator, value))


def split_records(df: DataFrame, field: str, operator: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects) of a record filter after a union of sources.

    A record whose source lacks ``field`` has NULL there (a field that is
    present is never NULL in a record): it is an error, not merely filtered out.
    """
    error = F.lit(f"field {field!r} not found in record")
    if field not in df.columns:
        record_predicate(df.withColumn(field, F.lit("")), field, operator, value)  # checks the operator
        return df.limit(0), df.withColumn("_error", error)
    keep = record_predicate(df, field, operator, value)
    return (df.filter(F.col(field).isNotNull() & keep),
            df.filter(F.col(field).isNull()).withColumn("_error", error))


def filter_record_maps(df: DataFrame, field: str, operator: str, value: str,
                       data_col: str = "Data") -> tuple[DataFrame, DataFrame]:
    """The same filter on map-shaped records (``Data: map<string,string>``).

    Returns (kept, rejects): a row whose map lacks ``field`` is an error, not
    merely filtered out, and goes to ``rejects`` with ``_error``. An unknown
    operator raises ``ValueError``.
    """
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator: {operator}")
    data = F.col(data_col)
    present = F.coalesce(F.map_contains_key(data, F.lit(field)), F.lit(False))
    text = F.coalesce(data.getItem(field), F.lit(""))
    if operator == "eq":
        keep = text == F.lit(value)
    elif operator == "neq":
        keep = text != F.lit(value)
    elif operator == "contains":
        keep = text.contains(F.lit(value))
    else:
        keep = numeric_compare(go_float(text), go_float(F.lit(value)), operator)
    kept = df.filter(present & keep)
    rejects = df.filter(~present).withColumn(
        "_error", F.lit(f"field {field!r} not found in record"))
    return kept, rejects
