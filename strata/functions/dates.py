"""Date expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: str | _dt.date | None) -> Column:
    """A fixed reporting date, or today's date when none is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def months_between_dates(end: Column, start: Column) -> Column:
    """Spark's months_between (rounded to 8 digits) on timestamps."""
    return F.months_between(end.cast("timestamp"), start.cast("timestamp"))
