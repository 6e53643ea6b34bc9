"""Shared column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import months_between_dates, normalize_text, trim_unicode

# Unicode White_Space code points (the set Go's TrimSpace strips).
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
               *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def test_trim_unicode_strips_every_white_space(spark):
    edge = "".join(chr(c) for c in WHITE_SPACE)
    df = spark.createDataFrame([(edge + "a b" + edge,), ("​x",)], "s string")
    out = [r.t for r in df.select(trim_unicode(F.col("s")).alias("t")).collect()]
    assert out == ["a b", "​x"]  # zero-width space is not white space


def test_normalize_text(spark):
    df = spark.createDataFrame([("　 MiXeD@Case.COM\t",)], "s string")
    assert df.select(normalize_text(F.col("s")).alias("t")).first().t == "mixed@case.com"


@pytest.mark.parametrize("end,start,months", [
    (dt.date(2024, 3, 31), dt.date(2024, 2, 29), 1.0),      # both month ends
    (dt.date(2024, 3, 15), dt.date(2024, 1, 15), 2.0),      # same day of month
    (dt.date(2024, 3, 1), dt.date(2024, 1, 31), 1.03225806),
    (dt.date(2023, 1, 1), dt.date(2024, 1, 1), -12.0),
])
def test_months_between_dates(spark, end, start, months):
    df = spark.createDataFrame([(end, start)], "e date, s date")
    got = df.select(months_between_dates(F.col("e"), F.col("s")).alias("m")).first().m
    assert got == pytest.approx(months)
