"""Hot keys: one key (or NULL) holding a third of the rows gives right answers.

Spark spreads the work (partial WindowGroupLimit, map-side combine, salted
NULL keys, AQE skew join); these tests pin the results on such inputs.
"""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import dedup
from strata.operators.quality import run_checks
from strata.sinks import tables


def _hot(spark, n=3000, hot=None):
    """ids 0..n-1; a third of the rows share key ``hot``, the rest unique."""
    k = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id").cast("string"))
    return spark.range(n).select(
        F.col("id"), k.alias("k"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(secs=F.col("id").cast("int"))).alias("ts"))


def test_latest_per_key_hot_key(spark):
    df = _hot(spark, hot="HOT").repartition(8)
    out = {r.k: r.id for r in dedup.latest_per_key(df, "k", "ts").collect()}
    assert out["HOT"] == 2997 and len(out) == 2001


def test_first_per_key_hot_null_key(spark):
    df = _hot(spark, hot=None).repartition(8)
    out = dedup.first_per_key(df, "k", ["ts"])
    assert out.filter(F.col("k").isNull()).count() == 1000  # NULL keys all pass
    assert out.count() == 3000


def test_merge_hot_target_key_and_null_keys(spark):
    target = _hot(spark, hot="HOT").select("k", "id")
    target = target.unionByName(_hot(spark, hot=None).select("k", (F.col("id") + 10_000).alias("id"))
                                .filter(F.col("k").isNull()))
    source = spark.createDataFrame([("HOT", -1), ("new", -2), (None, -3)], "k string, id long")
    out = tables.merge_frames(target, source, "k")
    counts = {r[tables.ACTION]: r["count"] for r in out.groupBy(tables.ACTION).count().collect()}
    # every HOT target row is updated; NULL-key rows of both sides never match
    assert counts == {"updated": 1000, "kept": 3000, "inserted": 2}
    assert out.filter(F.col("k") == "HOT").select("id").distinct().collect()[0].id == -1


def test_unique_check_hot_key(spark):
    df = _hot(spark, hot="HOT")
    v = run_checks(df, [{"name": "u", "column": "k", "rule": "unique"}])
    assert v.report()[0]["failing_rows"] == 1
