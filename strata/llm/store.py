"""Written tables in the shared folder, used to cut lineage between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


#: Spark then deletes a query's shuffle files as it ends, not when the driver collects garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once under spark.checkpoint.dir and read again, and the folder. The shuffle
    files that this took are deleted at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under spark.checkpoint.dir and read again."""
    return kept(df, name)[0]


def broadcast_if_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` (a written table of narrow rows), hinted for broadcast if it has at most ``rows`` rows;
    otherwise Spark joins it by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
