"""Gold daily summary and the region lookup it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _regions(customers: DataFrame, key: str, region: str, unique: bool) -> DataFrame:
    return customers.select(key, region) if unique else \
        customers.groupBy(key).agg(F.max(region).alias(region))


def with_region(events: DataFrame, customers: DataFrame, key: str = "customer_id",
                region: str = "region", unique: bool = False) -> DataFrame:
    """Events left-joined to one region per customer.

    Unless the key is known to be ``unique`` the dimension is made so first
    (greatest region, so the pick is deterministic), and a duplicated key
    cannot multiply event rows. AQE picks the join and splits skewed keys.
    """
    return events.join(_regions(customers, key, region, unique), on=key, how="left")


def build_daily_summary(events: DataFrame, ts_col: str = "event_timestamp",
                        key: str = "customer_id", session_col: str = "session_id",
                        approx: bool = False, sort: bool = False, rsd: float = 0.05) -> DataFrame:
    """Per (event_date, event_type, region): events, distinct customers and sessions.

    ``approx`` swaps the exact distinct counts for HyperLogLog sketches (no
    Expand, one pass) with standard error ``rsd``. No global sort unless ``sort`` is set.
    """
    distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    out = (
        events.withColumn("event_date", F.to_date(F.col(ts_col)))
        .groupBy("event_date", "event_type", "region")
        .agg(F.count(F.lit(1)).alias("event_count"),
             distinct(key).alias("unique_customers"),
             distinct(session_col).alias("unique_sessions"))
    )
    return out.orderBy("event_date", "event_type") if sort else out


def daily_summary_by_region(events: DataFrame, customers: DataFrame,
                            ts_col: str = "event_timestamp", key: str = "customer_id",
                            session_col: str = "session_id", region: str = "region",
                            approx: bool = False, unique: bool = False,
                            collapse: bool = False) -> DataFrame:
    """The daily summary from raw events and the customer dimension.

    By default events are joined to their region, then summarized.
    ``collapse`` first reduces them to one row per (date, type, customer,
    session) with a count: fewer rows reach the join where sessions have many
    events of a type, an extra shuffle where they don't. Both give the same rows.
    """
    if not collapse:
        return build_daily_summary(with_region(events, customers, key, region, unique), ts_col, key,
                                   session_col, approx)
    distinct = F.approx_count_distinct if approx else F.countDistinct
    visits = (events.groupBy(F.to_date(F.col(ts_col)).alias("event_date"), "event_type",
                             key, session_col)
              .agg(F.count(F.lit(1)).alias("__events")))
    return (visits.join(_regions(customers, key, region, unique), on=key, how="left")
            .groupBy("event_date", "event_type", region)
            .agg(F.sum("__events").alias("event_count"),
                 distinct(key).alias("unique_customers"),
                 distinct(session_col).alias("unique_sessions")))


def daily_sketches(events: DataFrame, customers: DataFrame, ts_col: str = "event_timestamp",
                   key: str = "customer_id", session_col: str = "session_id", region: str = "region",
                   unique: bool = False, lg_k: int = 12) -> DataFrame:
    """The daily summary with mergeable distinct counts: per (event_date, event_type, region) the
    number of events and HyperLogLog sketches of customers and sessions.

    Unlike counts, sketches of days add up (``merge_sketches``), so a week or a month needs
    no second look at the events. Size per row: at most 2**lg_k bytes or so a sketch.
    """
    joined = with_region(events, customers, key, region, unique)
    return (joined.withColumn("event_date", F.to_date(F.col(ts_col)))
            .groupBy("event_date", "event_type", region)
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.hll_sketch_agg(F.col(key).cast("string"), lg_k).alias("customers"),
                 F.hll_sketch_agg(F.col(session_col).cast("string"), lg_k).alias("sessions")))


def merge_sketches(sketches: DataFrame, *by) -> DataFrame:
    """Events, estimated distinct customers and sessions per ``by`` (columns of ``daily_sketches``
    or expressions of them, e.g. the month); no ``by``: of all."""
    return sketches.groupBy(*by).agg(
        F.sum("event_count").alias("event_count"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"),
        F.hll_sketch_estimate(F.hll_union_agg("sessions")).alias("unique_sessions"))
