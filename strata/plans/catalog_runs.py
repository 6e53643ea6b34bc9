"""More registered queries: streams, handlers, layers, configuration, incremental tables.

Same contract as ``strata.plans.catalog``, which imports this module.
"""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import datasets as ds
from strata.config import load_config
from strata.operators import columns, customers, dedup, quality, summary
from strata.plans import catalog as base
from strata.plans import lakehouse
from strata.plans.catalog import register
from strata.plans.records import RecordFlow, run_from_config, run_records
from strata.session import scratch_path
from strata.sinks import tables
from strata.streaming.records import StreamSource, forget_last_commits, read_ndjson_records, run_record_streams

# --- streams ------------------------------------------------------------------


@register("stream_mixed_headers", """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS username,
       CAST(c_nationkey AS VARCHAR) AS nation, 'customers' AS _record_source FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, 'customers' FROM supplier""")
def stream_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of csv_records_mixed_headers as one stream, from a config that names no columns."""
    root, out = scratch_path(spark, "mixed_stream"), scratch_path(spark, "mixed_stream_out")
    options = {"header": "true", "quote": ""}
    (ds.customer_records(spark, sf_dir).select("user_id", "username", "nation")
     .write.options(**options).csv(f"{root}/a"))
    ds.supplier_records(spark, sf_dir).select("username", "user_id").write.options(**options).csv(f"{root}/b")
    config = {"sources": [{"name": "customers", "type": "csv", "location": f"{root}/*"}],
              "destination": {"type": "jsonfile", "connection_string": out},
              "pipeline": {"max_files_per_trigger": 100}}
    run_from_config(spark, config, stream=True, checkpoint=scratch_path(spark, "mixed_stream_ckpt"))
    data = F.col("Data")
    return read_ndjson_records(spark, out).select(
        *[data[f].alias(f) for f in ("user_id", "username", "nation")], F.col("Source").alias("_record_source"))


@register("stream_late_rows", """SELECT 'written' AS part, CAST(c_custkey AS VARCHAR) AS user_id, NULL AS _error
FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'rejected', CAST(c_custkey AS VARCHAR), 'later than the watermark' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'rejected', CAST(s_suppkey AS VARCHAR), 'no time in field ''at''' FROM supplier""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the customers comes days after the watermark has passed their time, and suppliers
    have no time: both are in the dead letter, and every row is accounted for."""
    root, out, dead, checkpoint = (scratch_path(spark, f"late_{x}") for x in ("in", "out", "dead", "ckpt"))
    recs, k = ds.customer_records(spark, sf_dir).select("user_id"), F.col("user_id").cast("long") % 3
    flow = RecordFlow().deduplicate("once", "user_id", event_time="at", watermark="1 hour")
    source = [StreamSource("customers", f"{root}/*")]

    def deliver(n: int, rows: DataFrame) -> int:
        rows.write.options(header="true").csv(f"{root}/{n}")
        m = run_record_streams(spark, source, flow, out, checkpoint, dead, max_files_per_trigger=1000).metrics
        if m.records_filtered:
            raise RuntimeError(f"{m.records_filtered} rows are neither written nor rejected")
        return m.records_read

    read = deliver(1, recs.filter(k == 1).withColumn("at", F.lit("2024-01-05 00:00:00")))
    late = recs.filter(k == 0).withColumn("at", F.lit("2024-01-04 23:00:00"))
    fresh = recs.filter(k == 2).withColumn("at", F.lit("2024-01-04 23:00:01"))
    undated = ds.supplier_records(spark, sf_dir).select("user_id", F.lit("soon").alias("at"))
    read += deliver(2, late.unionByName(fresh).unionByName(undated))
    kept = read_ndjson_records(spark, out).select(F.lit("written").alias("part"), F.col("Data")["user_id"].alias("user_id"),
                                                  F.lit(None).cast("string").alias("_error"))
    return kept.unionByName(spark.read.parquet(dead).select(
        F.lit("rejected").alias("part"), F.col("fields")["user_id"].alias("user_id"), "_error"))


@register("stream_replay", f"""WITH {base.RECORDS_SQL}
SELECT user_id, username, CAST(2 AS BIGINT) AS streams_replayed FROM recs""")
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch of each stream loses its commit record, as in a crash, and is run again under
    its old id: the output does not change."""
    root, out, checkpoint = (scratch_path(spark, f"replay_{x}") for x in ("in", "out", "ckpt"))
    recs = ds.customer_records(spark, sf_dir).select("user_id", "username")
    for n in range(2):  # every key twice
        recs.write.options(header="true").csv(f"{root}/{n}")
    args = (spark, [StreamSource("customers", f"{root}/*")], RecordFlow().deduplicate("once", "user_id"), out, checkpoint)
    run_record_streams(*args, max_files_per_trigger=1000, keep_published=True)
    n = forget_last_commits(spark, checkpoint)
    run_record_streams(*args, max_files_per_trigger=1000, keep_published=True)
    data = F.col("Data")
    return read_ndjson_records(spark, out).select(data["user_id"].alias("user_id"), data["username"].alias("username"),
                                                  F.lit(n).cast("long").alias("streams_replayed"))


@register("stream_trigger_interval", f"""WITH {base.RECORDS_SQL} SELECT user_id, username FROM recs""")
def stream_trigger_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams that run on an interval until the intake has nothing new."""
    root, out = scratch_path(spark, "interval_in"), scratch_path(spark, "interval_out")
    recs = ds.customer_records(spark, sf_dir).select("user_id", "username")
    for n in range(2):
        recs.write.options(header="true").csv(f"{root}/{n}")
    run_record_streams(spark, [StreamSource("customers", f"{root}/*")], RecordFlow().deduplicate("once", "user_id"),
                       out, scratch_path(spark, "interval_ckpt"), max_files_per_trigger=1000,
                       processing_time="1 second", stop_when_idle=True)
    data = F.col("Data")
    return read_ndjson_records(spark, out).select(data["user_id"].alias("user_id"), data["username"].alias("username"))


# --- handlers, layers, configuration -------------------------------------------


@register("flow_error_handler", """SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'field count differs from header' AS _error
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'field ''status'' not found in record' FROM supplier""")
def flow_error_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the error handler of a run is given."""
    path = scratch_path(spark, "handled")
    flow = RecordFlow().filter("not_building", "status", "neq", "BUILDING")
    flow.set_error_handler(lambda rows: rows.select("user_id", "_error").write.parquet(path))
    run_records(spark, base._flow_sources(spark, sf_dir), flow, scratch_path(spark, "handled_out"))
    return spark.read.parquet(path)


@register("layer_selection", f"""SELECT 'bronze' AS run, 'raw_transactions' AS name, (SELECT count(*) FROM orders) AS rows_written
UNION ALL SELECT 'silver', 'events', (SELECT count(*) FROM events WHERE user_id IS NOT NULL)
UNION ALL SELECT 'silver', 'customers', (SELECT count(*) FROM customer WHERE c_custkey IS NOT NULL)
UNION ALL SELECT 'silver', 'transactions',
  (SELECT count(*) FROM ({base.ORDERS_SQL}) WHERE customer_id IS NOT NULL AND amount > 0)
UNION ALL SELECT 'gold', 'daily_summary', (SELECT count(*) FROM ({base.DAILY_SQL}))""")
def layer_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layers of one job run one at a time; each does its own part only."""
    config, rows = base.job_config(spark, sf_dir), []
    for layer, names in (("bronze", ["raw_transactions"]), ("silver", ["events", "customers", "transactions"]),
                         ("gold", ["daily_summary"])):
        result = lakehouse.run(spark, config, [layer], as_of=base.CLV_AS_OF, ingested_at=base.JOB_INGESTED_AT)
        if list(result["layers"]) != [layer]:
            raise RuntimeError(f"layers {list(result['layers'])} ran, not {layer}")
        rows += [(layer, n, result["layers"][layer][n]["rows_written"]) for n in names]
    return spark.createDataFrame(rows, "run string, name string, rows_written long")


OVERLAY = {"power_events": 60, "active_events": 40}


@register("config_overlay", f"""WITH {base.CUST_SQL}, {base.METRICS_SQL}
SELECT cust.customer_id, CASE WHEN coalesce(m.total_events, 0) >= {OVERLAY['power_events']}
         AND coalesce(m.distinct_event_types, 0) >= 5 THEN 'power_user'
       WHEN coalesce(m.total_events, 0) >= {OVERLAY['active_events']} THEN 'active' ELSE 'dormant' END AS segment
FROM cust LEFT JOIN m ON cust.customer_id = m.customer_id""")
def config_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments by thresholds from a file and an environment overlay over the defaults."""
    with tempfile.TemporaryDirectory() as folder:  # read by this process only
        Path(folder, "job.json").write_text(json.dumps({"segments": {**OVERLAY, "power_events": 1}}))
        Path(folder, "prod.json").write_text(json.dumps({"segments": {"power_events": OVERLAY["power_events"]}}))
        thresholds = load_config(f"{folder}/job.json", "prod")["segments"]
    enriched = customers.enrich_customers(ds.customers(spark, sf_dir), ds.events(spark, sf_dir))
    return customers.compute_customer_segments(enriched, **thresholds).select("customer_id", "segment")


@register("quality_unknown_rule", """SELECT DISTINCT event_type AS rule, true AS refused FROM events
UNION ALL SELECT 'not_null', false""")
def quality_unknown_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that do not exist (named like the event types) are refused, others run."""
    events = ds.events(spark, sf_dir)
    rules = [r.event_type for r in events.select("event_type").distinct().collect()] + ["not_null"]
    rows = []
    for rule in rules:
        try:
            quality.run_checks(events, [{"name": "c", "column": "event_id", "rule": rule}])
            rows.append((rule, False))
        except ValueError:
            rows.append((rule, True))
    return spark.createDataFrame(rows, "rule string, refused boolean")


@register("ingestion_today", f"""WITH {base.CUST_SQL}, {base.TXN_SQL}
SELECT cust.customer_id, t.first_purchase, true AS ingested_now,
       CASE WHEN t.customer_id IS NOT NULL THEN true END AS months_run_to_today
FROM cust LEFT JOIN t ON cust.customer_id = t.customer_id""")
def ingestion_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing pinned: rows are stamped with the time of the run, and customer value runs to today."""
    clv = customers.build_customer_lifetime_value(ds.customers(spark, sf_dir), ds.transactions(spark, sf_dir))
    out = columns.add_ingestion_metadata(clv, "customers")
    age = F.months_between(F.current_date(), F.col("first_purchase"))
    return out.select("customer_id", "first_purchase",
                      (F.abs(F.unix_timestamp("_ingested_at") - F.unix_timestamp(F.current_timestamp())) < 3600)
                      .alias("ingested_now"),
                      (F.abs(F.col("months_since_first_purchase") - age) < 1.5).alias("months_run_to_today"))


# --- incremental tables ----------------------------------------------------------


DELIVERED_SQL = f"""{base.CUST_SQL}, d AS (
  SELECT e.user_id AS customer_id, e.ts + to_days(CAST(e.days AS INTEGER)) AS happened,
         CASE WHEN e.days > 0 THEN upper(e.event_type) ELSE e.event_type END AS event_type,
         json_extract_string(e.props, '$.k') AS session
  FROM (SELECT *, CASE WHEN event_id % 2 = 1 THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS days FROM events) e
  WHERE e.user_id IS NOT NULL)"""


@register("gold_after_deliveries", f"""WITH {DELIVERED_SQL}
SELECT CAST(happened AS DATE) AS event_date, event_type, region, count(*) AS event_count,
       count(DISTINCT d.customer_id) AS unique_customers, count(DISTINCT session) AS unique_sessions
FROM d LEFT JOIN cust ON d.customer_id = cust.customer_id GROUP BY ALL""")
def gold_after_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after each of two deliveries; the second recomputes the changed days only."""
    config = base._run_deliveries(spark, sf_dir, ("bronze", "silver", "gold"))
    return tables.read_version(spark, f"{config['layers']['gold']['path']}/daily_summary")


@register("customers_after_deliveries", f"""WITH {DELIVERED_SQL}, x AS (
  SELECT customer_id, count(*) AS n, count(DISTINCT event_type) AS types, min(happened) AS a, max(happened) AS z FROM d GROUP BY 1)
SELECT CAST(cust.customer_id AS VARCHAR) AS customer_id, region, coalesce(n, 0) AS total_events,
       coalesce(types, 0) AS distinct_event_types, a AS first_event_at, z AS last_event_at
FROM cust LEFT JOIN x ON cust.customer_id = x.customer_id""")
def customers_after_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver customers after the same: the second run merges metrics kept by day."""
    config = base._run_deliveries(spark, sf_dir)
    out = tables.read_version(spark, f"{config['layers']['silver']['path']}/customers")
    return out.select("customer_id", "region", "total_events", "distinct_event_types",
                      *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_event_at", "last_event_at")])


@register("event_metrics_by_day", f"WITH {base.METRICS_SQL} SELECT * FROM m")
def event_metrics_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event metrics added up from those of days."""
    return customers.merge_event_metrics(customers.daily_event_metrics(ds.events(spark, sf_dir)))


@register("monthly_summary_sketched", f"""WITH {base.CUST_SQL}
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, region, count(*) AS event_count, true AS customers_close,
       true AS sessions_close
FROM events LEFT JOIN cust ON user_id = customer_id GROUP BY ALL""")
def monthly_summary_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers and sessions of months from the sketches of days, and whether they are
    near the exact ones, which need the events again."""
    events, regions = base._events_with_sessions(spark, sf_dir), ds.customers(spark, sf_dir)
    month = F.trunc("event_date", "month").cast("date").alias("month")
    near = summary.merge_sketches(summary.daily_sketches(events, regions, unique=True), month, "region")
    exact = (summary.with_region(events, regions, unique=True)
             .groupBy(F.trunc(F.to_date("event_timestamp"), "month").cast("date").alias("m"), F.col("region").alias("r"))
             .agg(F.countDistinct("customer_id").alias("c"), F.countDistinct("session_id").alias("s")))

    def close(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), base.SKETCH_ERROR * F.col(b))

    same = near["month"].eqNullSafe(exact["m"]) & near["region"].eqNullSafe(exact["r"])
    return near.join(exact, same).select("month", "region", "event_count", close("unique_customers", "c").alias("customers_close"),
                                         close("unique_sessions", "s").alias("sessions_close"))


# --- unique keys by digest -------------------------------------------------------

LINE_KEY_SQL = "concat_ws('-', l_orderkey, l_partkey)"


def _keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"))
    return ds.table(spark, sf_dir, "lineitem").withColumn("line_key", key)


@register("unique_report_sieved", f"""SELECT {LINE_KEY_SQL} AS line_key, count(*) AS dup_count
FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def unique_report_sieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one order with the same part, found by key digests before full keys."""
    return dedup.duplicate_keys(_keyed_lines(spark, sf_dir), "line_key", sieve=True)


@register("quality_report_sieved", f"""WITH f AS (SELECT {LINE_KEY_SQL} AS k, coalesce(l_quantity <= 10, true) AS f1
  FROM lineitem),
tot AS (SELECT count(*) AS n, count_if(f1) AS c1 FROM f),
u2 AS (SELECT count(*) AS c2 FROM (SELECT k FROM f WHERE NOT f1 GROUP BY k HAVING count(*) > 1))
{base._report_row(1, 'more_than_ten', 'l_quantity', 'greater_than', 'critical', 'ok', 'n', 'c1')} FROM tot
UNION ALL {base._report_row(2, 'one_line_per_part', 'line_key', 'unique', 'warning', 'ok', 'n', 'c2')} FROM tot, u2""")
def quality_report_sieved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unique check counts keys by digest among the lines that the first check leaves."""
    checks = [{"name": "more_than_ten", "column": "l_quantity", "rule": "greater_than", "value": 10,
               "severity": "critical"},
              {"name": "one_line_per_part", "column": "line_key", "rule": "unique", "sieve": True}]
    return quality.run_checks(_keyed_lines(spark, sf_dir), checks).report_frame()
