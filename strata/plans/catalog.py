"""Registered queries and their DuckDB oracles.

Each query reads the driver's tables (or files Spark derives from them) in
full and returns a DataFrame; ``ORACLE`` holds the same result as DuckDB SQL
over the tables registered as views. Column names match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import datasets as ds
from strata.config import load_config
from strata.operators import columns, customers, dedup, filters, quality, summary
from strata.plans import fixtures, lakehouse
from strata.plans.records import RecordFlow, run_records
from strata.schemas import EVENT_SCHEMA
from strata.session import scratch_path
from strata.sinks import tables
from strata.sources import files as src_files
from strata.sources import records as src_records
from strata.streaming.records import read_ndjson_records, run_record_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


# --- shared SQL pieces ---------------------------------------------------

CUST_SQL = """cust AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS first_name, r.r_name AS region,
         c.c_mktsegment AS status, c.c_acctbal AS balance
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

EVENTS_SQL = """ev AS (
  SELECT event_id, user_id AS customer_id, event_type, ts AS event_timestamp,
         value AS amount, props AS properties
  FROM events)"""

RECORDS_SQL = """recs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS status,
         ' ' || replace(c_name, '#', '.') || '@Example.Com ' AS email,
         c_name AS username, CAST(c_acctbal AS VARCHAR) AS balance,
         CAST(c_nationkey AS VARCHAR) AS nation
  FROM customer)"""

FLOAT_RE = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:[+-]?(inf|infinity)|nan))$"


def go_float_sql(expr: str) -> str:
    return (f"(CASE WHEN regexp_full_match(coalesce({expr}, ''), '{FLOAT_RE}') "
            f"THEN TRY_CAST({expr} AS DOUBLE) ELSE 0.0 END)")


# Customer 360 thresholds: the busiest test user has under 100 events, so
# the power-user cut is lowered to make every segment appear.
POWER_EVENTS, POWER_TYPES, ACTIVE_EVENTS = 70, 5, 10

SEGMENT_SQL = f"""CASE WHEN coalesce(m.total_events, 0) >= {POWER_EVENTS}
       AND coalesce(m.distinct_event_types, 0) >= {POWER_TYPES} THEN 'power_user'
     WHEN coalesce(m.total_events, 0) >= {ACTIVE_EVENTS} THEN 'active'
     ELSE 'dormant' END"""

METRICS_SQL = """m AS (
  SELECT user_id AS customer_id, count(*) AS total_events,
         count(DISTINCT event_type) AS distinct_event_types,
         max(ts) AS last_event_at, min(ts) AS first_event_at
  FROM events GROUP BY user_id)"""


def _customer_360(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    enriched = customers.enrich_customers(ds.customers(spark, sf_dir),
                                          ds.events(spark, sf_dir), how=how)
    return customers.compute_customer_segments(enriched, POWER_EVENTS, POWER_TYPES,
                                               ACTIVE_EVENTS)


@register("customer_360", f"""WITH {CUST_SQL}, {METRICS_SQL}
SELECT cust.*, coalesce(m.total_events, 0) AS total_events,
       coalesce(m.distinct_event_types, 0) AS distinct_event_types,
       m.last_event_at, m.first_event_at, {SEGMENT_SQL} AS segment
FROM cust LEFT JOIN m ON cust.customer_id = m.customer_id""")
def customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_360(spark, sf_dir, "left")


@register("customer_360_inner", f"""WITH {CUST_SQL}, {METRICS_SQL}
SELECT cust.*, m.total_events, m.distinct_event_types,
       m.last_event_at, m.first_event_at, {SEGMENT_SQL} AS segment
FROM cust JOIN m ON cust.customer_id = m.customer_id""")
def customer_360_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_360(spark, sf_dir, "inner")


@register("latest_event_per_user", f"""WITH {EVENTS_SQL}
SELECT event_id, customer_id, event_type, event_timestamp, amount, properties
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY event_timestamp DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM ev)
WHERE rn = 1""")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_per_key(ds.events(spark, sf_dir), key="customer_id",
                                order="event_timestamp", tie_breakers=["event_id"])


@register("dedup_injected_events", f"""WITH {EVENTS_SQL}, allv AS (
  SELECT *, 'original' AS batch FROM ev
  UNION ALL
  SELECT event_id, customer_id, event_type, event_timestamp + INTERVAL 1 HOUR,
         amount * 2, properties, 'replay' FROM ev WHERE event_type IN ('click', 'purchase'))
SELECT event_id, customer_id, event_type, event_timestamp, amount, properties, batch
FROM (SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY event_timestamp DESC NULLS LAST, batch DESC NULLS LAST) AS rn FROM allv)
WHERE rn = 1""")
def dedup_injected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = ds.events(spark, sf_dir)
    replay = (ev.filter(F.col("event_type").isin("click", "purchase"))
              .withColumns({"event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 1 HOUR"),
                            "amount": F.col("amount") * 2, "batch": F.lit("replay")}))
    both = ev.withColumn("batch", F.lit("original")).unionByName(replay)
    return dedup.latest_per_key(both, key="event_id", order="event_timestamp",
                                tie_breakers=["batch"])


@register("event_properties", f"""WITH {EVENTS_SQL}
SELECT event_id, customer_id, event_type, event_timestamp, amount,
       json_extract_string(properties, '$.k') AS k
FROM ev""")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.parse_event_properties(ds.events(spark, sf_dir), keys=["k"])


def _events_with_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = columns.parse_event_properties(ds.events(spark, sf_dir), keys=["k"])
    return ev.withColumnRenamed("k", "session_id")


DAILY_SQL = f"""WITH {CUST_SQL},
dim AS (SELECT customer_id, max(region) AS region FROM cust GROUP BY customer_id),
e AS (SELECT user_id AS customer_id, event_type, ts,
             json_extract_string(props, '$.k') AS session_id FROM events)
SELECT CAST(e.ts AS DATE) AS event_date, e.event_type, dim.region,
       count(*) AS event_count, count(DISTINCT e.customer_id) AS unique_customers,
       count(DISTINCT e.session_id) AS unique_sessions
FROM e LEFT JOIN dim ON e.customer_id = dim.customer_id
GROUP BY CAST(e.ts AS DATE), e.event_type, dim.region"""


@register("daily_summary", DAILY_SQL)
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events joined to the region of their customer (a known unique key), then summarized."""
    return summary.daily_summary_by_region(_events_with_sessions(spark, sf_dir),
                                           ds.customers(spark, sf_dir), unique=True)


@register("daily_summary_collapsed", DAILY_SQL)
def daily_summary_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events first reduced to one row per (date, type, customer, session)."""
    return summary.daily_summary_by_region(_events_with_sessions(spark, sf_dir),
                                           ds.customers(spark, sf_dir), collapse=True)


@register("daily_summary_join_first", DAILY_SQL)
def daily_summary_join_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's plan shape: join every event to its region, then summarize."""
    joined = summary.with_region(_events_with_sessions(spark, sf_dir), ds.customers(spark, sf_dir))
    return summary.build_daily_summary(joined)


#: far above the sketches' standard error of 1 %; small counts may be off by one
SKETCH_ERROR = 0.15


@register("daily_summary_approx", f"""SELECT event_date, event_type, region, event_count,
       true AS customers_close, true AS sessions_close FROM ({DAILY_SQL})""")
def daily_summary_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched distinct counts, and whether they are near the exact ones."""
    joined = summary.with_region(_events_with_sessions(spark, sf_dir), ds.customers(spark, sf_dir), unique=True)
    group = ["event_date", "event_type", "region"]
    exact = summary.build_daily_summary(joined).select(
        *[F.col(c).alias(f"x_{c}") for c in group],
        F.col("unique_customers").alias("c"), F.col("unique_sessions").alias("s"))
    near = summary.build_daily_summary(joined, approx=True, rsd=0.01)
    same = [near[c].eqNullSafe(exact[f"x_{c}"]) for c in group]

    def close(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), SKETCH_ERROR * F.col(b))

    return near.join(exact, same).select(
        *group, "event_count", close("unique_customers", "c").alias("customers_close"),
        close("unique_sessions", "s").alias("sessions_close"))


TXN_SQL = """t AS (
  SELECT o_custkey AS customer_id,
         sum(o_totalprice) AS lifetime_spend,
         count(*) AS transaction_count,
         min(o_orderdate) AS first_purchase, max(o_orderdate) AS last_purchase
  FROM orders GROUP BY o_custkey)"""


def _rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Finished floating values rounded: their last bits depend on row order."""
    return df.withColumns({c: F.round(c, places) for c in cols})


def _txn_out_sql(places: int) -> str:
    return f"""SELECT customer_id, round(lifetime_spend, {places}) AS lifetime_spend, transaction_count,
       first_purchase, last_purchase,
       round(lifetime_spend / transaction_count, {places}) AS avg_transaction_value FROM t"""


#: the same with three more decimals in every amount
SMALL_TXN_SQL = TXN_SQL.replace("o_totalprice", "o_totalprice / 1000")
SMALL_PLACES = 9


def _small_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ds.transactions(spark, sf_dir).withColumn("amount", F.col("amount") / 1000)


@register("txn_metrics", f"WITH {TXN_SQL} {_txn_out_sql(6)}")
def txn_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(customers.txn_metrics(ds.transactions(spark, sf_dir)),
                    "lifetime_spend", "avg_transaction_value")


@register("txn_metrics_small_amounts", f"WITH {SMALL_TXN_SQL} {_txn_out_sql(SMALL_PLACES)}")
def txn_metrics_small_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(customers.txn_metrics(_small_amounts(spark, sf_dir)),
                    "lifetime_spend", "avg_transaction_value", places=SMALL_PLACES)


CLV_AS_OF = "2001-09-01"
_A = f"TIMESTAMP '{CLV_AS_OF} 00:00:00'"
MONTHS_SQL = (
    f"CASE WHEN day({_A}) = day(t.first_purchase) OR ({_A}::DATE = last_day({_A}) "
    f"AND t.first_purchase::DATE = last_day(t.first_purchase)) "
    f"THEN CAST((year({_A}) - year(t.first_purchase)) * 12 + month({_A}) - month(t.first_purchase) AS DOUBLE) "
    f"ELSE round((year({_A}) - year(t.first_purchase)) * 12 + month({_A}) - month(t.first_purchase) "
    f"+ ((day({_A}) - day(t.first_purchase)) * 86400 + epoch({_A}) - epoch(date_trunc('day', {_A})) "
    f"- epoch(t.first_purchase) + epoch(date_trunc('day', t.first_purchase))) / 2678400.0, 8) END")


def _clv_sql(txn_sql: str, places: int = 6) -> str:
    return f"""WITH {CUST_SQL}, {txn_sql}, x AS (
  SELECT cust.*, t.lifetime_spend, t.transaction_count, t.first_purchase, t.last_purchase,
         t.lifetime_spend / t.transaction_count AS avg_transaction_value,
         {MONTHS_SQL} AS months_since_first_purchase
  FROM cust LEFT JOIN t ON cust.customer_id = t.customer_id)
SELECT x.* REPLACE (round(lifetime_spend, {places}) AS lifetime_spend,
                    round(avg_transaction_value, {places}) AS avg_transaction_value),
       CASE WHEN transaction_count > 1 THEN
         date_diff('day', first_purchase::DATE, last_purchase::DATE) / (transaction_count - 1)
       END AS purchase_frequency_days,
       round(avg_transaction_value * (transaction_count / greatest(months_since_first_purchase, 1.0)) * 12, 6)
         AS clv_score
FROM x"""


@register("customer_clv", _clv_sql(TXN_SQL))
def customer_clv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(customers.build_customer_lifetime_value(
        ds.customers(spark, sf_dir), ds.transactions(spark, sf_dir), as_of=CLV_AS_OF),
        "lifetime_spend", "avg_transaction_value", "clv_score")


@register("customer_clv_small_amounts", _clv_sql(SMALL_TXN_SQL, SMALL_PLACES))
def customer_clv_small_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clv = customers.build_customer_lifetime_value(
        ds.customers(spark, sf_dir), _small_amounts(spark, sf_dir), as_of=CLV_AS_OF)
    return _rounded(_rounded(clv, "lifetime_spend", "avg_transaction_value", places=SMALL_PLACES), "clv_score")


@register("standardize_columns", """SELECT c_custkey AS customer_key, c_name AS customer_name,
       c_acctbal AS acct_bal, c_mktsegment AS mkt_segment FROM customer""")
def standardize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ds.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias(" Customer-Name"),
        F.col("c_acctbal").alias("ACCT BAL"), F.col("c_mktsegment").alias("Mkt-Segment "))
    return columns.standardize_columns(raw)


@register("ingestion_metadata", """SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at,
       'raw_customers' AS _source, '0.1.0' AS _pipeline_version FROM customer""")
def ingestion_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.add_ingestion_metadata(ds.table(spark, sf_dir, "customer"), "raw_customers",
                                          ingested_at="2024-02-01 00:00:00",
                                          pipeline_version="0.1.0")


@register("unique_report", """SELECT o_custkey AS customer_id, count(*) AS dup_count
FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def unique_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(ds.transactions(spark, sf_dir), "customer_id")


def _filter_query(name: str, field: str, op: str, value: str, where: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return filters.filter_records(ds.customer_records(spark, sf_dir), field, op, value)
    run.__name__ = name
    register(name, f"WITH {RECORDS_SQL} SELECT * FROM recs WHERE {where}")(run)


_filter_query("filter_eq", "status", "eq", "BUILDING", "coalesce(status, '') = 'BUILDING'")
_filter_query("filter_neq", "status", "neq", "BUILDING", "coalesce(status, '') <> 'BUILDING'")
_filter_query("filter_contains", "username", "contains", "00000001",
              "contains(coalesce(username, ''), '00000001')")
_filter_query("filter_gt", "balance", "gt", "5000",
              f"NOT isnan({go_float_sql('balance')}) AND {go_float_sql('balance')} > 5000")
_filter_query("filter_lt", "balance", "lt", "0",
              f"NOT isnan({go_float_sql('balance')}) AND {go_float_sql('balance')} < 0")


@register("normalize_fields", f"""WITH {RECORDS_SQL}
SELECT user_id, status, regexp_replace(lower(email), '^\\s+|\\s+$', '', 'g') AS email,
       regexp_replace(lower(username), '^\\s+|\\s+$', '', 'g') AS username, balance, nation
FROM recs""")
def normalize_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.normalize_fields(ds.customer_records(spark, sf_dir),
                                    ["email", "username", "no_such_field"])


RENAMES = {"customer_ref": "user_id", "user_id": "username", "segment": "status",
           "ghost": "no_such_field"}


@register("rename_fields", f"""WITH {RECORDS_SQL}
SELECT username AS user_id, user_id AS customer_ref, status AS segment, email, balance, nation
FROM recs""")
def rename_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.rename_fields(ds.customer_records(spark, sf_dir), RENAMES)


@register("first_per_key", """SELECT txn_id, customer_id, amount, txn_date, status FROM (
  SELECT o_orderkey AS txn_id, o_custkey AS customer_id, o_totalprice AS amount,
         o_orderdate AS txn_date, o_orderstatus AS status,
         row_number() OVER (PARTITION BY CAST(o_custkey AS VARCHAR)
                            ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_key(ds.transactions(spark, sf_dir), "customer_id",
                               order_by=["txn_date", "txn_id"])


# --- data quality ----------------------------------------------------------


QUALITY_CHECKS = [
    {"name": "customer_known", "column": "customer_id", "rule": "not_null",
     "severity": "critical"},
    {"name": "contact_has_domain", "column": "email", "rule": "regex",
     "pattern": r"@.+[.]", "severity": "warning"},
    {"name": "amount_above_floor", "column": "amount", "rule": "greater_than", "value": 5,
     "severity": "critical"},
    {"name": "known_event_type", "column": "event_type", "rule": "regex",
     "pattern": "^(view|click|purchase|signup)$", "severity": "critical"},
    {"name": "no_late_dates", "column": "event_date", "rule": "less_than_or_equal",
     "value": "DATE '2024-01-25'", "severity": "warning"},
    {"name": "unique_event_id", "column": "event_id", "rule": "unique", "severity": "critical"},
    {"name": "one_event_per_user", "column": "customer_id", "rule": "unique",
     "severity": "warning"},
    {"name": "session_present", "column": "k", "rule": "not_null", "severity": "warning"},
]
QUARANTINE_TS_FIXED = "2024-02-01 00:00:00"


def _quality_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = columns.parse_event_properties(ds.events(spark, sf_dir), keys=["k"])
    return ev.withColumn("event_date", F.to_date("event_timestamp").cast("string"))


def _validation(spark: SparkSession, sf_dir: str) -> quality.Validation:
    return quality.run_checks(_quality_input(spark, sf_dir), QUALITY_CHECKS,
                              run_ts=QUARANTINE_TS_FIXED)


QUALITY_FLAGS_SQL = """q AS (
  SELECT event_id, user_id AS customer_id, event_type, ts AS event_timestamp,
         value AS amount, json_extract_string(props, '$.k') AS k,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date
  FROM events),
f AS (
  SELECT *, coalesce(customer_id IS NULL, false) AS f1,
         coalesce(amount <= 5 OR amount IS NULL, false) AS f3,
         coalesce(NOT regexp_matches(event_type, '^(view|click|purchase|signup)$'), false) AS f4,
         coalesce(TRY_CAST(event_date AS DATE) > DATE '2024-01-25', false) AS f5,
         coalesce(k IS NULL, false) AS f8
  FROM q)"""


def _report_row(pos, name, col, rule, sev, status, total, failing):
    rate = "NULL" if failing == "NULL" else f"round((1 - {failing} / greatest({total}, 1)) * 100, 2)"
    return (f"SELECT {pos} AS position, '{name}' AS \"check\", '{col}' AS \"column\", "
            f"'{rule}' AS rule, '{sev}' AS severity, '{status}' AS status, "
            f"CAST({total} AS BIGINT) AS total_rows, CAST({failing} AS BIGINT) AS failing_rows, "
            f"CAST({rate} AS DOUBLE) AS pass_rate")


_ALIVE_AT_6 = "NOT (f1 OR f3 OR f4)"

QUALITY_REPORT_SQL = f"""WITH {QUALITY_FLAGS_SQL},
tot AS (SELECT count(*) AS n, count_if(f1) AS c1, count_if(f3 AND NOT f1) AS c3,
               count_if(f4 AND NOT (f1 OR f3)) AS c4, count_if(f5 AND NOT (f1 OR f3 OR f4)) AS c5,
               count_if(f8 AND NOT (f1 OR f3 OR f4)) AS c8 FROM f),
u6 AS (SELECT count_if(na > 1) AS c, coalesce(sum(n), 0) AS n FROM (
         SELECT event_id, count_if({_ALIVE_AT_6}) AS na, count(*) AS n FROM f GROUP BY event_id)),
u7 AS (SELECT count_if(na > 1) AS c, coalesce(sum(n), 0) AS n FROM (
         SELECT customer_id, count_if({_ALIVE_AT_6}) AS na, count(*) AS n FROM f GROUP BY customer_id))
{_report_row(1, 'customer_known', 'customer_id', 'not_null', 'critical', 'ok', 'n', 'c1')} FROM tot
UNION ALL {_report_row(2, 'contact_has_domain', 'email', 'regex', 'warning', 'skipped', 'n', 'NULL')} FROM tot
UNION ALL {_report_row(3, 'amount_above_floor', 'amount', 'greater_than', 'critical', 'ok', 'n', 'c3')} FROM tot
UNION ALL {_report_row(4, 'known_event_type', 'event_type', 'regex', 'critical', 'ok', 'n', 'c4')} FROM tot
UNION ALL {_report_row(5, 'no_late_dates', 'event_date', 'less_than_or_equal', 'warning', 'ok', 'n', 'c5')} FROM tot
UNION ALL {_report_row(6, 'unique_event_id', 'event_id', 'unique', 'critical', 'ok', 'n', 'c')} FROM u6
UNION ALL {_report_row(7, 'one_event_per_user', 'customer_id', 'unique', 'warning', 'ok', 'n', 'c')} FROM u7
UNION ALL {_report_row(8, 'session_present', 'k', 'not_null', 'warning', 'ok', 'n', 'c8')} FROM tot"""


@register("quality_report", QUALITY_REPORT_SQL)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir).report_frame()


@register("quality_clean", f"""WITH {QUALITY_FLAGS_SQL}
SELECT event_id, customer_id, event_type, event_timestamp, amount, k, event_date
FROM f WHERE NOT (f1 OR f3 OR f4)""")
def quality_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir).clean


@register("quality_quarantine", f"""WITH {QUALITY_FLAGS_SQL}
SELECT event_id, customer_id, event_type, event_timestamp, amount, k, event_date,
       CASE WHEN f1 THEN 'customer_known' WHEN f3 THEN 'amount_above_floor'
            ELSE 'known_event_type' END AS _quality_check,
       TIMESTAMP '{QUARANTINE_TS_FIXED}' AS _quarantine_ts
FROM f WHERE f1 OR f3 OR f4""")
def quality_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir).quarantine


# --- merge / versioned tables ----------------------------------------------


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserts derived from the tables: BUILDING customers re-priced and renamed
    (updates), suppliers as new customers under negative keys (inserts), those
    of nation 0 with a NULL key (never match, always inserted)."""
    cust = ds.customers(spark, sf_dir)
    updates = cust.filter(F.col("status") == "BUILDING").select(
        "customer_id", F.upper("first_name").alias("first_name"), "region", "status",
        (F.col("balance") + 100).alias("balance"))
    sup = ds.table(spark, sf_dir, "supplier")
    inserts = sup.select(
        F.when(F.col("s_nationkey") == 0, F.lit(None)).otherwise(-F.col("s_suppkey") - 1)
        .cast("long").alias("customer_id"),
        F.col("s_name").alias("first_name"), F.lit(None).cast("string").alias("region"),
        F.lit("SUPPLIER").alias("status"), F.col("s_acctbal").alias("balance"))
    return updates.unionByName(inserts)


MERGE_SRC_SQL = """src AS (
  SELECT customer_id, upper(first_name) AS first_name, region, status, balance + 100 AS balance
  FROM cust WHERE status = 'BUILDING'
  UNION ALL
  SELECT CAST(CASE WHEN s_nationkey = 0 THEN NULL ELSE -s_suppkey - 1 END AS BIGINT),
         s_name, CAST(NULL AS VARCHAR), 'SUPPLIER', s_acctbal
  FROM supplier)"""

MERGE_ALL_SQL = f"""WITH {CUST_SQL}, {MERGE_SRC_SQL}
SELECT c.* FROM cust c
WHERE c.customer_id IS NULL
   OR c.customer_id NOT IN (SELECT customer_id FROM src WHERE customer_id IS NOT NULL)
UNION ALL SELECT * FROM src"""


@register("merge_all", MERGE_ALL_SQL)
def merge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.merge_frames(ds.customers(spark, sf_dir), merge_source(spark, sf_dir),
                               "customer_id").drop(tables.ACTION)


@register("merge_columns", f"""WITH {CUST_SQL}, {MERGE_SRC_SQL}
SELECT c.customer_id, c.first_name, c.region, c.status,
       CASE WHEN s.customer_id IS NOT NULL THEN s.balance ELSE c.balance END AS balance
FROM cust c LEFT JOIN src s ON c.customer_id = s.customer_id
UNION ALL
SELECT * FROM src s
WHERE s.customer_id IS NULL
   OR s.customer_id NOT IN (SELECT customer_id FROM cust WHERE customer_id IS NOT NULL)""")
def merge_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.merge_frames(ds.customers(spark, sf_dir), merge_source(spark, sf_dir),
                               "customer_id", columns=["balance"]).drop(tables.ACTION)


@register("merge_delete", f"""WITH {CUST_SQL}, {MERGE_SRC_SQL} SELECT * FROM src""")
def merge_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.merge_frames(ds.customers(spark, sf_dir), merge_source(spark, sf_dir),
                               "customer_id", delete_unmatched=True).drop(tables.ACTION)


@register("merge_upsert_table", MERGE_ALL_SQL)
def merge_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge into a stored table twice: the first call creates it, the second
    upserts; the latest version is read back."""
    path = scratch_path(spark, "merge_upsert")
    tables.merge_upsert(ds.customers(spark, sf_dir), path, "customer_id",
                        partition_by=["region"])
    tables.merge_upsert(merge_source(spark, sf_dir), path, "customer_id")
    return tables.read_version(spark, path)


ORDERS_SQL = """SELECT o_orderkey AS txn_id, o_custkey AS customer_id, o_totalprice AS amount,
       o_orderdate AS txn_date, o_orderstatus AS status FROM orders"""


def _orders_by_status(spark: SparkSession, sf_dir: str, *status: str) -> DataFrame:
    return ds.transactions(spark, sf_dir).filter(F.col("status").isin(*status))


def _time_travel_table(spark: SparkSession, sf_dir: str) -> str:
    """v0 snapshot of F orders, v1 append of O, v2 append of P, v3 overwrite
    with re-priced F orders."""
    path = scratch_path(spark, "time_travel")
    tables.write_table(_orders_by_status(spark, sf_dir, "F"), path, "overwrite",
                       partition_by=["status"])
    tables.write_table(_orders_by_status(spark, sf_dir, "O"), path, "append")
    tables.write_table(_orders_by_status(spark, sf_dir, "P"), path, "append")
    repriced = _orders_by_status(spark, sf_dir, "F").withColumn("amount", F.col("amount") * 2)
    tables.write_table(repriced, path, "overwrite")
    return path


@register("append_then_as_of", f"SELECT * FROM ({ORDERS_SQL}) WHERE status IN ('F', 'O')")
def append_then_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_version(spark, _time_travel_table(spark, sf_dir), version=1)


@register("overwrite_as_of", f"""SELECT txn_id, customer_id, amount * 2 AS amount, txn_date, status
FROM ({ORDERS_SQL}) WHERE status = 'F'""")
def overwrite_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_version(spark, _time_travel_table(spark, sf_dir))


@register("partition_overwrite", f"""SELECT txn_id, customer_id,
       CASE WHEN status = 'F' THEN amount * 2 ELSE amount END AS amount, txn_date, status
FROM ({ORDERS_SQL})""")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partition_overwrite")
    tables.write_table(ds.transactions(spark, sf_dir), path, "overwrite", partition_by=["status"])
    repriced = _orders_by_status(spark, sf_dir, "F").withColumn("amount", F.col("amount") * 2)
    tables.overwrite_partitions(repriced, path)
    return tables.read_version(spark, path)


@register("compact_same_rows", ORDERS_SQL)
def compact_same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends of many small files each, then compaction."""
    path = scratch_path(spark, "compact")
    for status in ("F", "O", "P"):
        tables.write_table(_orders_by_status(spark, sf_dir, status).repartition(8), path,
                           "append", partition_by=["status"])
    tables.compact(spark, path)
    return tables.read_version(spark, path)


# --- sources, records, sinks -----------------------------------------------


def _json_scan(spark: SparkSession, sf_dir: str):
    path = fixtures.write_event_json(spark, sf_dir, scratch_path(spark, "events_json"))
    raw = src_files.read_json_lines(spark, path, EVENT_SCHEMA)
    return src_files.split_corrupt(raw)


@register("json_scan_split", """SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) AS customer_id, event_type,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, ts AS event_timestamp,
       props AS properties FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_type = 'signup'""")
def json_scan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_scan(spark, sf_dir)[0]


@register("json_corrupt_rows", """SELECT '{"event_id": "' || CAST(event_id AS VARCHAR)
       || '", "broken": ' AS _corrupt_record FROM events WHERE event_type = 'error'""")
def json_corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_scan(spark, sf_dir)[1].select("_corrupt_record")


CSV_GOOD_SQL = """good AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS status,
         replace(c_name, '#', '.') || '@Example.Com ' AS email, c_name AS username,
         CAST(c_acctbal AS VARCHAR) AS balance, CAST(c_nationkey AS VARCHAR) AS nation,
         row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS _row_number
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"""


def _customer_scan(spark: SparkSession, sf_dir: str) -> src_records.RecordScan:
    path = fixtures.write_customer_csv(spark, sf_dir, scratch_path(spark, "customers_csv"))
    return src_records.read_csv_records(spark, path, "customers", recursive=True)


@register("csv_records", f"""WITH {CSV_GOOD_SQL}
SELECT user_id, status, email, username, balance, nation, _row_number,
       'customers-' || CAST(_row_number AS VARCHAR) AS _record_id,
       'customers' AS _record_source
FROM good""")
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_scan(spark, sf_dir).records.drop("_file", "_record_ts")


@register("csv_rejects", """SELECT CAST(c_custkey AS VARCHAR) AS user_id,
       CAST(c_custkey AS VARCHAR) || ',HOUSEHOLD,x, '
       || replace(c_name, '#', '.') || '@Example.Com ,' || c_name || ','
       || CAST(c_acctbal AS VARCHAR) || ',' || CAST(c_nationkey AS VARCHAR) AS _corrupt_record,
       'field count differs from header' AS _error, 'customers' AS _record_source
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_scan(spark, sf_dir).rejects.select("user_id", "_corrupt_record", "_error",
                                                        "_record_source")


SUPPLIER_RECS_SQL = """srecs AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS user_id, s_name AS username,
         CAST(s_acctbal AS VARCHAR) AS balance, CAST(s_nationkey AS VARCHAR) AS nation
  FROM supplier)"""


@register("union_sources", f"""WITH {RECORDS_SQL}, {SUPPLIER_RECS_SQL}
SELECT user_id, status, email, username, balance, nation, 'customers' AS _record_source FROM recs
UNION ALL
SELECT user_id, NULL, NULL, username, balance, nation, 'suppliers' FROM srecs""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src_records.union_sources({"customers": ds.customer_records(spark, sf_dir),
                                      "suppliers": ds.supplier_records(spark, sf_dir)})


@register("ndjson_roundtrip", f"""WITH {RECORDS_SQL}
SELECT 'customers-' || user_id AS ID, 'customers' AS Source, user_id, status, email,
       username, balance, nation FROM recs""")
def ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.sinks.files import write_ndjson
    from strata.streaming.records import read_ndjson_records
    recs = ds.customer_records(spark, sf_dir)
    recs = recs.withColumns({"_record_id": F.concat(F.lit("customers-"), F.col("user_id")),
                             "_record_source": F.lit("customers")})
    path = scratch_path(spark, "ndjson")
    write_ndjson(recs, path)
    back = read_ndjson_records(spark, path)
    fields = ["user_id", "status", "email", "username", "balance", "nation"]
    return back.select("ID", "Source", *[F.col("Data")[f].alias(f) for f in fields])


# --- record flow (batch and stream) ------------------------------------------


FLOW_CONFIG = [
    {"name": "positive_balance", "operation": "filter",
     "config": {"field": "balance", "operator": "gt", "value": "0"}},
    {"name": "normalize_contact", "operation": "normalize",
     "config": {"fields": ["email", "username"]}},
    {"name": "one_per_nation", "operation": "deduplicate", "config": {"key_field": "nation"}},
]
FLOW_FIELDS = ["user_id", "status", "email", "username", "balance", "nation"]


def _flow_sources(spark: SparkSession, sf_dir: str) -> list[dict]:
    cpath = fixtures.write_customer_csv(spark, sf_dir, scratch_path(spark, "flow_customers"))
    spath = fixtures.write_supplier_csv(spark, sf_dir, scratch_path(spark, "flow_suppliers"))
    return [{"name": "customers", "location": cpath + "/*/*/*.txt"},
            {"name": "suppliers", "location": spath}]


def _run_flow(spark: SparkSession, sf_dir: str):
    out = scratch_path(spark, "flow_out")
    metrics = run_records(spark, _flow_sources(spark, sf_dir), RecordFlow.from_config(FLOW_CONFIG),
                          out, dead_letter_path=scratch_path(spark, "flow_dead_letter"))
    return out, metrics


FLOW_SQL = f"""WITH {CSV_GOOD_SQL}, {SUPPLIER_RECS_SQL},
srecs_n AS (SELECT *, row_number() OVER (ORDER BY CAST(user_id AS BIGINT)) AS _row_number FROM srecs),
allr AS (
  SELECT user_id, status, email, username, balance, nation, _row_number, 'customers' AS Source
  FROM good
  UNION ALL
  SELECT user_id, NULL AS status, NULL AS email, username, balance, nation, _row_number,
         'suppliers' FROM srecs_n),
kept AS (SELECT * FROM allr WHERE NOT isnan({go_float_sql('balance')}) AND {go_float_sql('balance')} > 0)
SELECT ID, Source, user_id, status, email, username, balance, nation FROM (
  SELECT Source || '-' || CAST(_row_number AS VARCHAR) AS ID, Source, user_id, status,
         regexp_replace(lower(email), '^\\s+|\\s+$', '', 'g') AS email,
         regexp_replace(lower(username), '^\\s+|\\s+$', '', 'g') AS username, balance, nation,
         row_number() OVER (PARTITION BY nation ORDER BY _row_number, Source) AS rn
  FROM kept) WHERE rn = 1"""


@register("record_flow_batch", FLOW_SQL)
def record_flow_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV customers and suppliers -> filter -> normalize -> first per nation
    -> NDJSON, read back."""
    out, _ = _run_flow(spark, sf_dir)
    back = read_ndjson_records(spark, out)
    return back.select("ID", "Source", *[F.col("Data")[f].alias(f) for f in FLOW_FIELDS])


@register("run_metrics", f"""WITH {CSV_GOOD_SQL}, {SUPPLIER_RECS_SQL},
written AS (SELECT count(*) AS n FROM ({FLOW_SQL})),
rd AS (SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n),
rj AS (SELECT count(*) AS n FROM customer WHERE c_mktsegment = 'HOUSEHOLD')
SELECT rd.n AS records_read, written.n AS records_written,
       rd.n - written.n - rj.n AS records_filtered, rj.n AS records_rejected,
       CAST(1 AS BIGINT) AS batches_processed
FROM rd, written, rj""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, metrics = _run_flow(spark, sf_dir)
    return metrics.as_frame(spark)


def _stream_inputs(spark: SparkSession, sf_dir: str) -> str:
    """Two batches of CSV files: nations below 12 first, the rest second;
    every BUILDING customer is in both, so keys repeat across files."""
    recs = ds.customer_records(spark, sf_dir).select(*FLOW_FIELDS)
    low = F.col("nation").cast("int") < 12
    building = F.col("status") == "BUILDING"
    root = scratch_path(spark, "stream_in")
    recs.filter(low | building).write.options(header="true").csv(f"{root}/a")
    recs.filter(~low | building).write.options(header="true").csv(f"{root}/b")
    return root


STREAM_FLOW = [
    {"name": "normalize_contact", "operation": "normalize",
     "config": {"fields": ["email", "username"]}},
    {"name": "one_per_user", "operation": "deduplicate", "config": {"key_field": "user_id"}},
]


@register("stream_records", f"""WITH {RECORDS_SQL}
SELECT user_id, regexp_replace(lower(email), '^\\s+|\\s+$', '', 'g') AS email,
       regexp_replace(lower(username), '^\\s+|\\s+$', '', 'g') AS username FROM recs""")
def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming over the two file batches (one file per trigger),
    stateful dedup on user_id, idempotent foreachBatch sink; read back."""
    root = _stream_inputs(spark, sf_dir)
    out = scratch_path(spark, "stream_out")
    run_record_stream(spark, f"{root}/*/", FLOW_FIELDS, "customers",
                      RecordFlow.from_config(STREAM_FLOW), out,
                      checkpoint=scratch_path(spark, "stream_ckpt"))
    back = read_ndjson_records(spark, out)
    return back.select(*[F.col("Data")[f].alias(f) for f in ("user_id", "email", "username")])


# --- lakehouse jobs, end to end ---------------------------------------------


JOB_CHECKS = [
    {"name": "customer_known", "column": "customer_id", "rule": "not_null", "severity": "critical"},
    {"name": "contact_has_domain", "column": "email", "rule": "regex", "pattern": "@.+[.]",
     "severity": "warning", "tables": ["customers"]},
    {"name": "amount_positive", "column": "amount", "rule": "greater_than", "value": 0,
     "severity": "critical", "tables": ["transactions"]},
]


def job_config(spark: SparkSession, sf_dir: str, events: bool = True) -> dict:
    """Raw files derived from the tables, and a config pointing at them (``events`` False: the caller has its own)."""
    raw = scratch_path(spark, "raw")
    lake = scratch_path(spark, "lake")
    return load_config(overrides={
        "sources": {
            "raw_events": {"format": "json", "partition_columns": ["event_date"],
                           "path": fixtures.write_event_json(spark, sf_dir, f"{raw}/events") if events else None},
            "raw_customers": {"format": "csv", "path": fixtures.write_customer_source_csv(
                spark, sf_dir, f"{raw}/customers")},
            "raw_transactions": {"format": "parquet", "path": fixtures.write_transactions_parquet(
                spark, sf_dir, f"{raw}/transactions")},
        },
        "layers": {"bronze": {"path": f"{lake}/bronze"}, "silver": {"path": f"{lake}/silver"},
                   "gold": {"path": f"{lake}/gold"}},
        "events": {"property_keys": ["k"], "session_key": "k"},
        "segments": {"power_events": POWER_EVENTS, "power_types": POWER_TYPES,
                     "active_events": ACTIVE_EVENTS},
        "quality": {"quarantine_path": f"{lake}/quarantine", "checks": JOB_CHECKS},
    })


def run_job(spark: SparkSession, sf_dir: str) -> dict:
    """A bronze -> silver -> gold run of its own for each query."""
    config = job_config(spark, sf_dir)
    result = lakehouse.run(spark, config, as_of=CLV_AS_OF, ingested_at=JOB_INGESTED_AT)
    if result["status"] != "success":
        raise RuntimeError(f"lakehouse run failed: {result}")
    return config


JOB_INGESTED_AT = "2024-02-01 00:00:00"


@register("bronze_to_gold", DAILY_SQL)
def bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON events, CSV customers, parquet transactions -> bronze -> silver ->
    gold; the gold daily summary read back."""
    config = run_job(spark, sf_dir)
    return tables.read_version(spark, f"{config['layers']['gold']['path']}/daily_summary")


@register("bronze_to_gold_clv", f"""WITH {CUST_SQL}, {TXN_SQL}, {METRICS_SQL}, x AS (
  SELECT cust.customer_id, t.lifetime_spend, t.transaction_count,
         t.lifetime_spend / t.transaction_count AS avg_transaction_value,
         {MONTHS_SQL} AS months_since_first_purchase,
         coalesce(m.total_events, 0) AS total_events, {SEGMENT_SQL} AS segment
  FROM cust LEFT JOIN t ON cust.customer_id = t.customer_id
  LEFT JOIN m ON cust.customer_id = m.customer_id)
SELECT CAST(customer_id AS VARCHAR) AS customer_id, round(lifetime_spend, 6) AS lifetime_spend,
       transaction_count, months_since_first_purchase, total_events, segment,
       round(avg_transaction_value * (transaction_count / greatest(months_since_first_purchase, 1.0)) * 12, 6)
         AS clv_score
FROM x""")
def bronze_to_gold_clv(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = run_job(spark, sf_dir)
    clv = tables.read_version(spark, f"{config['layers']['gold']['path']}/customer_clv")
    return _rounded(clv, "lifetime_spend", "clv_score").select(
        "customer_id", "lifetime_spend", "transaction_count",
        "months_since_first_purchase", "total_events", "segment", "clv_score")


# --- larger input: lineitem validation ---------------------------------------

LINEITEM_CHECKS = [
    {"name": "quantity_positive", "column": "l_quantity", "rule": "greater_than", "value": 1,
     "severity": "critical"},
    {"name": "known_flag", "column": "l_returnflag", "rule": "regex", "pattern": "^[AR]$",
     "severity": "critical"},
    {"name": "discount_cap", "column": "l_discount", "rule": "less_than_or_equal", "value": 0.08,
     "severity": "warning"},
    {"name": "shipped_by_1998", "column": "l_shipdate", "rule": "less_than_or_equal",
     "value": "TIMESTAMP_NTZ '1998-01-01 00:00:00'", "severity": "warning"},
    {"name": "one_line_per_order", "column": "l_orderkey", "rule": "unique",
     "severity": "warning"},
]

LINEITEM_REPORT_SQL = f"""WITH f AS (
  SELECT l_orderkey,
         coalesce(l_quantity <= 1 OR l_quantity IS NULL, false) AS f1,
         coalesce(NOT regexp_matches(l_returnflag, '^[AR]$'), false) AS f2,
         coalesce(l_discount > 0.08, false) AS f3,
         coalesce(l_shipdate > TIMESTAMP '1998-01-01 00:00:00', false) AS f4
  FROM lineitem),
tot AS (SELECT count(*) AS n, count_if(f1) AS c1, count_if(f2 AND NOT f1) AS c2,
               count_if(f3 AND NOT (f1 OR f2)) AS c3, count_if(f4 AND NOT (f1 OR f2)) AS c4 FROM f),
u5 AS (SELECT count_if(na > 1) AS c, coalesce(sum(n), 0) AS n FROM (
         SELECT l_orderkey, count_if(NOT (f1 OR f2)) AS na, count(*) AS n FROM f GROUP BY l_orderkey))
{_report_row(1, 'quantity_positive', 'l_quantity', 'greater_than', 'critical', 'ok', 'n', 'c1')} FROM tot
UNION ALL {_report_row(2, 'known_flag', 'l_returnflag', 'regex', 'critical', 'ok', 'n', 'c2')} FROM tot
UNION ALL {_report_row(3, 'discount_cap', 'l_discount', 'less_than_or_equal', 'warning', 'ok', 'n', 'c3')} FROM tot
UNION ALL {_report_row(4, 'shipped_by_1998', 'l_shipdate', 'less_than_or_equal', 'warning', 'ok', 'n', 'c4')} FROM tot
UNION ALL {_report_row(5, 'one_line_per_order', 'l_orderkey', 'unique', 'warning', 'ok', 'n', 'c')} FROM u5"""


@register("lineitem_quality_report", LINEITEM_REPORT_SQL)
def lineitem_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = ds.table(spark, sf_dir, "lineitem")
    return quality.run_checks(li, LINEITEM_CHECKS).report_frame()


@register("bronze_events", """SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) AS customer_id, event_type,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, ts AS event_timestamp,
       props AS properties, 'raw_events' AS _source
FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'raw_events' FROM events WHERE event_type = 'signup'""")
def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze events table: parsed JSON lines without the corrupt ones."""
    config = run_job(spark, sf_dir)
    bronze = tables.read_version(spark, f"{config['layers']['bronze']['path']}/raw_events")
    return bronze.drop("_ingested_at", "_pipeline_version")


@register("quarantined_corrupt_events", """SELECT '{"event_id": "' || CAST(event_id AS VARCHAR)
       || '", "broken": ' AS _corrupt_record, 'raw_events' AS _source
FROM events WHERE event_type = 'error'""")
def quarantined_corrupt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrupt JSON lines as the bronze job quarantined them."""
    config = run_job(spark, sf_dir)
    q = spark.read.parquet(f"{config['quality']['quarantine_path']}/raw_events/corrupt/")
    return q.select("_corrupt_record", "_source")


@register("silver_customers", f"""WITH {CUST_SQL}, {METRICS_SQL}
SELECT CAST(cust.customer_id AS VARCHAR) AS customer_id, cust.region,
       coalesce(m.total_events, 0) AS total_events,
       coalesce(m.distinct_event_types, 0) AS distinct_event_types, {SEGMENT_SQL} AS segment
FROM cust LEFT JOIN m ON cust.customer_id = m.customer_id""")
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver customers after validation, enrichment, segments and the merge."""
    config = run_job(spark, sf_dir)
    silver = tables.read_version(spark, f"{config['layers']['silver']['path']}/customers")
    return silver.select("customer_id", "region", "total_events", "distinct_event_types",
                         "segment")


CUSTOMER_SOURCE_SQL = f"""WITH {CUST_SQL}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, first_name, status AS last_name,
       lower(replace(first_name, '#', '.')) || '@example.com' AS email, region,
       '2020-01-01' AS signup_date, status
FROM cust"""


@register("csv_scan", CUSTOMER_SOURCE_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared customer CSV schema applied to a header CSV."""
    from strata.schemas import CUSTOMER_SCHEMA
    path = fixtures.write_customer_source_csv(spark, sf_dir, scratch_path(spark, "cust_csv"))
    return src_files.read_csv(spark, path, CUSTOMER_SCHEMA)


@register("source_parquet", f"""SELECT txn_id, CAST(customer_id AS VARCHAR) AS customer_id,
       amount, txn_date, status FROM ({ORDERS_SQL})""")
def source_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A config-driven parquet source (format, path, options)."""
    path = fixtures.write_transactions_parquet(spark, sf_dir, scratch_path(spark, "tx_parquet"))
    return src_files.read_source(spark, {"format": "parquet", "path": path,
                                         "read_options": {"mergeSchema": "false"}})


@register("daily_summary_sorted", DAILY_SQL)
def daily_summary_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary with the optional global sort on (event_date, event_type)."""
    joined = summary.with_region(_events_with_sessions(spark, sf_dir), ds.customers(spark, sf_dir))
    return summary.build_daily_summary(joined, sort=True)


def _record_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and supplier records written as NDJSON and read back: the
    supplier maps carry no ``status`` or ``email`` key."""
    from strata.sinks.files import write_ndjson
    recs = src_records.union_sources({"customers": ds.customer_records(spark, sf_dir),
                                      "suppliers": ds.supplier_records(spark, sf_dir)})
    path = scratch_path(spark, "record_maps")
    write_ndjson(recs, path)
    return read_ndjson_records(spark, path)


@register("filter_record_maps", f"""WITH {RECORDS_SQL}
SELECT 'customers' AS Source, user_id, status FROM recs WHERE status = 'BUILDING'""")
def filter_record_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = filters.filter_record_maps(_record_maps(spark, sf_dir), "status", "eq", "BUILDING")
    return kept.select("Source", F.col("Data")["user_id"].alias("user_id"),
                       F.col("Data")["status"].alias("status"))


@register("record_map_rejects", f"""WITH {SUPPLIER_RECS_SQL}
SELECT 'suppliers' AS Source, user_id, 'field ''status'' not found in record' AS _error
FROM srecs""")
def record_map_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = filters.filter_record_maps(_record_maps(spark, sf_dir), "status", "eq",
                                            "BUILDING")
    return rejects.select("Source", F.col("Data")["user_id"].alias("user_id"), "_error")


# --- tables: NULL partitions, moved rows ------------------------------------------


def _null_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; those in processing have no status."""
    return ds.transactions(spark, sf_dir).withColumn("status", F.nullif(F.col("status"), F.lit("P")))


NULL_ORDERS_SQL = f"o AS (SELECT * REPLACE (nullif(status, 'P') AS status) FROM ({ORDERS_SQL}))"


@register("partition_overwrite_nulls", f"""WITH {NULL_ORDERS_SQL}
SELECT * REPLACE (CASE WHEN status = 'F' THEN amount * 2 ELSE amount END AS amount) FROM o""")
def partition_overwrite_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partition_nulls")
    orders = _null_status(spark, sf_dir)
    tables.write_table(orders, path, "overwrite", partition_by=["status"])
    again = orders.filter("status = 'F'").withColumn("amount", F.col("amount") * 2)
    tables.overwrite_partitions(again, path)
    return tables.read_version(spark, path)


@register("merge_within_partitions_nulls", f"""WITH {NULL_ORDERS_SQL}
SELECT txn_id, customer_id, CASE WHEN txn_id % 3 = 0 THEN amount + 1 ELSE amount END AS amount, txn_date,
       CASE WHEN txn_id % 3 = 0 THEN nullif(coalesce(status, 'F'), 'O') ELSE status END AS status FROM o""")
def merge_within_partitions_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders is redelivered: those without a status get one, open ones lose it."""
    path = scratch_path(spark, "merge_nulls")
    orders = _null_status(spark, sf_dir)
    tables.merge_upsert(orders, path, "txn_id", partition_by=["status"])
    moved = orders.filter("txn_id % 3 = 0").withColumns({
        "amount": F.col("amount") + 1,
        "status": F.nullif(F.coalesce("status", F.lit("F")), F.lit("O"))})
    tables.merge_upsert(moved, path, "txn_id", within_partitions=True)
    return tables.read_version(spark, path)


# --- silver across deliveries ------------------------------------------------------


def _run_deliveries(spark: SparkSession, sf_dir: str, layers=("bronze", "silver")) -> dict:
    """Two runs. The first delivery has every event, half of them as a later correction
    (type upper-cased, two days on); the second has the original of those (stale), a
    one-day correction of every seventh event, and the even events again."""
    config = job_config(spark, sf_dir, events=False)
    raw = ds.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("customer_id"),
        "event_type", F.col("ts").alias("event_timestamp"), F.col("props").alias("properties"))
    k = F.col("event_id").cast("long")

    def later(df: DataFrame, days: int) -> DataFrame:
        return df.withColumns({"event_type": F.upper("event_type"),
                               "event_timestamp": F.col("event_timestamp") + F.make_interval(days=F.lit(days))})

    first = later(raw.filter(k % 2 == 1), 2).unionByName(raw.filter(k % 2 == 0))
    second = raw.unionByName(later(raw.filter(k % 7 == 0), 1))
    for n, part in enumerate((first, second)):
        path = scratch_path(spark, f"delivery{n}")
        part = part.withColumn("event_date", F.to_date("event_timestamp").cast("string"))
        (part.select(F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
         .write.text(path))
        config["sources"]["raw_events"]["path"] = path
        if n:  # the other sources bring nothing new
            for name in ("raw_customers", "raw_transactions"):
                config["sources"][name]["path"] = None
        result = lakehouse.run(spark, config, layers, as_of=CLV_AS_OF, ingested_at=JOB_INGESTED_AT)
        if result["status"] != "success":
            raise RuntimeError(f"lakehouse run failed: {result}")
    return config


@register("silver_events", """WITH e AS (
  SELECT *, CASE WHEN event_id % 2 = 1 THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS days FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS customer_id,
       CASE WHEN days > 0 THEN upper(event_type) ELSE event_type END AS event_type,
       ts + to_days(CAST(days AS INTEGER)) AS event_timestamp,
       CAST(CAST(ts + to_days(CAST(days AS INTEGER)) AS DATE) AS VARCHAR) AS event_date,
       json_extract_string(props, '$.k') AS k FROM e WHERE user_id IS NOT NULL""")
def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events after two deliveries with stale, repeated and re-dated rows."""
    config = _run_deliveries(spark, sf_dir)
    events = tables.read_version(spark, f"{config['layers']['silver']['path']}/events")
    return events.select("event_id", "customer_id", "event_type",
                         F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "event_date", "k")


@register("silver_transactions", f"""SELECT txn_id, CAST(customer_id AS VARCHAR) AS customer_id, amount, txn_date,
       status FROM ({ORDERS_SQL}) WHERE customer_id IS NOT NULL AND amount > 0""")
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = run_job(spark, sf_dir)
    tx = tables.read_version(spark, f"{config['layers']['silver']['path']}/transactions")
    return tx.select("txn_id", "customer_id", "amount", "txn_date", "status")


@register("layer_counts", f"""SELECT 'raw_events' AS name, 'bronze' AS layer,
       (SELECT count(*) + count_if(event_type = 'signup') FROM events) AS rows_written
UNION ALL SELECT 'raw_customers', 'bronze', (SELECT count(*) FROM customer)
UNION ALL SELECT 'raw_transactions', 'bronze', (SELECT count(*) FROM orders)
UNION ALL SELECT 'events', 'silver', (SELECT count(*) FROM events WHERE user_id IS NOT NULL)
UNION ALL SELECT 'customers', 'silver', (SELECT count(*) FROM customer WHERE c_custkey IS NOT NULL)
UNION ALL SELECT 'transactions', 'silver',
  (SELECT count(*) FROM ({ORDERS_SQL}) WHERE customer_id IS NOT NULL AND amount > 0)
UNION ALL SELECT 'daily_summary', 'gold', (SELECT count(*) FROM ({DAILY_SQL}))""")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each write of a run reports."""
    result = lakehouse.run(spark, job_config(spark, sf_dir), as_of=CLV_AS_OF, ingested_at=JOB_INGESTED_AT)["layers"]
    rows = [(name, layer, result[layer][name]["rows_written"]) for layer, name in (
        ("bronze", "raw_events"), ("bronze", "raw_customers"), ("bronze", "raw_transactions"),
        ("silver", "events"), ("silver", "customers"), ("silver", "transactions"), ("gold", "daily_summary"))]
    return spark.createDataFrame(rows, "name string, layer string, rows_written long")


# --- quality: what is written and raised ------------------------------------------


@register("quarantine_rows", f"""WITH {QUALITY_FLAGS_SQL}
SELECT event_id, customer_id, event_type, amount,
       CASE WHEN f1 THEN 'customer_known' WHEN f3 THEN 'amount_above_floor'
            ELSE 'known_event_type' END AS _quality_check
FROM f WHERE f1 OR f3 OR f4""")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows as the engine wrote them, read back."""
    root = scratch_path(spark, "quarantine")
    engine = quality.QualityEngine({"checks": QUALITY_CHECKS, "quarantine_path": root})
    engine.validate(_quality_input(spark, sf_dir), "events")
    return spark.read.parquet(f"{root}/events").select("event_id", "customer_id", "event_type", "amount",
                                                       "_quality_check")


@register("quality_error_report", QUALITY_REPORT_SQL)
def quality_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report carried by the error that stops a run."""
    engine = quality.QualityEngine({"checks": QUALITY_CHECKS, "fail_on_error": True})
    try:
        engine.validate(_quality_input(spark, sf_dir), "events")
    except quality.DataQualityError as e:
        rows = [(i, *(r[c] for c in ("check", "column", "rule", "severity", "status", "total_rows",
                                     "failing_rows", "pass_rate"))) for i, r in enumerate(e.report, 1)]
        return spark.createDataFrame(rows, "position int, check string, column string, rule string, severity string, "
                                           "status string, total_rows long, failing_rows long, pass_rate double")
    raise RuntimeError("critical checks failed without an error")


# --- records: headers, missing fields, options, counters --------------------------


@register("csv_records_mixed_headers", """WITH a AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS username, CAST(c_nationkey AS VARCHAR) AS nation FROM customer)
SELECT user_id, username, nation, 'customers' AS _record_source FROM a
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, 'customers' FROM supplier""")
def csv_records_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one source with other columns in another order."""
    root = scratch_path(spark, "mixed_headers")
    options = {"header": "true", "quote": ""}
    (ds.customer_records(spark, sf_dir).select("user_id", "username", "nation")
     .write.options(**options).csv(f"{root}/a"))
    ds.supplier_records(spark, sf_dir).select("username", "user_id").write.options(**options).csv(f"{root}/b")
    scan = src_records.read_csv_records(spark, [f"{root}/a", f"{root}/b"], "customers")
    return scan.records.select("user_id", "username", "nation", "_record_source")


def _missing_field_run(spark: SparkSession, sf_dir: str, dead: str | None):
    flow = RecordFlow().filter("not_building", "status", "neq", "BUILDING")
    out = scratch_path(spark, "missing_field")
    return out, run_records(spark, _flow_sources(spark, sf_dir), flow, out, dead)


@register("flow_missing_field", f"""WITH {CSV_GOOD_SQL}
SELECT 'kept' AS part, user_id, NULL AS _error FROM good WHERE status <> 'BUILDING'
UNION ALL
SELECT 'rejected', CAST(s_suppkey AS VARCHAR), 'field ''status'' not found in record' FROM supplier
UNION ALL
SELECT 'rejected', CAST(c_custkey AS VARCHAR), 'field count differs from header' FROM customer
WHERE c_mktsegment = 'HOUSEHOLD'""")
def flow_missing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers have no status: they are errors, in the dead letter with the malformed rows."""
    dead = scratch_path(spark, "missing_field_dead")
    out, _ = _missing_field_run(spark, sf_dir, dead)
    kept = read_ndjson_records(spark, out).select(F.lit("kept").alias("part"), F.col("Data")["user_id"].alias("user_id"),
                                                  F.lit(None).cast("string").alias("_error"))
    return kept.unionByName(spark.read.parquet(dead).select(F.lit("rejected").alias("part"), "user_id", "_error"))


@register("dead_letter_rows", """SELECT CAST(c_custkey AS VARCHAR) AS user_id,
       'field count differs from header' AS _error, 'customers' AS _record_source
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""")
def dead_letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects as a run wrote them, read back."""
    dead = scratch_path(spark, "dead_letter")
    run_records(spark, _flow_sources(spark, sf_dir), RecordFlow.from_config(FLOW_CONFIG),
                scratch_path(spark, "dead_letter_out"), dead)
    return spark.read.parquet(dead).select("user_id", "_error", "_record_source")


@register("run_metrics_no_dead_letter", f"""WITH {CSV_GOOD_SQL}
SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS records_read,
       (SELECT count(*) FROM good WHERE status <> 'BUILDING') AS records_written,
       (SELECT count(*) FROM good WHERE status = 'BUILDING') AS records_filtered,
       (SELECT count(*) FROM customer WHERE c_mktsegment = 'HOUSEHOLD') + (SELECT count(*) FROM supplier)
         AS records_rejected, CAST(1 AS BIGINT) AS batches_processed""")
def run_metrics_no_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _missing_field_run(spark, sf_dir, None)[1].as_frame(spark)


@register("flow_custom_stage", f"""WITH {CSV_GOOD_SQL}
SELECT user_id, CAST(length(username) AS VARCHAR) AS name_length FROM good""")
def flow_custom_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage of the user's own between source and sink."""
    out = scratch_path(spark, "custom_stage")
    flow = RecordFlow().add_stage("name_length", lambda df: df.withColumn("name_length", F.length("username").cast("string")))
    run_records(spark, _flow_sources(spark, sf_dir)[:1], flow, out)
    data = F.col("Data")
    return read_ndjson_records(spark, out).select(data["user_id"].alias("user_id"), data["name_length"].alias("name_length"))


@register("json_custom_timestamp", """SELECT CAST(event_id AS VARCHAR) AS event_id,
       date_trunc('second', ts) AS event_timestamp FROM events""")
def json_custom_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reader options of a JSON source reach the parser."""
    path = scratch_path(spark, "json_timestamps")
    stamp = F.date_format("event_timestamp", "dd/MM/yyyy HH:mm:ss")
    (ds.events(spark, sf_dir).select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), stamp.alias("event_timestamp"))).alias("value"))
     .write.text(path))
    source = {"format": "json", "path": path, "read_options": {"timestampFormat": "dd/MM/yyyy HH:mm:ss"}}
    df = src_files.split_corrupt(src_files.read_source(spark, source, EVENT_SCHEMA))[0]
    return df.select("event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"))


# --- streams: rows without the key, restarts --------------------------------------


@register("stream_null_keys", f"""WITH {RECORDS_SQL}
SELECT user_id, username FROM recs WHERE CAST(user_id AS BIGINT) % 3 <> 0
UNION ALL SELECT NULL, username FROM recs WHERE CAST(user_id AS BIGINT) % 3 = 0""")
def stream_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, one without the key column; keyed rows come twice, the others pass."""
    from strata.streaming.records import StreamSource, run_record_streams
    recs, third = ds.customer_records(spark, sf_dir), F.col("user_id").cast("long") % 3 == 0
    root, options = scratch_path(spark, "null_keys"), {"header": "true"}
    for n in range(2):
        recs.filter(~third).select("user_id", "username").write.options(**options).csv(f"{root}/keyed/{n}")
    recs.filter(third).select("username").write.options(**options).csv(f"{root}/plain")
    out = scratch_path(spark, "null_keys_out")
    run_record_streams(spark, [StreamSource("keyed", f"{root}/keyed/*", ["user_id", "username"]),
                               StreamSource("plain", f"{root}/plain", ["username"])],
                       RecordFlow().deduplicate("d", "user_id"), out, scratch_path(spark, "null_keys_ckpt"),
                       max_files_per_trigger=100)
    data = F.col("Data")
    return read_ndjson_records(spark, out).select(data["user_id"].alias("user_id"), data["username"].alias("username"))


@register("stream_resume", f"""WITH {RECORDS_SQL}
SELECT user_id, username, CASE WHEN CAST(user_id AS BIGINT) % 2 = 0 THEN 1 ELSE 2 END AS run FROM recs""")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even keys first; a second run on the same checkpoint gets all keys and adds the odd ones only."""
    recs, even = ds.customer_records(spark, sf_dir).select("user_id", "username"), F.col("user_id").cast("long") % 2 == 0
    root, out, checkpoint = (scratch_path(spark, f"resume_{x}") for x in ("in", "out", "ckpt"))
    flow = RecordFlow().deduplicate("d", "user_id")
    parts = []
    for n, rows in enumerate((recs.filter(even), recs), 1):
        rows.write.options(header="true").csv(f"{root}/{n}")
        run_record_stream(spark, f"{root}/*/", ["user_id", "username"], "customers", flow, out, checkpoint,
                          max_files_per_trigger=100)
        parts.append(read_ndjson_records(spark, out).select(F.col("Data")["user_id"].alias("user_id"),
                                                            F.col("Data")["username"].alias("username")))
        if n == 1:
            first = tables.staged(parts[0], "resume_first")
    old = first.select("user_id", F.lit(1).alias("run"))
    return parts[1].join(old, "user_id", "left").withColumn("run", F.coalesce("run", F.lit(2)))


from strata.plans import catalog_runs  # noqa: E402,F401  registers its queries here
