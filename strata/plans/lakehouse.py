"""Bronze -> silver -> gold jobs over versioned parquet tables.

Bronze: each source is read (declared schema where there is one), names are
standardized, audit columns added, corrupt JSON lines quarantined, and the
rows appended; JSON is parsed once, for both. Silver reads only the bronze versions
appended since its last run (recorded with each silver version; a rewritten
bronze table means a full read). Events get their properties parsed, the latest
row per event id, validation, and are upserted on event id: the later event
time wins, then the later ingestion, then a row hash, so the table does not
depend on how deliveries were cut; an event whose date was corrected moves.
Only the dates involved are read and replaced. Transactions are validated and
appended, or upserted when they have a key.

Customers are kept up by what changed. ``silver/customer_daily`` holds event metrics per
(event partition, day, customer) that add up; a run computes them again for the partitions
its events touched. Customers that are new or were in such a row, before or after, get
the latest row per id, validation, their merged metrics (left join) and segments, and are
upserted on customer id in one write; all others stay as they are.

Gold: the daily summary by date, type and region, and customer lifetime value. Silver
notes in ``silver/changed_days`` the days whose events changed or whose customers' region
did; gold recomputes those days, from the event partitions that hold them, and replaces
their partitions; other days keep their files. Lifetime value depends on the reporting date
and is a new snapshot each time.

A run that finds these tables out of step with each other (a crash in between, changed
segment thresholds, unpartitioned events, a rewritten table) computes them in full, so
the result never depends on the way taken.

Layers hand over through stored tables, so a failing layer leaves the ones
before it committed; each table write is one job whose row count is
observed during the write. Validation writes its input once to the shared folder, counting
on the way, and quarantine and table read that: nothing is kept on the executors.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.columns import (add_ingestion_metadata, parse_event_properties,
                                      standardize_columns)
from strata.operators.customers import (build_customer_lifetime_value, compute_customer_segments,
                                        daily_event_metrics, enrich_customers, join_event_metrics,
                                        merge_event_metrics)
from strata.operators.dedup import latest_per_key
from strata.operators.quality import DataQualityError, QualityEngine
from strata.operators.summary import daily_summary_by_region
from strata.schemas import CUSTOMER_SCHEMA, EVENT_SCHEMA, TRANSACTION_COLUMNS, require_columns
from strata.sinks import tables
from strata.sinks.files import write_quarantine
from strata.sources.files import CORRUPT, read_source, split_corrupt, staged_split

SCHEMAS = {"raw_events": EVENT_SCHEMA, "raw_customers": CUSTOMER_SCHEMA}


#: which of two rows of one event is later
EVENT_ORDER = ("event_timestamp", "_ingested_at")


def _path(config: Mapping, layer: str, name: str) -> str:
    root = config["layers"][layer]["path"]
    if not root:
        raise ValueError(f"layers.{layer}.path is not set")
    return f"{str(root).rstrip('/')}/{name}"


def run_bronze(spark: SparkSession, config: Mapping,
               ingested_at: str | _dt.datetime | None = None) -> dict:
    metrics = {}
    quarantine = config["quality"].get("quarantine_path")
    for name, cfg in config["sources"].items():
        if not cfg.get("path"):
            continue
        raw = read_source(spark, cfg, SCHEMAS.get(name))
        df = add_ingestion_metadata(standardize_columns(raw), name, ingested_at=ingested_at)
        result: dict = {}
        if cfg["format"] == "json":
            df, corrupt = (staged_split if quarantine else split_corrupt)(df, _corrupt_name(cfg))
            if corrupt is not None and quarantine:
                result["corrupt"] = write_quarantine(corrupt, quarantine, name)
        parts = [c for c in cfg.get("partition_columns") or [] if c in df.columns]
        result.update(tables.write_table(df, _path(config, "bronze", name),
                                         config["layers"]["bronze"]["write_mode"], parts))
        metrics[name] = result
    return metrics


def _corrupt_name(cfg: Mapping) -> str:
    return str((cfg.get("read_options") or {}).get("columnNameOfCorruptRecord", CORRUPT))


def _engine(config: Mapping, as_of) -> QualityEngine:
    return QualityEngine(config["quality"], as_of=None if as_of is None else str(as_of))


def run_silver(spark: SparkSession, config: Mapping, as_of: str | _dt.date | None = None) -> dict:
    metrics = {}
    engine = _engine(config, as_of)
    silver = config["layers"]["silver"]
    ev_cfg = config.get("events", {})

    events_path = _path(config, "silver", "events")
    ev_parts = silver.get("events_partition_by") or []
    # incremental: only bronze versions appended since the last silver run
    seen = tables.latest_meta(spark, events_path).get("bronze_version")
    events, bronze_v, full = tables.read_changes(
        spark, _path(config, "bronze", "raw_events"), seen)
    touched = before = None
    if events is None:
        metrics["events"] = {"mode": "no new bronze rows", "bronze_version": bronze_v}
    else:
        events = parse_event_properties(events, ev_cfg.get("property_keys", ()))
        key = silver.get("events_key", "event_id")
        events = latest_per_key(events, key, EVENT_ORDER[0], EVENT_ORDER[1:])
        events_valid, events_report = engine.validate(events, "events", table="events", store=True)
        ev_parts = [c for c in ev_parts if c in events_valid.columns]
        if ev_parts and tables.table_exists(spark, events_path):
            touched = tables.touched_partitions(tables.read_version(spark, events_path), events_valid, key, ev_parts)
            before = _days_in(spark, config, touched, seen)
        # keys are unique: latest_per_key just ran on the merge key
        metrics["events"] = {**tables.merge_upsert(events_valid, events_path, key,
                                                   partition_by=ev_parts or None,
                                                   check_unique=False,
                                                   within_partitions=bool(ev_parts),
                                                   meta={"bronze_version": bronze_v},
                                                   newer=EVENT_ORDER, touched=touched),
                             "quality": events_report, "bronze_version": bronze_v,
                             "full_read": full}
    changed, since = _update_customer_daily(spark, config, touched, before, seen)
    metrics["customers"] = _silver_customers(spark, config, engine, changed, since)

    bronze_tx, tx_path = _path(config, "bronze", "raw_transactions"), _path(config, "silver", "transactions")
    if tables.table_exists(spark, bronze_tx):
        metrics["transactions"] = _silver_transactions(spark, silver, engine, bronze_tx, tx_path)
    return metrics


def _days_in(spark: SparkSession, config: Mapping, touched: DataFrame, version) -> DataFrame | None:
    """(day, customer_id) of the touched partitions before the merge, from the daily metrics;
    None if those are not of the events' ``version``."""
    path = _path(config, "silver", "customer_daily")
    if version is None or tables.latest_meta(spark, path).get("events_version") != version:
        return None
    return tables.staged(tables.in_partitions(tables.read_version(spark, path), touched)
                         .select("day", "customer_id").distinct(), "days_before")


def _note_days(spark: SparkSession, config: Mapping, days: DataFrame | None) -> None:
    """Notes days for gold; None: all of them."""
    path = _path(config, "silver", "changed_days")
    if days is None:
        tables.write_table(spark.range(0).select(F.lit(None).cast("date").alias("day")), path, "overwrite")
    else:
        tables.write_table(days.select("day").distinct(), path, "append")


def _update_customer_daily(spark: SparkSession, config: Mapping, touched: DataFrame | None,
                           before: DataFrame | None, seen) -> tuple[DataFrame | None, object]:
    """Brings the daily metrics up to the silver events: (customers whose rows changed, as a
    written frame, since which version of the events), or (None, None) where all may have."""
    events_path, path = (_path(config, "silver", x) for x in ("events", "customer_daily"))
    if not tables.table_exists(spark, events_path):
        return None, None
    meta = tables.latest_meta(spark, events_path)
    version, parts = meta.get("bronze_version"), list(meta.get("partition_by", []))
    if touched is None and version is not None \
            and tables.latest_meta(spark, path).get("events_version") == version:
        return tables.staged(spark.range(0).select(F.lit(None).cast("string").alias("customer_id")), "no_customers"), version
    events = tables.read_version(spark, events_path)
    new_meta = {"events_version": version}
    if touched is None or before is None:
        _note_days(spark, config, None)
        tables.write_table(daily_event_metrics(events, parts), path, "overwrite", parts, meta=new_meta)
        return None, None
    daily = tables.staged(daily_event_metrics(tables.in_partitions(events, touched), parts), "customer_daily")
    rows = before.unionByName(daily.select("day", "customer_id"))
    _note_days(spark, config, rows)  # first: noting too much is harmless
    tables.overwrite_partitions(daily, path, parts, within=touched, meta=new_meta, written=True)
    return tables.staged(rows.select("customer_id").distinct(), "changed_customers"), seen


def _silver_customers(spark: SparkSession, config: Mapping, engine: QualityEngine,
                      changed: DataFrame | None, since) -> dict:
    """Silver customers: those that are new, and those whose events ``changed`` since a version."""
    silver, seg = config["layers"]["silver"], dict(config.get("segments", {}) or {})
    key, path = silver["merge_key"], _path(config, "silver", "customers")
    daily_path = _path(config, "silver", "customer_daily")
    mode, meta = silver.get("write_mode", "merge"), tables.latest_meta(spark, path)
    follows = (mode == "merge" and key == "customer_id" and changed is not None and meta.get("segments") == seg
               and meta.get("events_version") == since and meta.get("customers_version") is not None)
    new, version, full = tables.read_changes(spark, _path(config, "bronze", "raw_customers"),
                                             meta["customers_version"] if follows else None)
    follows = follows and not full
    report = None
    if new is not None:
        new, report = engine.validate(latest_per_key(standardize_columns(new), key, "_ingested_at"), "customers",
                                      table="customers", store=True)
    daily = tables.read_version(spark, daily_path) if tables.table_exists(spark, daily_path) else \
        spark.createDataFrame([], "day date, customer_id string, events long, types array<string>, "
                                  "last_event_at timestamp, first_event_at timestamp")
    rows, metrics, held = new, daily, None
    if follows:
        ids = changed.select(F.col("customer_id").alias("__id"))
        if new is not None:
            ids = ids.unionByName(new.select(F.col(key).alias("__id")))
        ids = tables.staged(ids.filter("__id is not null").distinct(), "customer_ids")
        if new is None and not ids.limit(1).count():
            return {"mode": "no new rows", "rows_written": 0}
        old = tables.read_version(spark, path)
        base = [c for c in old.columns if c not in (*METRIC_COLUMNS, "segment")]
        held = old.join(ids, old[key] == ids["__id"], "left_semi")
        rows = held.select(*base)
        if new is not None:
            rows = latest_per_key(rows.unionByName(new.select(*base)), key, "_ingested_at")
        metrics = daily.join(ids, daily["customer_id"] == ids["__id"], "left_semi")
    out = compute_customer_segments(join_event_metrics(rows, merge_event_metrics(metrics), "left"), **seg)
    if follows:  # days on which a customer of another region had events
        out = tables.staged(out, "customers")
        was = held.select(F.col(key).alias("__id"), F.struct("region").alias("__was"))
        moved = out.join(was, F.col(key) == F.col("__id"), "left").filter(
            F.col("__was").isNull() | ~F.col("region").eqNullSafe(F.col("__was.region")))
        moved = moved.select(F.col(key).alias("__moved"))
        _note_days(spark, config, daily.join(moved, daily["customer_id"] == moved["__moved"], "left_semi"))
    elif changed is not None:  # else all days are noted already
        _note_days(spark, config, None)
    now = {"events_version": tables.latest_meta(spark, daily_path).get("events_version"),
           "customers_version": version, "segments": seg}
    if mode == "merge":
        res = tables.merge_upsert(out, path, key, partition_by=silver.get("partition_by"), check_unique=False, meta=now)
    else:
        res = tables.write_table(out, path, mode, silver.get("partition_by"), meta=now)
    return {**res, "quality": report, "full_read": not follows}


METRIC_COLUMNS = ("total_events", "distinct_event_types", "last_event_at", "first_event_at")


def _silver_transactions(spark: SparkSession, silver: Mapping, engine: QualityEngine,
                         bronze_path: str, path: str) -> dict:
    """Validates the transactions that bronze got since the last run and adds them."""
    seen = tables.latest_meta(spark, path).get("bronze_version")
    tx, bronze_v, full = tables.read_changes(spark, bronze_path, seen)
    if tx is None:
        return {"mode": "no new bronze rows", "bronze_version": bronze_v}
    require_columns(tx, TRANSACTION_COLUMNS, "transactions")
    key, parts = silver.get("transactions_key"), list(silver.get("transactions_partition_by") or [])
    if key:
        tx = latest_per_key(tx, key, "_ingested_at")
    tx_valid, report = engine.validate(tx, "transactions", table="transactions", store=True)
    meta = {"bronze_version": bronze_v}
    if key:
        res = tables.merge_upsert(tx_valid, path, key, partition_by=parts or None, check_unique=False,
                                  within_partitions=bool(parts), meta=meta, newer=["_ingested_at"])
    else:
        res = tables.write_table(tx_valid, path, "overwrite" if full else "append", parts or None, meta=meta)
    return {**res, "quality": report, "bronze_version": bronze_v, "full_read": full}


def _gold_summary(spark: SparkSession, config: Mapping, customers: DataFrame) -> dict:
    """The daily summary: in full at first, then the days that silver noted."""
    path, days_path = _path(config, "gold", "daily_summary"), _path(config, "silver", "changed_days")
    parts = list(config["layers"]["gold"].get("partition_by") or [])
    events = tables.read_version(spark, _path(config, "silver", "events"))
    session = config.get("events", {}).get("session_key", "session_id")
    meta = tables.latest_meta(spark, path)
    known = parts == ["event_date"] == meta.get("partition_by") and meta.get("session") == session
    days, version, full = (None, None, True) if not tables.table_exists(spark, days_path) else \
        tables.read_changes(spark, days_path, meta.get("days_version") if known else None)
    now = {"days_version": version, "session": session}
    if full or not known:
        summary = daily_summary_by_region(events, customers.select("customer_id", "region"),
                                          session_col=session, unique=True)
        return {**tables.write_table(summary, path, "overwrite", parts, meta=now), "full_read": True}
    if days is None:
        return {"mode": "no changed days", "rows_written": 0, "path": path}
    days = tables.staged(days.select(F.col("day").alias("event_date")).distinct(), "gold_days")
    daily = tables.read_version(spark, _path(config, "silver", "customer_daily"))
    by = tables.latest_meta(spark, _path(config, "silver", "customer_daily"))["partition_by"]
    held = daily.join(days, daily["day"].eqNullSafe(days["event_date"]), "left_semi").select(*by).distinct()
    rows = tables.in_partitions(events, tables.staged(held, "gold_partitions"))
    rows = rows.join(days.select(F.col("event_date").alias("__day")),
                     F.to_date("event_timestamp").eqNullSafe(F.col("__day")), "left_semi")
    summary = daily_summary_by_region(rows, customers.select("customer_id", "region"), session_col=session, unique=True)
    return {**tables.overwrite_partitions(summary, path, parts, within=days, meta=now), "full_read": False}


def run_gold(spark: SparkSession, config: Mapping, as_of: str | _dt.date | None = None) -> dict:
    metrics = {}
    gold = config["layers"]["gold"]
    customers = tables.read_version(spark, _path(config, "silver", "customers"))
    metrics["daily_summary"] = _gold_summary(spark, config, customers)
    tx_path = _path(config, "silver", "transactions")
    if tables.table_exists(spark, tx_path):
        clv = build_customer_lifetime_value(customers, tables.read_version(spark, tx_path),
                                            as_of=as_of)
        metrics["customer_clv"] = tables.write_table(
            clv, _path(config, "gold", "customer_clv"), "overwrite")
    return metrics


def run(spark: SparkSession, config: Mapping,
        layers: Sequence[str] = ("bronze", "silver", "gold"),
        as_of: str | _dt.date | None = None,
        ingested_at: str | _dt.datetime | None = None) -> dict:
    """Run the chosen layers in order. A critical quality failure (with
    ``fail_on_error``) ends the run with status ``failed_quality`` and its
    report; other errors propagate to the caller."""
    out: dict = {"as_of": None if as_of is None else str(as_of), "layers": {}}
    started = _dt.datetime.now(_dt.timezone.utc)
    try:
        if "bronze" in layers:
            out["layers"]["bronze"] = run_bronze(spark, config, ingested_at)
        if "silver" in layers:
            out["layers"]["silver"] = run_silver(spark, config, as_of)
        if "gold" in layers:
            out["layers"]["gold"] = run_gold(spark, config, as_of)
        out["status"] = "success"
    except DataQualityError as e:
        out.update(status="failed_quality", error=str(e), report=e.report)
    out["elapsed_seconds"] = round(
        (_dt.datetime.now(_dt.timezone.utc) - started).total_seconds(), 2)
    return out


def main(argv: Sequence[str] | None = None) -> int:
    """``python -m strata.plans.lakehouse --config c.yaml [--env dev]
    [--layers bronze silver gold] [--date YYYY-MM-DD]``.

    The session comes from ``spark-submit`` / the cluster defaults; the
    config's ``spark.config`` entries are applied to the builder. ``--date``
    is the as-of date for CLV and date checks. Exit code 1 on failure.
    """
    import argparse
    import json

    from strata.config import load_config

    parser = argparse.ArgumentParser(description="bronze -> silver -> gold")
    parser.add_argument("--config", required=True)
    parser.add_argument("--env", default=None)
    parser.add_argument("--layers", nargs="+", default=["bronze", "silver", "gold"])
    parser.add_argument("--date", default=None)
    args = parser.parse_args(argv)
    config = load_config(args.config, args.env)
    builder = SparkSession.builder.appName(
        str(config.get("spark", {}).get("app_name", "strata-lakehouse")))
    for k, v in (config.get("spark", {}).get("config") or {}).items():
        builder = builder.config(k, str(v))
    spark = builder.getOrCreate()
    try:
        result = run(spark, config, args.layers, as_of=args.date)
    except Exception as e:  # noqa: BLE001 - reported, then a failing exit code
        print(json.dumps({"status": "failed", "error": str(e)}))
        return 1
    print(json.dumps(result, default=str))
    return 0 if result["status"] == "success" else 1


if __name__ == "__main__":
    raise SystemExit(main())
