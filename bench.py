"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's whole plan runs into Spark's ``noop`` sink (nothing is
collected to the driver); one warm-up pass, then the median of
$BENCH_RUNS timed runs. Prints one JSON line. ``comparisons`` times the
reference's validation strategy (one count up front plus one per check)
next to the single-pass engine on the same lineitem checks.
"""

from __future__ import annotations

import gc
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strata import datasets as ds  # noqa: E402
from strata.operators.quality import QualityCheck  # noqa: E402
from strata.plans import catalog  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = [
    "customer_360", "latest_event_per_user", "dedup_injected_events", "daily_summary",
    "daily_summary_join_first",
    "txn_metrics", "customer_clv", "quality_report", "lineitem_quality_report", "merge_all",
    "first_per_key", "filter_gt", "normalize_fields", "partition_overwrite", "csv_records",
    "record_flow_batch", "bronze_to_gold",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def sequential_validate(spark, sf_dir: str) -> None:
    """The reference's strategy: count, then filter + count per check."""
    df = ds.table(spark, sf_dir, "lineitem")
    df.count()
    for c in catalog.LINEITEM_CHECKS:
        chk = QualityCheck.from_dict(c)
        if chk.rule == "unique":
            df.groupBy(chk.column).count().filter("count > 1").count()
            continue
        cond = F.coalesce(chk.failing(df), F.lit(False))
        df.filter(cond).count()
        if chk.severity == "critical":
            df = df.filter(~cond)


def release(spark) -> None:
    """Let Spark's cleaner drop earlier queries' shuffle files and broadcasts,
    so each query is timed as in a session of its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="strata-bench")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    queries = {}
    for name in names:
        fn = catalog.QUERIES[name]
        release(spark)
        queries[name] = timed(lambda fn=fn: run_noop(fn(spark, sf_dir)), runs)
    single = timed(lambda: catalog.lineitem_quality_report(spark, sf_dir).collect(), runs)
    sequential = timed(lambda: sequential_validate(spark, sf_dir), runs)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "comparisons": {"lineitem_validate_single_pass": single,
                        "lineitem_validate_sequential_reference_style": sequential},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
