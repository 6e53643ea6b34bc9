"""Physical plans of every registered query as they ran (PLANS.md).

Each query runs into Spark's ``noop`` sink with Spark's event log in a scratch
folder. Counted are the nodes of the last plan of every SQL execution that ran
for it: also those of the writes and reads that happen before the query returns
its frame, and after AQE has chosen. Usage:
    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from collections import Counter
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata.plans import catalog  # noqa: E402
from strata.session import local_session  # noqa: E402


def nodes(plan: dict) -> Counter:
    """Node names of a plan, exchanges by their kind; reused ones count once."""
    name = plan["nodeName"].split(" (")[0].strip()
    if name == "Exchange":
        kind = re.search(r"(hash|range|SinglePartition|RoundRobin|REBALANCE)", plan["simpleString"])
        name = f"Exchange {kind[1] if kind else ''}".strip()
    out = Counter({name: 1})
    if name != "ReusedExchange":
        for child in plan["children"]:
            out += nodes(child)
    return out


def executions(log: Path, after: int) -> tuple[dict[int, Counter], int]:
    """The last plan of each execution started after byte ``after`` of the log."""
    found: dict[int, Counter] = {}
    with log.open(errors="replace") as f:
        f.seek(after)
        for line in f:
            if "sparkPlanInfo" in line:
                event = json.loads(line)
                found[event["executionId"]] = nodes(event["sparkPlanInfo"])
        return found, f.tell()


def row(name: str, found: dict[int, Counter]) -> str:
    total = sum(found.values(), Counter())

    def listed(pattern: str) -> str:
        return ", ".join(f"{k} {v}" for k, v in sorted(total.items()) if re.search(pattern, k)) or "-"

    shuffles = sum(v for k, v in total.items() if k.startswith("Exchange"))
    writes = sum(v for k, v in total.items() if k.startswith("Execute InsertInto"))
    scans = sum(v for k, v in total.items() if k.startswith("Scan"))
    return (f"| {name} | {len(found)} | {writes} | {shuffles} ({total['Exchange SinglePartition']} single) | "
            f"{total['BroadcastExchange']} | {listed('Join|Cartesian')} | {listed('Aggregate')} | "
            f"{listed('Window|Expand')} | {scans} |")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    folder = tempfile.mkdtemp(prefix="run-plans-")
    log = {"enabled": "true", "dir": f"file://{folder}", "compress": "false", "rolling.enabled": "false",
           "buffer.kb": "1k"}
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
        map={f"spark.eventLog.{k}": v for k, v in log.items()}).getOrCreate()
    spark = local_session()
    print("# Physical plans of the registered queries\n")
    print(f"Input `{sf_dir}`. Sums over all SQL executions of a query, the writes and reads before its")
    print("frame included, as AQE left them. Generated by `scripts/plan_report.py`.\n")
    print("| query | executions | writes | shuffles | broadcasts | joins | aggregates | windows | scans |")
    print("|---|---|---|---|---|---|---|---|---|")
    at = 0
    for name, fn in catalog.QUERIES.items():
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found, at = executions(next(Path(folder).iterdir()), at)
        print(row(name, found), flush=True)
    print("""
Single-partition exchanges are the last step of global aggregates (one row per
task), windows over one row per file or length block, and limits.""")


if __name__ == "__main__":
    main()
