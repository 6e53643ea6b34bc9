"""Run counters: read, written, filtered, rejected, batches, rates.

Counts come from ``DataFrame.observe`` on the jobs that run anyway (or
from streaming progress), never from an extra ``count()``. The counters
are disjoint: read = written + filtered + rejected.
"""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass
class RunMetrics:
    records_read: int = 0
    records_written: int = 0
    records_filtered: int = 0
    records_rejected: int = 0
    batches_processed: int = 0
    started_at: float = field(default_factory=time.time)
    elapsed_seconds: float = 0.0
    layers: dict = field(default_factory=dict)

    def finish(self) -> "RunMetrics":
        self.elapsed_seconds = time.time() - self.started_at
        return self

    @property
    def error_rate_percent(self) -> float:
        return self.records_rejected / self.records_read * 100 if self.records_read else 0.0

    @property
    def records_per_second(self) -> float:
        return self.records_written / self.elapsed_seconds if self.elapsed_seconds > 0 else 0.0

    def snapshot(self) -> dict:
        d = asdict(self)
        d.pop("started_at")
        d["error_rate_percent"] = self.error_rate_percent
        d["records_per_second"] = self.records_per_second
        return d

    COUNTERS = ("records_read", "records_written", "records_filtered", "records_rejected",
                "batches_processed")

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """The counters as a one-row frame (no timing: it does not repeat)."""
        schema = T.StructType([T.StructField(c, T.LongType()) for c in self.COUNTERS])
        return spark.createDataFrame([tuple(getattr(self, c) for c in self.COUNTERS)], schema)
