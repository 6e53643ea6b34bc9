"""The record flow: ordered stages over text records, batch or streaming.

A stage is any ``DataFrame -> DataFrame`` function, chained with
``DataFrame.transform``. Built-in stages: filter, normalize, rename,
deduplicate. Deduplication keeps the first arrival per key (key as text;
rows with a NULL key pass); in batch "first" means the smallest
(``_row_number``, source name), i.e. sources read side by side; on a stream
(``strata.streaming.records``) it is Spark's dropDuplicates state, or
dropDuplicatesWithinWatermark when an event-time column is given. A filtered
record whose source lacks the field is an error: it goes to the rejects, as
malformed rows do.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.columns import normalize_fields, rename_fields
from strata.operators.dedup import first_per_key
from strata.operators.filters import split_records
from strata.plans.metrics import RunMetrics
from strata.session import stored
from strata.sinks.files import write_ndjson, write_rejects
from strata.sources.records import CORRUPT, RECORD_SOURCE, read_csv_records, union_sources

Stage = Callable[[DataFrame], DataFrame]
ARRIVAL_ORDER = ("_row_number", RECORD_SOURCE)


@dataclass
class _Step:
    name: str
    fn: Stage | None = None
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None
    dedup_key: str | None = None
    event_time: str | None = None
    watermark: str | None = None


@dataclass
class RecordFlow:
    steps: list[_Step] = field(default_factory=list)
    order_by: Sequence[str] = ARRIVAL_ORDER
    error_handler: Callable[[DataFrame], None] | None = None

    def add_stage(self, name: str, fn: Stage) -> "RecordFlow":
        self.steps.append(_Step(name, fn))
        return self

    def set_error_handler(self, handler: Callable[[DataFrame], None]) -> "RecordFlow":
        """Called with the rejected rows of a run (batch) or of each micro-batch."""
        self.error_handler = handler
        return self

    def filter(self, name: str, field: str, operator: str, value: str) -> "RecordFlow":
        self.steps.append(_Step(name, split=lambda df: split_records(df, field, operator, value)))
        return self

    def normalize(self, name: str, fields: Sequence[str]) -> "RecordFlow":
        return self.add_stage(name, lambda df: normalize_fields(df, fields))

    def rename(self, name: str, mappings: Mapping[str, str]) -> "RecordFlow":
        return self.add_stage(name, lambda df: rename_fields(df, mappings))

    def deduplicate(self, name: str, key_field: str, event_time: str | None = None,
                    watermark: str = "1 hour") -> "RecordFlow":
        self.steps.append(_Step(name, dedup_key=key_field, event_time=event_time,
                                watermark=watermark))
        return self

    @classmethod
    def from_config(cls, transforms: Sequence[Mapping[str, object]]) -> "RecordFlow":
        """Stages in list order from ``{name, operation, config}`` entries;
        an unknown operation raises ``ValueError``."""
        flow = cls()
        for t in transforms:
            name, op = str(t["name"]), str(t["operation"])
            cfg = dict(t.get("config", {}) or {})
            if op == "filter":
                flow.filter(name, str(cfg["field"]), str(cfg["operator"]), str(cfg["value"]))
            elif op == "normalize":
                flow.normalize(name, [str(f) for f in cfg.get("fields", [])])
            elif op == "map":
                flow.rename(name, {str(k): str(v) for k, v in cfg.get("mappings", {}).items()})
            elif op == "deduplicate":
                flow.deduplicate(name, str(cfg["key_field"]), cfg.get("event_time"),
                                 str(cfg.get("watermark", "1 hour")))
            else:
                raise ValueError(f"unknown transform operation {op!r} in stage {name!r}")
        return flow

    def apply(self, df: DataFrame) -> DataFrame:
        """The records that pass every stage."""
        return self.apply_with_rejects(df)[0]

    def apply_with_rejects(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(records that pass, records that are errors with ``_error``, or None)."""
        rejects: list[DataFrame] = []
        for step in self.steps:
            if step.split is not None:
                df, bad = step.split(df)
                rejects.append(bad)
            elif step.fn is not None:
                df = df.transform(step.fn)
            else:
                df = first_per_key(df, step.dedup_key, [c for c in self.order_by
                                                        if c in df.columns])
        return df, reduce(_by_name, rejects) if rejects else None

    def segments(self) -> list[tuple[_Step | None, "RecordFlow"]]:
        """The flow cut at its deduplications: (None, stages before the first), then
        (deduplication, stages after it) for each."""
        out: list[tuple[_Step | None, RecordFlow]] = [(None, RecordFlow(order_by=self.order_by))]
        for step in self.steps:
            if step.dedup_key is not None:
                out.append((step, RecordFlow(order_by=self.order_by)))
            else:
                out[-1][1].steps.append(step)
        return out


def _by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def run_records(spark: SparkSession, sources: Sequence[Mapping[str, object]], flow: RecordFlow,
                output_path: str, dead_letter_path: str | None = None) -> RunMetrics:
    """Batch run: CSV sources -> flow -> NDJSON, rejects to the dead letter.

    ``sources``: ``{name, location, properties: {delimiter, encoding}}``.
    Each source is parsed once, into a table in the shared folder; the read count
    is observed on the job that writes the output. Rejects (malformed rows and
    records that a filter can't judge) are made once: counted on the job that writes
    them, and given to the error handler from what was written, with or without a
    dead letter.
    """
    metrics = RunMetrics()
    scans = {}
    for s in sources:
        props = dict(s.get("properties", {}) or {})
        scans[str(s["name"])] = read_csv_records(
            spark, s["location"], str(s["name"]), sep=str(props.get("delimiter", ",")),
            encoding=str(props.get("encoding", "utf-8")))
    records = union_sources({n: sc.records for n, sc in scans.items()})
    read_obs, reject_obs = Observation("records_read"), Observation("records_rejected")
    out, _ = flow.apply_with_rejects(records.observe(read_obs, F.count(F.lit(1)).alias("n")))
    metrics.records_written = write_ndjson(out, output_path)["rows_written"]
    good = int(read_obs.get["n"])
    rejects = reduce(_by_name, [sc.rejects for sc in scans.values()])
    if (errors := flow.apply_with_rejects(records)[1]) is not None:  # without the observation
        rejects = _by_name(rejects, errors)
    rejects = rejects.observe(reject_obs, F.count(F.lit(1)).alias("n"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"))
    if flow.error_handler is not None:
        rejects = stored(rejects, "rejects")
    if dead_letter_path is not None:
        write_rejects(rejects, dead_letter_path)
    elif flow.error_handler is None:
        rejects.write.format("noop").mode("overwrite").save()
    if flow.error_handler is not None:
        flow.error_handler(rejects)
    metrics.records_rejected, malformed = int(reject_obs.get["n"]), int(reject_obs.get["bad"])
    metrics.records_read = good + malformed
    metrics.records_filtered = metrics.records_read - metrics.records_written - metrics.records_rejected
    metrics.batches_processed = 1
    return metrics.finish()


def run_from_config(spark: SparkSession, config: Mapping[str, object],
                    stream: bool = False, checkpoint: str | None = None) -> RunMetrics:
    """Run a record pipeline config: ``sources`` (name, type csv, location,
    properties), ``transforms`` (filter / normalize / map / deduplicate),
    ``destination`` (type jsonfile, connection_string = output folder) and
    ``pipeline`` (dead_letter_path; for streams max_files_per_trigger or
    max_bytes_per_trigger, processing_time, timeout_s). ``stream`` runs the source folders as one
    Structured Streaming query (needs ``checkpoint``); dedup state is shared
    by all sources, as in the batch run."""
    sources = list(config.get("sources", []))
    for s in sources:
        if s.get("type", "csv") != "csv":
            raise ValueError(f"unsupported source type: {s.get('type')}")
    dest = dict(config.get("destination", {}) or {})
    if dest.get("type", "jsonfile") != "jsonfile":
        raise ValueError(f"unsupported destination type: {dest.get('type')}")
    flow = RecordFlow.from_config(list(config.get("transforms", [])))
    out = str(dest["connection_string"])
    options = dict(config.get("pipeline", {}) or {})
    dead = options.get("dead_letter_path")
    if not stream:
        return run_records(spark, sources, flow, out, dead)
    from strata.streaming.records import StreamSource, run_record_streams
    if checkpoint is None:
        raise ValueError("a streaming run needs a checkpoint location")
    stream_sources = []
    for s in sources:
        props = dict(s.get("properties", {}) or {})
        stream_sources.append(StreamSource(str(s["name"]), str(s["location"]), None,
                                           str(props.get("delimiter", ",")), str(props.get("encoding", "utf-8"))))
    limits = {k: options[k] for k in ("max_files_per_trigger", "max_bytes_per_trigger",
                                      "processing_time", "timeout_s") if options.get(k) is not None}
    run = run_record_streams(spark, stream_sources, flow, out, checkpoint,
                             dead_letter_path=dead, **limits)
    return run.metrics


def main(argv: Sequence[str] | None = None) -> int:
    """``python -m strata.plans.records --config pipeline.json [--stream --checkpoint DIR]``."""
    import argparse
    import json

    parser = argparse.ArgumentParser(description="CSV records -> stages -> NDJSON")
    parser.add_argument("--config", required=True)
    parser.add_argument("--stream", action="store_true")
    parser.add_argument("--checkpoint", default=None)
    args = parser.parse_args(argv)
    with open(args.config) as f:
        config = json.load(f)
    spark = SparkSession.builder.appName("strata-records").getOrCreate()
    metrics = run_from_config(spark, config, stream=args.stream, checkpoint=args.checkpoint)
    print(json.dumps(metrics.snapshot()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
