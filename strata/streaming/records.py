"""The record flow on Structured Streaming.

Text files arrive in folders. The run is a chain of streams, each with its own
checkpoint; the deduplications of the flow are the joints:

* the intake reads lines. Each micro-batch holds whole files, so the header of every
  file is among its lines: records are parsed on the executors, each by the header
  of its own file. The stages before the first deduplication run on them.
* each deduplication reads what the stream before it has published: Spark keeps the
  keys in state (``dropDuplicates``, or ``dropDuplicatesWithinWatermark`` with an
  event time). A row without the key goes round the state. The stages up to
  the next deduplication, or the sink, run on each micro-batch.

Between streams a row is its fields as a map with its key and event time, so files may
bring fields that no earlier file had; all fields are text there. A batch is published
by one rename: the next stream sees it whole or not at all, and a batch run again after
a crash finds it published and leaves it. The sink writes ``batch_id=N`` with overwrite,
so a batch run again rewrites the same folder.

Late rows: with an event time, a batch's watermark is the greatest time of the batches
before it less the delay, kept beside the checkpoint. Keyed rows at or before it are not
handed to the state, which might have forgotten their key, but go to the dead letter.
Spark's own watermark never runs ahead of this one, so nothing is dropped unseen.

Rejects (malformed rows, records a stage can't judge, rows without a readable time, late
rows) have fixed columns: source, file, the malformed text or the fields as a map, and
``_error``. They are counted, given to the error handler and, with a dead-letter
folder, written there. Every row read is written, filtered or rejected.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.plans.metrics import RunMetrics
from strata.plans.records import RecordFlow
from strata.session import broadcast_below, drop_scratch, file_system, scratch_path, stored_counted
from strata.sinks.files import records_to_json_struct
from strata.sources.records import (CORRUPT, ENVELOPE, POSITION, RECORD_SOURCE, file_headers, header_groups,
                                    parse_lines, text_lines)

_HOP = f"{RECORD_SOURCE} string, _file string, fields map<string,string>, __key string, __time timestamp"


@dataclass
class StreamRun:
    metrics: RunMetrics
    output_path: str
    checkpoint: str


@dataclass(frozen=True)
class StreamSource:
    """A folder of CSV files. Each file has its own header, unless ``header`` is given for all."""

    name: str
    path: str
    header: Sequence[str] | None = None
    sep: str = ","
    encoding: str = "utf-8"


def run_record_stream(spark: SparkSession, source_path: str, header: Sequence[str] | None,
                      source_name: str, flow: RecordFlow, output_path: str, checkpoint: str,
                      dead_letter_path: str | None = None, max_files_per_trigger: int = 1,
                      processing_time: str | None = None, sep: str = ",",
                      timeout_s: float | None = None, encoding: str = "utf-8") -> StreamRun:
    """Run the flow over one folder of CSV files (see ``run_record_streams``)."""
    return run_record_streams(spark, [StreamSource(source_name, source_path, header, sep, encoding)], flow,
                              output_path, checkpoint, dead_letter_path, max_files_per_trigger,
                              processing_time, timeout_s)


def run_record_streams(spark: SparkSession, sources: Sequence[StreamSource], flow: RecordFlow,
                       output_path: str, checkpoint: str, dead_letter_path: str | None = None,
                       max_files_per_trigger: int = 1, processing_time: str | None = None,
                       timeout_s: float | None = None,
                       max_bytes_per_trigger: int | None = None, keep_published: bool = False,
                       stop_when_idle: bool = False) -> StreamRun:
    """Run the flow over several folders of CSV files as one chain of streams.

    The sources are put together before the flow, so dedup state is shared by all of
    them. By default ``availableNow``: process what is there, then stop (as a batch run ends
    when its sources are exhausted). With ``processing_time`` the streams keep running on
    that interval until ``timeout_s`` (with ``stop_when_idle`` until the intake has nothing new);
    what the intake has read by then is still brought to the sink. Each trigger takes up to ``max_files_per_trigger`` new files of a source, or,
    when ``max_bytes_per_trigger`` is given, new files up to that many bytes.

    Batches passed between streams are deleted once the next stream is done with them, unless
    ``keep_published``.
    """
    run = _Run(spark, list(sources), flow.segments(), flow.error_handler, output_path.rstrip("/"),
               checkpoint.rstrip("/"), dead_letter_path.rstrip("/") if dead_letter_path else None, keep_published)
    limit = ("maxBytesPerTrigger", str(max_bytes_per_trigger)) if max_bytes_per_trigger \
        else ("maxFilesPerTrigger", str(max_files_per_trigger))
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    hops = range(len(run.segments))
    if processing_time:
        queries = [run.start(i, limit, processing_time) for i in hops]
        _wait(queries, deadline, queries[0] if stop_when_idle else None)
        for i in hops[1:]:
            _wait([run.start(i, limit, None)], None)
    else:
        for i in hops:
            if not _wait([run.start(i, limit, None)], deadline):
                raise TimeoutError(f"the input was not read to its end in {timeout_s} s; "
                                   "a rerun on the same checkpoint goes on")
    m = run.metrics
    m.records_filtered = m.records_read - m.records_rejected - m.records_written
    return StreamRun(m.finish(), output_path, checkpoint)


def _wait(queries: list, deadline: float | None, intake=None) -> bool:
    """Whether the queries ended by themselves; all are stopped at the deadline, if one fails, or
    when ``intake`` has run and waits for data."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(0.2)
            if deadline is not None and time.monotonic() > deadline:
                return not any(q.isActive for q in queries)
            if intake is not None and intake.lastProgress is not None and not intake.status["isTriggerActive"] \
                    and not intake.status["isDataAvailable"]:
                return False
        return True
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        for q in queries:
            if q.exception() is not None:
                raise q.exception()


@dataclass
class _Run:
    spark: SparkSession
    sources: list[StreamSource]
    segments: list
    error_handler: Callable[[DataFrame], None] | None
    output: str
    checkpoint: str
    dead_letter: str | None
    keep_published: bool
    metrics: RunMetrics = field(default_factory=RunMetrics)

    def published(self, hop: int) -> str:
        return f"{self.checkpoint}/published/{hop}"

    def start(self, hop: int, limit: tuple[str, str], processing_time: str | None):
        rows = self.intake(limit) if hop == 0 else self.deduplicated(hop)
        trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
        return (rows.writeStream.foreachBatch(self.intake_batch if hop == 0 else self.hop_batch(hop))
                .option("checkpointLocation", f"{self.checkpoint}/stream-{hop}").trigger(**trigger).start())

    def intake(self, limit: tuple[str, str]) -> DataFrame:
        streams = [text_lines(self.spark.readStream.option(*limit), s.path).withColumn("__source", F.lit(k))
                   for k, s in enumerate(self.sources)]
        return reduce(DataFrame.unionByName, streams)

    def deduplicated(self, hop: int) -> DataFrame:
        """First arrivals of each key; rows without the key pass by the state."""
        step, root = self.segments[hop][0], self.published(hop)
        fs, p = file_system(self.spark, root)
        fs.mkdirs(p)
        reader = self.spark.readStream.schema(_HOP)
        if not self.keep_published:
            reader = reader.option("cleanSource", "delete")
        rows = reader.parquet(f"{root}/batch-*")
        keyed, keyless = rows.filter("__key is not null"), rows.filter("__key is null")
        if step.event_time:
            keyed = keyed.withWatermark("__time", step.watermark).dropDuplicatesWithinWatermark(["__key"])
        else:
            keyed = keyed.dropDuplicates(["__key"])
        return keyed.drop("__key", "__time").unionByName(keyless.drop("__key", "__time"))

    def intake_batch(self, lines: DataFrame, batch_id: int) -> None:
        """Lines to records by the headers of their files, and on through the first segment."""
        spark, held = self.spark, scratch_path(self.spark, "stream_lines")
        seen = Observation("lines")
        lines = lines.withColumn(POSITION, F.monotonically_increasing_id())
        count = F.count_if(F.col("value").rlike(r"[^\x00-\x20]")).alias("n")
        lines.observe(seen, count).write.partitionBy("__source").parquet(held)
        lines = spark.read.schema(lines.schema).parquet(held)
        frames, n_heads = [], 0
        for k, s in enumerate(self.sources):
            own = lines.filter(F.col("__source") == k)
            heads, n = stored_counted(file_headers(own), "stream_headers")
            groups = header_groups(spark, heads, s.sep, s.encoding)
            n_heads += n
            if groups:
                rows = parse_lines(own, broadcast_below(heads, known=n), groups, s.sep, s.encoding, s.header)
                frames.append(rows.drop("_block", POSITION).withColumn(RECORD_SOURCE, F.lit(s.name)))
        if frames:
            parsed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
            bad = parsed.filter(F.col(CORRUPT).isNotNull()).withColumn("_error", F.lit("field count differs from header"))
            self.pass_on(0, parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), [bad], batch_id)
        elif len(self.segments) == 1:
            self.write(spark.createDataFrame([], f"{RECORD_SOURCE} string"), batch_id)
        self.metrics.records_read += int(seen.get["n"]) - n_heads
        self.metrics.batches_processed += 1
        drop_scratch(spark, held)

    def hop_batch(self, hop: int) -> Callable[[DataFrame, int], None]:
        def work(rows: DataFrame, batch_id: int) -> None:
            held = scratch_path(self.spark, "stream_rows")
            rows.write.parquet(held)  # once: the state is not asked again
            rows = self.spark.read.schema(rows.schema).parquet(held)
            names = sorted(r[0] for r in rows.select(F.explode(F.map_keys("fields"))).distinct().collect())
            columns = [F.col("fields")[n].alias(n) for n in names]
            self.pass_on(hop, rows.select(*columns, RECORD_SOURCE, "_file"), [], batch_id)
            drop_scratch(self.spark, held)
        return work

    def pass_on(self, hop: int, rows: DataFrame, rejects: list[DataFrame], batch_id: int) -> None:
        """The stages of a segment, then the sink or the next deduplication."""
        rows, errors = self.segments[hop][1].apply_with_rejects(rows)
        rejects = rejects + ([errors] if errors is not None else [])
        if hop + 1 == len(self.segments):
            self.write(rows, batch_id)
        else:
            rejects += self.publish(hop + 1, rows, batch_id)
        if rejects:
            self.reject(hop, rejects, batch_id)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        written = Observation("written")
        lines = records_to_json_struct(rows).observe(written, F.count(F.lit(1)).alias("n"))
        lines.write.mode("overwrite").text(f"{self.output}/batch_id={batch_id}")
        self.metrics.records_written += int(written.get["n"])

    def publish(self, hop: int, rows: DataFrame, batch_id: int) -> list[DataFrame]:
        """Hands a batch to deduplication ``hop``; the rows it rejects."""
        step, spark = self.segments[hop][0], self.spark
        key = F.col(step.dedup_key).cast("string") if step.dedup_key in rows.columns else F.lit(None).cast("string")
        at = F.lit(None).cast("timestamp")
        rejects = []
        seen = Observation("times")
        if step.event_time:
            if step.event_time in rows.columns:
                at = F.col(step.event_time).try_cast("timestamp")
            undated = rows.filter(at.isNull()).withColumn("_error", F.lit(f"no time in field {step.event_time!r}"))
            rejects, rows = [undated], rows.filter(at.isNotNull())
            if (mark := self.watermark(hop, batch_id - 1)) is not None:
                late = key.isNotNull() & (at <= F.timestamp_micros(F.lit(mark)) - F.expr(f"interval '{step.watermark}'"))
                rejects.append(rows.filter(late).withColumn("_error", F.lit("later than the watermark")))
                rows = rows.filter(~late)
        out = rows.select(RECORD_SOURCE, "_file", _fields(rows).alias("fields"), key.alias("__key"), at.alias("__time"))
        fs, target = file_system(spark, f"{self.published(hop)}/batch-{batch_id:012d}")
        if fs.exists(target):
            return rejects
        fresh = f"{self.published(hop)}/_batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        out.observe(seen, F.max(F.unix_micros("__time")).alias("last"), F.count(F.lit(1)).alias("n")).write.parquet(fresh)
        if step.event_time:
            known = [x for x in (self.watermark(hop, batch_id - 1), seen.get["last"]) if x is not None]
            self.keep_watermark(hop, batch_id, max(known, default=None))
        if not fs.rename(file_system(spark, fresh)[1], target):
            raise OSError(f"batch {batch_id} could not be published to {target}")
        return rejects

    def _mark_path(self, hop: int, batch_id: int) -> str:
        return f"{self.checkpoint}/watermark/{hop}/batch-{batch_id:012d}"

    def watermark(self, hop: int, batch_id: int) -> int | None:
        """The greatest event time (microseconds) up to a batch; None before the first."""
        path = self._mark_path(hop, batch_id)
        fs, p = file_system(self.spark, f"{path}/_SUCCESS")
        return self.spark.read.schema("last long").parquet(path).first()[0] if batch_id >= 0 and fs.exists(p) else None

    def keep_watermark(self, hop: int, batch_id: int, last: int | None) -> None:
        (self.spark.createDataFrame([(last,)], "last long").coalesce(1)
         .write.mode("overwrite").parquet(self._mark_path(hop, batch_id)))

    def reject(self, hop: int, rejects: list[DataFrame], batch_id: int) -> None:
        all_rejects = reduce(DataFrame.unionByName, [_rejected(r) for r in rejects])
        n = Observation("rejects")
        seen = all_rejects.observe(n, F.count(F.lit(1)).alias("n"))
        if self.dead_letter is not None:
            seen.write.mode("overwrite").parquet(f"{self.dead_letter}/stream={hop}/batch_id={batch_id}")
        else:
            seen.write.format("noop").mode("overwrite").save()
        self.metrics.records_rejected += int(n.get["n"])
        if self.error_handler is not None:
            self.error_handler(all_rejects)


def _fields(rows: DataFrame) -> Column:
    """The data columns that are not NULL, as a map of texts."""
    names = [c for c in rows.columns if c not in ENVELOPE]
    if not names:
        return F.create_map().cast("map<string,string>")
    pairs = F.create_map(*[x for c in names for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def _rejected(rows: DataFrame) -> DataFrame:
    text = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    return rows.select(RECORD_SOURCE, "_file", text.alias(CORRUPT), _fields(rows).alias("fields"), "_error")


def forget_last_commits(spark: SparkSession, checkpoint: str) -> int:
    """Deletes the commit record of the last batch of each stream of a stopped run: what a crash
    between a batch's output and its commit leaves. The next run repeats these batches under their
    old ids (needs ``keep_published``). Returns the number of streams."""
    n = 0
    fs, root = file_system(spark, checkpoint)
    for s in fs.listStatus(root):
        if s.getPath().getName().startswith("stream-"):
            commits = fs.listStatus(file_system(spark, f"{s.getPath()}/commits")[1])
            ids = [int(c.getPath().getName()) for c in commits if c.getPath().getName().isdigit()]
            if ids:
                n += bool(fs.delete(file_system(spark, f"{s.getPath()}/commits/{max(ids)}")[1], False))
    return n


def read_ndjson_records(spark: SparkSession, path: str) -> DataFrame:
    """Read NDJSON records back (ID, Source, Timestamp, Data, Metadata)."""
    schema = ("ID string, Source string, Timestamp timestamp, "
              "Data map<string,string>, Metadata map<string,string>")
    return spark.read.schema(schema).json(path)
