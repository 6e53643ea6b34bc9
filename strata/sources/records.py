"""CSV record sources: good rows, rejected rows, and the record envelope.

A record is a row of text fields plus ``_record_id`` (``source-offset``),
``_record_source``, ``_record_ts``, ``_row_number`` and ``_file`` (written
as ID, Source, Timestamp and Metadata by the NDJSON sink). The envelope
names are prefixed because column names are case-insensitive: a data field
called ``id`` must not be overwritten by the record ID. Rows whose field
count differs from the header are rejected (kept with ``_error``), not
silently skipped. Empty fields are the empty string, as in the text. Every
file is read by its own header; files with different headers are put together
by column name, and a column a file lacks is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import broadcast_below, scratch_path, stored_counted

CORRUPT = "_corrupt_record"
RECORD_ID, RECORD_SOURCE, RECORD_TS = "_record_id", "_record_source", "_record_ts"
POSITION, MALFORMED = "__pos", "__malformed"
ENVELOPE = (RECORD_ID, RECORD_SOURCE, RECORD_TS, "_row_number", "_file", "_block", CORRUPT,
            "_error")
DATA_COLS_META = (("_row_number", "row_number"), ("_file", "file"))


@dataclass
class RecordScan:
    records: DataFrame
    rejects: DataFrame
    header: list[str]


def csv_options(sep: str = ",", encoding: str = "utf-8", multi_line: bool = False) -> dict:
    return {"header": "true", "sep": sep, "encoding": encoding, "escape": '"',
            "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "false",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            "columnPruning": "false", "multiLine": str(multi_line).lower()}


def csv_header(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
               encoding: str = "utf-8", recursive: bool = False) -> list[str]:
    """Field names from the first line (a one-line read)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(header="true", sep=sep, encoding=encoding,
                              ignoreLeadingWhiteSpace="true",
                              recursiveFileLookup=str(recursive).lower()).csv(paths).columns


def text_lines(reader, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files (``reader``: spark.read or spark.readStream) with file and split start."""
    paths = path if isinstance(path, str) else list(path)
    return reader.text(paths).select("value", F.col("_metadata.file_path").alias("_file"),
                                     F.col("_metadata.file_block_start").alias("_block"))


#: line number within a split, from the position Spark gives a row in its task
_LINE_BITS = (1 << 33) - 1
_HALF, _WHOLE = Decimal(2**63), Decimal(2**64)


def file_headers(lines: DataFrame) -> DataFrame:
    """(``_file``, ``__line``, ``__head``): place and 64-bit hash of each file's first line that is not blank.

    ``lines`` has value, ``_file``, ``_block`` and POSITION. One scan; the place and the hash are
    one number, so a task sends one fixed-size row per file and nothing is sorted.
    """
    first = lines.filter((F.col("_block") == 0) & F.col("value").rlike(r"[^\x00-\x20]"))
    line = F.col(POSITION).bitwiseAND(_LINE_BITS).cast("decimal(10,0)")
    unsigned = F.xxhash64("value").cast("decimal(20,0)") + _HALF
    heads = first.groupBy("_file").agg(F.min((line * _WHOLE + unsigned).cast("decimal(38,0)")).alias("both"))
    low = F.col("both") % _WHOLE
    return heads.select("_file", ((F.col("both") - low) / _WHOLE).cast("long").alias("__line"),
                        (low - _HALF).cast("long").alias("__head"))


def header_groups(spark: SparkSession, heads: DataFrame, sep: str, encoding: str) -> list[tuple[int, list[str]]]:
    """(hash, field names) of each distinct header, in order of its first file. One row per
    distinct header comes to the driver, however many files there are."""
    rows = heads.groupBy("__head").agg(F.min("_file").alias("file")).collect()
    return [(r["__head"], csv_header(spark, _plain_path(r["file"]), sep, encoding))
            for r in sorted(rows, key=lambda r: r["file"])]


def parse_lines(lines: DataFrame, heads: DataFrame, groups: Sequence[tuple[int, Sequence[str]]], sep: str = ",",
                encoding: str = "utf-8", header: Sequence[str] | None = None) -> DataFrame:
    """Records of text lines, each by the header of its file (or by ``header``), in one pass: the
    fields of all headers, a column its file lacks NULL, empty fields "", malformed rows with
    their text in ``_corrupt_record``. Blank lines and header lines are left out."""
    text = F.col("value") if encoding.lower() in ("utf-8", "utf8") else \
        F.decode(F.col("value").cast("binary"), encoding)
    own = heads.select(F.col("_file").alias("__f"), "__line", "__head")
    is_header = (F.col("_block") == 0) & (F.col(POSITION).bitwiseAND(_LINE_BITS) == F.col("__line"))
    rows = (lines.filter(F.col("value").rlike(r"[^\x00-\x20]")).join(own, F.col("_file") == F.col("__f"))
            .filter(~is_header).withColumn("__text", text))
    if header is not None:
        groups, rows = [(0, header)], rows.withColumn("__head", F.lit(0).cast("long"))
    options = {k: v for k, v in csv_options(sep).items() if k not in ("header", "encoding", "columnPruning", "multiLine")}
    parsed = {f"__p{i}": F.when(F.col("__head") == h, F.from_csv("__text", _ddl(names), options))
              for i, (h, names) in enumerate(groups)}
    rows = rows.withColumns(parsed)
    corrupt = F.coalesce(*(F.col(f"{p}.{CORRUPT}") for p in parsed)) if parsed else F.lit(None).cast("string")
    fields: dict[str, list] = {}
    for p, (_, names) in zip(parsed, groups):
        for n in names:
            kept = F.col(f"{p}.{CORRUPT}").isNull() & F.col(p).isNotNull()
            value = F.col(f"{p}.`{n}`")
            fields.setdefault(n, []).append(F.when(kept, F.coalesce(value, F.lit(""))).otherwise(value))
    return rows.select(*(F.coalesce(*v).alias(n) for n, v in fields.items()), corrupt.alias(CORRUPT),
                       "_file", "_block", POSITION)


def _ddl(header: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in [*header, CORRUPT])


def _plain_path(uri: str) -> str:
    """A listed file as a path Spark can be given (names are percent-encoded in listings)."""
    scheme, mark, rest = uri.partition("://")
    return f"{scheme}://{unquote(rest)}" if mark else unquote(uri)


def malformed_text(header: Sequence[str]):
    """``_corrupt_record``, written so that it also reads a data column.

    Spark refuses a raw CSV/JSON scan whose query reads only the corrupt
    column (e.g. ``count()`` of good rows). ``length(x) < 0`` is never true
    but the optimizer cannot fold it, so the first field stays in the scan.
    """
    first = F.col(header[0])
    return F.coalesce(F.col(CORRUPT), F.when(F.length(first) < 0, F.lit("")))


def record_schema(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in header]
                        + [T.StructField(CORRUPT, T.StringType())])


def _parse(spark: SparkSession, paths: list[str], header: list[str], sep: str, encoding: str,
           multi_line: bool, recursive: bool) -> DataFrame:
    """Rows of files with one header: empty fields as "", malformed rows with their text."""
    raw = (spark.read.schema(record_schema(header))
           .options(**csv_options(sep, encoding, multi_line))
           .option("recursiveFileLookup", str(recursive).lower()).csv(paths)
           .withColumn("_file", F.col("_metadata.file_path"))
           .withColumn("_block", F.col("_metadata.file_block_start")))
    bad = malformed_text(header)
    return raw.withColumns({**{h: F.when(bad.isNull(), F.coalesce(F.col(h), F.lit(""))).otherwise(F.col(h))
                               for h in header}, CORRUPT: bad})


def read_csv_records(spark: SparkSession, path: str | Sequence[str], source_name: str,
                     sep: str = ",", encoding: str = "utf-8", multi_line: bool = False,
                     header: Sequence[str] | None = None, envelope: bool = True,
                     recursive: bool = False) -> RecordScan:
    """Read CSV files as text records; malformed rows go to ``rejects``.

    Leading white space of fields is dropped, blank lines are skipped, a
    quoted field may hold the separator. ``multi_line`` allows newlines
    inside quotes (files then stop being splittable). ``recursive`` reads
    every file below the path, without partition folders as columns. A given
    ``header`` holds for all files.

    Headers are found by a scan on the executors. Files with one header go through
    Spark's CSV reader; those with several are parsed from their lines, each by its own
    (with ``multi_line``, where lines are no records, by one read per header).

    With the envelope the input is parsed once into a table in the shared folder,
    good and malformed rows apart, which the records and the rejects then read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names, raw = list(header or []), None
    if header is None:
        lines = text_lines(spark.read.option("recursiveFileLookup", str(recursive).lower()), paths)
        lines = lines.withColumn(POSITION, F.monotonically_increasing_id())
        heads = file_headers(lines)
        groups = header_groups(spark, heads, sep, encoding)
        if len(groups) > 1:
            heads, n_files = stored_counted(heads, "csv_headers")
        names = list(dict.fromkeys(n for _, own in groups for n in own))
        if not groups:
            names = csv_header(spark, paths, sep, encoding, recursive)
        elif len(groups) > 1 and multi_line:
            raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
                _parse(spark, [_plain_path(r._file) for r in heads.filter(F.col("__head") == h).collect()],
                       own, sep, encoding, True, False) for h, own in groups])
        elif len(groups) > 1:
            raw = parse_lines(lines, broadcast_below(heads, known=n_files), groups, sep, encoding)
    if raw is None:
        raw = _parse(spark, paths, names, sep, encoding, multi_line, recursive)
    if not envelope:
        rejects = raw.filter(F.col(CORRUPT).isNotNull())
        good = raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_block", POSITION)
        return RecordScan(good.withColumn(RECORD_SOURCE, F.lit(source_name)), _rejected(rejects, source_name), names)
    if POSITION not in raw.columns:
        raw = raw.withColumn(POSITION, F.monotonically_increasing_id())
    staged = scratch_path(spark, "csv_records")
    raw = raw.withColumn(MALFORMED, F.col(CORRUPT).isNotNull())
    raw.sortWithinPartitions(MALFORMED, POSITION).write.partitionBy(MALFORMED).parquet(staged)
    raw = spark.read.schema(raw.schema).parquet(staged)
    good = raw.filter(~F.col(MALFORMED)).drop(CORRUPT, MALFORMED)
    return RecordScan(with_record_envelope(good, source_name),
                      _rejected(raw.filter(MALFORMED).drop(MALFORMED), source_name), names)


def _rejected(rows: DataFrame, source_name: str) -> DataFrame:
    return (rows.withColumns({RECORD_SOURCE: F.lit(source_name),
                              "_error": F.lit("field count differs from header")})
            .drop("_block", POSITION))


def with_record_envelope(df: DataFrame, source_name: str, file_col: str = "_file",
                         block_col: str = "_block", pos_col: str = POSITION) -> DataFrame:
    """``_record_id = source-n``, ``_row_number = n``: n numbers rows 1, 2, ... in read
    order (file path, split start, position in split).

    ``df`` is a stored Parquet table in which the rows of a split stand one after another in
    one file, in order of ``pos_col``. A row's number is the rows of earlier files, plus those
    of earlier splits of its file, plus its place in the stored file less that of its
    split's first row. So only one row per split is counted, summed and joined; the
    records themselves are neither shuffled nor sorted. A row without an offset stops the job.
    """
    placed = df.withColumn("__at", F.col("_metadata.row_index"))
    splits = placed.groupBy(file_col, block_col).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    splits, n_splits = stored_counted(splits, "csv_splits")
    files = splits.groupBy(file_col).agg(F.sum("__n").alias("__m"))
    before = Window.orderBy(file_col).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(file_col, F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    splits = (splits.withColumn("__offset", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
              .join(files, file_col)
              .select(file_col, block_col, (F.col("__offset") + F.col("__base") - F.col("__first")).alias("__offset")))
    n = F.coalesce("__offset", F.raise_error(F.lit("a split has no record offset")).cast("long")) + F.col("__at") + 1
    return (placed.join(broadcast_below(splits, known=n_splits), [file_col, block_col], "left")
            .withColumn("_row_number", n.cast("long"))
            .withColumns({RECORD_ID: F.concat(F.lit(f"{source_name}-"), F.col("_row_number").cast("string")),
                          RECORD_SOURCE: F.lit(source_name),
                          RECORD_TS: F.current_timestamp()})
            .drop(pos_col, "__offset", "__at", block_col))


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Records of several sources in one frame, by column name, with the source name.

    Columns a source lacks are NULL.
    """
    tagged = [df if RECORD_SOURCE in df.columns else df.withColumn(RECORD_SOURCE, F.lit(name))
              for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
