"""File scans: JSON lines, CSV, parquet, and a config-driven reader.

Malformed input is kept, not dropped: JSON lines that do not parse keep
their text in ``_corrupt_record``; ``split_corrupt`` separates them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

CORRUPT = "_corrupt_record"

#: options of a JSON source that concern the files, not the parsing
FILE_OPTIONS = ("lineSep", "recursiveFileLookup", "pathGlobFilter", "modifiedBefore",
                "modifiedAfter", "ignoreMissingFiles", "ignoreCorruptFiles")
#: encodings in which a line break is one byte
BYTE_ENCODINGS = ("utf-8", "us-ascii", "iso-8859-1")


def _with_corrupt(schema: T.StructType, corrupt_col: str) -> T.StructType:
    if corrupt_col in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    corrupt_col: str = CORRUPT,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """JSON lines with a declared schema; bad lines keep their text.

    ``options`` are the JSON reader's: those about files go to the file scan,
    ``encoding`` (one of BYTE_ENCODINGS) decodes the lines, all others go to
    the parser. Modes that drop or stop at bad lines are refused.

    Read as text and parsed with ``from_json`` (PERMISSIVE): unlike the JSON
    file reader this lets a query count or filter on the corrupt column
    alone. Blank lines are dropped first, as the JSON reader does; ``{}``
    is a row of NULLs, not a corrupt one.
    """
    given = {k.lower(): (k, str(v)) for k, v in (options or {}).items()}
    if given.pop("mode", ("", "PERMISSIVE"))[1].upper() != "PERMISSIVE":
        raise ValueError("malformed lines are kept: only PERMISSIVE mode is read")
    encoding = (given.pop("encoding", None) or given.pop("charset", None) or ("", "utf-8"))[1]
    if encoding.lower() not in BYTE_ENCODINGS:
        raise ValueError(f"JSON lines are read in {BYTE_ENCODINGS}, not {encoding!r}")
    given.pop("columnnameofcorruptrecord", None)
    given.pop("multiline", None)
    files = {k: v for low, (k, v) in given.items() if low in {x.lower() for x in FILE_OPTIONS}}
    parse = {k: v for k, v in (x for low, x in given.items()) if k not in files}
    full = _with_corrupt(schema, corrupt_col)
    text = spark.read.options(**files).text(path)
    if encoding.lower() != "utf-8":
        text = text.select(F.decode(F.col("value").cast("binary"), encoding.upper()).alias("value"))
    parsed = F.from_json(F.col("value"), full, {**parse, "mode": "PERMISSIVE",
                                                "columnNameOfCorruptRecord": corrupt_col})
    return (text.filter(F.trim(F.col("value")) != "")
            .select(parsed.alias("r")).select("r.*"))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             **options: str) -> DataFrame:
    """CSV with a header, ``"`` as escape, declared schema or inference.

    Column pruning in the CSV parser is off so that which rows count as
    malformed does not depend on which columns a query selects.
    """
    opts = {"header": "true", "escape": '"', "columnPruning": "false", **options}
    reader = spark.read.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    elif "inferSchema" not in opts:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_source(spark: SparkSession, cfg: Mapping[str, object],
                schema: T.StructType | None = None) -> DataFrame:
    """Config-driven scan: ``format``, ``path``, ``read_options``.

    JSON goes through ``read_json_lines`` when a schema is given; an explicit
    schema always wins over ``inferSchema``.
    """
    fmt = str(cfg["format"])
    path = cfg["path"]
    options = {k: str(v) for k, v in dict(cfg.get("read_options", {}) or {}).items()}
    if fmt == "json" and schema is not None and options.get("multiLine", "false") != "true":
        return read_json_lines(spark, path, schema,
                               options.get("columnNameOfCorruptRecord", CORRUPT), options)
    if fmt == "csv":
        if schema is not None:
            options.pop("inferSchema", None)
        return read_csv(spark, path, schema, **options)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def staged_split(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame | None]:
    """``split_corrupt`` for frames that are both written: the input is read and parsed once, into
    a scratch table with clean and corrupt rows apart, and each part reads its own files."""
    if corrupt_col not in df.columns:
        return df, None
    mark = "__corrupt"
    marked = df.withColumn(mark, F.col(corrupt_col).isNotNull())
    path = scratch_path(df.sparkSession, "parsed")
    marked.write.partitionBy(mark).parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    return (stored.filter(~F.col(mark)).drop(mark, corrupt_col), stored.filter(F.col(mark)).drop(mark))


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame | None]:
    """(clean rows without the corrupt column, corrupt rows); (df, None) when
    the frame has no such column."""
    if corrupt_col not in df.columns:
        return df, None
    corrupt = df.filter(F.col(corrupt_col).isNotNull())
    clean = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    return clean, corrupt
