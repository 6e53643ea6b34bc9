"""Versioned parquet tables: append, overwrite, time travel, merge, compaction.

Layout: every append or overwrite is one folder
``path/strata_version=N/strata_kind=K/`` (K is ``append`` or ``snapshot``)
holding the table's own partition folders, plus ``_schema.json`` next to it.
Reading version v takes the newest snapshot s <= v and every finished append
after it up to v in one parquet read, so time travel is a listing. Only folders
with ``_SUCCESS`` count; the next N is one above the highest folder present, so
a failed write never blocks the next. One writer per table.

Partitioned fact tables change by Spark's dynamic partition overwrite: the new
rows are staged in the shared folder, then replace their partitions (NULL ones
too) in the newest version's folder. Such changes have no version of their own, but
are counted in its metadata: a version changed in place can't be asked for by number any
more, and ``read_changes`` gives its readers the whole table again. Several open appends are
first folded into one snapshot. A merge ``within_partitions`` reads only the
partitions the source touches and those that hold one of its keys today, as a
frame joined NULL-safely. Whole-table merges write a new snapshot, which suits
dimension tables. Spark keeps the empty string of a text partition column as
NULL; it is written as NULL here throughout.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import hashable, row_hash
from strata.session import scratch_path

VERSION_DIR = "strata_version"
KIND_DIR = "strata_kind"
SCHEMA_FILE = "_schema.json"
ACTION = "_merge_action"


@dataclass(frozen=True)
class Version:
    number: int
    kind: str
    done: bool


# --- file system --------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All version folders, finished or not, in order."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(f"{VERSION_DIR}=")):
            continue
        n = int(name.split("=", 1)[1])
        kinds = [k for k in fs.listStatus(st.getPath()) if k.isDirectory()
                 and k.getPath().getName().startswith(f"{KIND_DIR}=")]
        if not kinds:
            out.append(Version(n, "", False))
            continue
        kdir = kinds[0].getPath()
        done = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kdir, "_SUCCESS"))
        out.append(Version(n, kdir.getName().split("=", 1)[1], done))
    return sorted(out, key=lambda v: v.number)


def table_exists(spark: SparkSession, path: str) -> bool:
    return any(v.done for v in versions(spark, path))


def _version_dir(path: str, n: int) -> str:
    return f"{path.rstrip('/')}/{VERSION_DIR}={n}"


def _meta(spark: SparkSession, path: str, n: int) -> dict:
    text = _read_text(spark, f"{_version_dir(path, n)}/{SCHEMA_FILE}")
    return json.loads(text) if text else {}


# --- read -----------------------------------------------------------------------

def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (default: the latest finished one)."""
    done = [v for v in versions(spark, path) if v.done]
    if not done:
        raise FileNotFoundError(f"no table at {path}")
    target = done[-1].number if version is None else version
    if target not in {v.number for v in done}:
        raise ValueError(f"version {target} of {path} does not exist")
    upto = [v for v in done if v.number <= target]
    snaps = [v for v in upto if v.kind == "snapshot"]
    start = snaps[-1].number if snaps else upto[0].number
    parts = [v for v in upto if v.number >= start]
    meta = _meta(spark, path, target)
    if version is not None and any(_meta(spark, path, v.number).get("in_place") for v in parts):
        raise ValueError(f"version {version} of {path} was changed in place (partition overwrite): "
                         "only the current state can be read")
    dirs = [f"{_version_dir(path, v.number)}/{KIND_DIR}={v.kind}" for v in parts]
    reader = spark.read.option("basePath", path.rstrip("/"))
    if meta.get("schema"):
        schema = T.StructType.fromJson(meta["schema"])
        full = T.StructType(schema.fields + [T.StructField(VERSION_DIR, T.IntegerType()),
                                             T.StructField(KIND_DIR, T.StringType())])
        df = reader.schema(full).parquet(*dirs)
        names = schema.fieldNames()
    else:
        df = reader.parquet(*dirs)
        names = [c for c in df.columns if c not in (VERSION_DIR, KIND_DIR)]
    return df.select(*names)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read from there, for several readers."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_meta(spark: SparkSession, path: str) -> dict:
    """The metadata of the newest finished version ({} when there is none)."""
    done = [v for v in versions(spark, path) if v.done]
    return _meta(spark, path, done[-1].number) if done else {}


def latest_version(spark: SparkSession, path: str) -> int | None:
    done = [v for v in versions(spark, path) if v.done]
    return done[-1].number if done else None


def read_changes(spark: SparkSession, path: str, after: int | Sequence[int] | None
                 ) -> tuple[DataFrame | None, int | list[int] | None, bool]:
    """Rows added after state ``after``: (frame, newest state, full).

    A state is a version number, or [version, changes in place] once a partition
    overwrite has changed that version. When every newer version is an append, only those
    folders are read; if a newer version rewrote the table, partitions were
    overwritten since, or ``after`` is None, the whole current table is returned
    with ``full=True``. The frame is None when nothing is new.
    """
    done = [v for v in versions(spark, path) if v.done]
    if not done:
        return None, None, False
    latest = done[-1].number
    meta = _meta(spark, path, latest)
    state = [latest, meta["in_place"]] if meta.get("in_place") else latest
    if after is None:
        return read_version(spark, path), state, True
    number, changes = (after, 0) if isinstance(after, int) else after
    newer = [v for v in done if v.number > number]
    if _meta(spark, path, number).get("in_place", 0) != changes or any(
            v.kind != "append" or _meta(spark, path, v.number).get("in_place") for v in newer):
        return read_version(spark, path), state, True
    if not newer:
        return None, state, False
    dirs = [f"{_version_dir(path, v.number)}/{KIND_DIR}={v.kind}" for v in newer]
    reader = spark.read.option("basePath", path.rstrip("/"))
    if meta.get("schema"):
        schema = T.StructType.fromJson(meta["schema"])
        full = T.StructType(schema.fields + [T.StructField(VERSION_DIR, T.IntegerType()),
                                             T.StructField(KIND_DIR, T.StringType())])
        return reader.schema(full).parquet(*dirs).select(*schema.fieldNames()), state, False
    return reader.parquet(*dirs).drop(VERSION_DIR, KIND_DIR), state, False


def history(spark: SparkSession, path: str) -> list[dict]:
    return [{"version": v.number, "kind": v.kind, "done": v.done} for v in versions(spark, path)]


# --- write ---------------------------------------------------------------------

def _write(df: DataFrame, path: str, kind: str, partition_by: Sequence[str] | None,
           extra_metrics: Sequence[Column] = (), extra_meta: dict | None = None) -> dict:
    spark = df.sparkSession
    existing = versions(spark, path)
    n = existing[-1].number + 1 if existing else 0
    partition_by = list(partition_by or [])
    if partition_by:
        empty = [c for c in partition_by if c not in df.columns]
        if empty:
            raise ValueError(f"partition columns {empty} not in frame")
    df = _null_partitions(df, partition_by)
    vdir = _version_dir(path, n)
    schema = T.StructType([f for f in df.schema.fields if f.name != ACTION])
    _write_text(spark, f"{vdir}/{SCHEMA_FILE}", json.dumps(
        {"schema": schema.jsonValue(), "partition_by": partition_by, "kind": kind,
         **(extra_meta or {})}, default=str))
    obs = Observation(f"write_{n}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_written"), *extra_metrics)
    if ACTION in observed.columns:
        observed = observed.drop(ACTION)
    if partition_by:
        # right-sized files per partition; AQE splits a skewed partition
        observed = observed.hint("rebalance", *partition_by)
    writer = observed.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{vdir}/{KIND_DIR}={kind}")
    metrics = {k: int(v) if v is not None else 0 for k, v in obs.get.items()}
    return {**metrics, "version": n, "kind": kind, "path": path}


def _null_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Empty strings of text partition columns as NULL, as Spark reads them back."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    fix = {c: F.nullif(F.col(c), F.lit("")) for c in partition_by if c in text}
    return df.withColumns(fix) if fix else df


def _partitioning(spark: SparkSession, path: str) -> list[str]:
    done = [v for v in versions(spark, path) if v.done]
    return list(_meta(spark, path, done[-1].number).get("partition_by", [])) if done else []


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: Sequence[str] | None = None, merge_key: str | None = None,
                merge_columns: Sequence[str] | None = None, meta: dict | None = None) -> dict:
    """Append a segment, overwrite with a snapshot, or merge; returns write metrics.

    The row count is observed during the write, not by a second scan.
    ``mode="merge"`` needs ``merge_key`` and upserts (``merge_columns``
    limits the updated columns), see ``merge_upsert``.
    """
    if mode == "merge":
        if not merge_key:
            raise ValueError("merge_key is required for merge mode")
        return merge_upsert(df, path, merge_key, merge_columns, partition_by, meta=meta)
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode {mode!r}: use append, overwrite or merge")
    spark = df.sparkSession
    if table_exists(spark, path):
        current = _partitioning(spark, path)
        if partition_by is None:
            partition_by = current
        elif mode == "append" and list(partition_by) != current:
            # one layout per snapshot: mixed folder layouts break partition discovery
            raise ValueError(f"append partitioned by {list(partition_by)}, table by {current}")
    kind = "append" if mode == "append" else "snapshot"
    res = _write(df, path, kind, partition_by, extra_meta=meta)
    return {"rows_written": res["rows_written"], "mode": mode, "path": path,
            "version": res["version"]}


def _same(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
    """NULL-safe equality of ``cols`` in two frames."""
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in cols])


def _live_folder(spark: SparkSession, path: str, partition_by: Sequence[str]) -> tuple[str, int]:
    """The one folder that holds the newest version (open appends are folded first)."""
    done = [v for v in versions(spark, path) if v.done]
    if len(done) > 1 and done[-1].kind == "append" or not done:
        meta = {k: v for k, v in latest_meta(spark, path).items()
                if k not in ("schema", "partition_by", "kind", "in_place")}
        n = _write(read_version(spark, path), path, "snapshot", partition_by, extra_meta=meta)["version"]
        return f"{_version_dir(path, n)}/{KIND_DIR}=snapshot", n
    last = done[-1]
    return f"{_version_dir(path, last.number)}/{KIND_DIR}={last.kind}", last.number


def _drop_partitions(spark: SparkSession, folder: str, values: DataFrame) -> int:
    """Deletes the partition folders of ``values`` (partition columns as text), one at a time."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils \
        .getPartitionPathString
    n = 0
    for r in values.toLocalIterator():
        fs, p = _fs(spark, "/".join([folder, *(name(c, v) for c, v in r.asDict().items())]))
        n += bool(fs.delete(p, True))
    return n


def _count_change(spark: SparkSession, path: str, n: int, meta: dict) -> None:
    known = _meta(spark, path, n)
    _write_text(spark, f"{_version_dir(path, n)}/{SCHEMA_FILE}", json.dumps(
        {**known, **meta, "in_place": known.get("in_place", 0) + 1}, default=str))


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, *,
                         within: DataFrame | None = None, extra_metrics: Sequence[Column] = (),
                         meta: dict | None = None, written: bool = False) -> dict:
    """Replace only the partitions present in ``df``; others stay as they are.

    ``df`` (it may read the table) is staged in the shared folder and then
    written by dynamic partition overwrite, so NULL partitions are replaced and
    kept like any other and no partition value reaches the driver. With
    ``within`` (a written frame of partition values) partitions of it that have
    no rows in ``df`` are deleted. ``meta`` is merged into the version's metadata. ``written``: ``df``
    is a staged frame already and is not staged again.
    """
    spark = df.sparkSession
    if not table_exists(spark, path):
        partition_by = list(partition_by or [])
        if not partition_by:
            raise ValueError("overwrite_partitions needs partition columns")
        return write_table(df, path, "overwrite", partition_by)
    current = _partitioning(spark, path)
    partition_by = list(partition_by or current)
    if not partition_by or partition_by != current:
        raise ValueError(f"partition columns {partition_by} differ from the table's {current}")
    df = _null_partitions(df, partition_by)
    obs = Observation("partitions")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_written"), *extra_metrics).drop(ACTION)
    ready = observed if written else staged(observed, "partitions")
    folder, n = _live_folder(spark, path, partition_by)
    # counted before and after: a reader in between, or a crash, is followed by another full read
    _count_change(spark, path, n, {})
    (ready.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(folder))
    if within is not None:
        filled = (df if written else ready).select(*partition_by).distinct()
        empty = within.join(filled, _same(within, filled, partition_by), "left_anti")
        _drop_partitions(spark, folder, empty.select(*[F.col(c).cast("string") for c in partition_by]))
    _count_change(spark, path, n, meta or {})
    metrics = {k: int(v) if v is not None else 0 for k, v in obs.get.items()}
    return {**metrics, "mode": "overwrite_partitions", "path": path, "version": n}


# --- merge -------------------------------------------------------------------

def merge_frames(target: DataFrame, source: DataFrame, key: str,
                 columns: Sequence[str] | None = None,
                 delete_unmatched: bool = False, newer: Sequence[str] = ()) -> DataFrame:
    """MERGE semantics as a DataFrame, with an ``_merge_action`` column.

    Matched target rows take the source's values (all columns, or only
    ``columns``); unmatched source rows are inserted; unmatched target rows
    stay, or go with ``delete_unmatched``. NULL keys never match. With
    ``newer`` a matched row is updated only if the source row is later by those
    columns in order (NULL lowest), ties going to the greater ``row_hash`` of
    all target columns, so the result does not depend on how deliveries are cut.

    Plan: one scan of the target, left-joined (inner with
    ``delete_unmatched``) to the source on (key, salt). The salt is 0 for
    every keyed row and a row-unique number for NULL-key rows, so those
    spread over tasks instead of piling into the NULL hash bucket, and still
    match nothing. A left join lets AQE split a skewed target key or
    broadcast a small source. Inserts are source rows whose key is not among
    the target's distinct keys (a key-column-only scan, combined map-side),
    salted in the same way.
    """
    t_cols = target.columns
    missing = [c for c in t_cols if c not in source.columns]
    if key not in t_cols or key not in source.columns:
        raise ValueError(f"merge key {key!r} must be in both frames")
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    update = set(t_cols if columns is None else columns)
    unknown = update - set(t_cols)
    if unknown:
        raise ValueError(f"update columns {sorted(unknown)} not in target")
    types = dict((f.name, f.dataType) for f in target.schema.fields)

    src = source.select([F.col(c).cast(types[c]).alias(c) for c in t_cols])
    s_side = src.filter(F.col(key).isNotNull()).select(
        [F.col(c).alias(f"__s_{c}") for c in t_cols]
        + [F.lit(0).cast("long").alias("__s_salt"), F.lit(True).alias("__s_hit")])
    salted = target.withColumn("__t_salt", F.when(F.col(key).isNull(),
                                                  F.monotonically_increasing_id())
                               .otherwise(F.lit(0).cast("long")))
    cond = (salted[key] == s_side[f"__s_{key}"]) & (salted["__t_salt"] == s_side["__s_salt"])
    joined = salted.join(s_side, cond, "inner" if delete_unmatched else "left")
    hit = F.coalesce(F.col("__s_hit"), F.lit(False))
    if newer:
        hit = hit & _later([F.col(f"__s_{c}") for c in newer] + [row_hash(hashable(target), "__s_")],
                           [F.col(c) for c in newer] + [row_hash(hashable(target))])
    matched = joined.select(
        [F.when(hit, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in update
         else F.col(c) for c in t_cols]
        + [F.when(hit, F.lit("updated")).otherwise(F.lit("kept")).alias(ACTION)])
    t_keys = target.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(
        "__i_salt", F.lit(0).cast("long"))
    salted_src = src.withColumn("__i_salt", F.when(
        F.col(key).isNull(), F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long")))
    inserted = salted_src.join(t_keys, [key, "__i_salt"], "left_anti").select(
        *t_cols, F.lit("inserted").alias(ACTION))
    return matched.unionByName(inserted)


def _later(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """a > b column by column, NULL lowest (never NULL)."""
    out = F.lit(False)
    for x, y in reversed(list(zip(a, b))):
        more = F.coalesce(x > y, x.isNotNull() & y.isNull())
        out = more | (x.eqNullSafe(y) & out)
    return out


def duplicate_source_keys(source: DataFrame, key: str) -> DataFrame:
    return (source.filter(F.col(key).isNotNull()).groupBy(key).count()
            .filter(F.col("count") > 1))


def merge_upsert(source: DataFrame, path: str, key: str,
                 columns: Sequence[str] | None = None,
                 partition_by: Sequence[str] | None = None,
                 delete_unmatched: bool = False, check_unique: bool = True,
                 within_partitions: bool = False, meta: dict | None = None,
                 newer: Sequence[str] = (), touched: DataFrame | None = None) -> dict:
    """Upsert ``source`` into the table at ``path`` on ``key``.

    A missing table is created from the source (keeping ``partition_by``).
    Duplicate non-NULL source keys raise ``ValueError`` (one aggregate over
    the source). Counts are observed during the single write.

    ``within_partitions`` limits the merge to the partitions the source
    touches and those that hold one of its keys now (found from the key and
    partition columns), so a row whose partition changes moves. Only those are
    read and replaced; a partition left without rows is deleted. A caller that needs
    these partitions too passes them as ``touched`` (see ``touched_partitions``). ``newer``: see
    ``merge_frames``. ``meta`` is stored with the version (e.g. the source
    version read).
    """
    spark = source.sparkSession
    if check_unique and duplicate_source_keys(source, key).take(1):
        raise ValueError(f"source has duplicate values of merge key {key!r}")
    if not table_exists(spark, path):
        res = _write(source, path, "snapshot", partition_by, extra_meta=meta)
        return {"rows_inserted": res["rows_written"], "rows_updated": 0, "rows_deleted": 0,
                "rows_written": res["rows_written"], "mode": "merge (initial write)", "path": path, "version": res["version"]}
    parts = list(partition_by or _partitioning(spark, path))
    metrics = [F.count_if(F.col(ACTION) == "updated").alias("rows_updated"),
               F.count_if(F.col(ACTION) == "inserted").alias("rows_inserted")]
    target = read_version(spark, path)
    if within_partitions:
        if not parts:
            raise ValueError("within_partitions needs a partitioned table")
        source = _null_partitions(source, parts)
        if touched is None:
            touched = touched_partitions(target, source, key, parts)
        merged = merge_frames(in_partitions(target, touched), source, key, columns, delete_unmatched, newer)
        res = overwrite_partitions(merged, path, parts, within=touched, extra_metrics=metrics, meta=meta)
        mode = "merge (partitions)"
    else:
        merged = merge_frames(target, source, key, columns, delete_unmatched, newer)
        res = _write(merged, path, "snapshot", parts, metrics, extra_meta=meta)
        mode = "merge"
    return {"rows_inserted": res["rows_inserted"], "rows_updated": res["rows_updated"],
            "rows_written": res["rows_written"], "mode": mode, "merge_key": key,
            "path": path, "version": res["version"]}


def touched_partitions(target: DataFrame, source: DataFrame, key: str,
                       parts: Sequence[str]) -> DataFrame:
    """Partition values of the source's rows and of the stored rows with its keys, as a written frame.

    Keys are looked up only in partitions that the source itself has no rows in: the others are touched anyway.
    """
    source = _null_partitions(source, parts)
    types = {f.name: f.dataType for f in target.schema.fields}
    new = staged(source.select([F.col(c).cast(types[c]).alias(c) for c in parts]).distinct(), "touched_new")
    keys = source.select(F.col(key).alias("__key")).filter("__key is not null")
    stored = target.select(key, *parts)
    rest = stored.join(new, _same(stored, new, parts), "left_anti")
    old = rest.join(keys, rest[key] == keys["__key"], "left_semi").select(*parts).distinct()
    return staged(new.unionByName(old), "touched")


PRUNE_VALUES = 1000


def in_partitions(table: DataFrame, values: DataFrame) -> DataFrame:
    """The rows of ``table`` in the partitions that ``values`` (a written frame) lists, NULL-safely."""
    held = _prune(table, values, values.columns[0])
    return held.join(values, _same(held, values, values.columns), "left_semi")


def _prune(df: DataFrame, touched: DataFrame, col: str) -> DataFrame:
    """``df`` without partitions that can't match: a literal filter for the scan where ``touched``
    has few values of its first column. The join that follows decides; this only saves reading."""
    values = [r[0] for r in touched.select(col).distinct().limit(PRUNE_VALUES + 1).collect()]
    if len(values) > PRUNE_VALUES:
        return df
    known = [v for v in values if v is not None]
    keep = F.col(col).isin(known) if known else F.lit(False)
    return df.filter(keep | F.col(col).isNull() if len(known) < len(values) else keep)


# --- compaction ----------------------------------------------------------------

def _size_bytes(size: str) -> int:
    s = size.strip().lower()
    for unit, mult in (("gb", 1 << 30), ("mb", 1 << 20), ("kb", 1 << 10), ("b", 1)):
        if s.endswith(unit):
            return int(float(s[: -len(unit)]) * mult)
    return int(s)


def file_sizes(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Sizes of the live data files of the newest version, by partition folder (below its version)."""
    done = [v for v in versions(spark, path) if v.done]
    snaps = [v for v in done if v.kind == "snapshot"]
    start = snaps[-1].number if snaps else done[0].number
    leaves: dict[str, list[int]] = {}
    for v in (x for x in done if x.number >= start):
        fs, p = _fs(spark, f"{_version_dir(path, v.number)}/{KIND_DIR}={v.kind}")
        it = fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            if st.getPath().getName().endswith(".parquet"):
                parent = st.getPath().getParent().toString()
                leaves.setdefault(parent.split(f"{KIND_DIR}=", 1)[-1].partition("/")[2], []).append(st.getLen())
    return leaves


def compact(spark: SparkSession, path: str, target_file_size: str = "128mb",
            only_if_needed: bool = True, partitions: Sequence[Sequence] | None = None) -> dict:
    """Rewrite the current version as a snapshot of fewer, larger files.

    A rebalance (by the table's partition columns) lets AQE size output
    partitions to about ``target_file_size`` of shuffle data; the advisory
    size is set for this write only and restored after. With
    ``only_if_needed`` a table in which no partition has two files under a
    quarter of the target is left alone (decided from the listing).
    ``partitions`` (partition value tuples) compacts only those partitions, in
    place.
    """
    target = _size_bytes(target_file_size)
    if only_if_needed and partitions is None:
        leaves = file_sizes(spark, path)
        if not any(sum(size < target / 4 for size in sizes) > 1 for sizes in leaves.values()):
            return {"rows_written": 0, "mode": "compact (not needed)", "path": path,
                    "files": sum(map(len, leaves.values()))}
    current = read_version(spark, path)
    parts = _partitioning(spark, path)
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(conf, None)
    spark.conf.set(conf, str(target))
    try:
        if partitions is not None:
            schema = T.StructType([current.schema[c] for c in parts])
            chosen = spark.createDataFrame([tuple(v) for v in partitions], schema)
            held = _prune(current, chosen, parts[0])
            res = overwrite_partitions(held.join(chosen, _same(held, chosen, parts), "left_semi"), path, parts)
        else:
            res = _write(current.hint("rebalance", *parts) if parts
                         else current.hint("rebalance"), path, "snapshot", parts)
    finally:
        if old is None:
            spark.conf.unset(conf)
        else:
            spark.conf.set(conf, old)
    return {"rows_written": res["rows_written"], "mode": "compact", "path": path,
            "version": res["version"]}


def count_files(spark: SparkSession, path: str, version: int | None = None) -> int:
    """Data files in one version folder (for checks on compaction)."""
    done = [v for v in versions(spark, path) if v.done]
    v = done[-1] if version is None else next(x for x in done if x.number == version)
    fs, p = _fs(spark, f"{_version_dir(path, v.number)}/{KIND_DIR}={v.kind}")
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.endswith(".parquet"):
            n += 1
    return n
