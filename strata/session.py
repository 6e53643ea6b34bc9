"""Session-side helpers: shared scratch folders and a local session for tests."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and job scratch output.

    Read from ``spark.checkpoint.dir``; only a local session that has none (a
    test) gets a temporary folder. Any other master without it is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir adds a random child folder; its parent is the root
            root = current.rstrip("/").rsplit("/", 1)[0]
        elif not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            root = tempfile.mkdtemp(prefix="strata-ckpt-")
            sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    path = f"{shared_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.add(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder or file, wherever Spark can read it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_scratch(spark: SparkSession, path: str | None = None) -> int:
    """Delete one scratch folder, or all that this process has made; the number deleted.

    Frames read from them must not be used any more, so a job calls this when its
    results are written. Folders made by others are never touched.
    """
    done = 0
    for own in [path] if path is not None else sorted(_SCRATCH):
        if own not in _SCRATCH:
            raise ValueError(f"not a scratch folder of this process: {own}")
        fs, p = file_system(spark, own)
        done += bool(fs.delete(p, True))
        _SCRATCH.discard(own)
    return done


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder and read again (lineage cut, known size)."""
    path, schema = scratch_path(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def broadcast_below(df: DataFrame, rows: int = 500_000, known: int | None = None) -> DataFrame:
    """``df`` (a stored table of narrow rows) hinted for broadcast if it has at most ``rows`` rows
    (``known``: its number of rows, if counted already)."""
    n = df.limit(rows + 1).count() if known is None else known
    return F.broadcast(df) if n <= rows else df


def stored_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stored`` and the number of rows, counted on the write."""
    n = Observation(name)
    out = stored(df.observe(n, F.count(F.lit(1)).alias("n")), name)
    return out, int(n.get["n"])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """Session for tests and the bench; production callers pass their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark
