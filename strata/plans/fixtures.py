"""Raw files derived from the driver's tables, for source and job queries.

Every row of the table is written; malformed lines are derived from rows
(a broken copy of each ``error`` event, an extra field in every HOUSEHOLD
customer) so the expected result is known in SQL too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import datasets as ds

def event_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``value`` column: a JSON line per event; each ``error`` event also
    yields a truncated line, each ``signup`` event a ``{}`` and a blank line."""
    ev = ds.table(spark, sf_dir, "events")
    good = ev.select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type"),
        F.to_date("ts").cast("string").alias("event_date"),
        F.col("ts").alias("event_timestamp"),
        F.col("props").alias("properties")),
        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))
    broken = ev.filter(F.col("event_type") == "error").select(
        F.concat(F.lit('{"event_id": "'), F.col("event_id").cast("string"),
                 F.lit('", "broken": ')).alias("value"))
    empty = ev.filter(F.col("event_type") == "signup").select(F.lit("{}").alias("value"))
    blank = ev.filter(F.col("event_type") == "signup").select(F.lit("   ").alias("value"))
    return good.unionByName(broken).unionByName(empty).unionByName(blank)


def write_event_json(spark: SparkSession, sf_dir: str, path: str) -> str:
    event_json_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return path


CSV_HEADER = ("user_id", "status", "email", "username", "balance", "nation")
BLOCK_KEYS = 100_000


def customer_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text lines of the customer records, with folder keys ``seg``
    (market segment) and ``blk`` (key block of 100,000), and ``ord`` (key;
    -1 for the header line that starts every file). HOUSEHOLD rows carry an
    unquoted separator inside ``status``, so they have one field too many."""
    recs = ds.customer_records(spark, sf_dir)
    status = F.when(F.col("status") == "HOUSEHOLD", F.lit("HOUSEHOLD,x")).otherwise(F.col("status"))
    key = F.col("user_id").cast("long")
    lines = recs.select(
        F.col("status").alias("seg"),
        F.lpad(F.floor(key / BLOCK_KEYS).cast("string"), 8, "0").alias("blk"),
        key.alias("ord"),
        F.concat_ws(",", "user_id", status, "email", "username", "balance", "nation")
        .alias("value"))
    headers = lines.select("seg", "blk").distinct().select(
        "seg", "blk", F.lit(-1).cast("long").alias("ord"),
        F.lit(",".join(CSV_HEADER)).alias("value"))
    return lines.unionByName(headers)


def write_customer_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """One file per (segment, key block), lines in key order after the header;
    folder order is (segment, key) order. Read with ``recursive=True``."""
    (customer_csv_lines(spark, sf_dir).repartition("seg", "blk")
     .sortWithinPartitions("seg", "blk", "ord").drop("ord")
     .write.mode("overwrite").partitionBy("seg", "blk").text(path))
    return path


def write_supplier_csv(spark: SparkSession, sf_dir: str, path: str, files: int = 2) -> str:
    s = ds.supplier_records(spark, sf_dir).withColumn("__k", F.col("user_id").cast("long"))
    (s.repartitionByRange(files, "__k").sortWithinPartitions("__k").drop("__k")
     .write.mode("overwrite").options(header="true", quote="").csv(path))
    return path


def write_customer_source_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Raw customers as the declared customer CSV (header, all text)."""
    c = ds.customers(spark, sf_dir)
    (c.select(F.col("customer_id").cast("string").alias("customer_id"),
              F.col("first_name"),
              F.col("status").alias("last_name"),
              F.concat(F.lower(F.replace(F.col("first_name"), F.lit("#"), F.lit("."))),
                       F.lit("@example.com")).alias("email"),
              F.col("region"),
              F.lit("2020-01-01").alias("signup_date"),
              F.col("status"))
     .write.mode("overwrite").options(header="true").csv(path))
    return path


def write_transactions_parquet(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Raw transactions: orders with the customer id as text, like the other sources."""
    (ds.transactions(spark, sf_dir)
     .withColumn("customer_id", F.col("customer_id").cast("string"))
     .write.mode("overwrite").parquet(path))
    return path
