"""The driver's test tables seen through the reference data model.

events -> event_id, customer_id, event_type, event_timestamp, amount,
properties; customer (+ nation, region) -> customer_id, first_name, region,
status, balance; orders -> transactions (customer_id, amount, txn_date).
Only renames and lookups: every row of every table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("amount"),
        F.col("props").alias("properties"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their region name (customer -> nation -> region)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, "n_regionkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("region"),
            F.col("c_mktsegment").alias("status"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("txn_date"),
        F.col("o_orderstatus").alias("status"),
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text records (user_id, status, email, username, balance,
    nation), the shape a CSV record source yields. The email is derived from
    the name with mixed case and edge spaces, so normalizing has work to do."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("status"),
        F.concat(F.lit(" "), F.replace(F.col("c_name"), F.lit("#"), F.lit(".")),
                 F.lit("@Example.Com ")).alias("email"),
        F.col("c_name").alias("username"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.col("c_nationkey").cast("string").alias("nation"),
    )


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("string").alias("user_id"),
        F.col("s_name").alias("username"),
        F.col("s_acctbal").cast("string").alias("balance"),
        F.col("s_nationkey").cast("string").alias("nation"),
    )
