"""The given tables in the roles of transactions, identities and scores, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import epoch_seconds
from riskloom.operators.behaviour import FeatureSpec

# Amounts of the given tables have two decimals.
SPEC = FeatureSpec(amount_scale=2)
ORDER_SPEC = FeatureSpec(amount_scale=2, place="o_orderpriority", device=("o_orderstatus", "o_orderpriority"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_from(events: DataFrame) -> DataFrame:
    """``events`` as card transactions, with gaps in places, devices, cards and mail domains."""
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("bigint")
    kind = F.col("event_type")
    return events.withColumn("k", k).select(
        F.col("event_id").alias("TransactionID"),
        F.when(kind == "error", 1).otherwise(0).cast("bigint").alias("isFraud"),
        epoch_seconds(F.col("ts")).alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        F.col("user_id").alias("card1"),
        F.when(F.col("k") % 5 != 0, (F.lit(100) + F.col("k")).cast("double")).alias("card2"),
        F.when(F.col("k") % 7 != 0, F.floor(F.col("k") / 10).cast("double")).alias("addr1"),
        F.when(kind != "view", F.concat(kind, F.lit(".com"))).alias("P_emaildomain"),
        F.when(kind != "signup", kind).alias("DeviceInfo"),
        F.when(F.col("k") % 2 == 0, "mobile").otherwise("desktop").alias("DeviceType"),
        F.col("k").cast("double").alias("C1"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(table(spark, sf_dir, "events"))


TX = """tx AS (
  SELECT event_id AS "TransactionID",
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS "isFraud",
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "TransactionDT",
         value AS "TransactionAmt", CAST(round(value * 100) AS BIGINT) AS cents,
         user_id AS card1, CASE WHEN k % 5 <> 0 THEN CAST(100 + k AS DOUBLE) END AS card2,
         CASE WHEN k % 7 <> 0 THEN CAST(k // 10 AS DOUBLE) END AS addr1,
         CASE WHEN event_type <> 'view' THEN event_type || '.com' END AS "P_emaildomain",
         CASE WHEN event_type <> 'signup' THEN event_type END AS "DeviceInfo",
         CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS "DeviceType",
         CAST(k AS DOUBLE) AS "C1", CAST(user_id AS VARCHAR) AS uid1
  FROM (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS k FROM events) e)"""


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as transactions; a customer may order several times on one date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("TransactionID"), epoch_seconds(F.col("o_orderdate")).alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"), F.col("o_custkey").cast("string").alias("uid1"),
        "o_orderstatus", "o_orderpriority")


ORDER_TX = """tx AS (
  SELECT o_orderkey AS "TransactionID", CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS "TransactionDT",
         o_totalprice AS "TransactionAmt", CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST(o_custkey AS VARCHAR) AS uid1, o_orderstatus, o_orderpriority
  FROM orders)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a score in [0, 1] that leans towards the label and repeats values."""
    tx = transactions(spark, sf_dir)
    cents = F.round(F.col("TransactionAmt") * 100).cast("bigint")
    return tx.select("TransactionID", "TransactionDT", "isFraud", "DeviceType",
                     ((cents % 997 + F.col("isFraud") * 400) / F.lit(1400.0)).alias("prob"))


SCORED = TX + """, scored AS (
  SELECT "TransactionID", "TransactionDT", "isFraud", "DeviceType",
         (cents % 997 + "isFraud" * 400) / CAST(1400.0 AS DOUBLE) AS prob FROM tx)"""

SPLIT = """split_rows AS (
  SELECT *, CASE WHEN rn <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN rn <= n - floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY "TransactionDT", "TransactionID") AS rn, count(*) OVER () AS n FROM {0}) r)"""
