"""Time split, drift check and stratified folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.catalog.inputs import ORDER_TX, SPLIT, TX, order_transactions, transactions
from riskloom.catalog.registry import query
from riskloom.operators import splits

SPLIT_TX = TX + ", " + SPLIT.format("tx")
FOLDED = """SELECT "TransactionID", "isFraud", CAST((row_number() OVER (ORDER BY "isFraud", md5('42:' || "TransactionID"), "TransactionID") - 1) % 5
  AS INTEGER) AS fold FROM {0}"""


@query("time_split", f"""WITH {SPLIT_TX} SELECT "TransactionID", split FROM split_rows""")
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.time_split(transactions(spark, sf_dir)).select("TransactionID", "split")


@query("time_split_ties", f"""WITH {ORDER_TX}, {SPLIT.format("tx")} SELECT "TransactionID", split FROM split_rows""")
def time_split_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.time_split(order_transactions(spark, sf_dir)).select("TransactionID", "split")


@query("label_rate", f"""WITH {SPLIT_TX} SELECT split, count(*) AS n_rows, CAST(sum("isFraud") AS DOUBLE) / count(*) AS label_rate
  FROM split_rows GROUP BY split""")
def label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.label_rate(splits.time_split(transactions(spark, sf_dir)))


@query("strat_kfold", f"WITH {TX} {FOLDED.format('tx')}")
def strat_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_folds(transactions(spark, sf_dir).select("TransactionID", "isFraud"))


@query("cv_union", f"""WITH {SPLIT_TX}, cv AS (SELECT * FROM split_rows WHERE split = 'train' UNION ALL SELECT * FROM split_rows WHERE split = 'val')
  {FOLDED.format('cv')}""")
def cv_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = splits.time_split(transactions(spark, sf_dir)).select("TransactionID", "isFraud", "split")
    both = split.where("split = 'train'").unionByName(split.where("split = 'val'"))
    return splits.stratified_folds(both).drop("split")
