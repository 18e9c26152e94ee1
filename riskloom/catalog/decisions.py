"""Rules, fallback and the combined decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.behaviour import EVENT_DEVICE, new_device
from riskloom.catalog.inputs import SCORED, SPEC, scored, transactions
from riskloom.catalog.registry import query
from riskloom.operators.behaviour import first_sighting
from riskloom.operators.columns import user_keys
from riskloom.operators.decisions import (
    BLOCK_REASON, decide, fallback_fraud, huge_amount_from_new_device, rule_reason)

# The given amounts stay below 600, so the limits are lowered to reach every branch.
BLOCK, FALLBACK, THRESHOLD = 100.0, 60.0, 0.35


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount, first-sighting flag and score; transactions without a device have no score."""
    flagged = first_sighting(user_keys(transactions(spark, sf_dir)), SPEC)
    rows = flagged.join(scored(spark, sf_dir).select("TransactionID", "prob"), "TransactionID")
    return rows.withColumn("prob", F.when(F.col("DeviceInfo").isNotNull(), F.col("prob")))


INPUTS = f"""{SCORED}, rows AS (SELECT t."TransactionID", t."TransactionAmt", {new_device(EVENT_DEVICE)},
  CASE WHEN t."DeviceInfo" IS NOT NULL THEN prob END AS prob FROM tx t JOIN scored s ON s."TransactionID" = t."TransactionID")"""
HIT = f'("TransactionAmt" > {BLOCK} AND is_new_device_uid1 = 1)'


@query("rule_block", f"""WITH {INPUTS} SELECT "TransactionID", CASE WHEN {HIT} THEN '{BLOCK_REASON}' END AS reason FROM rows""")
def rule_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = first_sighting(user_keys(transactions(spark, sf_dir)), SPEC)
    return flagged.select("TransactionID", rule_reason([huge_amount_from_new_device(above=BLOCK)]).alias("reason"))


@query("rule_fallback", f"""WITH {INPUTS} SELECT "TransactionID", "TransactionAmt" > {FALLBACK} AS is_fraud FROM rows WHERE prob IS NULL""")
def rule_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    unscored = inputs(spark, sf_dir).where(F.col("prob").isNull())
    return unscored.select("TransactionID", fallback_fraud(above=FALLBACK).alias("is_fraud"))


def decision_sql(hit: str) -> str:
    return f"""SELECT "TransactionID", CASE WHEN NOT {hit} THEN prob END AS fraud_probability,
  CASE WHEN {hit} THEN true WHEN prob IS NOT NULL THEN prob > {THRESHOLD} ELSE "TransactionAmt" > {FALLBACK} END AS is_fraud,
  CASE WHEN {hit} THEN 'Fraud (Blocked by Business Rules: {BLOCK_REASON})'
       WHEN prob > {THRESHOLD} THEN 'Fraud (Blocked by ML, confidence: ' || printf('%.2f', prob) || ')'
       WHEN prob IS NOT NULL THEN 'Legit (Passed ML)'
       WHEN "TransactionAmt" > {FALLBACK} THEN 'Fraud (Blocked by Fallback rules)'
       ELSE 'Legit (Passed Fallback rules)' END AS action FROM rows"""


@query("decision", f"WITH {INPUTS} {decision_sql(HIT)}")
def decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(inputs(spark, sf_dir), THRESHOLD, [huge_amount_from_new_device(above=BLOCK)],
                  fallback=fallback_fraud(above=FALLBACK))
