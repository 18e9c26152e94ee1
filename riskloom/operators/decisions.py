"""Business rules, model decision and fallback, as one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import percent_text

# Limits and texts of the decision.
BLOCK_AMOUNT = 500_000.0
FALLBACK_AMOUNT = 10_000_000.0
BLOCK_REASON = "Blocked by Business Rule: Huge amount from new device"
RULE_ACTION = "Fraud (Blocked by Business Rules: %s)"
MODEL_FRAUD_ACTION = "Fraud (Blocked by ML, confidence: %s)"
MODEL_LEGIT_ACTION = "Legit (Passed ML)"
FALLBACK_FRAUD_ACTION = "Fraud (Blocked by Fallback rules)"
FALLBACK_LEGIT_ACTION = "Legit (Passed Fallback rules)"


@dataclass(frozen=True)
class Rule:
    """A named condition that blocks a transaction whatever the model says."""

    reason: str
    condition: Column


def huge_amount_from_new_device(amount: str = "TransactionAmt", new_device: str = "is_new_device_uid1",
                                above: float = BLOCK_AMOUNT) -> Rule:
    return Rule(BLOCK_REASON, (F.col(amount) > above) & (F.col(new_device) == 1))


def rule_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule that holds, else NULL."""
    return F.coalesce(*[F.when(r.condition, F.lit(r.reason)) for r in rules]) if rules else F.lit(None).cast("string")


def fallback_fraud(amount: str = "TransactionAmt", above: float = FALLBACK_AMOUNT) -> Column:
    return F.coalesce(F.col(amount) > above, F.lit(False))


def decide(df: DataFrame, threshold: float | Column, rules: Sequence[Rule], keep: Sequence[str] = ("TransactionID",),
           probability: str = "prob", fallback: Column | None = None) -> DataFrame:
    """``keep`` plus fraud_probability, is_fraud and action.

    A rule hit decides without the model, so its probability is NULL. A missing
    probability means the model could not score: the fallback decides.
    """
    prob = F.col(probability)
    by_model = prob > threshold
    by_fallback = fallback if fallback is not None else fallback_fraud()
    reasoned = df.withColumn("_reason", rule_reason(rules))
    hit = F.col("_reason").isNotNull()
    action = (F.when(hit, F.format_string(RULE_ACTION, "_reason"))
              .when(by_model, F.format_string(MODEL_FRAUD_ACTION, percent_text(prob)))
              .when(prob.isNotNull(), MODEL_LEGIT_ACTION)
              .when(by_fallback, FALLBACK_FRAUD_ACTION)
              .otherwise(FALLBACK_LEGIT_ACTION))
    return reasoned.select(
        *keep, F.when(~hit, prob).alias("fraud_probability"),
        F.when(hit, True).when(prob.isNotNull(), by_model).otherwise(by_fallback).alias("is_fraud"),
        action.alias("action"))
