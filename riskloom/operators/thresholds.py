"""Operating points on a precision-recall curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default business target and strategy names.
BUSINESS_FP_TARGET = 0.05
STRATEGIES = ("f1", "business")


def f1_threshold(curve: DataFrame) -> DataFrame:
    """Row of the best F1; the lowest threshold among equals."""
    return curve.orderBy(F.desc("f1_score"), F.asc("threshold")).limit(1)


def business_threshold(curve: DataFrame, target: float = BUSINESS_FP_TARGET) -> DataFrame:
    """Best recall with precision >= 1 - target, else the F1 row; ``reached`` tells which.

    One ordered limit: reaching rows come first and sort by recall, precision
    and threshold, the others by F1 and lowest threshold.
    """
    ok = F.col("precision") >= F.lit(1 - target)
    return (curve.withColumn("reached", ok)
            .orderBy(F.desc("reached"), F.desc(F.when(ok, F.col("recall"))), F.desc(F.when(ok, F.col("precision"))),
                     F.desc(F.when(ok, F.col("threshold"))), F.desc("f1_score"), F.asc("threshold"))
            .limit(1))


def choose_threshold(curve: DataFrame, strategy: str = "f1", target: float = BUSINESS_FP_TARGET) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown threshold strategy: {strategy}")
    return f1_threshold(curve) if strategy == "f1" else business_threshold(curve, target).drop("reached")
