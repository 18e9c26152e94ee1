"""Score a feature table in one pass: align, cast, predict, threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.columns import to_numeric
from riskloom.operators.decisions import Rule, decide
from riskloom.operators.models import predict, predicted_class
from riskloom.plans.training import TrainedModel


def prepare(df: DataFrame, trained: TrainedModel, keep: Sequence[str]) -> DataFrame:
    """``keep`` plus the model's columns: absent ones are 0, numbers are cast, NULLs stay missing."""
    numbers, texts = set(trained.inputs.numbers), set(trained.inputs.texts)
    if trained.anomaly:
        numbers = (numbers | set(trained.anomaly.scaling.names)) - {"anomaly_score"}
        texts |= set(trained.anomaly.levels.levels)
    wanted = sorted(numbers | texts)
    missing = {c: F.lit(0) for c in wanted if c not in df.columns}
    full = df.withColumns(missing).select(*dict.fromkeys([*keep, *wanted]))
    full = to_numeric(full, [c for c in wanted if c in numbers and c not in keep])
    full = full.withColumns({c: F.col(c).cast("string") for c in wanted if c in texts})
    return trained.anomaly.add(full) if trained.anomaly else full


def score(df: DataFrame, trained: TrainedModel, keep: Sequence[str] = ("TransactionID",)) -> DataFrame:
    """``keep`` plus prob; also for streams."""
    return predict(trained.model, trained.inputs, prepare(df, trained, keep), keep)


def batch_score(df: DataFrame, trained: TrainedModel, row_id: str = "TransactionID", decision: str = "isFraud") -> DataFrame:
    """(id, class), ready for ``write_submission``."""
    return score(df, trained, [row_id]).select(row_id, predicted_class(F.col("prob"), trained.threshold).alias(decision))


def score_and_decide(df: DataFrame, trained: TrainedModel, rules: Sequence[Rule], keep: Sequence[str],
                     shown: Sequence[str] = ("TransactionID",), fallback: Column | None = None) -> DataFrame:
    """Rules, model, fallback; ``keep`` must hold the columns the rules read. Also for streams."""
    return decide(score(df, trained, keep), trained.threshold, rules, shown, fallback=fallback)
