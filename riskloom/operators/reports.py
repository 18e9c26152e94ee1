"""Metric tables of runs: long form with readable labels, and runs side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import label_lookup

# Metric name parts and their labels.
SPLIT_LABELS = {"train": "Train", "val": "Val", "test": "Test"}
METRIC_LABELS = {"pr_auc": "PR-AUC", "recall": "Recall", "precision": "Precision", "f1": "F1-Score", "roc_auc": "ROC-AUC"}
METRIC_PREFIX = "metrics.lgbm_"
CV_METRIC, CV_LABEL = "cv_pr_auc", "Cross-Val PR-AUC"


def metric_labels(target_fpr: float = 0.05) -> dict[str, str]:
    at_fpr = {"recall_at_fpr": f"Recall @ FPR {int(target_fpr * 100)}%"}
    names = {f"{s}_{m}": f"{split} {metric}" for s, split in SPLIT_LABELS.items()
             for m, metric in {**METRIC_LABELS, **at_fpr}.items()}
    return names | {CV_METRIC: CV_LABEL}


def long_metrics(runs: DataFrame, run_ids: Sequence[str] | None = None, run_id: str = "run_id",
                 run_name: str = "run_name", target_fpr: float = 0.05) -> DataFrame:
    """(Run_ID_Short, Run_Name, Metric, Value) of the chosen runs; one row per run and ``metrics.*`` column."""
    metrics = [c for c in runs.columns if c.startswith("metrics.")]
    chosen = runs.where(F.col(run_id).isin(list(run_ids))) if run_ids else runs
    named = chosen.withColumn("Run_Name", F.coalesce(F.col(run_name), F.col(run_id)))
    # Runs are few: the window orders run names, not data.
    short = named.select("Run_Name").distinct().withColumn(
        "Run_ID_Short", (F.row_number().over(Window.orderBy("Run_Name")) - 1).cast("string"))
    long = named.select("Run_Name", *[F.col(f"`{c}`").cast("double").alias(c.removeprefix(METRIC_PREFIX)) for c in metrics])
    long = long.unpivot(["Run_Name"], [c.removeprefix(METRIC_PREFIX) for c in metrics], "Metric", "Value")
    return (long.withColumn("Metric", label_lookup(F.col("Metric"), metric_labels(target_fpr)))
            .join(short, "Run_Name").select("Run_ID_Short", "Run_Name", "Metric", "Value"))


def compare_runs(long: DataFrame, runs: Sequence[str]) -> DataFrame:
    """Metric by run, and the difference of each run to the first one."""
    wide = long.groupBy("Metric").pivot("Run_Name", list(runs)).agg(F.max("Value"))
    first = runs[0]
    return wide.select("Metric", *runs, *[(F.col(f"`{r}`") - F.col(f"`{first}`")).alias(f"{r}_delta") for r in runs[1:]])
