"""Train, choose a threshold, report; everything later steps need is written below one folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.columns import DROPPED_COLUMNS, numeric_columns, text_columns
from riskloom.operators.curves import curve_points, pr_curve, split_report
from riskloom.operators.boosting import Boosted, TreeParams
from riskloom.operators.codes import Codes
from riskloom.operators.models import (
    AnomalyModel, ReconstructionModel, TreeInputs, cross_validate, fit_anomaly, fit_tree_inputs, fit_trees, predict)
from riskloom.operators.prep import LevelEncoding, NumericScaling, fit_levels
from riskloom.operators.splits import stratified_folds, time_cuts
from riskloom.operators.thresholds import BUSINESS_FP_TARGET, choose_threshold
from riskloom.sources.metadata import add_meta, read_meta
from riskloom.session import shared_dir
from riskloom.sources.sinks import save_as, write_splits


@dataclass(frozen=True)
class TrainedModel:
    model: Boosted
    inputs: TreeInputs
    threshold: float
    anomaly: AnomalyModel | None = None


def train(features: DataFrame, out: str, params: TreeParams = TreeParams(), strategy: str = "f1",
          target: float = BUSINESS_FP_TARGET, latent_dim: int | None = None, folds: int = 0, label: str = "isFraud",
          row_id: str = "TransactionID", time: str = "TransactionDT", drop: Sequence[str] = DROPPED_COLUMNS) -> TrainedModel:
    """Split by time, fit on train with val as early stop, pick the threshold on val, store all of it below ``out``.

    ``latent_dim`` adds the reconstruction error as a feature; ``folds`` adds a
    cross validation over train and val.
    """
    spark = features.sparkSession
    shared_dir(spark)  # boosting cuts its lineage there
    # The splits are read many times from here on, so the features are computed and written once.
    rows = save_as(features, f"{out}/features")
    cuts = time_cuts(rows, time=time, row_id=row_id)
    used = [c for c in rows.columns if c not in drop]
    texts, numbers = text_columns(rows.select(used)), numeric_columns(rows.select(used))
    train_rows = rows.where(cuts.predicate("train"))
    # Only the reconstruction model needs one column per level; trees take text columns of any size.
    anomaly = fit_anomaly(train_rows, numbers, list(fit_levels(train_rows, texts).levels), latent_dim, label) if latent_dim else None
    enriched = anomaly.add(rows) if anomaly else rows
    write_splits(enriched.withColumn("split", cuts.label()), f"{out}/splits")
    splits = spark.read.parquet(f"{out}/splits")

    inputs = fit_tree_inputs(splits.where("split = 'train'"), [*numbers, *(["anomaly_score"] if anomaly else [])], texts, label, row_id,
                             f"{out}/codes")
    fitting = splits.where("split <> 'test'")
    fitted = fit_trees(fitting.withColumn("_is_val", F.col("split") == "val"), inputs, params, label, "_is_val", row_id)
    model = fitted.model
    spark.createDataFrame([(model.to_json(),)], "model string").write.mode("overwrite").parquet(f"{out}/model")
    spark.createDataFrame([(i + 1, q) for i, q in enumerate(fitted.quality)], "round int, val_pr_auc double").write.mode(
        "overwrite").parquet(f"{out}/rounds")

    predict(model, inputs, splits, [row_id, label, "split"]).write.mode("overwrite").partitionBy("split").parquet(f"{out}/scores")
    scores = spark.read.parquet(f"{out}/scores")
    curve = pr_curve(curve_points(scores.where("split = 'val'"), label=label))
    threshold = choose_threshold(curve, strategy, target).first()["threshold"]
    split_report(scores, threshold, label=label, target_fpr=target).write.mode("overwrite").parquet(f"{out}/report")

    entries = {"original_features": used, "numbers": list(inputs.numbers), "text_columns": list(inputs.texts),
               "best_threshold": threshold, "best_round": fitted.best_round, "params": asdict(params), "anomaly": None}
    if anomaly:
        anomaly.reconstruction.pca.write().overwrite().save(f"{out}/reconstruction")
        entries["anomaly"] = {"levels": {c: list(v) for c, v in anomaly.levels.levels.items()}, "means": dict(anomaly.scaling.means),
                              "deviations": dict(anomaly.scaling.deviations), "width": anomaly.reconstruction.width,
                              "center": list(anomaly.reconstruction.center)}
    if folds:
        folded = save_as(stratified_folds(fitting, folds, label=label, row_id=row_id), f"{out}/folds")
        quality = cross_validate(folded, numbers, texts, params, folds, label, row_id=row_id)
        entries["cv_pr_auc"] = quality.agg(F.avg("pr_auc")).first()[0]
    add_meta(spark, f"{out}/meta", entries)
    return TrainedModel(model, inputs, threshold, anomaly)


def load_trained(spark: SparkSession, out: str) -> TrainedModel:
    meta = read_meta(spark, f"{out}/meta")
    anomaly = None
    if stored := meta["anomaly"]:
        anomaly = AnomalyModel(
            LevelEncoding({c: tuple(v) for c, v in stored["levels"].items()}, ()),
            NumericScaling(stored["means"], stored["deviations"], ()),
            ReconstructionModel(PCAModel.load(f"{out}/reconstruction"), stored["width"], tuple(stored["center"])))
    model = Boosted.from_json(spark.read.parquet(f"{out}/model").first()["model"])
    codes = Codes(f"{out}/codes", tuple(meta["text_columns"]))
    return TrainedModel(model, TreeInputs(tuple(meta["numbers"]), codes), meta["best_threshold"], anomaly)


def reevaluate(spark: SparkSession, out: str, strategy: str = "f1", target: float = BUSINESS_FP_TARGET,
               label: str = "isFraud") -> TrainedModel:
    """A new threshold and report for the stored model, from the stored scores; the metadata gets a new version."""
    meta = read_meta(spark, f"{out}/meta")
    scores = spark.read.parquet(f"{out}/scores")
    threshold = choose_threshold(pr_curve(curve_points(scores.where("split = 'val'"), label=label)), strategy, target).first()["threshold"]
    split_report(scores, threshold, label=label, target_fpr=target).write.mode("overwrite").parquet(f"{out}/report")
    add_meta(spark, f"{out}/meta", {**meta, "best_threshold": threshold})
    return load_trained(spark, out)
