"""Exact precision-recall and ROC curves and the metrics read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import Running, sliced_running, value_slices


def confusion(df: DataFrame, threshold: float | Column, score: str = "prob", label: str = "isFraud",
              by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn with the class rule score > threshold (strict)."""
    hit = F.col(score) > threshold
    fraud = F.col(label) == 1
    return df.where(F.col(score).isNotNull()).groupBy(*by).agg(
        F.count_if(hit & fraud).alias("tp"), F.count_if(hit & ~fraud).alias("fp"),
        F.count_if(~hit & ~fraud).alias("tn"), F.count_if(~hit & fraud).alias("fn"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part.cast("double") / whole)


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` plus accuracy, precision, recall, f1 of a ``confusion`` table; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        *by, _share(tp + tn, tp + fp + tn + fn).alias("accuracy"), _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"), _share(tp * 2, tp * 2 + fp + fn).alias("f1"))


def curve_points(df: DataFrame, score: str = "prob", label: str = "isFraud", by: Sequence[str] = (),
                 slices: int | None = None) -> DataFrame:
    """One row per distinct score: threshold, d_tp, d_fp there, tp, fp at or above it, and the class totals.

    Rows are first counted per score; running counts use score slices, so the
    global order never meets in one task.
    """
    scored = df.select(*by, F.col(score).cast("double").alias("threshold"), F.col(label).cast("bigint").alias("_y"))
    # Rows without a label take no part, whatever their score.
    scored = value_slices(scored.where(F.col("threshold").isNotNull() & F.col("_y").isNotNull()), "threshold", "_cut", slices)
    counts = scored.groupBy(*by, "_cut", "threshold").agg(
        F.sum("_y").alias("d_tp"), (F.count(F.lit(1)) - F.sum("_y")).alias("d_fp"))
    points = sliced_running(counts.withColumn("_cut", -F.col("_cut")), by, "_cut", [F.desc("threshold")], [
        Running("tp", "sum", F.col("d_tp")), Running("fp", "sum", F.col("d_fp")),
        Running("positives", "sum", F.col("d_tp"), whole=True), Running("negatives", "sum", F.col("d_fp"), whole=True)])
    return points.drop("_cut")


def _precision() -> Column:
    return F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return F.when(F.col("positives") == 0, 1.0).otherwise(F.col("tp").cast("double") / F.col("positives"))


def _fpr() -> Column:
    return F.when(F.col("negatives") > 0, F.col("fp").cast("double") / F.col("negatives"))


def _tpr() -> Column:
    return F.when(F.col("positives") > 0, F.col("tp").cast("double") / F.col("positives"))


def pr_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """threshold, precision, recall, f1_score per distinct score."""
    curve = points.select(*by, "threshold", _precision().alias("precision"), _recall().alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return curve.withColumn("f1_score", F.lit(2.0) * p * r / (p + r + F.lit(1e-8)))


def roc_curve(points: DataFrame) -> DataFrame:
    """threshold, fpr, tpr per distinct score, and the start (NULL, 0, 0) before the highest score."""
    def point(threshold: Column, fpr: Column, tpr: Column) -> Column:
        return F.struct(threshold.alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))

    own = point(F.col("threshold"), _fpr(), _tpr())
    start = point(F.lit(None).cast("double"), F.when(F.col("negatives") > 0, 0.0), F.when(F.col("positives") > 0, 0.0))
    highest = (F.col("tp") + F.col("fp")) == (F.col("d_tp") + F.col("d_fp"))
    return points.select(F.inline(F.when(highest, F.array(own, start)).otherwise(F.array(own))))


def _curve_aggregates(target_fpr: float) -> dict[str, Column]:
    step = F.sum(F.col("d_tp") * _precision())
    area = F.sum(F.col("d_fp").cast("decimal(19,0)") * (F.col("tp") * 2 - F.col("d_tp")).cast("decimal(19,0)"))
    positives, negatives = F.max("positives"), F.max("negatives")
    both = (positives > 0) & (negatives > 0)
    return {
        "pr_auc": F.when(positives == 0, 0.0).otherwise(step / positives),
        "roc_auc": F.when(both, area.cast("double") / (positives.cast("double") * negatives.cast("double") * 2)),
        "recall_at_fpr": F.when(both, F.coalesce(F.max(F.when(_fpr() <= target_fpr, _tpr())), F.lit(0.0)))}


def curve_metrics(points: DataFrame, target_fpr: float = 0.05, by: Sequence[str] = ()) -> DataFrame:
    """pr_auc (step rule), roc_auc (ties by trapezoid) and recall_at_fpr, in one aggregate."""
    return points.groupBy(*by).agg(*[c.alias(n) for n, c in _curve_aggregates(target_fpr).items()])


def average_precision(df: DataFrame, score: str = "prob", label: str = "isFraud") -> DataFrame:
    return curve_metrics(curve_points(df, score, label)).select("pr_auc")


def split_report(df: DataFrame, threshold: float, score: str = "prob", label: str = "isFraud",
                 by: str = "split", target_fpr: float = 0.05) -> DataFrame:
    """All metrics of every split in one aggregate: the curve points hold the counts above the threshold too."""
    points = curve_points(df, score, label, [by])
    above = F.col("threshold") > threshold
    tp, fp = (F.coalesce(F.sum(F.when(above, F.col(c))), F.lit(0).cast("bigint")) for c in ("d_tp", "d_fp"))
    curve = _curve_aggregates(target_fpr)
    summary = points.groupBy(by).agg(
        tp.alias("tp"), fp.alias("fp"), (F.max("negatives") - fp).alias("tn"), (F.max("positives") - tp).alias("fn"),
        *[c.alias(n) for n, c in curve.items()])
    return class_metrics(summary, [by, *curve])


def reconstruction_errors(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """mse, rmse, mae over all elements of (predicted, actual) column pairs."""
    square_sum = sum((F.sum((F.col(p) - F.col(a)) * (F.col(p) - F.col(a))) for p, a in pairs), F.lit(0))
    abs_sum = sum((F.sum(F.abs(F.col(p) - F.col(a))) for p, a in pairs), F.lit(0))
    elements = sum((F.count(F.col(p) - F.col(a)) for p, a in pairs), F.lit(0))
    return df.agg(square_sum.cast("double").alias("_sq"), abs_sum.cast("double").alias("_abs"), elements.alias("n")).select(
        "n", (F.col("_sq") / F.col("n")).alias("val_loss"), F.sqrt(F.col("_sq") / F.col("n")).alias("rmse"),
        (F.col("_abs") / F.col("n")).alias("mae"))


def score_density(df: DataFrame, bins: int = 50, score: str = "prob", label: str = "isFraud") -> DataFrame:
    """Histogram per class over that class's own range, area 1: label, bin, left, n, density."""
    s = F.col(score).cast("double")
    scored = df.where(s.isNotNull()).select(F.col(label).alias(label), s.alias("_s"))
    ranges = scored.groupBy(F.col(label).alias("_l")).agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"),
                                                          F.count(F.lit(1)).alias("_all"))
    # A class with a single value gets the unit range around it.
    flat = F.col("_lo") == F.col("_hi")
    ranges = ranges.select("_l", "_all", F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                           F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    ranges = ranges.withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    joined = scored.join(F.broadcast(ranges), scored[label].eqNullSafe(ranges["_l"]))  # one row per class, 0 and 1
    guess = F.floor((F.col("_s") - F.col("_lo")) / F.col("_step"))

    def edge(i: Column) -> Column:
        return F.col("_lo") + i * F.col("_step")

    moved = guess - (F.col("_s") < edge(guess)).cast("bigint") + (F.col("_s") >= edge(guess + 1)).cast("bigint")
    binned = joined.withColumn("bin", F.greatest(F.lit(0).cast("bigint"), F.least(moved, F.lit(bins - 1).cast("bigint"))))
    return binned.groupBy(label, "bin", "_lo", "_step", "_all").agg(F.count(F.lit(1)).alias("n")).select(
        label, "bin", edge(F.col("bin")).alias("left"), "n",
        (F.col("n") / (F.col("_all") * F.col("_step"))).alias("density"))


def score_kde(df: DataFrame, grid: int = 200, score: str = "prob", label: str = "isFraud") -> DataFrame:
    """Gaussian density per class on ``grid`` points over its range, bandwidth n^(-1/5) * std.

    Equal scores are counted first. Each distinct score then contributes to its
    class's grid points, summed on the map side: the shuffle carries at most
    ``grid`` rows per class and task.
    """
    s = F.col(score).cast("double")
    counts = df.where(s.isNotNull()).groupBy(F.col(label).alias(label), s.alias("_s")).agg(F.count(F.lit(1)).alias("_w"))
    stats = df.where(s.isNotNull()).groupBy(F.col(label).alias("_l")).agg(
        F.min(s).alias("_lo"), F.max(s).alias("_hi"), F.count(F.lit(1)).alias("_all"), F.stddev(s).alias("_std"))
    stats = stats.withColumn("_h", F.pow(F.col("_all").cast("double"), F.lit(-0.2)) * F.col("_std")).where(F.col("_h") > 0)
    joined = counts.join(F.broadcast(stats), counts[label].eqNullSafe(stats["_l"]))  # one row per class, 0 and 1
    spread = joined.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    x = F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / F.lit(float(grid - 1))
    z = (x - F.col("_s")) / F.col("_h")
    kernel = F.exp(F.lit(-0.5) * z * z) * F.col("_w")
    norm = F.first("_all") * F.first("_h") * F.sqrt(F.lit(2.0) * F.pi())
    return spread.groupBy(label, "point").agg(F.first(x).alias("x"), (F.sum(kernel) / norm).alias("density"))


# Cells that scores of a class are dealt to before the kernel is applied.
KDE_CELLS = 4096


def score_kde_binned(df: DataFrame, grid: int = 200, score: str = "prob", label: str = "isFraud", cells: int = KDE_CELLS) -> DataFrame:
    """``score_kde`` with work that does not depend on the number of distinct scores.

    Every score is shared by the two nearest of ``cells`` even points, by its
    distance to them, and the kernel is applied to the points. That interpolates
    the kernel linearly, so a density is off by at most ``bound`` = d^2 /
    (8 sqrt(2 pi) h^3), with the points d apart and the bandwidth h.
    """
    s = F.col(score).cast("double")
    scored = df.where(s.isNotNull()).select(F.col(label).alias(label), s.alias("_s"))
    stats = scored.groupBy(F.col(label).alias("_l")).agg(
        F.min("_s").alias("_lo"), F.max("_s").alias("_hi"), F.count(F.lit(1)).alias("_all"), F.stddev("_s").alias("_std"))
    stats = stats.withColumn("_h", F.pow(F.col("_all").cast("double"), F.lit(-0.2)) * F.col("_std")).where(F.col("_h") > 0)
    stats = F.broadcast(stats.withColumn("_d", (F.col("_hi") - F.col("_lo")) / F.lit(float(cells - 1))))  # one row per class, 0 and 1
    joined = scored.join(stats, scored[label].eqNullSafe(stats["_l"]))
    place = (F.col("_s") - F.col("_lo")) / F.col("_d")
    cell = F.least(F.floor(place), F.lit(cells - 2).cast("bigint"))
    shared = joined.select(label, F.inline(F.array(
        F.struct(cell.alias("cell"), (cell + 1 - place).alias("w")), F.struct((cell + 1).alias("cell"), (place - cell).alias("w")))))
    weights = shared.groupBy(label, "cell").agg(F.sum("w").alias("_w"))
    spread = weights.join(stats, weights[label].eqNullSafe(stats["_l"])).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    x = F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / F.lit(float(grid - 1))
    z = (x - (F.col("_lo") + F.col("cell") * F.col("_d"))) / F.col("_h")
    norm = F.first("_all") * F.first("_h") * F.sqrt(F.lit(2.0) * F.pi())
    bound = F.first("_d") * F.first("_d") / (8 * F.sqrt(F.lit(2.0) * F.pi()) * F.pow(F.first("_h"), F.lit(3.0)))
    return spread.groupBy(label, "point").agg(
        F.first(x).alias("x"), (F.sum(F.exp(F.lit(-0.5) * z * z) * F.col("_w")) / norm).alias("density"), bound.alias("bound"))
