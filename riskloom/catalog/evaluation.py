"""Curves, metrics, thresholds, densities and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.inputs import SCORED, SPLIT, TX, scored, transactions
from riskloom.catalog.registry import query
from riskloom.operators import curves, reports, thresholds
from riskloom.operators.splits import time_split

POINTS = SCORED + """, pts AS (SELECT prob AS threshold, sum("isFraud") AS d_tp, count(*) - sum("isFraud") AS d_fp FROM scored GROUP BY prob),
cum AS (SELECT threshold, d_tp, d_fp, sum(d_tp) OVER w AS tp, sum(d_fp) OVER w AS fp, sum(d_tp) OVER () AS p, sum(d_fp) OVER () AS n
        FROM pts WINDOW w AS (ORDER BY threshold DESC)),
pr AS (SELECT threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / p AS recall FROM cum),
f1 AS (SELECT *, CAST(2.0 AS DOUBLE) * precision * recall / (precision + recall + CAST(1e-8 AS DOUBLE)) AS f1_score FROM pr)"""
AP = "round(sum(d_tp * (CAST(tp AS DOUBLE) / (tp + fp))) / max(p), 10)"
AUC = "CAST(sum(d_fp * (2 * tp - d_tp)) AS DOUBLE) / (CAST(max(p) AS DOUBLE) * CAST(max(n) AS DOUBLE) * 2)"
AT_FPR = "max(CASE WHEN CAST(fp AS DOUBLE) / n <= 0.05::DOUBLE THEN CAST(tp AS DOUBLE) / p END)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.curve_points(scored(spark, sf_dir))


@query("confusion", f"""WITH {SCORED} SELECT count(*) FILTER (prob > 0.35 AND "isFraud" = 1) AS tp, count(*) FILTER (prob > 0.35 AND "isFraud" = 0) AS fp,
  count(*) FILTER (prob <= 0.35 AND "isFraud" = 0) AS tn, count(*) FILTER (prob <= 0.35 AND "isFraud" = 1) AS fn FROM scored""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.confusion(scored(spark, sf_dir), 0.35)


CLASS_SQL = """CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1"""
COUNTS_SQL = """count(*) FILTER (prob > {0} AND "isFraud" = 1) AS tp, count(*) FILTER (prob > {0} AND "isFraud" = 0) AS fp,
  count(*) FILTER (prob <= {0} AND "isFraud" = 0) AS tn, count(*) FILTER (prob <= {0} AND "isFraud" = 1) AS fn"""


@query("cls_metrics", f"""WITH {SCORED}, c AS (SELECT "DeviceType", {COUNTS_SQL.format(0.35)} FROM scored GROUP BY "DeviceType")
  SELECT "DeviceType", {CLASS_SQL} FROM c""")
def cls_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.class_metrics(curves.confusion(scored(spark, sf_dir), 0.35, by=["DeviceType"]), ["DeviceType"])


@query("pr_curve", f"WITH {POINTS} SELECT * FROM f1")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.pr_curve(points(spark, sf_dir))


@query("roc_curve", f"""WITH {POINTS} SELECT threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM cum
  UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.roc_curve(points(spark, sf_dir))


@query("avg_precision", f"WITH {POINTS} SELECT {AP} AS pr_auc FROM cum")
def avg_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.average_precision(scored(spark, sf_dir)).select(F.round("pr_auc", 10).alias("pr_auc"))


@query("roc_auc", f"WITH {POINTS} SELECT {AUC} AS roc_auc FROM cum")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.curve_metrics(points(spark, sf_dir)).select("roc_auc")


@query("recall_at_fpr", f"WITH {POINTS} SELECT coalesce({AT_FPR}, 0) AS recall_at_fpr FROM cum")
def recall_at_fpr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.curve_metrics(points(spark, sf_dir), 0.05).select("recall_at_fpr")


@query("thr_f1", f"WITH {POINTS} SELECT * FROM f1 ORDER BY f1_score DESC, threshold LIMIT 1")
def thr_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.f1_threshold(curves.pr_curve(points(spark, sf_dir)))


BUSINESS = """(SELECT *, true AS reached FROM f1 WHERE precision >= CAST(1 AS DOUBLE) - CAST({0} AS DOUBLE) ORDER BY recall DESC, precision DESC, threshold DESC LIMIT 1)
  UNION ALL (SELECT *, false FROM f1 WHERE NOT EXISTS (SELECT 1 FROM f1 WHERE precision >= CAST(1 AS DOUBLE) - CAST({0} AS DOUBLE))
  ORDER BY f1_score DESC, threshold LIMIT 1)"""


@query("thr_business", f"WITH {POINTS} {BUSINESS.format(0.05)}")
def thr_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.business_threshold(curves.pr_curve(points(spark, sf_dir)), 0.05)


# The score without the part that leans towards the label.
BLIND = POINTS.replace('(cents % 997 + "isFraud" * 400) / CAST(1400.0 AS DOUBLE)', "(cents % 997) / CAST(1400.0 AS DOUBLE)")


@query("thr_business_fallback", f"WITH {BLIND} {BUSINESS.format(0.000001)}")
def thr_business_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score that knows nothing of the label: the target precision may be out of reach, then F1 decides."""
    rows = transactions(spark, sf_dir)
    cents = F.round(F.col("TransactionAmt") * 100).cast("bigint")
    blind = rows.select("isFraud", ((cents % 997) / F.lit(1400.0)).alias("prob"))
    return thresholds.business_threshold(curves.pr_curve(curves.curve_points(blind)), 0.000001)


@query("thr_strategy", f"WITH {POINTS}, chosen AS ({BUSINESS.format(0.05)}) SELECT threshold, precision, recall, f1_score FROM chosen")
def thr_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.choose_threshold(curves.pr_curve(points(spark, sf_dir)), "business", 0.05)


BY_SPLIT = f"""{SCORED}, {SPLIT.format('scored')},
c AS (SELECT split, {COUNTS_SQL.format(0.35)} FROM split_rows GROUP BY split),
pts AS (SELECT split, prob AS threshold, sum("isFraud") AS d_tp, count(*) - sum("isFraud") AS d_fp FROM split_rows GROUP BY split, prob),
cum AS (SELECT split, d_tp, d_fp, sum(d_tp) OVER w AS tp, sum(d_fp) OVER w AS fp, sum(d_tp) OVER (PARTITION BY split) AS p,
        sum(d_fp) OVER (PARTITION BY split) AS n FROM pts WINDOW w AS (PARTITION BY split ORDER BY threshold DESC)),
a AS (SELECT split, {AP} AS pr_auc, {AUC} AS roc_auc, coalesce({AT_FPR}, 0) AS recall_at_fpr FROM cum GROUP BY split)"""


@query("split_report", f"WITH {BY_SPLIT} SELECT split, {CLASS_SQL}, pr_auc, roc_auc, recall_at_fpr FROM c JOIN a USING (split)")
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = curves.split_report(time_split(scored(spark, sf_dir)), 0.35)
    return report.withColumn("pr_auc", F.round("pr_auc", 10))


@query("score_density", f"""WITH {SCORED}, r AS (SELECT "isFraud", min(prob) AS lo, (max(prob) - min(prob)) / 50.0::DOUBLE AS step, count(*) AS total
  FROM scored GROUP BY "isFraud"),
g AS (SELECT s."isFraud", prob, lo, step, total, CAST(floor((prob - lo) / step) AS BIGINT) AS i FROM scored s JOIN r USING ("isFraud")),
b AS (SELECT *, greatest(0, least(49, i - CAST(prob < lo + i * step AS BIGINT) + CAST(prob >= lo + (i + 1) * step AS BIGINT))) AS bin FROM g)
SELECT "isFraud", CAST(bin AS BIGINT) AS bin, lo + bin * step AS "left", count(*) AS n, count(*) / (total * step) AS density
FROM b GROUP BY "isFraud", bin, lo, step, total""")
def score_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.score_density(scored(spark, sf_dir))


@query("score_kde", f"""WITH {SCORED}, w AS (SELECT "isFraud", prob, count(*) AS k FROM scored GROUP BY "isFraud", prob),
r AS (SELECT "isFraud", min(prob) AS lo, max(prob) AS hi, count(*) AS total,
  pow(CAST(count(*) AS DOUBLE), CAST(-0.2 AS DOUBLE)) * stddev_samp(prob) AS h FROM scored GROUP BY "isFraud"),
g AS (SELECT r.*, CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 199.0::DOUBLE AS x FROM r, range(200) t(i))
SELECT g."isFraud", point, round(x, 8) AS x, round(sum(k * exp(-0.5::DOUBLE * ((x - prob) / h) * ((x - prob) / h))) / (max(total) * max(h) * sqrt(2 * pi())), 8) AS density
FROM g JOIN w USING ("isFraud") GROUP BY g."isFraud", point, x""")
def score_kde(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = curves.score_kde(scored(spark, sf_dir))
    return curve.withColumns({"x": F.round("x", 8), "density": F.round("density", 8)})


@query("score_kde_binned", f"""WITH {SCORED},
r AS (SELECT "isFraud", min(prob) AS lo, max(prob) AS hi, count(*) AS total,
  pow(CAST(count(*) AS DOUBLE), CAST(-0.2 AS DOUBLE)) * stddev_samp(prob) AS h, (max(prob) - min(prob)) / 511.0::DOUBLE AS d FROM scored GROUP BY "isFraud"),
p AS (SELECT "isFraud", (prob - lo) / d AS place, least(floor((prob - lo) / d), 510) AS cell FROM scored JOIN r USING ("isFraud")),
w AS (SELECT "isFraud", cell, sum(k) AS k FROM (SELECT "isFraud", cell, cell + 1 - place AS k FROM p
  UNION ALL SELECT "isFraud", cell + 1, place - cell FROM p) u GROUP BY "isFraud", cell),
g AS (SELECT r.*, CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 199.0::DOUBLE AS x FROM r, range(200) t(i))
SELECT g."isFraud", point, round(x, 8) AS x, round(sum(k * exp(-0.5::DOUBLE * pow((x - (lo + cell * d)) / h, 2))) / (max(total) * max(h) * sqrt(2 * pi())), 8) AS density,
  round(max(d * d / (8 * sqrt(2 * pi()) * pow(h, 3))), 8) AS bound
FROM g JOIN w USING ("isFraud") GROUP BY g."isFraud", point, x""")
def score_kde_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = curves.score_kde_binned(scored(spark, sf_dir), cells=512)
    return curve.withColumns({c: F.round(c, 8) for c in ("x", "density", "bound")})


@query("recon_errors", f"""WITH {TX}, e AS (SELECT CAST(card1 AS BIGINT) - cents AS a, cents % 1000 - CAST("C1" AS BIGINT) AS b FROM tx),
t AS (SELECT sum(a * a) + sum(b * b) AS sq, sum(abs(a)) + sum(abs(b)) AS ab, count(a) + count(b) AS n FROM e)
SELECT CAST(n AS BIGINT) AS n, CAST(sq AS DOUBLE) / n AS val_loss, sqrt(CAST(sq AS DOUBLE) / n) AS rmse, CAST(ab AS DOUBLE) / n AS mae FROM t""")
def recon_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).select(
        "card1", F.round(F.col("TransactionAmt") * 100).cast("bigint").alias("cents"), F.col("C1").cast("bigint").alias("c1"))
    return curves.reconstruction_errors(rows.withColumn("rest", F.col("cents") % 1000), [("card1", "cents"), ("rest", "c1")])


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row of metrics per device type, in the role of a training run."""
    wide = curves.class_metrics(curves.confusion(scored(spark, sf_dir), 0.35, by=["DeviceType"]), ["DeviceType"])
    return wide.select(
        F.concat(F.lit("run-"), "DeviceType").alias("run_id"), F.when(F.col("DeviceType") == "mobile", "mobile").alias("run_name"),
        F.col("precision").alias("metrics.lgbm_val_precision"), F.col("recall").alias("metrics.lgbm_val_recall"),
        F.col("f1").alias("metrics.lgbm_test_f1"), F.col("accuracy").alias("metrics.lgbm_test_accuracy"))


RUNS = f"""{SCORED}, c AS (SELECT "DeviceType", {COUNTS_SQL.format(0.35)} FROM scored GROUP BY "DeviceType"),
m AS (SELECT CASE WHEN "DeviceType" = 'mobile' THEN 'mobile' ELSE 'run-desktop' END AS run, {CLASS_SQL} FROM c),
long AS (SELECT run AS "Run_Name", 'Val Precision' AS "Metric", precision AS "Value" FROM m UNION ALL SELECT run, 'Val Recall', recall FROM m
  UNION ALL SELECT run, 'Test F1-Score', f1 FROM m UNION ALL SELECT run, 'test_accuracy', accuracy FROM m)"""


@query("metric_labels", f"""WITH {RUNS} SELECT CAST(dense_rank() OVER (ORDER BY "Run_Name") - 1 AS VARCHAR) AS "Run_ID_Short", * FROM long""")
def metric_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.long_metrics(run_metrics(spark, sf_dir), ["run-mobile", "run-desktop"])


@query("run_compare", f"""WITH {RUNS} SELECT "Metric", max(CASE WHEN "Run_Name" = 'mobile' THEN "Value" END) AS mobile,
  max(CASE WHEN "Run_Name" = 'run-desktop' THEN "Value" END) AS "run-desktop",
  max(CASE WHEN "Run_Name" = 'run-desktop' THEN "Value" END) - max(CASE WHEN "Run_Name" = 'mobile' THEN "Value" END) AS "run-desktop_delta"
  FROM long GROUP BY "Metric" """)
def run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.compare_runs(reports.long_metrics(run_metrics(spark, sf_dir)), ["mobile", "run-desktop"])
