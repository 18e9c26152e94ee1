"""Models, cross validation, search and the queries over their logs."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.cleaning import DUMMIES, NUMBERS
from riskloom.catalog.inputs import SPEC, SPLIT, TX, table, transactions
from riskloom.catalog.registry import query
from riskloom.operators import codes, models, prep
from riskloom.operators.boosting import TreeParams
from riskloom.operators.columns import legit_rows, numeric_columns, user_keys
from riskloom.operators.ordering import Running, running
from riskloom.operators.splits import stratified_folds, time_cuts, time_split
from riskloom.plans.features import build_features
from riskloom.plans.scoring import batch_score
from riskloom.plans.training import train
from riskloom.session import scratch_path, written
from riskloom.sources.readers import read_csv
from riskloom.sources.sinks import write_submission

# The tuned parameters, with the rounds and the patience of a production run.
PARAMS = TreeParams()
# Columns that spell out the label of the given events, and keys of rows.
HIDDEN = ["TransactionID", "isFraud", "TransactionDT", "DeviceInfo", "P_emaildomain", "is_new_device_uid1"]
# Its users are a text of more than 100 levels.
TEXTS = ["DeviceType", "uid1"]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with its time split, written once: boosting reads it many times."""
    rows = transactions(spark, sf_dir)
    return written(build_features(rows, spec=SPEC).withColumn("split", time_cuts(rows).label()), "features")


def numbers_of(rows: DataFrame) -> list[str]:
    return [c for c in numeric_columns(rows) if c not in HIDDEN]


def fitted(rows: DataFrame, params: TreeParams = PARAMS):
    """Trees on train over all inputs, ended by val."""
    inputs = models.fit_tree_inputs(rows.where("split = 'train'"), numbers_of(rows), TEXTS)
    fitting = rows.where("split <> 'test'").withColumn("_is_val", F.col("split") == "val")
    return models.fit_trees(fitting, inputs, params, validation="_is_val"), inputs


@query("gbt_train")
def gbt_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation quality after every round, and which round the model is cut at."""
    found, _ = fitted(features(spark, sf_dir))
    rows = [(i + 1, float(q), i + 1 == found.best_round) for i, q in enumerate(found.quality)]
    return spark.createDataFrame(rows, "round int, val_pr_auc double, best boolean")


@query("gbt_predict")
def gbt_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir)
    found, inputs = fitted(rows)
    scores = models.predict(found.model, inputs, rows, ["TransactionID", "isFraud", "split"])
    return scores.withColumn("predicted", models.predicted_class(F.col("prob"), 0.25))


STUMP = TreeParams(rounds=1, max_depth=1, learning_rate=0.1, feature_fraction=1.0, bagging_freq=0, min_data_in_leaf=20,
                   min_gain_to_split=0.0)
SPLIT_TX = f"{TX}, {SPLIT.format('tx')}"
SCORE = f"greatest(abs({{0}}) - {STUMP.lambda_l1!r}, CAST(0 AS DOUBLE)) * greatest(abs({{0}}) - {STUMP.lambda_l1!r}, CAST(0 AS DOUBLE)) / ({{1}} + {STUMP.lambda_l2!r})"
LEAF = f"-sign({{0}}) * greatest(abs({{0}}) - {STUMP.lambda_l1!r}, CAST(0 AS DOUBLE)) / ({{1}} + {STUMP.lambda_l2!r}) * {STUMP.learning_rate!r}"


@query("gbt_stump", f"""WITH {SPLIT_TX}, w AS (SELECT CAST({STUMP.scale_pos_weight!r} AS DOUBLE) AS spw),
tr AS (SELECT "isFraud" AS y, "C1", addr1 FROM split_rows WHERE split = 'train'),
b AS (SELECT ln(sum(y) * any_value(spw) / sum(1 - y)) AS base, any_value(spw) AS spw FROM tr, w),
u AS (SELECT base, spw, 1 / (1 + exp(-base)) AS p FROM b),
gh AS (SELECT base, round((p - 1) * spw * 1048576) AS g1, round(p * 1048576) AS g0, round(p * (1 - p) * spw * 1048576) AS h1,
  round(p * (1 - p) * 1048576) AS h0 FROM u),
cells AS (SELECT f, v, count(*) AS n, sum(CASE WHEN y = 1 THEN g1 ELSE g0 END) / 1048576 AS g, sum(CASE WHEN y = 1 THEN h1 ELSE h0 END) / 1048576 AS h
  FROM (SELECT 0 AS f, "C1" AS v, y FROM tr UNION ALL SELECT 1, addr1, y FROM tr) t, gh GROUP BY f, v),
whole AS (SELECT f, sum(n) AS wn, sum(g) AS wg, sum(h) AS wh, coalesce(sum(CASE WHEN v IS NULL THEN n END), 0) AS mn,
  coalesce(sum(CASE WHEN v IS NULL THEN g END), 0) AS mg, coalesce(sum(CASE WHEN v IS NULL THEN h END), 0) AS mh FROM cells GROUP BY f),
runs AS (SELECT f, v, lead(v) OVER o AS next, sum(n) OVER o AS n, sum(g) OVER o AS g, sum(h) OVER o AS h FROM cells WHERE v IS NOT NULL
  WINDOW o AS (PARTITION BY f ORDER BY v)),
sides AS (SELECT f, v, next, m, CASE WHEN m = 1 THEN n + mn ELSE n END AS nl, CASE WHEN m = 1 THEN g + mg ELSE g END AS gl,
  CASE WHEN m = 1 THEN h + mh ELSE h END AS hl, wn, wg, wh FROM runs JOIN whole USING (f), (VALUES (0), (1)) q(m) WHERE m = 0 OR mn > 0),
split AS (SELECT *, {SCORE.format('gl', 'hl')} + {SCORE.format('(wg - gl)', '(wh - hl)')} - {SCORE.format('wg', 'wh')} AS gain FROM sides
  WHERE nl >= {STUMP.min_data_in_leaf} AND wn - nl >= {STUMP.min_data_in_leaf} ORDER BY gain DESC, f, m, v LIMIT 1),
leaves AS (SELECT f, m, v + (next - v) / 2 AS cut, {LEAF.format('gl', 'hl')} AS lv, {LEAF.format('(wg - gl)', '(wh - hl)')} AS rv, nl, wn FROM split),
scored AS (SELECT "TransactionID", CASE WHEN CASE f WHEN 0 THEN "C1" ELSE addr1 END IS NULL THEN m = 1
  ELSE CASE f WHEN 0 THEN "C1" ELSE addr1 END <= cut END AS is_left, lv, rv, nl, wn, base FROM tx, leaves, gh)
SELECT "TransactionID", round(1 / (1 + exp(-(base + CASE WHEN is_left THEN lv ELSE rv END))), 9) AS prob,
  round(CASE WHEN is_left THEN lv ELSE rv END - (nl * lv + (wn - nl) * rv) / wn, 9) AS contribution FROM scored""")
def gbt_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of depth one on two inputs, one with gaps: the probability and what the split adds to the log odds."""
    rows = transactions(spark, sf_dir).withColumn("split", time_cuts(transactions(spark, sf_dir)).label())
    inputs = models.fit_tree_inputs(rows, ["C1", "addr1"], [])
    model = models.fit_trees(rows.where("split = 'train'"), inputs, STUMP).model
    scores = models.contributions(model, inputs, transactions(spark, sf_dir), ["TransactionID"])
    margin = F.aggregate("contributions", F.col("base"), lambda a, b: a + b)
    added = F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)
    return scores.select("TransactionID", F.round(1 / (1 + F.exp(-margin)), 9).alias("prob"), F.round(added, 9).alias("contribution"))


FOLD_OF = """CAST(('0x' || substr(md5('42:' || CAST("TransactionID" AS VARCHAR)), 1, 8)) AS BIGINT) % 5"""


def codes_sql(without: str) -> str:
    """Ranks and label rates of train's user texts by the definition, one fold left out per row (and ``without``)."""
    return f"""WITH {SPLIT_TX}, tr AS (SELECT *, {FOLD_OF} AS fold FROM split_rows WHERE split = 'train'),
used AS (SELECT * FROM tr WHERE {without}),
prior AS (SELECT sum("isFraud") / count(*) AS p FROM used),
levels AS (SELECT uid1, count(*) AS n, sum("isFraud") AS yes FROM used GROUP BY uid1),
ranked AS (SELECT *, rank() OVER (ORDER BY n DESC) AS r FROM levels),
own AS (SELECT uid1, fold, count(*) AS n, sum("isFraud") AS yes FROM used GROUP BY uid1, fold)"""


MIXED = "round(({0} + p * 20) / ({1} + 20), 9)"


@query("category_codes", codes_sql("true") + f"""
SELECT t."TransactionID", CAST(r AS BIGINT) AS uid1_rank,
  CASE WHEN split = 'train' THEN {MIXED.format('k.yes - o.yes', 'k.n - o.n')} ELSE {MIXED.format('k.yes', 'k.n')} END AS uid1_rate
FROM (SELECT *, {FOLD_OF} AS fold FROM split_rows) t LEFT JOIN ranked k USING (uid1)
LEFT JOIN own o ON o.uid1 = t.uid1 AND o.fold = t.fold, prior""")
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a text with many levels; rows the codes were fitted on do not see their own fold."""
    rows = user_keys(transactions(spark, sf_dir))
    split = rows.withColumn("split", time_cuts(rows).label())
    train_rows = split.where("split = 'train'")
    fitted_codes = codes.fit_codes(codes.count_levels(train_rows, ["uid1"], "isFraud", codes.fold_of("TransactionID")), ["uid1"])
    fold = F.when(F.col("split") == "train", codes.fold_of("TransactionID")).otherwise(codes.UNFITTED)
    return fitted_codes.add(split, fold).select("TransactionID", "uid1_rank", F.round("uid1_rate", 9).alias("uid1_rate"))


@query("cv_codes", " UNION ALL ".join(f"""SELECT * FROM ({codes_sql(f'fold <> {k}')}
SELECT {k} AS held_fold, t."TransactionID", CAST(r AS BIGINT) AS uid1_rank, CASE WHEN t.fold <> {k} THEN {MIXED.format('k.yes - o.yes', 'k.n - o.n')}
  ELSE {MIXED.format('k.yes', 'k.n')} END AS uid1_rate FROM tr t LEFT JOIN ranked k USING (uid1)
  LEFT JOIN own o ON o.uid1 = t.uid1 AND o.fold = t.fold, prior) q{k}""" for k in range(2)))
def cv_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes cross validation uses for its first two folds: counted once, the held fold subtracted."""
    rows = user_keys(transactions(spark, sf_dir))
    train_rows = rows.where(time_cuts(rows).predicate("train"))
    counts = codes.count_levels(train_rows, ["uid1"], "isFraud", codes.fold_of("TransactionID"))
    out = None
    for k in range(2):
        fold = codes.fold_of("TransactionID")
        coded = codes.fit_codes(counts, ["uid1"], without=k).add(train_rows, F.when(fold == k, codes.UNFITTED).otherwise(fold))
        part = coded.select(F.lit(k).alias("held_fold"), "TransactionID", "uid1_rank", F.round("uid1_rate", 9).alias("uid1_rate"))
        out = part if out is None else out.unionByName(part)
    return out


@query("batch_score")
def batch_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build_features(transactions(spark, sf_dir), spec=SPEC)
    trained = train(rows, scratch_path(spark, "model"), PARAMS, latent_dim=3)
    path = scratch_path(spark, "submission")
    write_submission(batch_score(rows, trained), path)
    return read_csv(spark, path, "TransactionID bigint, isFraud int")


def matrix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    split = time_split(transactions(spark, sf_dir))
    train_rows = split.where("split = 'train'")
    levels, scaling = prep.fit_levels(train_rows, list(DUMMIES)), prep.fit_scaling(train_rows, NUMBERS)
    width = len(levels.names) + len(scaling.names)
    return written(prep.numeric_matrix(split, levels, scaling, ["TransactionID", "isFraud", "split"]), "matrix"), width


@query("anomaly_score")
def anomaly_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, width = matrix(spark, sf_dir)
    model = models.fit_reconstruction(legit_rows(rows.where("split = 'train'")), width, 3)
    return model.score(rows).select("TransactionID", "split", "anomaly_score")


@query("anomaly_embeddings")
def anomaly_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconstruction error of the embeddings from the components of one class."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    width = 64
    return models.fit_reconstruction(legit_rows(rows, "label"), width, 8).score(rows).select("vec_id", "label", "anomaly_score")


@query("latent_search")
def latent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, width = matrix(spark, sf_dir)
    legit = legit_rows(rows)
    return models.search_latent_dim(legit.where("split = 'train'"), legit.where("split = 'val'"), width, [1, 3, 6])


@query("cross_val")
def cross_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(spark, sf_dir).where("split <> 'test'")
    folded = written(stratified_folds(rows), "folds")
    return models.cross_validate(folded, numbers_of(rows), TEXTS, PARAMS)


@query("hpo_search")
def hpo_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials with their state, rounds, best quality and parameters."""
    rows = features(spark, sf_dir)
    inputs = models.fit_tree_inputs(rows.where("split = 'train'"), numbers_of(rows), TEXTS)
    fitting = rows.where("split <> 'test'").withColumn("_is_val", F.col("split") == "val")
    return models.search_trees(fitting, inputs, models.sample_trials(), PARAMS).trials


@query("attribution")
def attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean share of every input in the log odds of the validation rows."""
    rows = features(spark, sf_dir)
    found, inputs = fitted(rows)
    return models.attribution(found.model, inputs, rows.where("split = 'val'"))


@query("hpo_best", f"""WITH {TX} SELECT study, trial, val_pr_auc FROM (SELECT card1 AS study, "TransactionID" AS trial, cents AS val_pr_auc,
  row_number() OVER (PARTITION BY card1 ORDER BY cents DESC, "TransactionID") AS rn FROM tx) r WHERE rn = 1""")
def hpo_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as studies, their transactions as trials."""
    trials = transactions(spark, sf_dir).select(
        F.col("card1").alias("study"), F.col("TransactionID").alias("trial"), SPEC.units.alias("val_pr_auc"))
    return models.best_trial(trials, ["study"], "val_pr_auc")


STEPS = """steps AS (SELECT {0}, row_number() OVER (PARTITION BY {1} ORDER BY "TransactionDT", "TransactionID") AS step, cents, "isFraud" FROM tx)"""


@query("early_stop", f"""WITH {TX}, {STEPS.format('card1 AS run', 'card1')},
a AS (SELECT *, min(cents) OVER (PARTITION BY run ORDER BY step) AS best FROM steps),
b AS (SELECT *, max(CASE WHEN cents = best THEN step END) OVER (PARTITION BY run ORDER BY step) AS best_step FROM a),
s AS (SELECT run, count(*) AS n_steps, min(CASE WHEN step - best_step >= 5 THEN step END) AS stop_step FROM b GROUP BY run)
SELECT s.run, n_steps, stop_step, (SELECT min(cents) FROM steps x WHERE x.run = s.run AND x.step <= coalesce(s.stop_step, s.n_steps)) AS best_loss FROM s""")
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as runs, their amounts as losses."""
    rows = transactions(spark, sf_dir).select(F.col("card1").alias("run"), "TransactionDT", "TransactionID", SPEC.units.alias("loss"))
    steps = running(rows, ["run"], ["TransactionDT", "TransactionID"], [Running("step", "sum", F.lit(1).cast("bigint"))])
    return models.early_stopping(steps, 5)


DAY = '"TransactionDT" // 86400'


@query("prune_median", f"""WITH {TX}, {STEPS.format(f'card1 AS study, {DAY} AS trial', f'card1, {DAY}')},
c AS (SELECT study, trial, step, cents AS value, max("isFraud") OVER (PARTITION BY study, trial) = 0 AS complete FROM steps),
b AS (SELECT *, max(value) OVER (PARTITION BY study, trial ORDER BY step) AS best,
  quantile_cont(CASE WHEN complete THEN CAST(value AS DOUBLE) END, 0.5) OVER (PARTITION BY study, step ORDER BY trial
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS median FROM c),
d AS (SELECT study, trial, CAST(coalesce(sum(k) OVER (PARTITION BY study ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
  AS n_completed FROM (SELECT study, trial, max(CAST(complete AS INTEGER)) AS k FROM c GROUP BY study, trial) t)
SELECT study, trial, step, best, median, n_completed, coalesce(best < median, false) AND n_completed >= 3 AND step >= 2 AS prune
FROM b JOIN d USING (study, trial)""")
def prune_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as studies, days as trials, amounts as reported values; a day with a fraud did not complete."""
    rows = transactions(spark, sf_dir).select(
        F.col("card1").alias("study"), F.expr("TransactionDT div 86400").alias("trial"), "TransactionDT", "TransactionID",
        SPEC.units.alias("value"), "isFraud")
    steps = running(rows, ["study", "trial"], ["TransactionDT", "TransactionID"], [Running("step", "sum", F.lit(1).cast("bigint"))])
    fraud = rows.groupBy("study", "trial").agg((F.max("isFraud") == 0).alias("complete"))
    values = steps.join(fraud, ["study", "trial"]).select("study", "trial", "step", "value", "complete")
    return models.median_pruning(values, startup_trials=3, warmup_steps=2)
