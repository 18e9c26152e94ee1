import itertools
import random
import statistics
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.operators import boosting, codes, models
from riskloom.operators.curves import average_precision, curve_metrics, curve_points
from riskloom.operators.splits import stratified_folds
from riskloom.plans.scoring import batch_score, score
from riskloom.plans.training import load_trained, reevaluate, train
from riskloom.sources.metadata import read_meta
from riskloom.sources.sinks import read_split

SMALL = models.TreeParams(rounds=3, max_depth=2, min_data_in_leaf=5)


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(5)
    rows = []
    for i in range(400):
        y = int(draw.random() < 0.3)
        rows.append((i, y, i * 10, draw.gauss(5 + 3 * y, 1), None if draw.random() < 0.2 else draw.random(),
                     draw.choice(["a", "b", None]), f"many{i}"))
    return spark.createDataFrame(
        rows, "TransactionID bigint, isFraud int, TransactionDT bigint, x double, noise double, kind string, wide string").cache()


def test_trees_learn_and_repeat(table):
    inputs = models.fit_tree_inputs(table, ["x", "noise"], ["kind"])
    scores = [models.predict(models.fit_trees(table.repartition(n), inputs, SMALL).model, inputs, table, ["TransactionID", "isFraud"])
              for n in (2, 5)]
    a, b = ([tuple(r) for r in s.orderBy("TransactionID").collect()] for s in scores)
    assert a == b and all(0 <= r[2] <= 1 for r in a)
    assert average_precision(scores[0]).first()[0] > 0.8


def test_importance_and_attribution(spark, table):
    inputs = models.fit_tree_inputs(table, ["x", "noise"], ["kind"])
    model = models.fit_trees(table, inputs, SMALL).model
    gain = {r["feature"]: r["importance"] for r in models.feature_importance(spark, model).collect()}
    assert max(gain, key=gain.get) == "x" and set(gain) == {"x", "noise", "kind_rank", "kind_rate"}
    share = {r["feature"]: r["mean_abs"] for r in models.attribution(model, inputs, table).collect()}
    assert set(share) == set(gain) and max(share, key=share.get) == "x"
    rows = models.contributions(model, inputs, table, ["TransactionID"]).collect()
    prob = {r["TransactionID"]: r["prob"] for r in models.predict(model, inputs, table, ["TransactionID"]).collect()}
    for r in rows:
        assert 1 / (1 + np.exp(-(r["base"] + sum(r["contributions"])))) == pytest.approx(prob[r["TransactionID"]], abs=1e-9)


def known_value(tree, x, known, node=0):
    """Expected leaf value when only the features ``known`` of row ``x`` are known."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    sides = [tree.left[node], tree.right[node]]
    if f in known:
        left = tree.missing_left[node] if np.isnan(x[f]) else x[f] <= tree.threshold[node]
        return known_value(tree, x, known, sides[0] if left else sides[1])
    return sum(tree.cover[s] * known_value(tree, x, known, s) for s in sides) / tree.cover[node]


def test_contributions_are_shapley_values(table):
    """Against the definition: the mean over all orders in which features become known."""
    inputs = models.fit_tree_inputs(table, ["x", "noise"], ["kind"])
    params = models.TreeParams(rounds=3, max_depth=4, min_data_in_leaf=5, min_gain_to_split=0.0, feature_fraction=1.0)
    model = models.fit_trees(table, inputs, params).model
    rows = inputs.transform(table).select("TransactionID", *inputs.names, model.contributions().alias("c")).limit(40).collect()
    assert max(len(set(t.feature[t.feature >= 0])) for t in model.trees) > 2
    for r in rows:
        x = np.array([np.nan if r[n] is None else r[n] for n in inputs.names], float)
        for f in range(4):
            total = 0.0
            for order in itertools.permutations(range(4)):
                before = set(order[:order.index(f)])
                total += sum(known_value(t, x, before | {f}) - known_value(t, x, before) for t in model.trees)
            assert r["c"][f] == pytest.approx(total / 24, abs=1e-9)


def test_best_split_over_all_cuts():
    """Against trying every cut and both ways for missing values."""
    draw = np.random.default_rng(5)
    params = models.TreeParams(min_data_in_leaf=3, min_gain_to_split=0.0)
    for _ in range(50):
        sums = np.zeros((256, 3), np.int64)
        used = [*range(6), 255]
        sums[used, 0] = draw.integers(-40 << 20, 40 << 20, 7)
        sums[used, 1] = draw.integers(1 << 20, 9 << 20, 7)
        sums[used, 2] = draw.integers(1, 6, 7)
        best = 0.0
        for cut in range(6):
            for missing_left in (False, True):
                left = [*range(cut + 1), *([255] if missing_left else [])]
                right = [k for k in used if k not in left]
                parts = [sums[p].sum(axis=0) if p else np.zeros(3) for p in (left, right, used)]
                if min(parts[0][2], parts[1][2]) >= 3:
                    score = [max(abs(g) / 2**20 - params.lambda_l1, 0) ** 2 / (h / 2**20 + params.lambda_l2) for g, h, _ in parts]
                    best = max(best, score[0] + score[1] - score[2])
        found = boosting.best_split(sums, params)
        assert (found[0] if found else 0.0) == pytest.approx(best)


def test_quality_of_each_round_is_that_of_a_model_trained_so_far(table):
    rows = table.withColumn("_is_val", F.col("TransactionID") % 4 == 0)
    inputs = models.fit_tree_inputs(rows.where("NOT _is_val"), ["x", "noise"], ["kind"])
    params = replace(SMALL, rounds=20, patience=50)
    whole = models.fit_trees(rows, inputs, params, validation="_is_val")
    assert len(whole.quality) == 20 and whole.best_round == int(np.argmax(whole.quality)) + 1
    for n in (1, 2, 17):
        alone = models.fit_trees(rows, inputs, replace(params, rounds=n), validation="_is_val")
        assert alone.quality == whole.quality[:n]
        model = whole.model if n == whole.best_round else alone.model
        scores = models.predict(model, inputs, rows.where("_is_val"), ["TransactionID", "isFraud"])
        assert average_precision(scores).first()[0] == pytest.approx(whole.quality[len(model.trees) - 1], abs=1e-3)


def test_patience_ends_boosting(table):
    rows = table.withColumn("_is_val", F.col("TransactionID") % 4 == 0)
    inputs = models.fit_tree_inputs(rows, ["noise"], [])
    found = models.fit_trees(rows, inputs, replace(SMALL, rounds=500, patience=3), validation="_is_val")
    assert len(found.quality) < 100 and len(found.quality) - found.best_round >= 3


def test_stored_model_is_the_same(table):
    inputs = models.fit_tree_inputs(table, ["x", "noise"], ["kind"])
    model = models.fit_trees(table, inputs, SMALL).model
    again = boosting.Boosted.from_json(model.to_json())
    x = np.random.default_rng(0).normal(5, 3, (100, 4))
    x[::7, 0] = np.nan
    assert (again.margin(x) == model.margin(x)).all() and again.names == model.names


def test_odd_training_rows(spark, table):
    """One class, no rows, NULL labels, columns of nothing but NULLs."""
    inputs = models.TreeInputs(("x", "none"), codes.no_codes(spark))
    rows = table.withColumn("none", F.lit(None).cast("double"))
    for part in (rows.where("isFraud = 1"), rows.where("false"), rows.withColumn("isFraud", F.lit(None).cast("int"))):
        model = models.fit_trees(part, inputs, SMALL).model
        assert model.trees == () and models.predict(model, inputs, rows, ["TransactionID"]).where("prob <> 0.5").count() == 0
    assert len(models.fit_trees(rows, inputs, SMALL).model.trees) == 3


def test_a_text_of_many_levels_decides(spark):
    draw = random.Random(3)
    bad = {f"level {i}" for i in draw.sample(range(300), 60)}
    rows = []
    for i in range(9000):
        level = f"level {draw.randrange(300)}"
        rows.append((i, int(draw.random() < (0.98 if level in bad else 0.02)), i, level, draw.random()))
    frame = spark.createDataFrame(rows, "TransactionID bigint, isFraud int, TransactionDT bigint, device string, noise double")
    inputs = models.fit_tree_inputs(frame.where("TransactionID < 6000"), ["noise"], ["device"])
    params = models.TreeParams(rounds=10, max_depth=3, learning_rate=0.3)
    model = models.fit_trees(frame.where("TransactionID < 6000"), inputs, params).model
    scores = models.predict(model, inputs, frame.where("TransactionID >= 6000"), ["TransactionID", "isFraud"])
    assert curve_metrics(curve_points(scores)).first()["roc_auc"] > 0.9
    alone = models.fit_tree_inputs(frame, ["noise"], [])
    without = models.predict(models.fit_trees(frame.where("TransactionID < 6000"), alone, params).model, alone,
                             frame.where("TransactionID >= 6000"), ["TransactionID", "isFraud"])
    assert curve_metrics(curve_points(without)).first()["roc_auc"] < 0.6


def test_cross_validation(table):
    folded = stratified_folds(table, 3)
    found = models.cross_validate(folded, ["x"], ["kind"], SMALL, folds=3).orderBy("fold").collect()
    assert [r["fold"] for r in found] == [0, 1, 2] and all(r["pr_auc"] > 0.7 for r in found)
    # The same by hand for one fold, from rows that never held it.
    rest = folded.where("fold <> 1")
    inputs = models.TreeInputs(("x",), codes.fit_codes(codes.count_levels(rest, ["kind"], "isFraud", F.col("fold")), ["kind"]))
    marked = folded.withColumn("_is_val", F.col("fold") == 1)
    table_, edges = models.tree_table(marked, inputs, SMALL, "isFraud", "TransactionID", "_is_val", F.col("fold"))
    model = boosting.Boosting(table_, edges, SMALL).run()
    scores = models.predict(model, inputs, folded.where("fold = 1"), ["TransactionID", "isFraud"])
    assert average_precision(scores).first()[0] == pytest.approx(found[1]["pr_auc"], abs=1e-12)


@pytest.mark.parametrize("latent_dim", [None, 2], ids=["trees", "anomaly_and_trees"])
def test_pipeline_end_to_end(spark, table, tmp_path, latent_dim):
    trained = train(table, str(tmp_path), SMALL, latent_dim=latent_dim, folds=0 if latent_dim else 2)
    assert ("anomaly_score" in trained.inputs.numbers) == bool(latent_dim)
    assert latent_dim or read_meta(spark, f"{tmp_path}/meta")["cv_pr_auc"] > 0.7
    assert trained.inputs.texts == ("kind", "wide")
    assert read_split(spark, f"{tmp_path}/splits", "val").count() == 60
    report = {r["split"]: r for r in spark.read.parquet(f"{tmp_path}/report").collect()}
    assert set(report) == {"train", "val", "test"} and report["test"]["roc_auc"] > 0.8
    again = load_trained(spark, str(tmp_path))
    assert again.threshold == trained.threshold
    a, b = (sorted(tuple(r) for r in batch_score(table, t).collect()) for t in (trained, again))
    assert a == b and {r[1] for r in a} == {0, 1}
    stored = spark.read.parquet(f"{tmp_path}/scores").select("TransactionID", F.col("prob").alias("stored"))
    assert score(table, again).join(stored, "TransactionID").where("abs(prob - stored) > 1e-12").count() == 0
    # Absent columns count as 0, unreadable numbers as missing.
    partial = table.drop("noise").withColumn("x", F.when(F.col("TransactionID") < 5, "?").otherwise(F.col("x").cast("string")))
    assert score(partial, again).where("prob IS NULL").count() == 0


def test_reevaluation_keeps_the_model(spark, table, tmp_path):
    first = train(table, str(tmp_path), SMALL)
    again = reevaluate(spark, str(tmp_path), "business", 0.3)
    assert again.model.to_json() == first.model.to_json()
    assert read_meta(spark, f"{tmp_path}/meta")["best_threshold"] == again.threshold
    assert load_trained(spark, str(tmp_path)).threshold == again.threshold


def test_reconstruction_error(spark):
    draw = np.random.default_rng(0)
    base = draw.normal(size=(80, 2)) @ draw.normal(size=(2, 5))
    rows = base - base.mean(axis=0)
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(rows)], ["id", "features"])
    model = models.fit_reconstruction(df, 5, 2)
    assert max(r["anomaly_score"] for r in model.score(df).collect()) < 1e-9
    odd = spark.createDataFrame([(0, Vectors.dense(rows[0] + 3 * np.linalg.svd(rows)[2][4]))], ["id", "features"])
    assert model.score(odd).first()["anomaly_score"] == pytest.approx(9 / 5)
    losses = {r["latent_dim"]: r["val_loss"] for r in models.search_latent_dim(df, df, 5, [1, 2]).collect()}
    assert losses[2] < 1e-9 < losses[1]


def test_a_rare_level_scores_higher(spark):
    """Columns that are not centred: almost every row has the level, the few without it are the odd ones."""
    draw = np.random.default_rng(1)
    rows = [(i, Vectors.dense([*draw.normal(size=2), 0.0 if i < 10 else 1.0])) for i in range(500)]
    df = spark.createDataFrame(rows, ["id", "features"])
    scores = {r["id"]: r["anomaly_score"] for r in models.fit_reconstruction(df, 3, 2).score(df).collect()}
    assert min(scores[i] for i in range(10)) > max(scores[i] for i in range(10, 500))
    whole = models.fit_reconstruction(df, 3, 3).score(df).collect()
    assert max(r["anomaly_score"] for r in whole) < 1e-9


def test_trials_respect_ranges():
    trials = models.sample_trials(200)
    assert trials == models.sample_trials(200) != models.sample_trials(200, seed=1)
    for t in trials:
        assert 3 <= t["max_depth"] <= 6 and 8 <= t["num_leaves"] <= min(2 ** t["max_depth"], 64)
        assert 0.005 <= t["learning_rate"] <= 0.1 and 0.1 <= t["lambda_l1"] <= 20


def test_search_prunes_as_the_median_says(spark, table):
    fitting = table.withColumn("_is_val", F.col("TransactionID") % 3 == 0)
    inputs = models.fit_tree_inputs(fitting.where("NOT _is_val"), ["x", "noise"], ["kind"])
    trials = [{**t, "min_data_in_leaf": 5 if i < 3 else 150} for i, t in enumerate(models.sample_trials(6))]
    found = models.search_trees(fitting, inputs, trials, models.TreeParams(rounds=6), rung=2, startup_trials=2, warmup_rounds=2)
    rows = {r["trial"]: r for r in found.trials.collect()}
    log = found.log.collect()
    first = {}
    for r in models.median_pruning(found.log, startup_trials=2, warmup_steps=2).orderBy("trial", "step").collect():
        if r["prune"]:
            first.setdefault(r["trial"], r["step"])
    assert {t for t, r in rows.items() if r["state"] == "pruned"} == set(first) != set()
    for t, r in rows.items():
        values = [x["value"] for x in sorted(log, key=lambda x: x["step"]) if x["trial"] == t]
        assert r["n_rounds"] == len(values) == (first[t] + 1 if t in first else 6)
        assert r["val_pr_auc"] == max(values) and r["best_round"] == values.index(max(values)) + 1
        assert all(r[k] == pytest.approx(float(v)) for k, v in trials[t].items())
    with pytest.raises(ValueError):
        models.search_trees(fitting, inputs, [{"unknown": 1.0}])


def test_best_trial(spark):
    trials = spark.createDataFrame([("s", 0, 0.5), ("s", 1, 0.9), ("s", 2, 0.9)], "study string, trial int, v double")
    assert models.best_trial(trials, ["study"], "v").first()["trial"] == 1
    assert models.best_trial(trials, ["study"], "v", maximise=False).first()["trial"] == 0


def loop(losses, patience):
    """(stop step, best) of a training loop that stops after ``patience`` losses above the best."""
    best, waited = None, 0
    for step, loss in enumerate(losses):
        if best is None or loss <= best:
            best, waited = loss, 0
        else:
            waited += 1
            if waited >= patience:
                return step, best
    return None, best


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 10, "slice_rows": 6}], ids=["plain", "hot"])
def test_early_stopping(spark, limits):
    draw = random.Random(9)
    series = {f"r{k}": [draw.randrange(12) for _ in range(draw.randrange(1, 30))] for k in range(40)}
    df = spark.createDataFrame([(k, i, float(v)) for k, s in series.items() for i, v in enumerate(s)], "run string, step bigint, loss double")
    found = {r["run"]: r for r in models.early_stopping(df, 3, **limits).collect()}
    for k, s in series.items():
        assert (found[k]["stop_step"], found[k]["best_loss"], found[k]["n_steps"]) == (*loop(s, 3), len(s))


@pytest.mark.parametrize("maximise", [True, False])
def test_median_pruning(spark, maximise):
    draw = random.Random(4)
    rows = [("s", t, step, draw.randrange(20), t % 3 != 0) for t in range(12) for step in range(draw.randrange(2, 8))]
    df = spark.createDataFrame(rows, "study string, trial int, step int, value int, complete boolean")
    found = {(r["trial"], r["step"]): r for r in models.median_pruning(df, 2, 1, maximise).collect()}
    assert len(found) == len(rows)
    better = max if maximise else min
    for _, t, step, _, _ in rows:
        best = better(r[3] for r in rows if r[1] == t and r[2] <= step)
        earlier = [r[3] for r in rows if r[1] < t and r[2] == step and r[4]]
        done = len({r[1] for r in rows if r[1] < t and r[4]})
        median = statistics.median(earlier) if earlier else None
        worse = median is not None and (best < median if maximise else best > median)
        assert found[t, step]["median"] == median and found[t, step]["best"] == best
        assert found[t, step]["prune"] == (worse and done >= 2 and step >= 1)
