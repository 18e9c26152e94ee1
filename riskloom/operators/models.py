"""Trees over a feature table, reconstruction-error scores, cross validation, search, attribution."""

from __future__ import annotations

import math
import random
import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.boosting import Boosted, Boosting, TreeParams, binned, fit_edges, one_task_holds
from riskloom.operators.codes import UNFITTED, Codes, count_levels, fit_codes, fold_of, no_codes
from riskloom.operators.columns import legit_rows
from riskloom.operators.curves import average_precision
from riskloom.operators.ordering import HOT_ROWS, SLICE_ROWS, Running, running
from riskloom.operators.prep import LevelEncoding, NumericScaling, fit_levels, fit_scaling, with_matrix
from riskloom.session import at_once


@dataclass(frozen=True)
class TreeInputs:
    """What trees are given: numbers as they are, missing ones included, and rank and label rate of every text column."""

    numbers: tuple[str, ...]
    codes: Codes

    @property
    def texts(self) -> tuple[str, ...]:
        return self.codes.texts

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *self.codes.names]

    def transform(self, df: DataFrame, fold: Column | None = None) -> DataFrame:
        """``df`` with the codes. ``fold`` is given for rows the codes were fitted on."""
        return self.codes.add(df, fold)


def fit_tree_inputs(train: DataFrame, numbers: Sequence[str], texts: Sequence[str], label: str = "isFraud",
                    row_id: str = "TransactionID", path: str | None = None) -> TreeInputs:
    """Code tables of all ``texts``, fitted on ``train`` fold by fold and written to ``path``."""
    if not texts:
        return TreeInputs(tuple(numbers), no_codes(train.sparkSession))
    counts = count_levels(train, texts, label, fold_of(row_id))
    return TreeInputs(tuple(numbers), fit_codes(counts, texts, path=path))


@dataclass(frozen=True)
class FittedTrees:
    """The model of the best round, and the validation quality after every round that was tried."""

    model: Boosted
    quality: tuple[float, ...]

    @property
    def best_round(self) -> int:
        return len(self.model.trees)


def tree_table(rows: DataFrame, inputs: TreeInputs, params: TreeParams, label: str, row_id: str, validation: str | None = None,
               fold: Column | None = None) -> tuple[DataFrame, dict[str, list[float]]]:
    """(binned rows, bin edges); edges see only rows that ``validation`` does not mark."""
    held = F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(False)
    own_fold = fold if fold is not None else fold_of(row_id)
    coded = inputs.transform(rows.withColumn("_held", held), F.when(held, UNFITTED).otherwise(own_fold))
    edges = fit_edges(coded.where(~F.col("_held") & F.col(label).isNotNull()), inputs.names, row_id, params.max_bins)
    return binned(coded, edges, label, row_id, F.col("_held")), edges


def fit_trees(train: DataFrame, inputs: TreeInputs, params: TreeParams = TreeParams(), label: str = "isFraud",
              validation: str | None = None, row_id: str = "TransactionID") -> FittedTrees:
    """Boosts on the rows that ``validation`` does not mark; the marked ones end it and choose the round."""
    table, edges = tree_table(train, inputs, params, label, row_id, validation)
    boosting = Boosting(table, edges, params)
    model = boosting.run()
    boosting.close()
    table.unpersist()
    return FittedTrees(model, tuple(boosting.quality))


def predict(model: Boosted, inputs: TreeInputs, df: DataFrame, keep: Sequence[str], name: str = "prob") -> DataFrame:
    """``keep`` plus the fraud probability."""
    raw = df.select(*dict.fromkeys([*keep, *inputs.numbers, *inputs.texts]))
    held = {c: f"_keep_{c}" for c in keep}
    scored = inputs.transform(raw.withColumns({h: F.col(c) for c, h in held.items()}))
    return scored.select(*[F.col(h).alias(c) for c, h in held.items()], model.column().alias(name))


def contributions(model: Boosted, inputs: TreeInputs, df: DataFrame, keep: Sequence[str], name: str = "contributions") -> DataFrame:
    """``keep``, the array of each input's share of the row's log odds (in the order of ``inputs.names``), and ``base``."""
    raw = df.select(*dict.fromkeys([*keep, *inputs.numbers, *inputs.texts]))
    held = {c: f"_keep_{c}" for c in keep}
    parts = inputs.transform(raw.withColumns({h: F.col(c) for c, h in held.items()})).select(
        *[F.col(h).alias(c) for c, h in held.items()], model.contributions().alias("_parts"))
    n = len(inputs.names)
    return parts.select(*keep, F.slice("_parts", 1, n).alias(name), F.get("_parts", F.lit(n)).alias("base"))


def attribution(model: Boosted, inputs: TreeInputs, df: DataFrame) -> DataFrame:
    """(feature, mean_abs, mean): how much each input moves the log odds of the rows of ``df``."""
    rows = contributions(model, inputs, df, [])
    named = rows.select(F.posexplode("contributions").alias("i", "part"))
    names = F.array(*[F.lit(n) for n in inputs.names])
    return named.groupBy("i").agg(F.avg(F.abs("part")).alias("mean_abs"), F.avg("part").alias("mean")).select(
        F.get(names, F.col("i")).alias("feature"), "mean_abs", "mean")


def predicted_class(probability: Column, threshold: float) -> Column:
    """Strictly above the threshold is fraud."""
    return (probability > threshold).cast("int")


def feature_importance(spark: SparkSession, model: Boosted) -> DataFrame:
    """(feature, importance): share of the total gain, one row per input."""
    return spark.createDataFrame(list(model.importance().items()), "feature string, importance double")


@dataclass(frozen=True)
class ReconstructionModel:
    """Linear autoencoder: the mean and the principal components of the legit rows."""

    pca: Transformer
    width: int
    center: tuple[float, ...]

    def score(self, df: DataFrame, features: str = "features", name: str = "anomaly_score") -> DataFrame:
        """Mean squared reconstruction error per row.

        The components are orthonormal, so the squared error is the squared
        distance of the row from the mean minus that of its projection.
        """
        def distance(vector: str, center: Sequence[float]) -> Column:
            squares = F.zip_with(vector_to_array(vector), F.array(*[F.lit(float(m)) for m in center]),
                                 lambda v, m: (v - m) * (v - m))
            return F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v)

        projected = self.pca.copy({self.pca.inputCol: features}).transform(df)
        middle = self.pca.pc.toArray().T @ np.array(self.center)
        error = F.greatest(F.lit(0.0), distance(features, self.center) - distance("_projected", middle)) / F.lit(float(self.width))
        return projected.withColumn(name, error).drop("_projected")


def fit_reconstruction(legit: DataFrame, width: int, latent_dim: int = 61, features: str = "features") -> ReconstructionModel:
    """Fit on z-scored legit rows; the covariance has width x width entries, whatever the number of rows."""
    k = min(latent_dim, width)
    center = legit.agg(Summarizer.mean(F.col(features))).first()[0]
    pca = PCA(k=k, inputCol=features, outputCol="_projected").fit(legit)
    return ReconstructionModel(pca, width, tuple(center.toArray().tolist()))


@dataclass(frozen=True)
class AnomalyModel:
    """Encoding, scaling and reconstruction: adds a score to raw rows without a join."""

    levels: LevelEncoding
    scaling: NumericScaling
    reconstruction: ReconstructionModel

    def add(self, df: DataFrame, name: str = "anomaly_score") -> DataFrame:
        scored = self.reconstruction.score(with_matrix(df, self.levels, self.scaling, "_matrix"), "_matrix", name)
        return scored.drop("_matrix")


def fit_anomaly(train: DataFrame, numbers: Sequence[str], texts: Sequence[str], latent_dim: int = 61,
                label: str = "isFraud") -> AnomalyModel:
    """Levels from train, scaling and components from its legit rows."""
    levels, scaling = fit_levels(train, texts), fit_scaling(train, numbers, label)
    width = len(levels.names) + len(scaling.names)
    legit = with_matrix(legit_rows(train, label), levels, scaling, "_matrix").select("_matrix")
    return AnomalyModel(levels, scaling, fit_reconstruction(legit, width, latent_dim, "_matrix"))


def mean_square_score(columns: Sequence[str]) -> Column:
    """Reconstruction error of the empty projection: the mean squared z-score."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.col(c) * F.col(c)
    return total / F.lit(float(len(columns)))


# Boosting within folds.
FOLD_ROUNDS, FOLD_PATIENCE = 500, 30


def cross_validate(df: DataFrame, numbers: Sequence[str], texts: Sequence[str], params: TreeParams, folds: int = 5,
                   label: str = "isFraud", fold: str = "fold", row_id: str = "TransactionID") -> DataFrame:
    """(fold, best_round, pr_auc): train on the other folds, stop and evaluate on this one.

    ``df`` should be a written table. Nothing of the held fold reaches the
    inputs: levels are counted once per fold, the held fold's counts are left
    out, and each other fold's codes leave that fold out as well. Folds run next
    to each other where one task can boost over the rows, else one after the other.
    """
    counts = count_levels(df, texts, label, F.col(fold)) if texts else None
    params = replace(params, rounds=min(params.rounds, FOLD_ROUNDS), patience=min(params.patience, FOLD_PATIENCE))

    def run(k: int) -> tuple[int, int, float]:
        codes = fit_codes(counts, texts, without=k) if texts else no_codes(df.sparkSession)
        inputs = TreeInputs(tuple(numbers), codes)
        table, edges = tree_table(df.withColumn("_is_held", F.col(fold) == k), inputs, params, label, row_id, "_is_held", F.col(fold))
        boosting = Boosting(table, edges, params)
        model = boosting.run()
        boosting.close()
        table.unpersist()
        held = predict(model, inputs, df.where(F.col(fold) == k), [row_id, label])
        return k, len(model.trees), average_precision(held, label=label).first()[0]

    spark = df.sparkSession
    small = one_task_holds(df.count(), len(numbers) + 2 * len(texts), params)
    rows = at_once(spark, run, range(folds), min(folds, spark.sparkContext.defaultParallelism) if small else 1)
    return spark.createDataFrame(rows, "fold int, best_round int, pr_auc double")


# Search ranges (low, high, logarithmic) of the tree search.
TREE_SEARCH = {
    "learning_rate": (0.005, 0.1, True),
    "bagging_fraction": (0.5, 0.85, False),
    "feature_fraction": (0.4, 0.85, False),
    "min_gain_to_split": (0.01, 1.0, False),
    "lambda_l1": (0.1, 20.0, True),
    "lambda_l2": (0.1, 20.0, True),
    "scale_pos_weight": (1.0, 50.0, False),
}
TREE_SEARCH_WHOLE = {"max_depth": (3, 6), "bagging_freq": (1, 5), "min_data_in_leaf": (100, 1000)}
LEAVES_LOW, LEAVES_HIGH = 8, 64
# The same for the reconstruction model.
LATENT_DIM_RANGE = (8, 64)
# Fixed value: trials of a search.
TRIALS = 170


def sample_trials(n: int = TRIALS, seed: int = 42) -> list[dict[str, float]]:
    """Seeded random draws; the number of leaves never exceeds what the depth allows."""
    draw = random.Random(seed)
    trials = []
    for _ in range(n):
        trial: dict[str, float] = {k: draw.randint(low, high) for k, (low, high) in TREE_SEARCH_WHOLE.items()}
        trial["num_leaves"] = draw.randint(LEAVES_LOW, min(2 ** int(trial["max_depth"]), LEAVES_HIGH))
        for name, (low, high, logarithmic) in TREE_SEARCH.items():
            trial[name] = math.exp(draw.uniform(math.log(low), math.log(high))) if logarithmic else draw.uniform(low, high)
        trials.append(trial)
    return trials


# Trials that always run to their end, rounds before any trial is pruned, patience within a trial.
STARTUP_TRIALS, WARMUP_ROUNDS, TRIAL_PATIENCE = 10, 7, 50
# Ours: trials that run next to each other at most.
TRIALS_AT_ONCE = 16


@dataclass(frozen=True)
class Search:
    """``trials``: (trial, state, n_rounds, best_round, val_pr_auc, parameters); ``log``: (study, trial, step, value, complete)."""

    trials: DataFrame
    log: DataFrame


@dataclass
class _Verdicts:
    """How far trials are and what became of them.

    Verdicts are given in the order of the trials, each by the median of the
    earlier ones that completed, so they are those of trials that run one after
    the other. A trial that is ahead of the verdicts needs no further rounds
    once it would be pruned whatever becomes of the earlier ones.
    """

    n: int
    startup: int
    warmup: int
    values: list[list[float]] = field(default_factory=list)
    ended: list[bool] = field(default_factory=list)
    states: list[str] = field(default_factory=list)
    read: int = 0
    lock: threading.Lock = field(default_factory=threading.Lock)

    def __post_init__(self):
        self.values, self.ended = [[] for _ in range(self.n)], [False] * self.n

    def enough(self, trial: int, values: list[float], ended: bool) -> bool:
        """Notes the values a trial has reached; whether it needs no further rounds."""
        with self.lock:
            if trial < len(self.states):
                return True
            before = len(self.values[trial])
            self.values[trial], self.ended[trial] = values, ended
            self._settle()
            return trial < len(self.states) or ended or any(self._worse(trial, step) for step in range(before, len(values)))

    def _settle(self) -> None:
        while len(self.states) < self.n:
            trial = len(self.states)
            values = self.values[trial]
            pruned = next((step for step in range(self.read, len(values)) if self._worse(trial, step)), None)
            if pruned is not None:
                self.values[trial] = values[:pruned + 1]
            elif not self.ended[trial]:
                self.read = len(values)
                return
            self.states.append("complete" if pruned is None else "pruned")
            self.read = 0

    def _worse(self, trial: int, step: int) -> bool:
        """Whether the best value so far is below the median, with any of the earlier trials that have no verdict yet among the completed."""
        complete = [v for v, s in zip(self.values, self.states[:trial]) if s == "complete"]
        at_step = [v[step] for v in complete if step < len(v)]
        if not at_step or len(complete) < self.startup or step < self.warmup:
            return False
        best = max(self.values[trial][:step + 1])
        open_values = sorted(v[step] if step < len(v) else -math.inf for v in self.values[len(self.states):trial])
        return all(best < float(np.median(at_step + open_values[:k])) for k in range(len(open_values) + 1))


def search_trees(fitting: DataFrame, inputs: TreeInputs, trials: Sequence[Mapping[str, float]], base: TreeParams = TreeParams(),
                 validation: str = "_is_val", label: str = "isFraud", row_id: str = "TransactionID", rung: int = 4,
                 startup_trials: int = STARTUP_TRIALS, warmup_rounds: int = WARMUP_ROUNDS, width: int | None = None) -> Search:
    """Trials, each advanced ``rung`` rounds at a time or more and pruned by the median of earlier ones that completed.

    A trial goes on boosting where it stood; nothing is fitted twice. The rows
    are binned once for all trials. A trial ends pruned at the first step at
    which ``median_pruning`` over the log says so, else complete. Where one task
    can boost over the rows, ``width`` trials run next to each other (default: as
    many as there are cores, up to ``TRIALS_AT_ONCE``), else one after the other;
    trials and log do not depend on it.
    """
    known = set(TreeParams.__dataclass_fields__)
    if unknown := {k for t in trials for k in t} - known:
        raise ValueError(f"parameters that would not be applied: {sorted(unknown)}")
    spark = fitting.sparkSession
    table, edges = tree_table(fitting, inputs, base, label, row_id, validation)
    verdicts = _Verdicts(len(trials), startup_trials, warmup_rounds)
    sampled = [replace(base, **{k: type(getattr(base, k))(v) for k, v in t.items()}, patience=min(base.patience, TRIAL_PATIENCE))
                 for t in trials]

    def run(i: int) -> None:
        boosting = Boosting(table, edges, sampled[i])
        while not verdicts.enough(i, list(boosting.quality), boosting.done()):
            n = len(boosting.trees)
            more = max(rung, warmup_rounds + 1 - n, n if boosting.in_task else 0)
            boosting.advance(min(more, boosting.params.rounds - n))
        boosting.close()

    labelled = table.agg(F.sum("n")).first()[0] or 0
    small = all(one_task_holds(labelled, len(edges), p) for p in sampled)
    cores = min(spark.sparkContext.defaultParallelism, TRIALS_AT_ONCE)
    at_once(spark, run, range(len(trials)), (width or cores) if small else 1)
    table.unpersist()
    rows, log = [], []
    for i, (trial, state, values) in enumerate(zip(trials, verdicts.states, verdicts.values, strict=True)):
        log += [("trees", i, step, float(v), state == "complete") for step, v in enumerate(values)]
        best = int(np.argmax(values)) if values else -1
        rows.append((i, state, len(values), best + 1, values[best] if values else None, *[float(v) for v in trial.values()]))
    columns = ", ".join(f"{c} double" for c in trials[0])
    return Search(spark.createDataFrame(rows, f"trial int, state string, n_rounds int, best_round int, val_pr_auc double, {columns}"),
                  spark.createDataFrame(log, "study string, trial int, step int, value double, complete boolean"))


def search_latent_dim(legit_train: DataFrame, legit_val: DataFrame, width: int, dims: Sequence[int]) -> DataFrame:
    """(trial, latent_dim, val_loss): one reconstruction model per size, scored on legit validation rows."""
    rows = []
    for i, k in enumerate(dims):
        scored = fit_reconstruction(legit_train, width, k).score(legit_val)
        rows.append((i, k, scored.agg(F.avg("anomaly_score")).first()[0]))
    return legit_train.sparkSession.createDataFrame(rows, "trial int, latent_dim int, val_loss double")


def best_trial(trials: DataFrame, by: Sequence[str], metric: str, maximise: bool = True) -> DataFrame:
    """Best trial per study; the earlier trial among equals."""
    value = F.struct(F.col(metric) if maximise else -F.col(metric), -F.col("trial"))
    return trials.groupBy(*by).agg(F.max_by("trial", value).alias("trial"), F.max_by(metric, value).alias(metric))


def early_stopping(losses: DataFrame, patience: int = 5, run: str = "run", step: str = "step", loss: str = "loss",
                   hot_rows: int = HOT_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(run, n_steps, stop_step, best_loss): stop after ``patience`` consecutive losses above the best.

    Steps are consecutive. A loss equal to the best counts as an improvement.
    """
    lowest = running(losses.select(run, step, loss), [run], [step], [Running("_best", "min", F.col(loss))], hot_rows, slice_rows)
    reached = F.when(F.col(loss) == F.col("_best"), F.col(step))
    gaps = running(lowest, [run], [step], [Running("_at", "max", reached)], hot_rows, slice_rows, counted=losses)
    stop = F.col(step) - F.col("_at") >= patience
    return gaps.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_steps"), F.min(F.when(stop, F.col(step))).alias("stop_step"),
        F.coalesce(F.min_by("_best", F.when(stop, F.col(step))), F.min(loss)).alias("best_loss"))


def median_pruning(values: DataFrame, startup_trials: int = 10, warmup_steps: int = 7, maximise: bool = True,
                   study: str = "study", hot_rows: int = HOT_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Prune decisions over (study, trial, step, value, complete).

    A trial is pruned at a step when its best value so far is worse than the
    median of what completed earlier trials reported at that step; not before
    ``startup_trials`` trials have completed, nor during the warm-up steps.
    A (study, step) group has one row per trial, so it is as small as the budget.
    """
    op = "max" if maximise else "min"
    best = running(values, [study, "trial"], ["step"], [Running("best", op, F.col("value"))], hot_rows, slice_rows)
    earlier_at_step = (Window.partitionBy(study, "step").orderBy("trial")
                       .rowsBetween(Window.unboundedPreceding, -1))
    median = F.percentile(F.when(F.col("complete"), F.col("value").cast("double")), F.lit(0.5)).over(earlier_at_step)
    per_trial = values.groupBy(study, "trial").agg(F.max(F.col("complete").cast("int")).alias("_c"))
    earlier_trials = Window.partitionBy(study).orderBy("trial").rowsBetween(Window.unboundedPreceding, -1)
    done = per_trial.select(F.col(study).alias("_study"), F.col("trial").alias("_trial"),
                            F.coalesce(F.sum("_c").over(earlier_trials), F.lit(0)).alias("n_completed"))
    joined = best.withColumn("median", median).join(
        done, (F.col(study) == F.col("_study")) & (F.col("trial") == F.col("_trial")))
    worse = F.col("best") < F.col("median") if maximise else F.col("best") > F.col("median")
    ready = (F.col("n_completed") >= startup_trials) & (F.col("step") >= warmup_steps)
    return joined.select(study, "trial", "step", "best", "median", "n_completed",
                         F.coalesce(worse & ready, F.lit(False)).alias("prune"))
