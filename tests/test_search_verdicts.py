from dataclasses import replace

import numpy as np
import pytest

from riskloom.catalog import QUERIES
from riskloom.operators import models


@pytest.fixture(scope="module")
def rows(spark):
    """Two inputs that tell a little, one with gaps, and noise; every fifth row is held."""
    draw = np.random.default_rng(8)
    n = 4000
    x, z, noise = draw.normal(size=n), draw.integers(0, 9, n).astype(float), draw.normal(size=n)
    y = draw.random(n) < 1 / (1 + np.exp(2 - x - 0.4 * z * (x > 0)))
    found = [(i, int(y[i]), float(x[i]), None if i % 3 == 0 else float(z[i]), float(noise[i]), i % 5 == 0) for i in range(n)]
    return spark.createDataFrame(found, "TransactionID bigint, isFraud int, x double, z double, noise double, _is_val boolean").repartition(3).cache()


PARAMS = models.TreeParams(rounds=40, patience=40, max_depth=4, min_data_in_leaf=20, learning_rate=0.2)


def trials_of(found):
    return [tuple(r) for r in found.trials.orderBy("trial").collect()], [tuple(r) for r in found.log.orderBy("trial", "step").collect()]


def test_trials_next_to_each_other_end_as_one_after_the_other(rows):
    inputs = models.fit_tree_inputs(rows, ["x", "z", "noise"], [])
    trials = [{**t, "min_data_in_leaf": 20 + 60 * (i % 4)} for i, t in enumerate(models.sample_trials(10))]
    found = [trials_of(models.search_trees(rows, inputs, trials, replace(PARAMS, rounds=12), rung=rung, startup_trials=2, warmup_rounds=2, width=width))
             for rung, width in ((1, 1), (4, 4), (3, 10))]
    assert found[0] == found[1] == found[2]
    states = [r[1] for r in found[0][0]]
    assert "pruned" in states and "complete" in states


def test_verdicts_in_any_order():
    """Trials that advance in any order and by any number of rounds get the verdicts of trials in a row."""
    draw = np.random.default_rng(2)
    for _ in range(30):
        curves = [np.round(np.cumsum(draw.random(draw.integers(4, 12))) * draw.random(), 2).tolist() for _ in range(12)]
        ordered, n_complete = [], []
        for c in curves:
            stop = next((s for s in range(2, len(c)) if len(n_complete) >= 3 and (m := [v[s] for v in n_complete if s < len(v)])
                         and max(c[:s + 1]) < float(np.median(m))), None)
            ordered.append(c if stop is None else c[:stop + 1])
            n_complete += [c] if stop is None else []
        verdicts, at = models._Verdicts(12, 3, 2), {i: 0 for i in range(12)}
        while at:
            i = int(draw.choice(sorted(at)[:5]))
            at[i] = min(at[i] + int(draw.integers(1, 4)), len(curves[i]))
            if verdicts.enough(i, curves[i][:at[i]], at[i] == len(curves[i])):
                del at[i]
        assert verdicts.values == ordered
        assert verdicts.states == ["complete" if len(a) == len(b) and any(a is c for c in n_complete) else "pruned" for a, b in zip(curves, ordered)]


def test_registered_search_is_whole(spark, sf_dir):
    """170 trials; the first ten run to their patience of 50 rounds, none is pruned before its eighth round."""
    rows = QUERIES["hpo_search"](spark, sf_dir).orderBy("trial").collect()
    assert [r["trial"] for r in rows] == list(range(170)) and len({r["learning_rate"] for r in rows}) == 170
    complete = [r for r in rows if r["state"] == "complete"]
    assert all(r["n_rounds"] == min(r["best_round"] + 50, 3000) for r in complete) and all(r["state"] == "complete" for r in rows[:10])
    assert all(r["n_rounds"] >= 8 for r in rows)
