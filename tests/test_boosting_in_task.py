from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting, models


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


def binned(rows, params=PARAMS):
    return models.tree_table(rows, models.fit_tree_inputs(rows, ["x", "z", "noise"], []), params, "isFraud", "TransactionID", "_is_val")


def same(a, b):
    return all(np.array_equal(v, w) for t, u in zip(a, b, strict=True) for v, w in zip(vars(t).values(), vars(u).values(), strict=True))


@pytest.mark.parametrize("changed", [{}, {"bagging_freq": 0, "feature_fraction": 1.0}, {"lambda_l1": 0.0, "num_leaves": 5, "min_gain_to_split": 0.0}],
                         ids=["bag", "all rows", "few leaves"])
def test_one_task_finds_what_jobs_find(rows, changed):
    """Trees and qualities to the last digit, also when advanced in pieces, over snapshots."""
    params = replace(PARAMS, rounds=20, **changed)
    table, edges = binned(rows, params)
    jobs = boosting.Boosting(table, edges, params, task_bytes=0)
    task, pieces = boosting.Boosting(table, edges, params), boosting.Boosting(table, edges, params)
    assert task.in_task and not jobs.in_task
    jobs.advance(20)
    task.advance(20)
    for n in (3, 5, 9, 3):
        pieces.advance(n)
    assert len(jobs.trees) == 20 and max(t.depth for t in jobs.trees) > 1
    assert jobs.quality == task.quality == pieces.quality and len(set(jobs.quality)) > 10
    assert same(jobs.trees, task.trees) and same(jobs.trees, pieces.trees)


@pytest.mark.parametrize("task_bytes", [0, boosting.TASK_BYTES], ids=["jobs", "task"])
def test_patience_ends_at_its_round(rows, task_bytes):
    """Not at the end of the rounds that happened to be advanced together."""
    params = replace(PARAMS, rounds=60, patience=3, learning_rate=1.0, max_depth=3)
    fit = boosting.Boosting(*binned(rows, params), params, task_bytes=task_bytes)
    model = fit.run()
    assert len(fit.quality) == len(fit.trees) == len(model.trees) + 3 < 60 and fit.done()


def test_what_one_task_cannot_hold_goes_by_jobs():
    params = models.TreeParams()
    assert boosting.one_task_holds(5_000_000, 20, params)
    assert not boosting.one_task_holds(50_000_000, 20, params) and not boosting.one_task_holds(5_000_000, 400, params)
    assert not boosting.one_task_holds(1000, 20, replace(params, max_depth=30))
