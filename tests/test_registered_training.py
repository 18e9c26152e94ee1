from riskloom.catalog import QUERIES
from riskloom.operators import models


def test_gbt_train_is_whole(spark, sf_dir):
    """Up to 3000 rounds, ended by 100 in a row without a better one."""
    rows = QUERIES["gbt_train"](spark, sf_dir).orderBy("round").collect()
    best = [r["round"] for r in rows if r["best"]]
    assert [r["round"] for r in rows] == list(range(1, len(rows) + 1)) and len(best) == 1
    assert len(rows) == min(best[0] + 100, 3000)


def test_cross_val_is_whole(spark, sf_dir, monkeypatch):
    """Up to 500 rounds in each fold, ended by 30 in a row without a better one."""
    fits = []

    class Kept(models.Boosting):
        def close(self):
            fits.append(self)
            super().close()

    monkeypatch.setattr(models, "Boosting", Kept)
    rows = QUERIES["cross_val"](spark, sf_dir).orderBy("fold").collect()
    assert [r["fold"] for r in rows] == list(range(5)) and len(fits) == 5
    assert all(len(f.trees) == min(f.best_round() + 30, 500) for f in fits)
    assert sorted(r["best_round"] for r in rows) == sorted(f.best_round() for f in fits)


def test_folds_next_to_each_other_are_those_in_a_row(spark, sf_dir, monkeypatch):
    """By a job per level and one after the other, as tables go that no task can hold."""
    class ByJobs(models.Boosting):
        def __post_init__(self):
            super().__post_init__()
            self.in_task = False

    monkeypatch.setattr(models, "Boosting", ByJobs)
    monkeypatch.setattr(models, "one_task_holds", lambda *_: False)
    monkeypatch.setattr(models, "FOLD_PATIENCE", 2)
    slow = [tuple(r) for r in QUERIES["cross_val"](spark, sf_dir).orderBy("fold").collect()]
    monkeypatch.undo()
    monkeypatch.setattr(models, "FOLD_PATIENCE", 2)
    fast = [tuple(r) for r in QUERIES["cross_val"](spark, sf_dir).orderBy("fold").collect()]
    assert slow == fast and len(fast) == 5
