import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import boosting, models


def test_levels_read_blocks_with_gradients(spark):
    """Rows travel in blocks, and a tree's levels read a table without the margins that earlier trees would have to be added to."""
    rows = spark.range(3000, numPartitions=2).select(
        F.col("id").alias("TransactionID"), (F.col("id") % 3 == 0).cast("int").alias("isFraud"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 11).cast("double").alias("z"), (F.col("id") % 5 == 0).alias("_is_val"))
    params = models.TreeParams(rounds=3, max_depth=3, min_data_in_leaf=5, bagging_fraction=1.0, feature_fraction=0.5)
    table, edges = models.tree_table(rows, models.fit_tree_inputs(rows, ["x", "z"], []), params, "isFraud", "TransactionID", "_is_val")
    blocks = table.select("held", "n", "n_yes").collect()
    assert len(blocks) <= 4 and sum(b["n"] for b in blocks if b["held"]) == 600 and sum(b["n_yes"] for b in blocks) == 1000
    fit = boosting.Boosting(table, edges, params)
    fit.advance(2)
    bag = fit._bag(2, [1])
    assert bag.columns == ["g", "h", "bins"]
    parts = bag.collect()
    assert sum(len(p["bins"]) for p in parts) == 2400
    margin = {r["TransactionID"]: r["m"] for r in models.predict(fit.model(), models.fit_tree_inputs(rows, ["x", "z"], []), rows.where("NOT _is_val"),
              ["TransactionID", "isFraud"], "m").collect()}
    p = np.array(list(margin.values()))
    w = np.where(np.array(list(margin)) % 3 == 0, params.scale_pos_weight, 1.0)
    expected = np.rint(p * (1 - p) * w * boosting.UNIT).sum()
    assert abs(sum(np.frombuffer(p["h"], np.int32).sum() for p in parts) - expected) <= 2400
