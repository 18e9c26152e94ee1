import random

import pytest
from pyspark.sql import functions as F

from riskloom.catalog.inputs import SPEC
from riskloom.operators.behaviour import amount_ratio, behaviour
from riskloom.streaming import ordered
from riskloom.streaming.runs import read_stream, run_available
from tests.test_streaming import SCHEMA, arriving, state_store  # noqa: F401


@pytest.mark.parametrize("buckets", [1, 7])
def test_users_of_one_bucket_with_many_devices(spark, tmp_path, state_store, buckets):  # noqa: F811
    """Many users share a bucket, one has more devices than its history holds itself; missing users, too."""
    draw = random.Random(9)
    rows = [(i, draw.choice(["big", "big", None, *[f"u{k}" for k in range(9)]]), draw.randrange(20_000), draw.choice([None, 1.25, 3.5]),
             draw.choice([None, 1.0, 2.0]), f"d{draw.randrange(90)}", "m") for i in range(700)]
    order = sorted(rows, key=lambda r: r[2] + draw.randrange(1000))
    stream = arriving(spark, str(tmp_path / "in"), [order[i * 140:(i + 1) * 140] for i in range(5)])
    streamed = run_available(ordered.ordered_features(stream, SPEC, "1000 seconds", buckets=buckets), "ordered")
    passed = max(r[2] for r in rows) - 1000
    assert len({r[5] for r in rows if r[1] == "big"}) > ordered.INLINE
    batch = amount_ratio(behaviour(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC).where(F.col("TransactionDT") <= passed)
    assert sorted(repr(tuple(r)) for r in streamed.collect()) == sorted(repr(tuple(r)) for r in batch.select(*streamed.columns).collect())
