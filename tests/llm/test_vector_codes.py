"""Vector codes against plain assignment, which measures all distances in every round."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import vector_codes as V
from riskloom.llm.catalog import QUERIES


def plain(rows, parts=8, entries=16, rounds=6):
    """{(vec_id, code, error, label_error, digest)}, sorted, of rows (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * c) for c in v], lab) for i, v, lab in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[r[1][p * width:(p + 1) * width] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(p, c[p])[1], []).append(c[p])
            for k, some in groups.items():
                books[p][k] = [sum(column) // len(some) for column in zip(*some)]
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(kept, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], digest)
                   for r, f, e in zip(kept, found, error)), key=str)


def result(frame):
    return sorted((tuple(r) for r in V.with_label_errors(frame).collect()), key=str)


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed, n, dimension=16, grid=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = rng.choice([-1, 0, 1])
        v = [float(np.float32(rng.gauss(centre, .3) if grid is None else rng.choice(grid))) for _ in range(dimension)]
        rows.append((i * 3 % 1009, v, rng.choice([1, 2, None])))
    return rows


@pytest.mark.parametrize("rows", [vectors(1, 400), vectors(2, 300, 8, [0.0, 1 / 4096, 2 / 4096]), vectors(3, 500, 24, [-.5, 0.0, .5]),
                                  vectors(4, 5), vectors(5, 1), vectors(6, 17)],
                         ids=["gauss", "ties", "grid", "few", "one", "17"])
def test_equals_plain_assignment(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(V.compress(frame)) == plain(rows)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = sorted((tuple(r) for r in QUERIES["op11_vector_codes"](spark, path).collect()), key=str)
    assert found == plain(rows)


def test_damaged_rows(spark):
    good = vectors(7, 40, 8)
    bad = [(None, None, 1), (900, None, None), (901, [1.0, None] + [0.0] * 6, 1), (902, [float("nan")] + [0.0] * 7, 1),
           (903, [float("inf")] * 8, 1), (904, [-float("inf")] * 8, 2), (905, [], 1), (906, [1.0] * 16, 1)]
    rows = good + bad + good[:9] + [(None, good[0][1], None), (None, good[3][1], 5)]
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(0).alias(n) for n in ("x", "v", "bounds", "error", "_l")])
    assert result(V.compress(frame)) == plain(rows)


def test_empty_and_refused(spark):
    assert V.with_label_errors(V.compress(spark.createDataFrame([], SCHEMA))).collect() == []
    assert V.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1.0] * 9, 1)], SCHEMA))
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1e9] * 8, 1)], SCHEMA))


def test_bounds_spare_measuring(spark):
    """On clustered vectors most parts keep their entry by their bounds alone, and b moves."""
    log = []
    rows = vectors(8, 3000, 16)
    V.compress(spark.createDataFrame(rows, SCHEMA), log=log).count()
    first, last = log[1][1], log[-1][1]
    assert log[0][1][:, 0].sum() == 8 * 3000  # nothing to check yet
    assert last[:, 0].sum() > .4 * last.sum() and last[:, 0].sum() > first[:, 0].sum()
    assert len({keep for keep, _ in log}) > 1


def test_states_hold_the_truth():
    """After any movement, upper bounds are above and lower bounds below the exact distances."""
    rng = np.random.default_rng(3)
    x = rng.integers(-4000, 4000, (500, 4))
    entries = rng.integers(-4000, 4000, (9, 4))
    state, keep = V.nearest(x, entries, 2), 2
    for wanted in (3, 1, 4, 2, 7, 2):
        step = rng.integers(-150, 150, entries.shape)
        entries = entries + step
        moved = np.sqrt((step.astype(float) ** 2).sum(axis=1)) * (1 + V.SLACK)
        state, _ = V.advance(state, x, entries, moved, wanted)
        keep = wanted
        square = V.distances(x, entries)
        assert (state.entry == square.argmin(axis=1)).all()
        true = np.sqrt(square)
        assert (true[np.arange(500), state.entry] <= state.upper).all()
        listed = np.zeros((500, 256), bool)
        listed[np.arange(500), state.entry] = True
        for i in range(keep):
            known = state.others[:, i] != V.NOBODY
            assert (true[known, state.others[known, i]] >= state.lower[known, i]).all()
            listed[np.arange(500)[known], state.others[known, i]] = True
        for i in range(500):
            rest = true[i][~listed[i, :9]]
            assert not len(rest) or rest.min() >= state.lower[i, -1]
        state = V.unpacked(V.packed([state]), (keep,))[0]
