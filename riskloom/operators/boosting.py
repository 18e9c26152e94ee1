"""Boosted trees for a yes/no label, grown leaf by leaf from histograms that tasks build and Spark adds up.

Numbers are cut into at most 255 bins once; a missing value has a bin of its own
and every split learns which way it goes. For each level of a tree the tasks add
gradients by (node, feature, bin); the partial sums meet by feature, where the
best split of each node is chosen, and only that choice reaches the driver. Sums
are integers, so a model does not depend on how rows are dealt. The tables that
travel are bounded by leaves x features x bins, never by rows.

Rows keep their bins and margin on the executors' disks, in blocks: a row of the
binned table holds up to ``STEP_ROWS`` rows, bins column by column. Before its first
level a tree gets a table of its own, the gradients and used bins of the rows in
its bag, which all its levels read; earlier trees are followed once for it. Margins
are brought up to date every ``SNAPSHOT`` rounds and the lineage is cut by a
checkpoint every ``CHAIN`` snapshots, so a lost partition is made again from the
last checkpoint.

Quality on the validation rows, the area under the precision-recall curve, is
read off after every round, from margins rounded to 1/4096: that bounds what is
counted per round to 65,536 cells. ``Boosting`` can be advanced further as long as
its patience lasts; ``Boosted.cut`` gives the model of any earlier round.

A table that one task can hold (``one_task_holds``) is boosted within one task, which
reads the blocks and grows one tree after the other from its arrays: a round then
takes no Spark job, and folds or trials run next to each other, one per task. As
sums are integers and margins are added up in the same order, the trees and
qualities are those of the jobs, to the last digit.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import shared_dir, written


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters; defaults are the tuned ones."""

    # Fixed values.
    learning_rate: float = 0.04326812777022993
    num_leaves: int = 46
    max_depth: int = 6
    feature_fraction: float = 0.7951465798454141
    bagging_fraction: float = 0.8140068172963008
    bagging_freq: int = 2
    min_gain_to_split: float = 0.7677607867288584
    lambda_l1: float = 0.34079057646894473
    lambda_l2: float = 0.5286743981802347
    min_data_in_leaf: int = 183
    scale_pos_weight: float = 2.3042399671763754
    rounds: int = 3000
    # Rounds without a better validation quality before boosting ends.
    patience: int = 100
    # Ours.
    max_bins: int = 255
    seed: int = 42


MISSING_BIN = 255
# Least sum of second derivatives in a leaf.
LEAST_HESSIAN = 1e-3
# Gradients are summed as whole multiples of 2**-20.
UNIT = float(1 << 20)
# Margins are rounded to 1/4096 between -8 and 8 where quality is read off.
CELL, CELLS = 4096.0, 65536
SNAPSHOT, CHAIN = 16, 8
# Rows that quantiles are read from, and their columns that the driver holds at a time.
EDGE_ROWS, EDGE_COLUMNS = 200_000, 16
# Rows of a block, and bytes of its bins.
STEP_ROWS, STEP_BYTES = 16384, 1 << 20
# Sums a task holds at a time; deeper levels of wide tables take several passes.
TASK_SUMS = 1 << 24
# Bytes that a task may take for a table it boosts alone: of a row its bins, twice, and ROW_BYTES.
TASK_BYTES, ROW_BYTES = 768 << 20, 80
# Rows that it counts at a time, and (node, feature) pairs whose cuts it tries at a time.
COUNT_ROWS, SPLIT_ROWS = 1 << 16, 1 << 11


@dataclass(frozen=True)
class Walk:
    """A tree over bins: the column each node asks, and the next node by node and bin."""

    column: np.ndarray
    following: np.ndarray
    depth: int

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of a block (columns, rows)."""
        n = bins.shape[1]
        node, rows, flat, begin = np.zeros(n, np.int64), np.arange(n), bins.reshape(-1), self.column * n
        for _ in range(self.depth):
            node = self.following[(node << 8) + flat[begin[node] + rows]]
        return node


@dataclass(frozen=True)
class Tree:
    """Nodes in a row; a leaf has feature -1 and itself as both children. Values are log odds, learning rate included."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    depth: int

    def walk(self, columns: Sequence[int] | None = None) -> Walk:
        """The tree for blocks that hold the bins of ``columns`` (default: all) in this order."""
        feature, bins = np.maximum(self.feature, 0), np.arange(MISSING_BIN + 1)
        left = np.where(bins == MISSING_BIN, self.missing_left[:, None], bins <= self.bin[:, None])
        following = np.where(left, self.left[:, None], self.right[:, None])
        if columns is not None:
            place = np.zeros(max([*columns, *feature]) + 1, np.int64)
            place[list(columns)] = range(len(columns))
            feature = place[feature]
        return Walk(feature.astype(np.int64), following.astype(np.int64).ravel(), self.depth)

    def sides(self, x: np.ndarray) -> np.ndarray:
        """(rows, nodes): whether each row would go left at each node."""
        v = x[:, np.maximum(self.feature, 0)]
        return np.where(np.isnan(v), self.missing_left, v <= self.threshold)

    def of_values(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of numbers; NaN is missing."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            v = x[rows, np.maximum(self.feature[node], 0)]
            node = np.where(np.where(np.isnan(v), self.missing_left[node], v <= self.threshold[node]), self.left[node], self.right[node])
        return node


@dataclass(frozen=True)
class Boosted:
    """A fitted model over the features ``names``, in order."""

    names: tuple[str, ...]
    base: float
    trees: tuple[Tree, ...]

    def cut(self, rounds: int) -> Boosted:
        return replace(self, trees=self.trees[:rounds])

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for t in self.trees:
            total += t.value[t.of_values(x)]
        return total

    def column(self, features: Sequence[Column] | None = None) -> Column:
        """The probability, from the columns ``names`` or those given."""
        model = self

        @F.pandas_udf("double")
        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(1.0 / (1.0 + np.exp(-model.margin(_matrix(x, len(model.names))))))

        return probability(_vector(features or [F.col(f"`{n}`") for n in self.names]))

    def contributions(self, features: Sequence[Column] | None = None) -> Column:
        """Array: what each feature adds to the row's log odds (Shapley values of the tree paths), then the base."""
        model, tables = self, [_Shapley.of(t) for t in self.trees]

        @F.pandas_udf("array<double>")
        def explained(x: pd.Series) -> pd.Series:
            values = _matrix(x, len(model.names))
            out = np.zeros((len(values), len(model.names) + 1))
            out[:, -1] = model.base
            for tree, table in zip(model.trees, tables):
                table.add(tree, values, out)
            return pd.Series(list(out))

        return explained(_vector(features or [F.col(f"`{n}`") for n in self.names]))

    def importance(self) -> dict[str, float]:
        """Share of the total gain by feature."""
        total = np.zeros(len(self.names))
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(total, t.feature[inner], t.gain[inner])
        return dict(zip(self.names, (total / total.sum() if total.sum() else total).tolist()))

    def to_json(self) -> str:
        return json.dumps({"names": self.names, "base": self.base, "trees": [
            {k: (v.tolist() if isinstance(v, np.ndarray) else v) for k, v in vars(t).items()} for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        stored = json.loads(text)
        return Boosted(tuple(stored["names"]), stored["base"], tuple(
            Tree(**{k: (np.array(v) if isinstance(v, list) else v) for k, v in t.items()}) for t in stored["trees"]))


def _vector(features: Sequence[Column]) -> Column:
    return F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in features])


def _matrix(x: pd.Series, width: int) -> np.ndarray:
    return np.stack(x.to_list()).astype(float) if len(x) else np.zeros((0, width))


@dataclass(frozen=True)
class _Shapley:
    """For every leaf: the distinct features on its path and, for each subset of them a row may satisfy, their shares.

    The game of a path pays its leaf's value times, for each of its features,
    1 or 0 if the feature is known (the row satisfies the path's tests on it or
    not) and the share of training rows that do if it is unknown.
    """

    features: tuple[tuple[int, ...], ...]
    tests: tuple[tuple[tuple[tuple[int, bool], ...], ...], ...]  # per leaf and feature: (node, must go left)
    shares: tuple[np.ndarray, ...]  # per leaf: (subsets, features)
    expected: float

    @staticmethod
    def of(tree: Tree) -> _Shapley:
        paths: list[tuple[int, list[tuple[int, bool]]]] = []
        todo: list[tuple[int, list[tuple[int, bool]]]] = [(0, [])]
        while todo:
            node, path = todo.pop()
            if tree.feature[node] < 0:
                paths.append((node, path))
            else:
                todo += [(int(tree.left[node]), [*path, (node, True)]), (int(tree.right[node]), [*path, (node, False)])]
        features, tests, shares, expected = [], [], [], 0.0
        for leaf, path in paths:
            names = tuple(sorted({int(tree.feature[n]) for n, _ in path}))
            known = np.ones(len(names))
            for node, left in path:
                child = tree.left[node] if left else tree.right[node]
                known[names.index(int(tree.feature[node]))] *= tree.cover[child] / tree.cover[node]
            value = float(tree.value[leaf])
            expected += value * float(known.prod())
            m = len(names)
            table = np.zeros((1 << m, m))
            for met in range(1 << m):
                o = np.array([met >> i & 1 for i in range(m)], float)
                for i in range(m):
                    # Coefficients of t^s: all ways to have s others known, weighted by what they pay.
                    ways = np.array([1.0])
                    for j in range(m):
                        if j != i:
                            ways = np.convolve(ways, [known[j], o[j]])
                    weight = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
                    table[met, i] = value * (o[i] - known[i]) * float(np.dot(weight, ways))
            features.append(names)
            tests.append(tuple(tuple((n, left) for n, left in path if tree.feature[n] == f) for f in names))
            shares.append(table)
        return _Shapley(tuple(features), tuple(tests), tuple(shares), expected)

    def add(self, tree: Tree, x: np.ndarray, out: np.ndarray) -> None:
        side = tree.sides(x)
        out[:, -1] += self.expected
        for names, tests, table in zip(self.features, self.tests, self.shares):
            met = np.zeros(len(x), np.int64)
            for i, some in enumerate(tests):
                good = np.ones(len(x), bool)
                for node, left in some:
                    good &= side[:, node] == left
                met |= good.astype(np.int64) << i
            found = table[met]
            for i, f in enumerate(names):
                out[:, f] += found[:, i]


def fit_edges(train: DataFrame, names: Sequence[str], row_id: str, max_bins: int = 255,
              sample_rows: int = EDGE_ROWS) -> dict[str, list[float]]:
    """Bin edges per column: between all distinct values where there are at most ``max_bins``, else quantiles.

    Quantiles are those of the ``sample_rows`` rows whose ids have the least
    hashes, the same rows however they are dealt. The driver sees at most
    ``max_bins`` values of a column, and of the sample ``EDGE_COLUMNS`` columns
    at a time.
    """
    names = list(names)
    if not names:
        return {}
    rows = train.select(F.xxhash64(F.col(f"`{row_id}`")).alias("_key"), *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    rows = rows.select("_key", *[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) for c in names])
    numbers = rows.drop("_key")
    sizes = numbers.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in names]).first().asDict()
    edges: dict[str, list[float]] = {}
    few = [c for c in names if sizes[c] <= 1.2 * max_bins]
    if few:
        distinct = numbers.select(*[F.col(f"`{c}`") for c in few]).unpivot([], few, "name", "value").where(
            "value IS NOT NULL").distinct()
        small = distinct.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= max_bins).select("name")
        found: dict[str, list[float]] = {r["name"]: [] for r in small.collect()}
        for r in distinct.where(F.col("name").isin(list(found))).collect() if found else []:
            found[r["name"]].append(r["value"])
        for c, values in found.items():
            values.sort()
            edges[c] = [a + (b - a) / 2 for a, b in zip(values, values[1:])]
    many = [c for c in names if c not in edges and sizes[c]]
    if many:
        shares = np.arange(1, max_bins) / max_bins
        sample = written(rows.select("_key", *[F.col(f"`{c}`") for c in many]).orderBy("_key").limit(sample_rows), "edge_rows")
        for i in range(0, len(many), EDGE_COLUMNS):
            some = sample.select(*[F.col(f"`{c}`") for c in many[i:i + EDGE_COLUMNS]]).toPandas()
            for c in some.columns:
                values = some[c].to_numpy(float)
                values = values[~np.isnan(values)]
                edges[c] = np.unique(np.quantile(values, shares, method="inverted_cdf")).tolist() if len(values) else []
    return {c: edges.get(c, []) for c in names}


BLOCKS = "held boolean, n int, n_yes int, y binary, key binary, margin binary, bins binary"


def binned(rows: DataFrame, edges: dict[str, list[float]], label: str, row_id: str, validation: Column | None = None) -> DataFrame:
    """Blocks of the labelled rows, kept on the executors' disks. ``validation`` marks held rows, which have their own blocks."""
    cuts = [np.array(v) for v in edges.values()]
    held = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    source = rows.where(F.col(label).isNotNull()).select(
        (F.col(label) == 1).alias("y"), held.alias("held"), F.xxhash64(F.col(row_id)).alias("key"),
        _vector([F.col(f"`{c}`") for c in edges]).alias("x"))
    step = max(1, min(STEP_ROWS, STEP_BYTES // max(len(cuts), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                n = batch.num_rows
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
                bins = np.empty((len(cuts), n), np.uint8)
                for j, edge in enumerate(cuts):
                    bins[j] = np.where(np.isnan(x[:, j]), MISSING_BIN, np.searchsorted(edge, x[:, j], "left"))
                y, is_held, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "held", "key"))
                for side in (False, True):
                    own = np.flatnonzero(is_held.astype(bool) == side)
                    if len(own):
                        yield _block(side, y[own].astype(np.uint8), key[own], np.zeros(len(own)), bins[:, own])

    return source.mapInArrow(run, BLOCKS).persist(StorageLevel.DISK_ONLY)


def _block(held: bool, y: np.ndarray, key: np.ndarray, margin: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([held]), pa.array([len(y)], pa.int32()), pa.array([int(y.sum())], pa.int32()),
         *[pa.array([part.tobytes()], pa.binary()) for part in (y, key, margin, bins)]],
        names=["held", "n", "n_yes", "y", "key", "margin", "bins"])


def _blocks(batches: Iterator[pa.RecordBatch], kinds: dict[str, type], width: int) -> Iterator[tuple]:
    """Of each block ``held`` (where there is one), the arrays named in ``kinds``, and its bins (width, rows)."""
    for batch in batches:
        for i in range(batch.num_rows):
            parts = [np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()]
            bins = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(width, -1)
            yield (batch.column("held")[i].as_py() if "held" in batch.schema.names else False, *parts, bins)


BLOCK_KINDS = {"y": np.uint8, "key": np.int64, "margin": np.float64}


def _in_bag(key: np.ndarray, draw: int, seed: int, fraction: float) -> np.ndarray:
    """Rows of a bag, by a hash of their key: the same rows wherever they are."""
    if fraction >= 1:
        return np.ones(len(key), bool)
    z = key.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (draw + 1 + 1_000_003 * seed)) & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(fraction * float(1 << 63)) * 2)


@dataclass
class _Node:
    depth: int
    g: float
    h: float
    n: int
    split: tuple | None = None  # (gain, feature, bin, missing left)
    left: int = -1
    right: int = -1


def leaf_value(g, h, l1: float, l2: float):
    return -np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) / (h + l2)


def _score(g, h, l1: float, l2: float):
    return np.maximum(np.abs(g) - l1, 0.0) ** 2 / (h + l2)


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, params: TreeParams) -> tuple[np.ndarray, ...]:
    """(gain, bin, missing left, g, h, n of the left side) of each row of (rows, bins) sums; gain is minus infinity without a split."""
    whole = [part.sum(axis=1) for part in (g, h, n)]
    known = [np.cumsum(part[:, :-1], axis=1) for part in (g, h, n)]
    none = _score(whole[0], whole[1], params.lambda_l1, params.lambda_l2)
    least = max(params.min_data_in_leaf, 1)
    best = (np.full(len(g), -np.inf), np.zeros(len(g), np.int64), np.zeros(len(g), bool), np.zeros(len(g)), np.zeros(len(g)),
            np.zeros(len(g), np.int64))
    for missing_left in (False, True):
        some = np.flatnonzero(n[:, MISSING_BIN]) if missing_left else np.arange(len(g))
        gl, hl, nl = [k[some] + part[some, MISSING_BIN:] for k, part in zip(known, (g, h, n))] if missing_left else known
        gr, hr, nr = (w[some, None] - left for w, left in zip(whole, (gl, hl, nl)))
        gain = (_score(gl, hl, params.lambda_l1, params.lambda_l2) + _score(gr, hr, params.lambda_l1, params.lambda_l2)
                - none[some, None])
        good = (nl >= least) & (nr >= least) & (hl >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN)
        gain = np.where(good, gain, -np.inf)
        at = np.argmax(gain, axis=1)
        i = np.arange(len(some))
        i = i[(gain[i, at] > params.min_gain_to_split) & (gain[i, at] > best[0][some])]
        for to, found in zip(best, (gain[i, at[i]], at[i], missing_left, gl[i, at[i]], hl[i, at[i]], nl[i, at[i]])):
            to[some[i]] = found
    return best


def best_split(sums: np.ndarray, params: TreeParams) -> tuple | None:
    """(gain, bin, missing left, g, h, n of the left side) of one feature's (bins, 3) integer sums; None without a split."""
    found = best_splits(sums[None, :, 0] / UNIT, sums[None, :, 1] / UNIT, sums[None, :, 2], params)
    return _plain(found, 0)


def _plain(splits: tuple[np.ndarray, ...], i: int) -> tuple | None:
    """The split of row ``i``."""
    return tuple(part[i].item() for part in splits) if splits[0][i] > -np.inf else None


def one_task_holds(rows: int, width: int, params: TreeParams, task_bytes: int = TASK_BYTES) -> bool:
    """Whether a task can boost over ``rows`` of ``width`` features alone: by memory, and with sums that a float holds exactly."""
    return (rows * (2 * width + ROW_BYTES) <= task_bytes and width * (MISSING_BIN + 1) * 3 << max(params.max_depth, 0) <= TASK_SUMS
            and rows * max(params.scale_pos_weight, 1.0) * UNIT < 1 << 53)


def ended(quality: Sequence[float], patience: int) -> int | None:
    """The rounds after which ``patience`` rounds in a row were no better than the best before; None while it lasts."""
    best, at = -math.inf, 0
    for i, value in enumerate(quality):
        if value > best:
            best, at = value, i
        if i - at >= patience:
            return i + 1
    return None


class _Rounds:
    """How a tree grows and when boosting ends, whatever holds the rows."""

    edges: dict[str, list[float]]
    params: TreeParams
    trees: list[Tree]
    quality: list[float]
    learns: bool

    def best_round(self) -> int:
        """Number of trees with the best quality; the earliest of equals, all without validation rows."""
        return int(np.argmax(self.quality)) + 1 if self.quality else len(self.trees)

    def done(self) -> bool:
        return (len(self.trees) >= self.params.rounds or not self.learns
                or (bool(self.quality) and len(self.quality) - self.best_round() >= self.params.patience))

    def _grow(self, number: int) -> Tree:
        params, names = self.params, list(self.edges)
        draw = np.random.default_rng([params.seed, number])
        used = max(1, math.ceil(params.feature_fraction * len(names)))
        features = sorted(draw.choice(len(names), used, replace=False).tolist()) if used < len(names) else list(range(len(names)))
        nodes = [_Node(0, 0.0, 0.0, 0)]
        level = [0]
        rows = self._bag(number, features)
        for depth in range(params.max_depth):
            most = max(1, TASK_SUMS // (len(features) * (MISSING_BIN + 1) * 3))
            found: dict[int, tuple] = {}
            for begin in range(0, len(level), most):
                found |= self._splits(rows, nodes, level[begin:begin + most], features)
            following = []
            for k in level:
                if k == 0:
                    nodes[0].g, nodes[0].h, nodes[0].n = found[0][1]
                split = found[k][0]
                if split is None:
                    continue
                gain, j, at, missing_left, gl, hl, nl = split
                node = nodes[k]
                node.split, node.left, node.right = (gain, j, at, missing_left), len(nodes), len(nodes) + 1
                nodes += [_Node(depth + 1, gl, hl, nl), _Node(depth + 1, node.g - gl, node.h - hl, node.n - nl)]
                following += [node.left, node.right]
            level = following
            if not level:
                break
        self._free(rows)
        return self._finished(nodes)

    def _finished(self, nodes: list[_Node]) -> Tree:
        """The most gainful splits that ``num_leaves`` allows, taken leaf by leaf."""
        params = self.params
        kept: set[int] = set()
        heap = [(-nodes[0].split[0], 0)] if nodes[0].split else []
        while heap and len(kept) + 1 < params.num_leaves:
            _, k = heapq.heappop(heap)
            kept.add(k)
            for child in (nodes[k].left, nodes[k].right):
                if nodes[child].split:
                    heapq.heappush(heap, (-nodes[child].split[0], child))
        order = [k for k in range(len(nodes)) if k == 0 or any(k in (nodes[p].left, nodes[p].right) for p in kept)]
        place = {k: i for i, k in enumerate(order)}
        cuts = list(self.edges.values())
        rows = []
        for k in order:
            node = nodes[k]
            value = float(leaf_value(node.g, node.h, params.lambda_l1, params.lambda_l2)) * params.learning_rate
            if k in kept:
                gain, j, at, missing_left = node.split
                edge = cuts[j][at] if at < len(cuts[j]) else math.inf
                rows.append((j, at, edge, missing_left, place[node.left], place[node.right], value, node.n, gain))
            else:
                rows.append((-1, 0, 0.0, False, place[k], place[k], value, node.n, 0.0))
        columns = [np.array(c) for c in zip(*rows)]
        return Tree(*columns, depth=max([nodes[k].depth + 1 for k in kept], default=0))

    def _partial(self, nodes: list[_Node]) -> Tree:
        """The tree as grown so far, all its splits kept."""
        rows = [(n.split[1], n.split[2], 0.0, n.split[3], n.left, n.right, 0.0, 0, 0.0) if n.split
                else (-1, 0, 0.0, False, k, k, 0.0, 0, 0.0) for k, n in enumerate(nodes)]
        return Tree(*[np.array(c) for c in zip(*rows)], depth=max(n.depth for n in nodes))

@dataclass
class Boosting(_Rounds):
    """Boosting over a ``binned`` table, round by round."""

    table: DataFrame
    edges: dict[str, list[float]]
    params: TreeParams = TreeParams()
    trees: list[Tree] = field(default_factory=list)
    quality: list[float] = field(default_factory=list)
    base: float = 0.0
    task_bytes: int = TASK_BYTES

    def __post_init__(self):
        shared_dir(self.table.sparkSession)
        counts = {r["held"]: (r["n"], r["yes"]) for r in self.table.groupBy("held").agg(F.sum("n").alias("n"), F.sum("n_yes").alias("yes")).collect()}
        self.held, self.held_yes = counts.get(True, (0, 0))
        self.fit_rows, fit_yes = counts.get(False, (0, 0))
        yes, no = fit_yes * self.params.scale_pos_weight, self.fit_rows - fit_yes
        self.base = math.log(yes / no) if yes and no else 0.0
        self.learns = bool(yes and no)
        self.snapshot, self.settled, self.chain = self.table, 0, 0
        self.in_task = one_task_holds(self.fit_rows + self.held, len(self.edges), self.params, self.task_bytes)

    def model(self) -> Boosted:
        return Boosted(tuple(self.edges), self.base, tuple(self.trees))

    def best(self) -> Boosted:
        return self.model().cut(self.best_round())

    def run(self) -> Boosted:
        """Advances until the patience or the rounds are used up, and returns the best model."""
        while not self.done():
            self.advance(min(max(4 * SNAPSHOT, len(self.trees)), self.params.rounds - len(self.trees)))
        return self.best()

    def advance(self, rounds: int) -> None:
        """Adds ``rounds`` trees and notes the quality after each; fewer where the patience ends."""
        if self.in_task:
            return self._advance_in_task(rounds)
        last = len(self.trees) + rounds
        while len(self.trees) < last and not self.done():
            start = len(self.trees)
            for _ in range(min(last - start, SNAPSHOT - (start - self.settled))):
                self.trees.append(self._grow(len(self.trees)))
            if self.held:
                self.quality += self._qualities(start)
            if len(self.trees) - self.settled >= SNAPSHOT:
                self._settle()
        end = ended(self.quality, self.params.patience)
        if end is not None:
            del self.trees[end:], self.quality[end:]

    def _advance_in_task(self, rounds: int) -> None:
        if self.done():
            return
        edges, params, base, trees, quality = self.edges, self.params, self.base, list(self.trees), list(self.quality)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _InTask(edges, params, base, batches, trees, quality)
            found.advance(rounds)
            new = pickle.dumps((found.trees[len(trees):], found.quality[len(quality):]))
            yield pa.RecordBatch.from_arrays([pa.array([new], pa.binary())], names=["new"])

        new_trees, new_quality = pickle.loads(self.table.coalesce(1).mapInArrow(run, "new binary").collect()[0]["new"])
        self.trees += new_trees
        self.quality += new_quality

    def close(self) -> None:
        if self.snapshot is not self.table:
            self.snapshot.unpersist()

    def _pending(self) -> list[Tree]:
        return self.trees[self.settled:]

    def _settle(self) -> None:
        """Margins that include all trees so far."""
        pending, width, old = self._pending(), len(self.edges), self.snapshot

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walks = [t.walk() for t in pending]
            for held, y, key, margin, bins in _blocks(batches, BLOCK_KINDS, width):
                now = margin.copy()
                for t, walk in zip(pending, walks):
                    now += t.value[walk.leaves(bins)]
                yield _block(held, y, key, now, bins)

        new = old.mapInArrow(run, old.schema)
        self.chain += 1
        if self.chain % CHAIN == 0:
            new = new.checkpoint()
        else:
            new = new.persist(StorageLevel.DISK_ONLY)
            new.count()
        if old is not self.table:
            old.unpersist()
        self.snapshot, self.settled = new, len(self.trees)

    def _bag(self, number: int, features: list[int]) -> DataFrame:
        """Gradients and used bins of the rows a tree learns from, in blocks; kept from its first level on."""
        params, pending, width, base = self.params, self._pending(), len(self.edges), self.base
        draw = number // max(params.bagging_freq, 1)
        fraction = params.bagging_fraction if params.bagging_freq > 0 else 1.0
        kind = self._unit_kind()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walks = [t.walk() for t in pending]
            for _, y, key, margin, bins in _blocks(batches, BLOCK_KINDS, width):
                use = np.flatnonzero(_in_bag(key, draw, params.seed, fraction))
                if not len(use):
                    continue
                bins, y, margin = np.take(bins, use, axis=1), y[use].astype(float), margin[use] + base
                for t, walk in zip(pending, walks):
                    margin = margin + t.value[walk.leaves(bins)]
                p = 1.0 / (1.0 + np.exp(-margin))
                w = np.where(y > 0, params.scale_pos_weight, 1.0)
                g, h = np.rint((p - y) * w * UNIT), np.rint(p * (1 - p) * w * UNIT)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.tobytes()], pa.binary()) for part in (g.astype(kind), h.astype(kind), bins[features])],
                    names=["g", "h", "bins"])

        return self.snapshot.where("NOT held").mapInArrow(run, "g binary, h binary, bins binary").persist(StorageLevel.DISK_ONLY)

    def _free(self, rows: DataFrame) -> None:
        rows.unpersist()

    def _unit_kind(self) -> type:
        """Holds the whole units of one row's gradient."""
        return np.int32 if max(self.params.scale_pos_weight, 1.0) * UNIT < 1 << 30 else np.int64

    def _splits(self, rows: DataFrame, nodes: list[_Node], level: list[int], features: list[int]) -> dict[int, tuple]:
        """{node: (best split or None, sums of the node)} for the nodes of one level."""
        params, kind = self.params, self._unit_kind()
        walk = self._partial(nodes).walk(features)
        slots = np.full(len(nodes), -1)
        slots[level] = range(len(level))
        size = (MISSING_BIN + 1) * len(level)

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(features), 3, size), np.int64)
            for _, g, h, bins in _blocks(batches, {"g": kind, "h": kind}, len(features)):
                slot = slots[walk.leaves(bins)]
                here = np.flatnonzero(slot >= 0)
                if not len(here):
                    continue
                if len(here) < len(slot):
                    bins, g, h, slot = np.take(bins, here, axis=1), g[here], h[here], slot[here]
                first, g, h = slot * (MISSING_BIN + 1), g.astype(float), h.astype(float)
                for i in range(len(features)):
                    cell = first + bins[i]
                    sums[i, 0] += np.bincount(cell, g, size).astype(np.int64)
                    sums[i, 1] += np.bincount(cell, h, size).astype(np.int64)
                    sums[i, 2] += np.bincount(cell, minlength=size)
            if sums[0, 2].any():
                yield pa.RecordBatch.from_arrays([pa.array(features, pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())],
                                                 names=["feature", "sums"])

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for j, raw in zip(batch.column("feature").to_pylist(), batch.column("sums").to_pylist()):
                    part = np.frombuffer(raw, np.int64)
                    total[j] = total[j] + part if j in total else part
            rows = []
            for j, flat in total.items():
                sums = flat.reshape(3, len(level), MISSING_BIN + 1)
                splits = best_splits(sums[0] / UNIT, sums[1] / UNIT, sums[2], params)
                for i, k in enumerate(level):
                    g, h, n = sums[:, i].sum(axis=1).tolist()
                    rows.append((k, j, g, h, n, *(_plain(splits, i) or (None,) * 6)))
            if rows:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=NAMES), schema=SPLITS, preserve_index=False)

        sums = rows.mapInArrow(gather, "feature int, sums binary")
        found_rows = sums.repartition("feature").mapInArrow(
            choose, "node int, feature int, g bigint, h bigint, n bigint, gain double, at int, missing_left boolean, gl double, "
                    "hl double, nl bigint").collect()
        found: dict[int, tuple] = {k: (None, (0.0, 0.0, 0)) for k in level}
        for r in sorted(found_rows, key=lambda r: (r["node"], r["feature"])):
            best = found[r["node"]][0]
            if r["gain"] is not None and (best is None or r["gain"] > best[0]):
                best = (r["gain"], r["feature"], r["at"], r["missing_left"], r["gl"], r["hl"], r["nl"])
            found[r["node"]] = (best, (r["g"] / UNIT, r["h"] / UNIT, r["n"]))
        return found

    def _qualities(self, start: int) -> list[float]:
        """Validation quality after each round from ``start`` on, in one pass over the held rows."""
        pending, width, base, before = self._pending(), len(self.edges), self.base, start - self.settled

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((len(pending) - before, CELLS, 2), np.int32)
            walks = [t.walk() for t in pending]
            for _, y, _, margin, bins in _blocks(batches, BLOCK_KINDS, width):
                now, y = margin + base, y.astype(np.int64)
                for i, (t, walk) in enumerate(zip(pending, walks)):
                    now = now + t.value[walk.leaves(bins)]
                    if i >= before:
                        cell = np.clip(np.rint(now * CELL) + CELLS // 2, 0, CELLS - 1).astype(np.int64)
                        np.add.at(counts[i - before], (cell, y), 1)
            at, cell = np.nonzero(counts.any(axis=2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(counts[at, cell, 0].astype(np.int64)),
                 pa.array(counts[at, cell, 1].astype(np.int64))], names=["at", "cell", "no", "yes"])

        cells = self.snapshot.where("held").mapInArrow(run, "at int, cell int, no bigint, yes bigint")
        found = cells.groupBy("at", "cell").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toPandas()
        found = found.sort_values(["at", "cell"], ascending=[True, False])
        by_round = dict(list(found.groupby("at")))
        return [average_precision_of(by_round[i]["yes"].to_numpy(), by_round[i]["no"].to_numpy()) if i in by_round else 0.0
                for i in range(len(pending) - before)]


class _Side:
    """The rows of a table that are fitted on, or those that are held, as arrays; ``score`` is the log odds so far."""

    def __init__(self, parts: list[tuple], width: int, base: float):
        y, key, margin, bins = (list(part) for part in zip(*parts)) if parts else ([], [], [], [])
        self.y, self.key = np.concatenate([np.zeros(0, np.uint8), *y]), np.concatenate([np.zeros(0, np.int64), *key])
        self.margin = np.concatenate([np.zeros(0), *margin])
        self.bins = np.concatenate([np.zeros((width, 0), np.uint8), *bins], axis=1)
        self.base, self.score = base, self.margin + base

    def add(self, tree: Tree, number: int) -> None:
        """Adds round ``number``; margins are settled when ``Boosting`` settles them, so that sums round alike."""
        walk = tree.walk()
        for begin in range(0, len(self.y), STEP_ROWS):
            rows = slice(begin, begin + STEP_ROWS)
            value = tree.value[walk.leaves(np.ascontiguousarray(self.bins[:, rows]))]
            self.margin[rows] += value
            self.score[rows] += value
        if (number + 1) % SNAPSHOT == 0:
            self.score = self.margin + self.base


@dataclass
class _Bag:
    """Gradients, used bins and present node of the rows a tree learns from, and the sums of the last level's nodes."""

    g: np.ndarray
    h: np.ndarray
    bins: np.ndarray
    node: np.ndarray
    sums: dict[int, np.ndarray]


class _InTask(_Rounds):
    """Boosting over the arrays of a table, within one task."""

    learns = True

    def __init__(self, edges: dict[str, list[float]], params: TreeParams, base: float, batches: Iterator[pa.RecordBatch],
                 trees: Sequence[Tree], quality: Sequence[float]):
        self.edges, self.params, self.trees, self.quality = edges, params, list(trees), list(quality)
        parts: dict[bool, list[tuple]] = {False: [], True: []}
        for held, *arrays in _blocks(batches, BLOCK_KINDS, len(edges)):
            parts[held].append(tuple(arrays))
        self.fit, self.held = (_Side(parts.pop(held), len(edges), base) for held in (False, True))
        for number, tree in enumerate(self.trees):
            self.fit.add(tree, number)
            self.held.add(tree, number)

    def advance(self, rounds: int) -> None:
        last = len(self.trees) + rounds
        while len(self.trees) < last and not self.done():
            tree, number = self._grow(len(self.trees)), len(self.trees)
            self.trees.append(tree)
            self.fit.add(tree, number)
            if len(self.held.y):
                self.held.add(tree, number)
                self.quality.append(self._quality())

    def _quality(self) -> float:
        cell = np.clip(np.rint(self.held.score * CELL) + CELLS // 2, 0, CELLS - 1).astype(np.int64)
        counts = np.bincount(2 * cell + self.held.y, minlength=2 * CELLS).reshape(CELLS, 2)
        used = np.flatnonzero(counts.any(axis=1))[::-1]
        return average_precision_of(counts[used, 1], counts[used, 0])

    def _bag(self, number: int, features: list[int]) -> _Bag:
        params, fit = self.params, self.fit
        fraction = params.bagging_fraction if params.bagging_freq > 0 else 1.0
        use = np.flatnonzero(_in_bag(fit.key, number // max(params.bagging_freq, 1), params.seed, fraction))
        y, p = fit.y[use], 1.0 / (1.0 + np.exp(-fit.score[use]))
        w = np.where(y > 0, params.scale_pos_weight, 1.0)
        bins = np.empty((len(features), len(use)), np.uint8)
        for i, j in enumerate(features):
            np.take(fit.bins[j], use, out=bins[i])
        return _Bag(np.rint((p - y) * w * UNIT), np.rint(p * (1 - p) * w * UNIT), bins, np.zeros(len(use), np.int64), {})

    def _free(self, rows: _Bag) -> None:
        pass

    def _splits(self, rows: _Bag, nodes: list[_Node], level: list[int], features: list[int]) -> dict[int, tuple]:
        """As ``Boosting._splits``. Of two siblings the smaller is counted; the other has what is left of their parent."""
        counted, others = level, []
        if rows.sums:
            walk = self._partial(nodes).walk(features)
            parents = {node.left: k for k, node in enumerate(nodes) if node.split}
            pairs = [(k, nodes[parents[k]].right, parents[k]) for k in level if k in parents]
            pairs = [(a, b, p) if nodes[a].n <= nodes[b].n else (b, a, p) for a, b, p in pairs]
            counted, others = [a for a, _, _ in pairs], pairs
        slots = np.full(len(nodes), -1)
        slots[counted] = range(len(counted))
        size = (MISSING_BIN + 1) * len(counted)
        sums = np.zeros((len(features), 3, size))
        for begin in range(0, len(rows.node), COUNT_ROWS):
            part = slice(begin, begin + COUNT_ROWS)
            bins, g, h, node = rows.bins[:, part], rows.g[part], rows.h[part], rows.node[part]
            if rows.sums:
                # One step down from the node each row was in.
                asked, at = walk.column[node], np.arange(len(node))
                node = rows.node[part] = walk.following[(node << 8) + bins[asked, at]]
            slot = slots[node]
            here = np.flatnonzero(slot >= 0)
            if len(here) < len(slot):
                bins, g, h, slot = np.take(bins, here, axis=1), g[here], h[here], slot[here]
            first = slot * (MISSING_BIN + 1)
            for i in range(len(features)):
                cell = first + bins[i]
                sums[i, 0] += np.bincount(cell, g, size)
                sums[i, 1] += np.bincount(cell, h, size)
                sums[i, 2] += np.bincount(cell, minlength=size)
        own = dict(zip(counted, sums.reshape(len(features), 3, len(counted), MISSING_BIN + 1).transpose(2, 0, 1, 3)))
        for a, b, parent in others:
            own[b] = rows.sums[parent] - own[a]
        rows.sums = own
        found: dict[int, tuple] = {}
        most = max(1, SPLIT_ROWS // len(features))
        for some in (level[begin:begin + most] for begin in range(0, len(level), most)):
            g, h, n = np.stack([own[k] for k in some]).reshape(-1, 3, MISSING_BIN + 1).transpose(1, 0, 2)
            splits = best_splits(g / UNIT, h / UNIT, n, self.params)
            first = np.argmax(splits[0].reshape(len(some), -1), axis=1)
            for i, (k, j) in enumerate(zip(some, first.tolist())):
                split = _plain(splits, i * len(features) + j)
                best = split and (split[0], features[j], *split[1:])
                g, h, n = own[k][0].sum(axis=1).tolist()
                found[k] = (best, (g / UNIT, h / UNIT, int(n)))
        return found


NAMES = ["node", "feature", "g", "h", "n", "gain", "at", "missing_left", "gl", "hl", "nl"]
SPLITS = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("g", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
                    ("gain", pa.float64()), ("at", pa.int32()), ("missing_left", pa.bool_()), ("gl", pa.float64()),
                    ("hl", pa.float64()), ("nl", pa.int64())])


def average_precision_of(yes: np.ndarray, no: np.ndarray) -> float:
    """Area under the precision-recall steps of counts in descending order of score; 0 without a yes."""
    total = yes.sum()
    if not total:
        return 0.0
    hits, seen = np.cumsum(yes), np.cumsum(yes + no)
    return float((yes * hits / seen).sum() / total)
