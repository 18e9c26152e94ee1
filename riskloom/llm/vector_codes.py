"""Product codes of vectors, with adaptive distance bounds that spare most of the work.

Components become integers ``floor(scale * x)``, vectors are cut into equal
consecutive parts, and each part position has a small codebook that a few rounds
of assignment and averaging improve. All distances are exact integers, so the
result does not depend on how rows are dealt.

After the first round every part keeps, as Drake and Hamerly describe: an upper
bound of the distance to its entry, its ``b`` closest other entries in the order
of their lower bounds, and one outer bound for all the rest. When entries move,
bounds move by as much. A part whose upper bound is below all of its lower bounds
keeps its entry unseen; otherwise just the entries whose bounds it reaches are
measured, in integers, and only if it reaches the outer bound all of them. ``b``
is chosen per round and position from the counts of bounds reached, so that
checking bounds and measuring entries cost least together. Bounds are kept in 32
bits and rounded away from certainty.

Bounds persist on the executors' disks between rounds, beside the integer
vectors. A round only maps partitions, with the codebooks as constants, so a
partition of a lost executor is made again from its own part of the source; no
shuffle stands between. The driver sees sums per entry, never rows.

Dropped: NULL vectors, vectors with NULL or non-finite components, and vectors
whose length is not that of the first one kept. Codebooks start as the rows with
the smallest ids, equal ids in the order of their vectors, NULL ids last; fewer
rows give fewer entries. Rows with equal or NULL ids are coded each. The length
must be a multiple of the parts, and components must be below 2^30 / ``scale``
in size; both raise ValueError. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from riskloom.session import written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Integers below this keep sums of squares of a part within 64 bits.
LARGEST = 1 << 30
# Rows a task works on at a time.
STEP_ROWS = 8192
# What looking at one more kept bound costs, measured in distances to an entry.
BOUND_COST = 0.25
# Relative slack of distances, far above the rounding of square roots and sums.
SLACK = 1e-6
NOBODY = 255


@dataclass(frozen=True)
class Books:
    """Entries (parts, entries, width) of one round, how far each moved since the last, and bounds to keep per part."""

    entries: np.ndarray
    moved: np.ndarray
    keep: tuple[int, ...]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


@dataclass
class State:
    """Bounds of n parts at one position: entry, upper bound, closest others with lower bounds, outer bound last."""

    entry: np.ndarray  # (n,) uint8
    upper: np.ndarray  # (n,) float64
    others: np.ndarray  # (n, b) uint8, NOBODY where none is known
    lower: np.ndarray  # (n, b + 1) float64


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (n, k) of integer rows to integer entries."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        d = x[:, i, None] - entries[None, :, i]
        out += d * d
    return out


def nearest(x: np.ndarray, entries: np.ndarray, keep: int) -> State:
    """A fresh state: all distances measured, ties to the lower index."""
    square = distances(x, entries)
    entry = np.argmin(square, axis=1)
    rows = np.arange(len(x))
    root = np.sqrt(square.astype(np.float64))
    upper = root[rows, entry] * (1 + SLACK)
    root *= 1 - SLACK
    root[rows, entry] = np.inf
    order = np.argsort(root, axis=1, kind="stable")[:, :keep + 1]
    lower = np.take_along_axis(root, order, axis=1)
    if lower.shape[1] < keep + 1:  # fewer entries than bounds
        pad = keep + 1 - lower.shape[1]
        lower = np.pad(lower, ((0, 0), (0, pad)), constant_values=np.inf)
        order = np.pad(order, ((0, 0), (0, pad)), constant_values=NOBODY)
    others = np.where(np.isinf(lower[:, :keep]), NOBODY, order[:, :keep])
    return State(entry.astype(np.uint8), upper, others.astype(np.uint8), lower)


def advance(state: State, x: np.ndarray, entries: np.ndarray, moved: np.ndarray, keep: int) -> tuple[State, np.ndarray]:
    """(state after the entries moved, bounds reached per row). Only uncertain rows are measured."""
    k, b = len(entries), state.others.shape[1]
    reach = np.append(moved, np.zeros(NOBODY + 1 - k))
    reach[NOBODY] = moved.max()
    upper = (state.upper + moved[state.entry]) * (1 + SLACK)
    lower = state.lower.copy()
    lower[:, :b] -= reach[state.others]
    lower[:, b] -= moved.max()
    lower *= np.where(lower > 0, 1 - SLACK, 1 + SLACK)
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]  # each bound holds for all entries behind it too
    entry, others = state.entry.copy(), state.others.copy()
    doubtful = np.flatnonzero(lower[:, 0] <= upper)
    if len(doubtful):  # the distance to the own entry first
        own = x[doubtful] - entries[entry[doubtful]]
        upper[doubtful] = np.sqrt((own * own).sum(axis=1).astype(np.float64)) * (1 + SLACK)
    reached = np.zeros(len(x), np.uint8)
    reached[doubtful] = (lower[doubtful] <= upper[doubtful, None]).sum(axis=1)
    some = np.flatnonzero((reached > 0) & (reached <= b))
    if len(some):
        names = np.concatenate([entry[some, None], others[some]], axis=1)
        known = names != NOBODY
        measured = known & (np.arange(b + 1) <= reached[some, None])
        square = np.full(names.shape, np.iinfo(np.int64).max)
        row, column = np.nonzero(measured)
        d = x[some[row]] - entries[names[row, column]]
        square[row, column] = (d * d).sum(axis=1)
        best = np.lexsort((names, square), axis=1)[:, 0]
        at = np.arange(len(some))
        root = np.where(measured, np.sqrt(square.astype(np.float64)) * (1 - SLACK),
                        np.concatenate([np.zeros((len(some), 1)), lower[some, :b]], axis=1))
        root[~known] = np.inf
        upper[some] = np.sqrt(square[at, best].astype(np.float64)) * (1 + SLACK)
        entry[some] = names[at, best]
        root[at, best] = -1.0  # sorts first and is cut off
        order = np.argsort(root, axis=1, kind="stable")[:, 1:]
        others[some] = np.take_along_axis(names, order, axis=1)
        lower[some, :b] = np.take_along_axis(root, order, axis=1)
    lower, others = _resize(lower, others, keep)
    whole = np.flatnonzero(reached > b)
    if len(whole):
        fresh = nearest(x[whole], entries, keep)
        entry[whole], upper[whole], others[whole], lower[whole] = fresh.entry, fresh.upper, fresh.others, fresh.lower
    return State(entry, upper, others, lower), reached


def _resize(lower: np.ndarray, others: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Room for ``keep`` bounds: the outer bound takes in those that go, or stands for those not known yet."""
    b = others.shape[1]
    if keep < b:
        outer = lower[:, keep:].min(axis=1, keepdims=True)
        return np.concatenate([lower[:, :keep], outer], axis=1), others[:, :keep]
    if keep > b:
        more = keep - b
        return (np.concatenate([lower, np.repeat(lower[:, b:], more, axis=1)], axis=1),
                np.concatenate([others, np.full((len(others), more), NOBODY, np.uint8)], axis=1))
    return lower, others


def packed(states: list[State]) -> np.ndarray:
    """A row of bytes per vector; bounds lose precision only towards less certainty."""
    parts = []
    for s in states:
        up = np.nextafter(s.upper.astype("<f4"), np.float32(np.inf))
        low = np.nextafter(s.lower.astype("<f4"), np.float32(-np.inf))
        parts += [s.entry[:, None], s.others, np.ascontiguousarray(up[:, None]).view(np.uint8),
                  np.ascontiguousarray(low.astype("<f4")).view(np.uint8)]
    return np.concatenate(parts, axis=1)


def unpacked(raw: np.ndarray, keep: tuple[int, ...]) -> list[State]:
    states, at = [], 0
    for b in keep:
        entry, others = raw[:, at], raw[:, at + 1:at + 1 + b]
        at += 1 + b
        bounds = np.ascontiguousarray(raw[:, at:at + 4 * (b + 2)]).view("<f4").astype(np.float64)
        at += 4 * (b + 2)
        states.append(State(entry, bounds[:, 0], others, bounds[:, 1:]))
    return states


def _fixed(column: pa.Array, rows: int, dtype: str) -> np.ndarray:
    """A binary column of equally long values as a matrix."""
    if not rows:
        return np.zeros((0, 0), dtype)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + rows + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(rows, -1).view(dtype)


def _binary(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))]).cast(pa.binary())


def integers(table: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int) -> DataFrame:
    """(vec_id, label, x: integer components) of the vectors without NULLs and infinities."""
    wide = table.select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"),
                        F.col(vector_column).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return wide.where(F.col("v").isNotNull() & (F.size("v") > 0) & sound).select(
        "vec_id", "label", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"))


class Coder:
    """Codebooks of one run and the passes over the rows."""

    def __init__(self, rows: DataFrame, dimension: int, parts: int):
        self.parts, self.width = parts, dimension // parts
        names = rows.schema
        self.schema = StructType([StructField("vec_id", names["vec_id"].dataType), StructField("label", names["label"].dataType),
                                  StructField("x", BinaryType()), StructField("bounds", BinaryType()),
                                  StructField("reached", BinaryType())])

    def first(self, rows: DataFrame, books: Books) -> DataFrame:
        """Integer vectors as bytes, each with a fresh state."""
        parts, width = self.parts, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for begin in range(0, whole.num_rows, STEP_ROWS):
                    batch = whole.slice(begin, STEP_ROWS)
                    n = batch.num_rows
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, parts, width)
                    if n and (x.max() >= LARGEST or x.min() <= -LARGEST):
                        raise ValueError("components are too large for exact 64-bit distances")
                    states = [nearest(x[:, p], books.entries[p], books.keep[p]) for p in range(parts)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id"), batch.column("label"), _binary(x.astype("<i4").reshape(n, -1).view(np.uint8)),
                         _binary(packed(states)), _binary(np.zeros((n, parts), np.uint8))],
                        names=["vec_id", "label", "x", "bounds", "reached"])

        return rows.mapInArrow(run, self.schema)

    def next(self, state: DataFrame, before: tuple[int, ...], books: Books) -> DataFrame:
        """The state after the entries have moved to ``books``."""
        parts, width = self.parts, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for begin in range(0, whole.num_rows, STEP_ROWS):
                    batch = whole.slice(begin, STEP_ROWS)
                    n = batch.num_rows
                    x = _fixed(batch.column("x"), n, "<i4").astype(np.int64).reshape(n, parts, width)
                    old = unpacked(_fixed(batch.column("bounds"), n, "u1"), before)
                    done = [advance(s, x[:, p], books.entries[p], books.moved[p], books.keep[p]) for p, s in enumerate(old)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id"), batch.column("label"), batch.column("x"),
                         _binary(packed([s for s, _ in done])), _binary(np.stack([r for _, r in done], axis=1))],
                        names=["vec_id", "label", "x", "bounds", "reached"])

        return state.mapInArrow(run, self.schema)

    def sums(self, state: DataFrame, keep: tuple[int, ...], entries: int) -> tuple[np.ndarray, list, np.ndarray]:
        """(members, sums of components, rows per number of bounds reached) by position and entry."""
        parts, width = self.parts, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for begin in range(0, whole.num_rows, STEP_ROWS):
                    batch = whole.slice(begin, STEP_ROWS)
                    n = batch.num_rows
                    x = _fixed(batch.column("x"), n, "<i4").astype(np.int64).reshape(n, parts, width)
                    states = unpacked(_fixed(batch.column("bounds"), n, "u1"), keep)
                    reached = _fixed(batch.column("reached"), n, "u1")
                    out: tuple = ([], [], [], [])
                    for p, s in enumerate(states):
                        total = np.zeros((entries, width), np.int64)
                        np.add.at(total, s.entry, x[:, p])
                        for kind, counts in ((0, np.bincount(s.entry, minlength=entries)), (1, np.bincount(reached[:, p]))):
                            for slot in np.flatnonzero(counts).tolist():
                                for column, value in zip(out, (2 * p + kind, slot, int(counts[slot]),
                                                               [] if kind else total[slot].tolist())):
                                    column.append(value)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                         pa.array(out[3], pa.list_(pa.int64()))], names=["place", "slot", "members", "total"])

        found = state.select("x", "bounds", "reached").mapInArrow(run, "place int, slot int, members bigint, total array<bigint>")
        cells = found.groupBy("place", "slot").agg(
            F.sum("members").alias("members"),
            *[F.sum(F.get("total", F.lit(i)).cast("decimal(20,0)")).alias(f"t{i}") for i in range(width)]).collect()
        members = np.zeros((parts, entries), np.int64)
        total = [[[0] * width for _ in range(entries)] for _ in range(parts)]
        reached = np.zeros((parts, entries + 2), np.int64)
        for r in cells:
            if r["place"] % 2:
                reached[r["place"] // 2, r["slot"]] = r["members"]
            else:
                members[r["place"] // 2, r["slot"]] = r["members"]
                total[r["place"] // 2][r["slot"]] = [int(r[f"t{i}"]) for i in range(width)]
        return members, total, reached

    def coded(self, state: DataFrame, keep: tuple[int, ...], books: Books) -> DataFrame:
        """(vec_id, label, code, error) from the last state."""
        parts, width = self.parts, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digits = np.array([f"{i:02x}" for i in range(256)])
            for whole in batches:
                for begin in range(0, whole.num_rows, STEP_ROWS):
                    batch = whole.slice(begin, STEP_ROWS)
                    n = batch.num_rows
                    x = _fixed(batch.column("x"), n, "<i4").astype(np.int64).reshape(n, parts, width)
                    entry = np.stack([s.entry for s in unpacked(_fixed(batch.column("bounds"), n, "u1"), keep)], axis=1)
                    d = x - books.entries[np.arange(parts), entry]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id"), batch.column("label"), pa.array(["".join(r) for r in digits[entry].tolist()], pa.string()),
                         pa.array((d * d).sum(axis=(1, 2)))], names=["vec_id", "label", "code", "error"])

        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        return state.select("vec_id", "label", "x", "bounds").mapInArrow(
            run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def bounds_to_keep(reached: np.ndarray, entries: int, before: int) -> int:
    """The number of bounds that would have made the last round cheapest; twice as many if too many rows fell through."""
    most = max(1, entries - 2)
    rows, places = reached.sum(), np.arange(len(reached))

    def cost(b: int) -> float:
        return b * BOUND_COST * rows + float((reached * np.where(places <= b, places, entries)).sum())

    best = min(range(1, min(before, most) + 1), key=lambda b: (cost(b), b))
    if best == before and reached[before + 1:].sum() * entries > before * BOUND_COST * rows:
        return min(most, 2 * before)
    return best


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
             log: list | None = None) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of every sound vector. ``log`` takes (bounds kept, reached) by round."""
    rows = integers(table, id_column, vector_column, label_column, scale)
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    if not seeds:
        none = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint, codebooks_sha256 string"
        return table.sparkSession.createDataFrame([], none)
    dimension = len(seeds[0]["x"])
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("x") == dimension)
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    first = np.array([r["x"] for r in seeds], object)
    if max(abs(v) for v in first.ravel().tolist()) >= LARGEST:
        raise ValueError("components are too large for exact 64-bit distances")
    first = first.astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    k = len(seeds)
    coder = Coder(rows, dimension, parts)
    books = Books(first, np.zeros((parts, k)), (max(1, k // 4),) * parts)
    old, state = None, coder.first(rows, books).persist(StorageLevel.DISK_ONLY)
    for _ in range(rounds):
        members, total, reached = coder.sums(state, books.keep, k)
        if old is not None:
            old.unpersist()
        if log is not None:
            log.append((books.keep, reached))
        moved_to = books.entries.copy()
        for p in range(parts):
            for e in np.flatnonzero(members[p]).tolist():
                moved_to[p, e] = [t // int(members[p, e]) for t in total[p][e]]
        step = np.sqrt(((moved_to - books.entries).astype(np.float64) ** 2).sum(axis=2)) * (1 + SLACK)
        keep = books.keep
        if old is not None:  # the first assignment measured everything
            keep = tuple(bounds_to_keep(reached[p], k, b) for p, b in enumerate(books.keep))
        following = Books(moved_to, step, keep)
        old, state = state, coder.next(state, books.keep, following).persist(StorageLevel.DISK_ONLY)
        books = following
    result = written(coder.coded(state, books.keep, books), "codes")
    for frame in (old, state):
        if frame is not None:
            frame.unpersist()
    return result.withColumn("codebooks_sha256", F.lit(books.digest()))


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with the errors of equal labels, NULLs together, summed as label_error."""
    # Written first: its size is known to the join, which may then broadcast it or split a hot label.
    sums = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors").withColumnRenamed("label", "_l")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_l")), "left").select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by plain assignment, all distances measured in every round."""
    steps = [f"""kept AS MATERIALIZED (
        SELECT vec_id, label, [CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    cut AS MATERIALIZED (
        SELECT vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
    book0 AS MATERIALIZED (
        SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < {entries})"""]
    distance = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(c.x, b.x)])"
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
        SELECT vec_id, label, p, x, CAST(d[1] AS BIGINT) AS d, CAST(d[2] AS BIGINT) AS e FROM (
            SELECT c.vec_id, c.label, c.p, any_value(c.x) AS x, min([CAST({distance} AS BIGINT), b.e]) AS d
            FROM cut c JOIN book{r} b ON b.p = c.p GROUP BY c.vec_id, c.label, c.p))""")
        if r < rounds:
            steps.append(f"""mean{r} AS (
        SELECT p, e, list(m ORDER BY i) AS x FROM (
            SELECT p, e, i, CAST((sum(x[i]) - (sum(x[i]) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
            FROM near{r}, range(1, 1 + (SELECT min(len(x)) FROM cut)) t(i) GROUP BY p, e, i) GROUP BY p, e),
    book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e)""")
    return "WITH " + ",\n    ".join(steps) + f""",
    coded AS (SELECT vec_id, label, string_agg(lpad(format('{{:x}}', e), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
              FROM near{rounds} GROUP BY vec_id, label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256 FROM coded"""
