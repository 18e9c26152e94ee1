"""Mixing sources to target weights: whole epochs, then a weighted sample without replacement.

Targets are shares of a word budget by source weight; no source gives more than
``MAX_EPOCHS`` times its size, and what it cannot give is shared among the
others by weight (``source_targets``).

A source whose target is e times its size and a rest gives every document e
times. The rest is drawn in the order of exponential keys -ln(u) / w, where u
is a hash of the document and w its quality weight (Efraimidis and Spirakis:
the smallest keys are a weighted sample without replacement). Documents are
taken while their running total stays within the rest; those larger than half
of it wait, so that one document cannot spoil the draw. While more than
``CLOSE`` of the target is open, the prefix sum is repeated over documents that
still fit. Where none fits, the smallest document outside is taken and the
overrun given back the same way, latest keys first; that is undone if it ends
farther from the target. Every round halves what is open or uses up what fits,
so rounds grow with the logarithm of the rest. The gap that remains is closed by
at most one exchange: a document outside the draw whose size fits the gap, or
the next one in order for a drawn one whose size fits the overrun, whichever
brings the total nearest to the target.

The running total needs no task that holds a source: documents are cut into
slices of the (source, key) order by Spark's range partitioner, slice totals
carry what came before.

NULL text has size 0, a NULL source is a source of its own and comes last, a
document without weight counts as ``UNLABELLED``. Rows equal in id, source and
text share a key, but every row is drawn by itself; which of them is taken first
does not show in the result.
Empty documents are taken when their key's turn comes, which adds no words. An
empty table gives an empty mix. Other columns pass through ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.text import WORD
from riskloom.operators.ordering import Running, order_slices, sliced_running
from riskloom.session import parallelism, written

# Of sources by code point, in turn.
WEIGHTS = (5, 2, 1)
# Words of the mix per words of all documents.
BUDGET = 1.5
MAX_EPOCHS = 2
# Weights of documents that are labelled good, labelled poor, or not labelled.
GOOD, POOR, UNLABELLED = 1.0, 0.25, 0.75
SEED = 7
# Share of a target that may stay open after the draw, and rounds at most (twice the bits of a count).
CLOSE = 0.001
MAX_ROUNDS = 128
# Rows of a slice at most; smaller where that keeps all tasks busy.
SLICE_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def label_weights(labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality") -> DataFrame:
    """(_weight_id, _weight) by document, from labels 0 and 1; repeated labels count as good if all say so."""
    return (labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_weight_id"))
            .agg(F.min(label_column).alias("_least"))
            .select("_weight_id", F.when(F.col("_least") > 0, GOOD).when(F.col("_least") <= 0, POOR)
                    .otherwise(UNLABELLED).alias("_weight")))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_source, source_size, target) from one (_source, source_size) row per source.

    A source is full if its share at the final rate reaches max_epochs times
    its size. In ascending order of size per weight the full ones come first,
    so the rate follows from running sums: after the k leanest are full it is
    (budget - their caps) / weight of the others, and the first k whose
    following source is not full at that rate is the answer.
    """
    by_name = Window.orderBy(F.asc_nulls_last("_source"))  # one row per source
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    capped = weighted.withColumn("_cap", F.col("source_size") * float(max_epochs))
    lean = Window.orderBy(F.col("_cap") / F.col("_w"), F.asc_nulls_last("_source"))
    before = lean.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    running = capped.select(
        "*", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)).alias("_full"),
        (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))).alias("_open"),
        (F.sum("source_size").over(every) * float(budget)).alias("_budget"))
    rate = (F.col("_budget") - F.col("_full")) / F.col("_open")
    fits = running.withColumn("_rate", F.when(rate <= F.col("_cap") / F.col("_w"), rate))
    # Past the leanest source that is not full the rates only fall: its rate is the greatest that fits.
    final = fits.withColumn("_final", F.max("_rate").over(every))
    target = F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * F.col("_final")))
    return final.select("_source", "source_size", target.alias("target"))


def _toggled(rows: DataFrame, open_: DataFrame, halved: bool, slice_rows: int) -> DataFrame:
    """_row of the documents that a prefix sum over the fitting ones takes in, or gives back where too much is taken.

    ``open_`` has (_name, _open) per source that takes part: words still to take, or if negative to give back.
    """
    limit = F.abs(F.col("_open")) / 2 if halved else F.abs(F.col("_open"))
    found = rows.join(F.broadcast(open_), rows["_source"].eqNullSafe(open_["_name"]))  # one row per source
    fit = found.where((F.col("_in") == (F.col("_open") < 0)) & (F.col("size") <= limit)).select(
        "_row", "_source", "size", "_open", "_print", "_id", F.when(F.col("_open") > 0, F.col("_key")).otherwise(-F.col("_key")).alias("_turn"))
    fit = written(fit, "fitting")
    n = fit.count()
    within = [F.asc("_turn"), F.asc("_print"), F.asc_nulls_last("_id"), F.asc("_row")]
    per_slice = max(1, min(slice_rows, -(-n // parallelism(rows.sparkSession))))
    sliced = order_slices(fit, [F.asc_nulls_last("_source"), *within], n, slice_rows=per_slice)
    total = sliced_running(sliced, ["_source"], "_slice", within, [Running("_through", "sum", F.col("size"))])
    return total.where(F.col("_through") <= F.abs(F.col("_open"))).select(F.col("_row").alias("_moved"))


def _draw(rows: DataFrame, targets: DataFrame, slice_rows: int) -> DataFrame:
    """``rows`` with _in: whether the rest of its source takes the document."""
    state = written(rows.withColumn("_in", F.lit(False)).withColumn("_was", F.lit(False)), "draw")
    aim = targets.select(F.col("_name").alias("_s"), F.col("_rest"), (F.col("target") * CLOSE).alias("_near"))
    forced: dict = {}
    halved, finished = True, set()
    for _ in range(MAX_ROUNDS):
        # One row per source reaches the driver.
        sums = state.groupBy("_source").agg(F.coalesce(F.sum(F.when(F.col("_in"), F.col("size"))), F.lit(0)).alias("_sum"))
        left = {r["_s"]: (r["_rest"] - r["_sum"], r["_near"]) for r in
                aim.join(sums, aim["_s"].eqNullSafe(sums["_source"])).collect()}
        active = {s: o for s, (o, near) in left.items() if s not in finished and abs(o) > near}
        if not active:
            break
        moved = written(_toggled(state, _open_table(state, active), halved, slice_rows), "moved")
        if moved.isEmpty():
            if halved:
                halved = False
                continue
            # Nothing fits: take the smallest document outside, once per source, and give back what is too much.
            finished |= {s for s, o in active.items() if o < 0 or s in forced}
            again = {s: o for s, o in active.items() if s not in finished}
            if not again:
                break
            forced |= again
            table = _open_table(state, again)
            outside = (state.join(F.broadcast(table), state["_source"].eqNullSafe(table["_name"])).where(~F.col("_in") & (F.col("size") > 0))
                       .groupBy("_name").agg(F.min(F.struct("size", "_key", "_print", "_id", "_row")).alias("_least")))
            moved = written(outside.select(F.col("_least._row").alias("_moved")), "moved")
            marks = F.array(*[F.coalesce(F.lit(s), F.lit("")) for s in again])
            here = F.when(F.col("_source").isNull(), F.lit(None in again)).otherwise(F.array_contains(marks, F.col("_source")))
            state = state.withColumn("_was", F.when(here, F.col("_in")).otherwise(F.col("_was")))
            if moved.isEmpty():
                finished |= set(again)
                continue
        halved = True
        joined = state.join(moved, state["_row"] == moved["_moved"], "left")
        state = written(joined.withColumn("_in", F.col("_in") != F.col("_moved").isNotNull()).drop("_moved"), "draw")
    worse = [s for s, before in forced.items() if abs(left[s][0]) > abs(before)]
    if worse:
        marks = F.array(*[F.coalesce(F.lit(s), F.lit("")) for s in worse])
        here = F.when(F.col("_source").isNull(), F.lit(None in worse)).otherwise(F.array_contains(marks, F.col("_source")))
        state = state.withColumn("_in", F.when(here, F.col("_was")).otherwise(F.col("_in")))
    return state.drop("_was")


def _open_table(rows: DataFrame, open_: dict) -> DataFrame:
    return rows.sparkSession.createDataFrame([(s, int(o)) for s, o in open_.items()], "_name string, _open bigint")


def plan(docs: DataFrame, labels: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text",
         source_column: str = "source", weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
         max_epochs: int = MAX_EPOCHS, seed: int = SEED, slice_rows: int = SLICE_ROWS,
         label_id: str | None = None, row_column: str | None = None) -> DataFrame:
    """One row per document: _row, _id, _source, size, source_size, target, epochs, chosen, taken.

    ``label_id`` names the id column of ``labels`` where it differs from
    ``id_column``, ``row_column`` a written number of each row.
    """
    spark = docs.sparkSession
    text = F.col(text_column)
    rows = docs.select((F.col(row_column) if row_column else F.monotonically_increasing_id()).alias("_row"),
                       F.col(id_column).alias("_id"), F.col(source_column).cast("string").alias("_source"),
                       word_count(text).alias("size"), F.xxhash64(F.col(id_column), text, F.lit(seed)).alias("_print"))
    if labels is None:
        weighted = rows.withColumn("_weight", F.lit(1.0))
    else:
        by_id = label_weights(labels, label_id or id_column)
        weighted = (rows.join(by_id, rows["_id"] == by_id["_weight_id"], "left")
                    .select(*rows.columns, F.coalesce("_weight", F.lit(UNLABELLED)).alias("_weight")))
    # The upper 53 bits of the hash, never 0 or 1.
    uniform = (F.shiftrightunsigned("_print", 11).cast("double") + 0.5) / float(1 << 53)
    # Written at once: the row numbers hold from here on.
    sized = written(weighted.select("_row", "_id", "_print", "_source", "size", (-F.log(uniform) / F.col("_weight")).alias("_key")), "sized")

    # One row per source; few enough for a window over all of them.
    targets = source_targets(sized.groupBy("_source").agg(F.sum("size").alias("source_size")), weights, budget, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = written(targets.select(
        F.col("_source").alias("_name"), "source_size", "target", epochs.cast("bigint").alias("epochs"),
        F.round(F.col("target") - epochs * F.col("source_size")).cast("bigint").alias("_rest")).coalesce(1), "targets")
    drawn = _draw(sized, targets, slice_rows)
    drawn = drawn.join(F.broadcast(targets), drawn["_source"].eqNullSafe(targets["_name"])).drop("_name")
    # An empty document costs nothing; it goes where the key order would have it, at the front of what is drawn.
    drawn = drawn.withColumn("_in", F.col("_in") & (F.col("_rest") > 0))

    # Per source: the gap the draw leaves, and the edge, the first document outside it, which would overrun.
    edge = F.min(F.when(~F.col("_in") & (F.col("size") > 0), F.struct("_key", "_print", F.col("_row").alias("row"), "size")))
    ends = (drawn.groupBy(F.col("_source").alias("_name"))
            .agg((F.first("_rest") - F.coalesce(F.sum(F.when(F.col("_in"), F.col("size"))), F.lit(0))).alias("_gap"),
                 edge.alias("_edge")).where("_gap > 0").withColumn("_over", F.col("_edge.size") - F.col("_gap")))
    ends = written(ends.coalesce(1), "ends")
    # One exchange at most: a document outside that fits the gap, or the edge for a drawn one that fits the overrun.
    off = F.when(F.col("_in"), F.abs(F.col("_over") - F.col("size"))).otherwise(F.abs(F.col("_gap") - F.col("size")))
    swaps = (drawn.where("size > 0").join(F.broadcast(ends), drawn["_source"].eqNullSafe(ends["_name"]))
             .withColumn("_off", off).where(F.col("_off") < F.col("_gap")))
    best = swaps.groupBy("_name").agg(F.min(F.struct("_off", "_in", "_key", "_print", F.col("_row").alias("row"))).alias("_best"))
    moved = written(best.join(ends.select(F.col("_name").alias("_same"), "_edge"), best["_name"].eqNullSafe(F.col("_same")))
                    .select(F.col("_name"), F.col("_best.row").alias("_one"),
                            F.when(F.col("_best._in"), F.col("_edge.row")).alias("_other")).coalesce(1), "exchange")
    marked = drawn.join(F.broadcast(moved), drawn["_source"].eqNullSafe(moved["_name"]), "left")
    changes = (F.coalesce(F.col("_row") == F.col("_one"), F.lit(False)) | F.coalesce(F.col("_row") == F.col("_other"), F.lit(False)))
    done = marked.withColumn("chosen", F.col("_in") != changes)
    taken = F.col("epochs") * F.col("size") + F.when(F.col("chosen"), F.col("size")).otherwise(0)
    return done.select("_row", "_id", "_source", "size", "source_size", "target", "epochs", "chosen", taken.cast("bigint").alias("taken"))


def mix_report(docs: DataFrame, labels: DataFrame | None = None, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, size, source_size, target, taken) of every document."""
    return plan(docs, labels, id_column, **options).select(F.col("_id").alias(id_column), "size", "source_size",
                                                           "target", "taken")


def mixed(docs: DataFrame, labels: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text",
          source_column: str = "source", seed: int = SEED, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as they were."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no column of the documents can clash
    rows = written(docs.toDF(*names.values()).withColumn("_number", F.monotonically_increasing_id()), "numbered")
    planned = plan(rows, labels, names[id_column], names[text_column], names[source_column], seed=seed, label_id=id_column,
                   row_column="_number", **options)
    times = planned.select("_row", (F.col("epochs") + F.col("chosen").cast("int")).cast("int").alias("_times")).where("_times > 0")
    joined = rows.join(times, rows["_number"] == times["_row"])
    copies = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.select(*names.values()).toDF(*docs.columns)
