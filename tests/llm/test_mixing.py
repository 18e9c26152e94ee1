import re
from collections import defaultdict

import pytest

from riskloom.llm import mixing as M


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    """Fill the sources that overrun, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = budget * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        share = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and share[s] > most * sizes[s]}
        if not over:
            return share
        full |= over


def by_source(rows):
    out = defaultdict(int)
    for _, text, _, source in rows:
        out[source] += words(text)
    return out


def test_targets_and_takings(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = documents.select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    sizes = by_source(rows)
    want = targets(sizes)
    source = {r[0]: r[3] for r in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    found = M.mix_report(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(largest[s] / 2, 1)
    again = M.mix_report(docs.repartition(5), labels.repartition(3), slice_rows=17).collect()
    assert sorted(found) == sorted(again)


def test_whole_epochs_come_first(spark, documents):
    rows = M.plan(documents).collect()
    for r in rows:
        assert r["taken"] == (r["epochs"] + r["chosen"]) * r["size"]
        assert r["epochs"] == int(r["target"] // r["source_size"])


def test_weights_decide_who_is_drawn(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "s") for i in range(4000)], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id bigint, quality int")
    drawn = M.plan(docs, labels, budget=0.25).where("chosen").collect()
    good = sum(r["_id"] % 2 for r in drawn)
    # Weights 1 and 0.25: of a quarter of the rows, between two and four times as many are good.
    assert len(drawn) == 1000 and 2.5 < good / (1000 - good) < 4.5


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("budget", [0.79, 0.24, 0.5])
def test_one_huge_document(spark, budget, seed):
    """A hundred documents of 1,000 words and one of 100,000: targets that a choice of them meets are met."""
    docs = spark.createDataFrame([(i, "w " * (100_000 if i == 40 else 1000), "s") for i in range(101)], "doc_id bigint, text string, source string")
    rows = M.mix_report(docs, budget=budget, seed=seed).collect()
    assert abs(sum(r["taken"] for r in rows) - 200_000 * budget) <= 500


def test_sizes_of_all_magnitudes(spark):
    rows = [(i, "w " * (1 << i % 15), "ab"[i % 2]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for seed in range(3):
        taken, target = defaultdict(int), {}
        for r in M.mix_report(docs, seed=seed, budget=0.7).collect():
            taken[rows[r["doc_id"]][2]] += r["taken"]
            target[rows[r["doc_id"]][2]] = r["target"]
        assert all(abs(taken[s] - target[s]) <= max(1, 0.001 * target[s]) for s in target)


def test_mix_equals_report_with_repeated_rows_and_shared_ids(spark):
    rows = [(i % 40, "w " * (i % 40 % 7 + 3), "ab"[i % 3 == 0]) for i in range(160)] + [(5, "w " * 8, "a")] * 9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    planned, mixed = M.mix_report(docs).collect(), by_source([(r[0], r[1], None, r[2]) for r in M.mixed(docs).collect()])
    assert sum(mixed.values()) == sum(r["taken"] for r in planned)
    want = {r["source_size"]: r["target"] for r in planned}
    sizes = by_source([(i, t, None, s) for i, t, s in rows])
    for s in sizes:
        assert abs(mixed[s] - want[sizes[s]]) <= 5


def test_mix_repeats_documents(spark, documents):
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in M.mix_report(documents).collect() if r["size"]}
    mixed = M.mixed(documents)
    assert mixed.columns == documents.columns
    times = defaultdict(int)
    for r in mixed.select("doc_id").collect():
        times[r[0]] += 1
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in times.items() if k in taken}


def test_odd_rows(odd, odd_rows, labels):
    sizes = by_source(odd_rows)
    want = targets(sizes)
    rows = M.mix_report(odd, labels).collect()
    assert sorted(r["size"] for r in rows) == sorted(words(r[1]) for r in odd_rows)
    assert sorted({r["target"] for r in rows}) == pytest.approx(sorted(set(want.values())))
    mixed = M.mixed(odd, labels)
    assert mixed.columns == odd.columns
    assert sum(words(r["text"]) for r in mixed.collect()) == pytest.approx(sum(r["taken"] for r in rows))


def test_empty_table(empty, no_labels):
    assert M.mix_report(empty, no_labels).count() == 0 and M.mixed(empty).count() == 0
