import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import boosted
from riskloom.llm import quality as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


def test_counts_of_all_documents(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = {r["doc_id"]: r for r in Q.judge(documents, Q.fit_quality(documents, labels)).collect()}
    for doc_id, text in documents.select("doc_id", "text").collect():
        row, counts = found[doc_id], brute(text)
        assert [row[c] for c in Q.COUNTS] == counts
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row["kept"] and row["base_failed"])


def test_held_out_accuracy(spark):
    """Trees fitted on one half of the labelled documents judge the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    trees = Q.fit_quality(docs, labels.where("doc_id % 2 = 0"))
    judged = Q.judge(docs, trees).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in judged]) > 0.95
    assert all(r["kept"] for r in judged if r["quality"] == 1)


@pytest.mark.parametrize("which", ["labels", "no_labels"])
def test_odd_rows(odd, odd_rows, which, request):
    labels = request.getfixturevalue(which)
    trees = Q.fit_quality(odd, labels)
    rows = Q.judge(odd, trees).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(brute(t)[0] for _, t, _, _ in odd_rows)
    kept = Q.keep_good(odd, trees)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in rows if r["kept"]}


def test_empty_table(empty, labels):
    trees = Q.fit_quality(empty, labels)
    assert Q.judge(empty, trees).count() == 0 and Q.keep_good(empty, trees).count() == 0


def test_sample_is_bounded_and_stable(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    one, two = (Q.fit_quality(documents.repartition(n), labels.repartition(n + 1), sample_rows=40) for n in (2, 5))
    assert np.array_equal(one.threshold, two.threshold) and np.array_equal(one.value, two.value)


def test_monotone_trees():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = (x[:, 0] - 0.6 * x[:, 1] + 0.4 * np.sin(9 * x[:, 0]) + 0.2 * rng.standard_normal(4000) > 0.3).astype(float)
    trees = boosted.fit(x, y, np.array([1, -1, 0]))
    grid = np.linspace(0, 1, 200)
    for j, sign in ((0, 1), (1, -1)):
        for base in rng.random((20, 3)):
            points = np.repeat(base[None], 200, axis=0)
            points[:, j] = grid
            assert (sign * np.diff(trees.margin(points)) >= -1e-12).all()
    assert ((trees.probability(x) > 0.5) == (y > 0.5)).mean() > 0.85


def test_repeats_at_text_edges():
    counts, _ = Q.statistics(pa.array(["a b c", "a b c", "a b c a b c", None, "a\n\na\n \na"]))
    assert counts[:, 4].tolist() == [0, 0, 6, 0, 0] and counts[:, 3].tolist() == [0, 0, 0, 0, 2]
