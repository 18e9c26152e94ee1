import hashlib
import re

import pytest

from riskloom.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = words_of(text)
        if w:
            k = min(width, len(w))
            for i in range(len(w) - k + 1):
                windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                names = windows.get(tuple(w[i:i + k]))
                if names:
                    hit.update(range(i, i + k))
                    found |= {n for n in names if n is not None}
        ids = sorted(map(str, found))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


EXTRA = [(901, "the"), (902, "That it."), (903, ""), (904, None), (905, "... ?"), (901, "The"), (None, "lazy dog. The quick"),
         (906, "Ünïcode wörds ß")]


@pytest.mark.parametrize("block_words", [10 ** 6, 300])
def test_report(spark, sf_dir, documents, block_words):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bench = bench.union(spark.createDataFrame(EXTRA, bench.schema))
    want = brute([tuple(r) for r in documents.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()])
    got = D.report(documents, bench, block_words=block_words).collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_odd_rows(spark, odd, odd_rows):
    bench = spark.createDataFrame(EXTRA, "item_id bigint, text string")
    want = brute([r[:2] for r in odd_rows], EXTRA)
    assert sorted(map(tuple, D.report(odd, bench).collect()), key=key) == sorted(want, key=key)
    kept = D.remove_documents(odd, bench)
    assert kept.columns == odd.columns and kept.count() == sum(not r[5] for r in want)


def test_long_items_are_cut_with_overlap(spark, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT_WORDS", 7)
    long = " ".join(f"w{i}" for i in range(100))
    bench = spark.createDataFrame([(1, long)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 13))) for i in range(88)], "doc_id bigint, text string")
    assert {r["n_hit"] for r in D.report(docs, bench).collect()} == {13}


def test_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in D.report(odd, none).collect()} == {0}
    assert D.report(empty, none).count() == 0


def test_remove_spans(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}! after é"), (2, "clean text"), (3, None)], "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in D.remove_spans(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string")).collect()}
    assert out == {1: "Before, ! after é", 2: "clean text", 3: None}
