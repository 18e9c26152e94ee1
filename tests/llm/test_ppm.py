import math
import zlib
from collections import Counter, defaultdict

import pytest

from riskloom.llm import ppm as P

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
K = P.ORDER


class Model:
    """The same model as nested dictionaries."""

    def __init__(self, texts, learn):
        self.words, self.trie = Counter(), [defaultdict(Counter) for _ in range(K + 1)]
        for text, use in zip(texts, learn):
            if use:
                words, coded = self.coded(text)
                self.words.update(words)
                self.words["END"] += 1
                for p in range(K, len(coded)):
                    for k in range(K + 1):
                        self.trie[k][coded[p - k:p]][coded[p]] += 1
        self.known = {}

    @staticmethod
    def coded(text):
        words = (text or "").encode().translate(LOW).split()
        return words, b"\0" * K + b" ".join(words) + b"\0"

    def cost(self, context, byte):
        if (context, byte) not in self.known:
            cost, ruled = 0.0, set()
            for k in range(K, -1, -1):
                after = self.trie[k].get(context[K - k:])
                if not after:
                    continue
                left = {b: n for b, n in after.items() if b not in ruled}
                total = sum(left.values()) + len(left)
                if left and byte in left:
                    cost += math.log10(left[byte] / total)
                    break
                if left:
                    cost += math.log10(len(left) / total)
                ruled |= set(after)
            else:
                cost -= math.log10(256 - len(ruled))
            self.known[context, byte] = cost
        return self.known[context, byte]

    def row(self, text):
        words, coded = self.coded(text)
        tokens = [*words, "END"]
        total, types = sum(self.words.values()), len(self.words)
        base = sum(math.log10((self.words[t] + 0.5) / (total + 0.5 * (types + 1))) for t in tokens)
        score = sum(self.cost(coded[p - K:p], coded[p]) for p in range(K, len(coded)))
        return len(tokens), sum(self.words[t] > 0 for t in tokens), total, pytest.approx(base), pytest.approx(score)


def out_of(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def test_all_documents(documents):
    rows = sorted(map(tuple, documents.select("doc_id", "text").collect()))
    model = Model([t for _, t in rows], [not out_of(i) for i, _ in rows])
    found = {r["doc_id"]: tuple(r) for r in P.score(documents).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows[:40] + rows[-10:]:
        assert found[doc_id] == (doc_id, out_of(doc_id), *model.row(text))


def test_odd_rows_in_many_chunks(odd, odd_rows):
    model = Model([r[1] for r in odd_rows], [not out_of(r[0]) for r in odd_rows])
    found = P.score(odd, chunk_bytes=1000).collect()
    want = sorted(((r[0] or 0, *model.row(r[1])) for r in odd_rows), key=lambda r: (r[0], r[1]))
    got = sorted(((r["doc_id"] or 0, *tuple(r)[2:]) for r in found), key=lambda r: (r[0], r[1]))
    assert got == want


def test_held_out_texts_score_better_than_by_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sums = P.score(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert sums["s"] > sums["b"]


def test_nothing_learnt(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in P.score(docs, learn=F.lit(False)).collect()}
    assert found[1]["score"] == pytest.approx(-3 * math.log10(256)) and found[1]["train_tokens"] == 0
    assert found[2]["n_tokens"] == 1 and found[2]["n_known"] == 0


def test_empty_table(empty):
    assert P.score(empty).count() == 0
