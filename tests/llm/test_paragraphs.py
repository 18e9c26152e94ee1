from collections import defaultdict

import numpy as np
import pytest

from riskloom.llm import paragraphs as P

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=P.MIN_WORDS, similar=P.SIMILAR):
    lines = {}
    for k, (doc_id, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            words = tuple(line.encode().translate(LOW).split())
            if len(words) >= least:
                lines[k, doc_id, i] = words
    texts = sorted(set(lines.values()))
    sets = [frozenset(zip(*(w[i:] for i in range(P.SHINGLE)))) for w in texts]
    label = list(range(len(texts)))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in holders[g]:
                shared[j] += 1
            holders[g].append(i)
        for j, n in shared.items():
            if n >= similar * (len(s) + len(sets[j]) - n) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    number = dict(zip(texts, label))
    groups = defaultdict(list)
    for (k, doc_id, i), words in lines.items():
        groups[number[words]].append((doc_id is None, doc_id, i, len(words)))
    out = []
    for members in groups.values():
        if len(members) > 1:
            first = min(members, key=lambda m: (m[0], m[1] or 0, m[2]))
            out += [(m[1], m[2], m[3], first[1], first[2], len(members), m[1:3] != first[1:3]) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [P.BUCKET, 2])
def test_all_documents(documents, bucket):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, P.repeats(documents, bucket=bucket).collect()), key=str) == brute(rows)


def test_edited_passages_are_found(spark):
    rng = np.random.default_rng(2)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = list(passage)
        own[int(rng.integers(60))] = f"edit{i}"
        rows.append((i, f"alone {i} " + " ".join(f"x{i}y{j}" for j in range(30)) + "\n" + " ".join(own)))
    found = P.repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["paragraph"]) for r in found) == [(i, 1) for i in range(40)]
    assert sum(not r["removed"] for r in found) == 1


def test_odd_rows(odd, odd_rows):
    assert sorted(map(tuple, P.repeats(odd).collect()), key=str) == brute([r[:2] for r in odd_rows])
    out = P.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == len(odd_rows)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[9].endswith("MIT Licence!") and texts[10] == "" and texts[2] == "" and texts[3] is None


def test_empty_table(empty):
    assert P.repeats(empty).count() == 0


def test_bands_have_high_recall():
    assert P.recall() > 0.998 and P.recall(0.3) < 0.1


def test_forest_connects_what_is_similar():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 10 ** 9, 50)
    sets = [np.concatenate([base[i:], rng.integers(0, 10 ** 9, i)]) for i in range(6)] + [rng.integers(0, 10 ** 9, 20)]
    edges = P.similar_forest(sets, 0.8)
    assert {x for e in edges for x in e} == set(range(6)) and len(edges) == 5
