import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from riskloom.llm import simhash as S
from riskloom.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def classes(nodes, near):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(sorted(nodes), 2):
        if near(a, b):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def links_of(spark, bits, **options):
    rows = spark.createDataFrame([(int(np.uint64(b).view(np.int64)),) for b in bits], "bits bigint")
    found = components(S.links(rows, **options))
    named = {r["node"]: r["component"] for r in found.collect()}
    out = {}
    for b in bits:
        signed = int(np.uint64(b).view(np.int64))
        out.setdefault(named.get(signed, signed), set()).add(b)
    return sorted(map(sorted, out.values()))


def near_cloud(n, seed):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < n:
        bits = rng.choice(centers)
        for _ in range(rng.randrange(9)):
            bits ^= 1 << rng.randrange(64)
        out.add(bits)
    return sorted(out)


@pytest.mark.parametrize("bucket", [4096, 4])
def test_links_against_all_pairs(spark, bucket):
    bits = near_cloud(500, 5)
    named = classes(bits, lambda a, b: (a ^ b).bit_count() <= S.RADIUS)
    want = {}
    for b, c in named.items():
        want.setdefault(c, set()).add(b)
    assert links_of(spark, bits, bucket=bucket) == sorted(map(sorted, want.values()))


def test_keys_meet_within_the_radius():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for blocks in S.BLOCKS:
        other = bits.copy()
        for i in range(len(other)):
            for b in rng.choice(64, 3, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(b)
        same = S.distance_keys(bits, blocks) == S.distance_keys(other, blocks)
        assert same.any(axis=1).all()


def test_distances_determine_small_blocks():
    """With 16 blocks a key fixes 52 bits, which bounds its bucket."""
    nibbles = np.arange(16, dtype=np.uint64)
    for k in range(16):
        table = S.distances(nibbles << np.uint64(4 * k), 16)[:, k]
        assert len({tuple(c) for c in table.T}) == 16


def test_fingerprints_of_all_documents(documents):
    found = {r[0]: r[1] for r in S.fingerprints(documents).collect()}
    for doc_id, text in documents.select("doc_id", "text").collect():
        assert found[doc_id] & (1 << 64) - 1 == fingerprint(text)


def test_odd_rows(odd, odd_rows):
    prints = {r[:2]: fingerprint(r[1]) for r in odd_rows}
    named = classes(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (doc_id, _), p in prints.items():
        if doc_id is not None:
            least[named[p]] = min(least.get(named[p], doc_id), doc_id)
    got = sorted(map(tuple, S.near_duplicates(odd).collect()), key=str)
    assert got == sorted(((r[0], f"{prints[r[:2]]:016x}", least.get(named[prints[r[:2]]])) for r in odd_rows), key=str)
    kept = S.keep_first(odd)
    assert kept.columns == odd.columns
    # Texts without words share fingerprint zero; rows without id stay.
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(
        r[0] or 0 for r in odd_rows if r[0] is None or least[named[prints[r[:2]]]] == r[0])


def test_empty_table(empty):
    assert S.near_duplicates(empty).count() == 0 and S.keep_first(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5), (101, 100)]
    random.Random(3).shuffle(edges)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
