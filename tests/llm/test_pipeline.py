import re
from collections import Counter

import numpy as np
import zlib
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm import mixing, quality
from riskloom.llm.catalog import tokenizer_path
from riskloom.session import written


def test_stages(spark, sf_dir, documents):
    """Each stage on what the one before kept, against the plain definitions."""
    from test_decontam import brute as hits
    from test_mixing import targets
    from test_simhash import classes, fingerprint
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        columns = docs.columns
        docs = written(stage(spark, docs, sf_dir), name)
        seen[name] = before, [tuple(r) for r in docs.collect()]
        if name != "token_files":
            assert docs.columns == columns and set(seen[name][1]) <= set(before)
    text = documents.columns.index("text")

    before, after = seen["quality"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(documents, quality.fit_quality(documents, labels)).collect()}
    assert sorted(after) == sorted(r for r in before if verdict[r[0]])

    before, after = seen["near_duplicates"]
    prints = {r[0]: fingerprint(r[text]) for r in before}
    named = classes(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(named[p], i)
    assert sorted(r[0] for r in after) == sorted(first.values())

    before, after = seen["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {h[0] for h in hits([(r[0], r[text]) for r in before], items) if not h[5]}
    assert sorted(r[0] for r in after) == sorted(clean)

    before, after = seen["mixing"]
    source = documents.columns.index("source")
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[text] or "")) for r in before}
    sizes = Counter()
    for r in before:
        sizes[r[source]] += size[r[0]]
    taken = Counter()
    for r in after:
        taken[r[source]] += size[r[0]]
    for s, target in targets(sizes).items():
        assert abs(taken[s] - target) <= max(size[r[0]] for r in before if r[source] == s) / 2 + 1
    assert max(Counter(r[0] for r in after).values()) <= mixing.MAX_EPOCHS

    before, after = seen["token_files"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    assert [r[0] for r in sorted(after, key=lambda r: r[1])] == sorted(r[0] for r in before)
    crc = {r[0]: zlib.crc32(np.array(tokenizer.encode(r[text], add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in before}
    assert all(crc[r[0]] == r[3] for r in after)


def test_run_and_empty_tables(spark, sf_dir, empty, tmp_path):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
