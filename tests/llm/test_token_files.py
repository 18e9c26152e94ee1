import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskloom.llm import token_files as T
from riskloom.llm.catalog import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [T.END_ID]


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(ids_of(tokenizer, text), "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_all_documents(spark, documents, tokenizer):
    rows = [tuple(r) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]
    found = sorted(map(tuple, T.encode_documents(documents, tokenizer_path()).collect()))
    assert found == expected(tokenizer, rows)


def test_odd_rows(odd, odd_rows, tokenizer):
    found = [tuple(r) for r in T.encode_documents(odd, tokenizer_path(), length=16, parts=3).collect()]
    assert len(found) == len(odd_rows)
    by_id = sorted(found, key=lambda r: r[1])
    assert [r[0] for r in by_id] == sorted((r[0] for r in odd_rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for _, begin, n, _ in by_id:
        assert begin == start
        start += n
    want = sorted((r[0] or 0, zlib.crc32(np.array(ids_of(tokenizer, r[1]), "<u4").tobytes())) for r in odd_rows)
    assert sorted((r[0] or 0, r[3]) for r in found) == want


def test_empty_table(empty):
    assert T.encode_documents(empty, tokenizer_path()).collect() == []


def test_files_hold_equal_sequences(spark, documents, tokenizer):
    manifest = T.write_sequences(documents, tokenizer_path(), length=64, parts=2).orderBy("part").collect()
    for file in manifest:
        table = T.sequences(file["path"])
        assert table.schema.field("ids").type == pa.list_(pa.field("item", pa.uint16(), False), 64)
        assert len(table) == file["sequences"] == -(-file["ids"] // 64)
        mask = table.column("mask").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        assert mask.sum() == file["ids"] and mask[:file["ids"]].all()
        assert sum(len(x) for x in table.column("doc_ids").to_pylist()) == file["documents"]


def test_words_and_whole_texts_agree(tokenizer):
    texts = ["<|endoftext|>, x<|endoftext|> <|ENDOFTEXT|>", "it's DON'T I'll. foo'. bar's,", "ΑΣ ΣΑΣ. Σ", "é İx á.",
             "ab12.,!? 3,5 x|y| <a|b|>.", "“quoted”. naïve’s…", "a\x1cb c\xa0d", "", " \n", "...", "I. I’ÉA."]
    cache = T.WordCache(tokenizer_path(), size=8)
    assert cache.by_word
    for _ in range(2):
        ids, bounds = cache.texts(pa.array([t.encode() for t in texts], pa.binary()))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(tokenizer, t)[:-1] for t in texts]
