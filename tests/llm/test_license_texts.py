"""Whole licenses in documents, in other wraps, under other holders and behind comment marks."""

import re
import textwrap

import duckdb
import pytest

from riskloom.llm import licenses as L
from riskloom.llm.license_texts import license_texts

TEXTS = license_texts()


def one(license, words):
    return next(t for name, t in TEXTS if name == license and words in t)


def wrapped(text, width, mark=""):
    """Every paragraph filled to a width, comment marks before each line and between paragraphs."""
    return f"\n{mark.rstrip()}\n".join(textwrap.fill(p, width, initial_indent=mark, subsequent_indent=mark) for p in re.split(r"\n\s*\n", text))


MIT = one("MIT", "Permission is hereby granted")
BSD = one("BSD-3-Clause", "2. Redistributions")
APACHE = one("Apache-2.0", "TERMS AND CONDITIONS")
HEADER = one("Apache-2.0", "you may not use this file")
PROSE = "\n\n".join(f"Some words of chapter {i} that say nothing\nabout any license." for i in range(40))
CASES = [
    (1, "Copyright (c) 2031 Some Body <a@b.c>\n\n" + wrapped(MIT, 37), [("MIT", True, 0, 1)]),
    (2, "Copyright © 1999, A. Holder\nAll rights reserved.\n\n" + wrapped(BSD, 52).upper(), [("BSD-3-Clause", True, 0, 1)]),
    (3, wrapped(APACHE, 66), [("Apache-2.0", True, 0, 1)]),
    (4, "# Copyright 2020 The Authors\n#\n" + wrapped(HEADER, 70, "# ") + "\n\nimport os\n\nprint(os.name)", [("Apache-2.0", False, 0, 1)]),
    (5, PROSE + "\n\n(c) Holder\n\n" + wrapped(MIT, 41) + "\n\n" + PROSE, [("MIT", False, 0, 1)]),
    (6, "/*\n * (c) Holder\n *\n" + wrapped(BSD, 60, " * ") + "\n */\n\nint main();\n\n" + wrapped(MIT, 80), [("BSD-3-Clause", False, 0, 1), ("MIT", False, 0, 1)]),
    (7, wrapped(BSD, 80).replace("2. Redistributions", "2. Some redistributions"), []),
    # A paragraph is missing, and two stand in another order.
    (8, MIT.replace(MIT.split("\n\n")[1] + "\n\n", ""), []),
    (9, "\n\n".join(reversed(MIT.split("\n\n"))), []),
    (10, "All of it is\nreleased under\nthe MIT licence", []),
    (11, PROSE + "\n\nReleased under\nthe MIT licence.\n\n" + PROSE + "\nReleased under the MIT license\n", [("MIT", False, 1, 1)]),
    (12, wrapped(MIT, 60) + "\n\n" + wrapped(MIT, 50), [("MIT", False, 0, 2)]),
    (13, "", []), (14, None, []), (15, "\n \n***\n", []),
    # Breaks before "copyright" and "(c)" in sentences do not make notices of them.
    (16, re.sub(r"\s+(?=copyright|\(c\))", "\n", MIT, flags=re.I), [("MIT", True, 0, 1)]),
    (17, re.sub(r"[ \n]+(?=copyright)", "\n", BSD, flags=re.I), [("BSD-3-Clause", True, 0, 1)]),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(i, t) for i, t, _ in CASES], "doc_id bigint, text string")


def test_whole_licenses_are_found(spark, cases):
    found = {}
    for row in L.find(cases, L.known_texts(spark)).orderBy("doc_id", "license").collect():
        found.setdefault(row["doc_id"], []).append(tuple(row)[1:])
    assert found == {i: want for i, _, want in CASES if want}


def test_against_sql(spark, cases):
    con = duckdb.connect()
    con.register("documents", cases.toPandas().astype({"doc_id": "int64"}))
    want = con.execute(L.find_sql()).fetchall()
    assert sorted(map(tuple, L.find(cases, L.known_texts(spark)).collect())) == sorted(want)


def test_known_texts_have_forms_of_their_own(spark):
    """No text is the form of two licenses, and every text finds itself as a whole."""
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(TEXTS)], "doc_id bigint, text string")
    found = L.find(rows, L.known_texts(spark)).where("whole_text").collect()
    assert sorted((r["doc_id"], r["license"]) for r in found) == [(i, name) for i, (name, _) in enumerate(TEXTS)]


def test_odd_rows(spark, odd, empty, odd_rows):
    twice = spark.createDataFrame([(1, MIT), (1, MIT), (1, "x\n\n" + MIT), (None, MIT), (None, "a\n\n" + MIT)], "doc_id bigint, text string")
    assert sorted(map(tuple, L.find(twice, L.known_texts(spark)).collect()), key=str) == [(1, "MIT", True, 0, 3), (None, "MIT", True, 0, 2)]
    assert [tuple(r) for r in L.find(odd, L.known_texts(spark)).collect()] == [(9, "MIT", False, 1, 0)]
    assert L.find(empty, L.known_texts(spark)).count() == 0
    assert L.find(odd, spark.createDataFrame([], "license string, text string")).count() == 0
    nulls = spark.createDataFrame([(None, "MIT text"), ("MIT", None), ("x", "")], "license string, text string")
    assert L.find(odd, nulls).count() == 0
