from collections import defaultdict

from riskloom.llm import catalog
from riskloom.llm import paragraphs
from riskloom.llm import passages as P

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def covered(rows, width=P.PASSAGE):
    """(doc, word) of every word in a window that another row has, by brute force."""
    words = [(text or "").encode().translate(LOW).split() for _, text in rows]
    held = defaultdict(set)
    for k, own in enumerate(words):
        for i in range(len(own) - width + 1):
            held[tuple(own[i:i + width])].add(k)
    out = set()
    for k, own in enumerate(words):
        for i in range(len(own) - width + 1):
            if len(held[tuple(own[i:i + width])]) > 1:
                out |= {(rows[k][0], j) for j in range(i, i + width)}
    return out


def found(rows):
    return {(r["doc_id"], j) for r in rows for j in range(r["start"], r["start"] + r["n_words"])}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def words(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_all_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = covered(rows)
    got = P.shared_passages(documents).collect()
    assert want and found(got) == want
    text = {i: (t or "").encode().translate(LOW).split() for i, t in rows}
    for r in got:
        first = text[r["component_id"]][r["component_start"]:][:P.PASSAGE]
        assert first == text[r["doc_id"]][r["start"]:][:P.PASSAGE] and r["removed"] == (r["component_id"] != r["doc_id"])


def test_other_lines_and_breaks(spark):
    """Inside longer lines, across other breaks, in short lines."""
    passage = words("p", 60)
    rows = [(1, " ".join(words("a", 90) + passage + words("b", 90))),
            (2, "\n".join([" ".join(words("c", 30)), " ".join(passage[:15]), " ".join(passage[15:] + words("d", 70))])),
            (3, "\n".join(" ".join(passage[i:i + 8]).upper() for i in range(0, 60, 8))),
            (4, " ".join(words("e", 20) + passage[:49] + words("f", 80)))]
    got = {r["doc_id"]: r for r in P.shared_passages(frame(spark, rows)).collect()}
    assert {i: (r["paragraph"], r["start"], r["n_words"]) for i, r in got.items()} == {1: (0, 90, 60), 2: (1, 30, 60), 3: (0, 0, 60)}
    assert all((r["component_id"], r["component_start"], r["n_paragraphs"]) == (1, 90, 3) for r in got.values())
    assert [got[i]["removed"] for i in (1, 2, 3)] == [False, True, True]


def test_neighbouring_passages_keep_their_own_first(spark):
    a, b = words("a", 70), words("b", 70)
    rows = [(1, " ".join(a)), (2, " ".join(a + b)), (3, " ".join(words("x", 9) + b))]
    got = {(r["doc_id"], r["start"]): (r["n_words"], r["component_id"], r["removed"]) for r in
           P.shared_passages(frame(spark, rows)).collect()}
    assert got == {(1, 0): (70, 1, False), (2, 0): (70, 1, True), (2, 70): (70, 2, False), (3, 9): (70, 2, True)}


def test_copies_null_ids_and_short_texts(spark, odd, odd_rows, empty):
    text = " ".join(words("w", 55))
    rows = [(None, text), (5, text), (5, text), (6, None), (7, ""), (8, "w1 w2")]
    got = P.shared_passages(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["component_id"], r["removed"], r["n_paragraphs"]) for r in got) == [
        (0, 55, 5, True, 3), (5, 55, 5, False, 3), (5, 55, 5, False, 3)]
    assert found(P.shared_passages(odd).collect()) == covered([r[:2] for r in odd_rows])
    assert P.repeats(empty).count() == 0


def test_query_has_passages_and_lines(spark, sf_dir, documents):
    got = catalog.QUERIES["op6_paragraphs"](spark, sf_dir).collect()
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found([r for r in got if r["kind"] == "passage"]) == covered(rows)
    assert sum(r["kind"] == "line" for r in got) == paragraphs.repeats(documents).count()


def left_over(rows, width=P.PASSAGE):
    """(id, words kept) of every row, by brute force: the first document of each window keeps it."""
    split = [(text or "").encode().translate(LOW).split() for _, text in rows]
    first = {}
    for (i, _), own in sorted(zip(rows, split), key=lambda r: (r[0][0] is None, r[0][0] or 0)):
        for k in range(len(own) - width + 1):
            first.setdefault(tuple(own[k:k + width]), i)
    out = []
    for (i, _), own in zip(rows, split):
        gone = set()
        for k in range(len(own) - width + 1):
            if i is not None and first[tuple(own[k:k + width])] != i:
                gone |= set(range(k, k + width))
        out.append((i, [w for k, w in enumerate(own) if k not in gone]))
    return sorted(out, key=str)


def kept(frame):
    return sorted(((r["doc_id"], (r["text"] or "").encode().translate(LOW).split()) for r in frame.collect()), key=str)


def test_removal_against_all_windows(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    left = P.remove_passages(documents)
    assert left.columns == documents.columns and kept(left) == left_over(rows)
    assert P.shared_passages(left).where("component_id <> doc_id").count() < P.shared_passages(documents).where("component_id <> doc_id").count()


def test_removal_leaves_other_text_alone(spark):
    passage = words("p", 60)
    rows = [(1, " ".join(passage)), (2, "Ünï  A\n\n" + "\t".join(passage).upper() + " \n B ß\n"), (2, "other\ttext  here "), (3, None), (4, ""),
            (None, " ".join(passage)), (5, " ".join(passage[:55])), (6, "x " + " ".join(passage + words("q", 70))), (7, " ".join(words("q", 70)) + "\ny")]
    got = sorted(((r["doc_id"], r["text"]) for r in P.remove_passages(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, rows[0][1]), (2, "Ünï  A\n\n \n B ß\n"), (2, "other\ttext  here "), (3, None), (4, ""), (None, rows[5][1]), (5, ""),
                          (6, "x  " + " ".join(words("q", 70))), (7, "\ny")], key=str)


def test_removal_of_odd_rows(odd, odd_rows, empty):
    left = P.remove_passages(odd)
    assert left.columns == odd.columns and left.schema["_cut"].dataType == odd.schema["_cut"].dataType
    assert kept(left) == left_over([r[:2] for r in odd_rows])
    assert P.remove_passages(empty).count() == 0
