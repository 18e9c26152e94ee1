import pytest

from riskloom.llm import licenses as L
from riskloom.llm import rollups as R
from riskloom.session import scratch_path


def forms(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in frame.orderBy("i").select(L.canonical(frame["text"])).collect()]


def test_equivalent_texts_have_one_form(spark):
    one, *others = forms(spark, [
        "Released under the MIT License.", "RELEASED  under the “MIT” Licence!", "Copyright (c) 2020 A. B.\nReleased under\nthe MIT license",
        "  © 2021 C\n(c) D\nReleased — under the MIT License"])
    assert set(others) == {one} == {"released under the mit license"}

    assert forms(spark, ["sub-license", "licences licences", "", "...", None, "éa"]) == [
        "sublicense", "licenses licenses", "", "", None, "éa"]


def test_scan_of_odd_rows(spark, odd, empty):
    known = L.notices(spark)
    assert [tuple(r) for r in L.scan(odd, known).collect()] == [(9, "MIT", False, 1)]
    whole = spark.createDataFrame([(1, "Released under the MIT License."), (1, "Released under the MIT License."),
                                   (None, "x\nLicensed under CC BY 4.0")], "doc_id bigint, text string")
    assert sorted(map(tuple, L.scan(whole, known).collect()), key=str) == [(1, "MIT", True, 2), (None, "CC-BY-4.0", False, 1)]
    assert L.scan(empty, known).count() == 0
    assert L.scan(odd, spark.createDataFrame([], "license string, text string")).count() == 0


CHANGES = "source string, lang string, tokenizer_version string, old_tokens bigint, new_tokens bigint, change_no bigint"


def test_batches_are_committed_once(spark):
    store = scratch_path(spark, "rollups-test")

    def batch(*rows):
        return spark.createDataFrame(list(rows), CHANGES)

    assert R.totals(spark, store).count() == 0
    first = batch(("a", "en", "1", None, 10, 1), ("a", "en", "1", None, 5, 2), (None, None, "1", None, 7, 3), ("b", "en", "1", None, None, 4))
    assert R.commit(store, "1", first) and not R.commit(store, "1", first)
    assert R.commit(store, "2", batch(("a", "en", "1", 10, 12, 5), ("a", "en", "1", 5, None, 6)))
    want = {("a", "en", "1", 1, 12), (None, None, "1", 1, 7)}
    assert set(map(tuple, R.totals(spark, store).collect())) == want
    R.compact(spark, store)
    assert set(map(tuple, R.totals(spark, store).collect())) == want
    assert not R.commit(store, "2", first)
    assert R.commit(store, "3", batch(("a", "en", "1", 12, None, 7)))
    assert R.commit(store, "4", batch())
    assert set(map(tuple, R.totals(spark, store).collect())) == {(None, None, "1", 1, 7)}
    R.compact(spark, store)
    assert R.batches(spark, store) == ["1", "2", "3", "4"]
    assert set(map(tuple, R.totals(spark, store).collect())) == {(None, None, "1", 1, 7)}


def test_a_half_written_batch_does_not_count(spark):
    store = scratch_path(spark, "rollups-test")
    rows = spark.createDataFrame([("a", "en", "1", None, 10, 1)], CHANGES)
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store}/batches/1")
    assert R.totals(spark, store).count() == 0
    assert R.commit(store, "1", rows)
    assert [tuple(r) for r in R.totals(spark, store).collect()] == [("a", "en", "1", 1, 10)]


def test_a_batch_committed_while_folding(spark, monkeypatch):
    """Between the listing and the totals of ``compact`` another writer commits."""
    store = scratch_path(spark, "rollups-test")
    rows = [spark.createDataFrame([("a", "en", "1", None, n, 1)], CHANGES) for n in (10, 5)]
    R.commit(store, "1", rows[0])
    whole = R.totals

    def later(*args, **options):
        R.commit(store, "2", rows[1])
        return whole(*args, **options)

    monkeypatch.setattr(R, "totals", later)
    R.compact(spark, store)
    monkeypatch.undo()
    assert [tuple(r) for r in R.totals(spark, store).collect()] == [("a", "en", "1", 2, 15)]
    R.compact(spark, store)
    assert [tuple(r) for r in R.totals(spark, store).collect()] == [("a", "en", "1", 2, 15)]


def test_commits_without_sparks_markers(spark):
    store, name = scratch_path(spark, "rollups-test"), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(name, "false")
    try:
        assert R.commit(store, "1", spark.createDataFrame([("a", "en", "1", None, 10, 1)], CHANGES))
        assert [tuple(r) for r in R.totals(spark, store).collect()] == [("a", "en", "1", 1, 10)]
    finally:
        hadoop.unset(name)


def test_distinct_changes(spark):
    rows = spark.createDataFrame([("a", "en", "1", None, 10, 1)] * 3, CHANGES)
    assert R.deltas(R.distinct_changes(rows)).first()["tokens"] == 10 and R.deltas(rows).first()["tokens"] == 30


@pytest.mark.parametrize("name", ["op5_token_rollups", "op7_licenses"])
def test_empty_documents(spark, empty, name, tmp_path):
    from riskloom.llm import catalog
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.QUERIES[name](spark, str(tmp_path)).count() == 0
