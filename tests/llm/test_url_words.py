from riskloom.llm import catalog
from riskloom.llm import urls as U

PLANTED = {"freecasino": ["free", "casino"], "bestcasino": ["best", "casino"], "cheappills": ["cheap", "pills"],
           "adultads": ["adult", "ads"], "pokerspam": ["poker", "spam"], "casinobets": ["casino", "bets"]}


def test_concatenated_hosts_over_a_large_dictionary(spark, tmp_path, monkeypatch):
    """Words of middling counts and a large total: the product of two counts is below it."""
    html = "<p>" + "free best cheap " * 20 + " ".join(f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnp") + " the" * 50_000 + "</p>"
    rows = [(i, f"http://{name}.io/", html if i == 0 else "") for i, name in enumerate(PLANTED)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    kept, split = {}, U.split_names

    def seen(names, dictionary):
        out = split(names, dictionary)
        kept.update({r["name"]: r["words"] for r in out.collect()})
        return out

    monkeypatch.setattr(U, "split_names", seen)
    found = {r["host"]: r["verdict"] for r in catalog.QUERIES["op10_url_filter"](spark, str(tmp_path)).collect()}
    assert {n: kept[n] for n in PLANTED} == PLANTED
    assert found == {f"{n}.io": "block" for n in PLANTED}
