import math
import re
from collections import Counter, defaultdict

import pytest

from riskloom.llm import urls as U

RULES = [(v, r.partition("/")[0], "/" + r.partition("/")[2], r) for v, r in U.RULES]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def ruled(host, path):
    fits = [(len(r), v, r) for v, h, p, r in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def names(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return [re.sub("[0-9]", "0", n) for n in re.findall("[a-z\x80-\U0010ffff]+|[0-9]+", lowered)]


def brute(rows):
    urls = [parts(u) for _, u, _ in rows]
    tags = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)>|<!--.*?-->|<[^>]*>", re.S | re.I)
    counts = Counter()
    for _, _, html in rows:
        text = tags.sub(b" ", (html or "").encode())
        counts.update(w.decode() for w in re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower()).split()
                      if len(w.decode()) <= U.MAX_WORD)
    hosts, paths = {h for h, _ in urls}, {p for _, p in urls}
    for t in U.BLOCK_TERMS:
        counts[t] += U.TERM_COUNT
    total = math.log(sum(counts.values()))

    def words(text):
        out = []
        for n in names(text):
            found = {(i, j): math.log(counts[n[i:j]]) - total for i in range(len(n)) for j in range(i + 1, len(n) + 1)
                     if n[i:j] in counts and j - i <= U.MAX_WORD}
            out += U.best_split(n, found, total)
        return out

    bag = {t: words(t) for t in hosts | paths}
    seen, classes = {True: Counter(), False: Counter()}, Counter()
    for h, p in urls:
        block = any(w in U.BLOCK_TERMS for w in bag[h])
        classes[block] += 1
        seen[block].update(bag[h])
        seen[block].update(bag[p])
    v = len(set(seen[True]) | set(seen[False]))
    b, a = sum(seen[True].values()) + v, sum(seen[False].values()) + v
    out = {}
    for (page, _, _), (h, p) in zip(rows, urls):
        score = math.log((classes[True] + 1) / (classes[False] + 1)) + sum(
            math.log((seen[True][w] + 1) / (b + 1e-9)) - math.log((seen[False][w] + 1) / (a + 1e-9)) for w in bag[h] + bag[p])
        verdict, rule = ruled(h, p)
        out[page] = (h, p, rule, verdict or ("block" if score > 0 else "allow"), pytest.approx(score, abs=1e-6))
    return out


def test_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: tuple(r)[1:] for r in U.judge(pages).collect()}
    assert found == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_odd_urls(spark):
    rows = [(1, None, None), (2, "no scheme", "<p>casino</p>"), (3, "http://A.Example.NET/en/x?y", ""),
            (4, "http://x.net", "<p>cheap pills</p>"), (5, "http://x.net/", None), (6, "ftp://b.org/fr/?q://z", ""),
            (7, "http://notexample.com/de/", ""), (8, "http://example.com/de/1#a", ""), (9, "http://cheappills.io/a", ""),
            (10, "http://buy-pills.io/a", ""), (10, "http://buy-pills.io/a", ""), (11, "http://" + "a" * 300 + ".io/" + "b" * 300, ""),
            (12, "://", ""), (14, "http://münchenürlaub9.de/2024/x", "<p>ürlaub münchen x</p>"), (13, "http://h\n.net/x\ny", "")]
    pages = spark.createDataFrame([(*r, 0, 0) for r in rows], "page_id bigint, url string, html string, host int, score int")
    found = U.judge(pages).collect()
    assert {r["page_id"]: tuple(r)[1:] for r in found} == brute(rows) and len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    assert by_id[3]["rule"] == "example.net/en/" and by_id[4]["rule"] is None and by_id[5]["verdict"] == "block"
    # "cheappills" has no mark between its words.
    assert by_id[9]["verdict"] == by_id[10]["verdict"] == "block" and by_id[7]["verdict"] == "allow"
    assert U.keep_allowed(pages).columns == pages.columns


def test_empty_table(spark):
    assert U.judge(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_splits():
    found = defaultdict(float, {})
    assert U.best_split("cheappills", {(0, 5): -3.0, (5, 10): -4.0}, 12.0) == ["cheap", "pills"]
    assert U.best_split("", found, 1.0) == []
