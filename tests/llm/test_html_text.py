"""Main texts against a plain reading of the given pages, pages of other makes, and pages held out of the fit."""

import html
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import html_text as H
from riskloom.llm import page_labels
from riskloom.llm.catalog import QUERIES


@pytest.fixture(scope="module")
def tree():
    return H.fit_pages()


def plain(page):
    """The article element of the tables' template, read without blocks or classifier."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(/?p|br|/?h1)>", " ", inside))).split())


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    found = QUERIES["op13_html_text"](spark, path).collect()
    assert len(found) == len(pages)
    for r in found:
        text = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))


OTHERS = [
    ("""<!doctype html><HTML><BODY CLASS="has-sidebar"><HEADER><h1>Site</h1><nav>Home <a href=/x>about</a></nav></HEADER>
     <div id="cookie-notice" role=dialog>We use cookies for more things than you would like to know. <button>Accept</button></div>
     <main><article><header><h1>Title &amp; more</h1><p class=byline>By <a href=#>Someone</a></p></header>
     <p>One&nbsp;two <b>thr</b>ee &lt;b&gt; x<p>four<br>five <script>if(a<b)"</p>"</script>six<!-- a <p> in a comment --> seven
     <form><p>Search here <input><textarea>secret</textarea></p></form><aside>Read also</aside><table><tr><td>a<td>b</table>
     <div class="share-buttons"><a>Tweet</a></div></article></main>
     <aside><p>Side text that is long enough to look like an article paragraph, but is not one at all.</p></aside>
     <section id=comments><article class=comment><p>I liked it very much, thank you for writing all this.</p></article></section>
     <footer>(c) me</footer>""", "Title & more One two three <b> x four five six seven a b"),
    ("<div class=menu><a>Home</a> <a>News</a></div><div class=entry-content><p>Short.</p><p>A second paragraph of words.</p></div>"
     "<div class=sidebar><p>Something about the author of this page and more of it.</p></div>"
     "<div class=commentlist><p>First! This is a very long comment about the paragraph of words.</p></div>",
     "Short. A second paragraph of words."),
    ("<div class='ArticleBody'>kept<div class='adBox'>bought</div> too</div>", "kept too"),
    ("", ""), (None, ""), ("<p></p> \n", ""), ("plain words without any tag at all", "plain words without any tag at all"),
    ("<div hidden>x</div><article>a<style>p{}</article>", "a"),
    ("<article>a < b <i c='>'>e</i>f<![CDATA[x]]><?php y ?></article>", "a < b ef"),
    ("<article>x<script>never closed <p>y", "x"),
    ("<article><p>a</div></section>b</article>", "a b"),
    ("<article>&am &amp &copy &#0; &#x110000; &#xD800; ok</article>", "&am & © � � � ok"),
    ("<article>wo<b>rd</b> un<script>x</script>cut<p>bl</p>ock</article>", "word uncut bl ock"),
    ("<article>Ünï  cödé &#128512;</article>", "Ünï cödé \U0001f600"),
]


def test_other_pages(spark):
    rows = [(i, None if i % 5 == 0 else f"u{i}", page) for i, (page, _) in enumerate(OTHERS)] + [(None, None, None), (3, "u3", "x")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    frame = frame.select("*", *[F.lit(0).alias(n) for n in ("text", "n_chars", "words")])
    found = sorted(H.extract(frame).collect(), key=str)
    texts = {i: text for i, (_, text) in enumerate(OTHERS)}
    assert len(found) == len(rows)
    for r in found:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and not (r.page_id == 3 and r.text == "x"):
            assert r.text == texts[r.page_id], r.page_id


def test_empty(spark):
    frame = H.extract(spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert frame.collect() == [] and frame.columns == ["page_id", "url", "text", "n_chars"]


def test_held_out_pages():
    """Fitted without a page (all its lengths), the tree labels most blocks of that page rightly."""
    right = total = words_right = words_total = 0
    whole, at = page_labels.pages(), 0
    for rows in page_labels.LABELLED:
        copies = next(n for n in range(len(whole) - at, 0, -1) if all(len(p[1]) == len(rows) and p[1] == [r[0] for r in rows]
                                                                     for p in whole[at:at + n]))
        held = whole[at]
        tree = H.fit_pages(whole[:at] + whole[at + copies:])
        found = H.blocks(held[0])
        same = tree.main(H.features(found)) == np.array(held[1], bool)
        size = np.array([b.words for b in found])
        right, total = right + int(same.sum()), total + len(same)
        words_right, words_total = words_right + int(size[same].sum()), words_total + int(size.sum())
        at += copies
    assert at == len(whole)
    assert right / total > .9 and words_right / words_total > .9, (right / total, words_right / words_total)


@pytest.mark.parametrize("part", ["<", "<a ", "<p>", "<div>", "</p>", "<!--", "&", "<b>x", "<a b='", "</script", "<script>", "<a b", "x "])
def test_long_pages_take_linear_time(tree, part):
    begin = time.time()
    H.main_texts(["<article>" + part * (1_000_000 // len(part))], tree)
    assert time.time() - begin < 20


def test_labels_must_fit():
    with pytest.raises(ValueError):
        H.fit_pages([("<p>a<p>b", [1])])
