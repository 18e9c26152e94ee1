"""URL filters: rules by host and path, then naive Bayes over the words of host and path.

Hosts run words together. Each name (a run of letters, of any script) is split
by the most probable sequence of dictionary words. The dictionary counts the
words of the pages' own texts and of ``BLOCK_TERMS``; a name that no text has as
a word is no word, so it is split where its parts are words. The dictionary is
never broadcast: the substrings of the distinct names are joined to it, so a
name meets only words that occur in it. A run of digits is a token by its
length. Dictionary words are up to ``MAX_WORD`` letters long; a longer run of
letters in a name can only be split.

The classifier learns from the urls: those whose host has a word of
``BLOCK_TERMS`` are examples to block, the others to allow. Its counts by word
are a table, too, joined to the words of distinct hosts and paths; a word or
host that most urls share is a skewed join, which Spark splits.

A NULL url or one without ``://`` has an empty host and path, no words, and is
judged by the prior alone. Repeated rows are judged alike. A NULL page text has
no words. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import lower_ascii, pieces, utf8
from riskloom.session import written

# (verdict, rule): a rule is a host and the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Words that mark a host as an example to block.
BLOCK_TERMS = ("adult", "ads", "bets", "betting", "casino", "gambling", "payday", "pills", "poker", "porn", "spam",
               "viagra", "xxx")
# Count that a term has in the dictionary besides its occurrences.
TERM_COUNT = 100
# Longest dictionary word.
MAX_WORD = 32
SMOOTHING = 1.0
# Distinct words a task counts before it passes them on.
FLUSH_WORDS = 200_000

# Names in host and path: runs of letters (every character beyond ASCII counts as one) and runs of digits.
NAMES = r"[a-z\x{80}-\x{10FFFF}]+|[0-9]+"


def host(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(after)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host_: Column, path_: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _page_words(pages: DataFrame, html_column: str) -> DataFrame:
    """(word, n) of the page texts, summed by task; the same word comes from many tasks."""
    tags = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)>|<!--.*?-->|<[^>]*>", re.S | re.I)
    letters = bytes(b if 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else b if b >= 0x80 else 32 for b in range(256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for piece in pieces(batches, "_html"):
            for html in piece.column("_html").to_pylist():
                counts.update(tags.sub(b" ", html).translate(letters).split())
            if len(counts) > FLUSH_WORDS:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    def rows(counts: Counter) -> pa.RecordBatch:
        some = [(w, n) for w, n in ((w.decode("utf-8", "replace"), n) for w, n in counts.items()) if len(w) <= MAX_WORD]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()),
                                           pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    return pages.select(utf8(F.col(html_column)).alias("_html")).mapInArrow(run, "word string, n bigint")


def best_split(name: str, found: dict[tuple[int, int], float], log_total: float) -> list[str]:
    """Most probable words of ``name``; ``found`` has the log probability of each dictionary word by its place."""
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        choices = []
        for start in range(max(0, end - MAX_WORD), end):
            score = found.get((start, end))
            if score is None:  # an unknown word: ten times rarer with every letter
                score = np.log(10.0) * (1 - (end - start)) - log_total
            choices.append((best[start] + score, start))
        score, start = max(choices)
        best.append(score)
        back.append(start)
    words, end = [], len(name)
    while end:
        words.append(name[back[end]:end])
        end = back[end]
    return words[::-1]


def split_names(names: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(name, words) of the distinct ``name`` rows by the (word, n) dictionary."""
    total = float(dictionary.agg(F.sum("n")).first()[0] or 1)
    places = F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start")
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - F.col("start") + 1))).alias("size")
    parts = (names.select("name", places).select("name", "start", sizes)
             .withColumn("word", F.substring(F.col("name"), F.col("start"), F.col("size"))))
    hits = parts.join(dictionary, "word").groupBy("name").agg(
        F.collect_list(F.struct("start", "size", "n")).alias("found"))  # at most MAX_WORD per letter
    joined = names.join(hits, "name", "left").select("name", "found")
    log_total = float(np.log(total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            words = [best_split(r["name"], {(f["start"] - 1, f["start"] - 1 + f["size"]): float(np.log(f["n"])) - log_total
                                            for f in r["found"] or ()}, log_total) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return joined.mapInArrow(run, "name string, words array<string>")


def _names(text: Column) -> Column:
    found = F.regexp_extract_all(lower_ascii(text), F.lit(NAMES), F.lit(0))
    return F.transform(found, lambda n: F.translate(n, "123456789", "000000000"))


def _bag(distinct: DataFrame, column: str, splits: DataFrame) -> DataFrame:
    """(text, word, n): the words of each distinct ``column`` text."""
    names = distinct.select(column, F.explode(_names(F.col(column))).alias("name"))
    return (names.join(splits, "name").select(column, F.explode("words").alias("word"))
            .groupBy(column, "word").agg(F.count(F.lit(1)).alias("n")))


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
          rules: Sequence[tuple[str, str]] = RULES, terms: Sequence[str] = BLOCK_TERMS) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every page; score is the log odds of blocking by the method."""
    url = F.col(url_column).cast("string")
    urls = pages.select(F.col(id_column).alias("_id"), host(url).alias("host"), path(url).alias("path"))
    urls = written(urls, "urls")
    hosts = written(urls.groupBy("host").agg(F.count(F.lit(1)).alias("urls")), "hosts")
    paths = written(urls.groupBy("path").agg(F.count(F.lit(1)).alias("urls")), "paths")

    names = written(hosts.select(F.explode(_names(F.col("host"))).alias("name"), "urls")
                    .unionByName(paths.select(F.explode(_names(F.col("path"))).alias("name"), "urls"))
                    .groupBy("name").agg(F.sum("urls").alias("n")), "names")
    spark = pages.sparkSession
    seeds = spark.createDataFrame([(t, TERM_COUNT) for t in terms], "word string, n bigint")
    words = _page_words(pages, html_column).unionByName(seeds)
    dictionary = written(words.groupBy("word").agg(F.sum("n").alias("n")), "dictionary")
    splits = written(split_names(names.select("name"), dictionary), "splits")
    host_bag = written(_bag(hosts, "host", splits), "host-words")
    path_bag = written(_bag(paths, "path", splits), "path-words")

    # Examples: whole urls, by the words of their host.
    marked = host_bag.groupBy("host").agg(F.max(F.col("word").isin(list(terms))).alias("block"))
    by_host = hosts.join(marked, "host", "left").withColumn("block", F.coalesce("block", F.lit(False)))
    path_class = (urls.join(by_host.select("host", "block"), "host").groupBy("path", "block")
                  .agg(F.count(F.lit(1)).alias("urls")))
    per_word = (host_bag.join(by_host.select("host", "block", "urls"), "host").select("word", "block", (F.col("n") * F.col("urls")).alias("n"))
                .unionByName(path_bag.join(path_class, "path").select("word", "block", (F.col("n") * F.col("urls")).alias("n"))))
    counts = written(per_word.groupBy("word").agg(
        F.sum(F.when(F.col("block"), F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("block"), 0).otherwise(F.col("n"))).alias("a")), "word-counts")
    sums = counts.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v")).first()
    classes = by_host.agg(F.sum(F.when(F.col("block"), F.col("urls"))).alias("b"),
                          F.sum(F.when(~F.col("block"), F.col("urls"))).alias("a")).first()
    size = SMOOTHING * (sums["v"] or 0) + 1e-9
    prior = float(np.log(((classes["b"] or 0) + SMOOTHING) / ((classes["a"] or 0) + SMOOTHING)))
    shift = float(np.log(((sums["a"] or 0) + size) / ((sums["b"] or 0) + size)))
    odds = counts.select("word", (F.log((F.col("b") + SMOOTHING) / (F.col("a") + SMOOTHING)) + shift).alias("odds"))

    def scores(bag: DataFrame, column: str, name: str) -> DataFrame:
        # Sorted before the sum, so reruns add in the same order.
        terms_of = bag.join(odds, "word").groupBy(column).agg(
            F.sort_array(F.collect_list(F.struct("word", (F.col("n") * F.col("odds")).alias("x")))).alias("xs"))
        return terms_of.select(column, F.aggregate("xs", F.lit(0.0), lambda t, x: t + x["x"]).alias(name))

    joined = (urls.join(scores(host_bag, "host", "_host_score"), "host", "left")
              .join(scores(path_bag, "path", "_path_score"), "path", "left"))
    score = F.lit(prior) + F.coalesce("_host_score", F.lit(0.0)) + F.coalesce("_path_score", F.lit(0.0))
    ruled = joined.select(F.col("_id").alias(id_column), "host", "path", score.alias("score"),
                          rule(F.col("host"), F.col("path"), rules).alias("_r"))
    verdict = F.coalesce("_r.verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return ruled.select(id_column, "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"), "score")


def keep_allowed(pages: DataFrame, id_column: str = "page_id", **options) -> DataFrame:
    """The pages whose verdict is allow, columns as they were; pages without id are judged by nobody and go."""
    allowed = (judge(pages, id_column, **options).where("verdict = 'allow'")
               .select(F.col(id_column).alias("_allowed")).distinct())
    return pages.join(allowed, pages[id_column] == allowed["_allowed"], "left_semi")
