"""License scans by canonical digests, with DataFrame functions only.

A text is brought to a canonical form: lower case, lines of copyright notices
gone, every run of other characters than letters and digits one space, one
spelling of equivalent words. Its SHA-256 is looked up in a table of digests of
known license texts in the same form; a hit is the whole text, never a part of
one. There are three kinds of units:

* the whole text of a document, however it is wrapped;
* each of its lines, for notices of one line;
* paragraphs, parted by lines without letters and digits, so that comment marks
  part them, too. A known text of several paragraphs stands where all of them
  follow each other: paragraphs are looked up one by one, and hits of one text
  whose places agree are counted. No window of text is copied, so a long
  document costs no more than its length.

The known texts are a table (``known_texts`` makes one of whole licenses, file
headers and short notices; any table of license, text will do). It is joined by
digest: units are reduced to a digest before anything is shuffled, and AQE splits
a digest that very many documents share. Units that begin with other letters than
any known text, or must be longer than all of them, are left out before their
form is made. Spark broadcasts the known digests only if they are below its own
threshold; the driver holds first letters, at most three of each text.

A line is a copyright notice if it begins with a sign, "copyright" with a sign or
a year, "(c)" with a year or at most three words, or "all rights reserved". Other
sentences that break before "copyright" or "(c)" are kept, so the form does not
depend on where they break.

NULL and empty texts have no units and give no row, nor do units that are empty
in canonical form. Two known texts with one canonical form are both reported.
Repeated rows are added up by id; rows with a NULL id are one document. An empty
table, or no known texts, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.license_texts import license_texts

# Short notices by which projects name their license.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This software is released under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Words that count as the same, in canonical form.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
    ("organisation", "organization"), ("favour", "favor"), ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"), ("whilst", "while"), ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holder"), ("copyright holders", "copyright holder"),
)
# A line that is a notice of copyright, whoever holds it, after lower-casing.
YEAR = r"(?:(?:19|20)[0-9][0-9]|yyyy|year)"
NO_WORD = r"[^a-z0-9\n]*"
COPYRIGHT = rf"(^|\n){NO_WORD}(?:©|copyright{NO_WORD}(?:\(c\)|©|{YEAR})|\(c\){NO_WORD}(?:copyright{NO_WORD})?{YEAR}|all rights reserved)[^\n]*"
# "(c)" and at most three words. It takes the break behind, so the first of two neighbours is found first, the second by a second pass.
SHORT = r"(^|\n)[^a-z0-9\n]*\(c\) *[^ \n]*(?: +[^ \n]+){0,2} *(\n|\z)"
COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
# What is neither a letter, a digit nor a line break; Latin-1 signs and general punctuation are not letters.
OTHER = r"[^a-z0-9\n\x{C0}-\x{1FFF}\x{2070}-\x{10FFFF}]+"


def _marked(text: Column) -> Column:
    """Lower case, without copyright lines, two spaces for every run of other characters, line breaks kept."""
    low = F.lower(text)
    signs = F.contains(low, F.lit(COPYRIGHT_SIGNS[0]))
    for sign in COPYRIGHT_SIGNS[1:]:
        signs = signs | F.contains(low, F.lit(sign))
    # The patterns run only where one of their signs occurs.
    bare = F.regexp_replace(low, COPYRIGHT, "$1")
    for _ in range(2):
        bare = F.regexp_replace(bare, SHORT, "$1$2")
    return F.regexp_replace(F.when(signs, bare).otherwise(low), OTHER, "  ")


def _form(marked: Column) -> Column:
    """The canonical form of one marked text; its line breaks are spaces."""
    # Two spaces between words, so that neighbours are replaced apart.
    out = F.concat(F.lit(" "), F.replace(marked, F.lit("\n"), F.lit("  ")), F.lit(" "))
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(f" {one.replace(' ', '  ')} "), F.lit(f" {other} "))
    return F.trim(F.regexp_replace(out, " {2,}", " "))


def canonical(text: Column) -> Column:
    return _form(_marked(text))


def marked_sql(text: str) -> str:
    """``_marked`` for the check engine."""
    out = f"regexp_replace(lower({text}), '{COPYRIGHT}', '\\1', 'g')"
    for _ in range(2):
        out = f"regexp_replace({out}, '{SHORT}', '\\1\\2', 'g')"
    return f"regexp_replace({out}, '{OTHER}', '  ', 'g')"


def form_sql(marked: str) -> str:
    """``_form`` for the check engine."""
    out = f"' ' || replace({marked}, chr(10), '  ') || ' '"
    for one, other in SPELLINGS:
        out = f"replace({out}, ' {one.replace(' ', '  ')} ', ' {other} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


# A replaced word keeps at least this share of its length.
SHRINK = min(len(other) / len(one) for one, other in SPELLINGS)


def least_form(marked: Column, breaks: Column) -> Column:
    """No form of a marked text with so many line breaks is shorter.

    A text of w words has at most w + 1 + breaks runs of two spaces, and no more
    words than letters, so at least a third of what is left without the breaks
    are letters; replaced words keep SHRINK of theirs.
    """
    return (F.length(marked) - 2 - 3 * breaks) * (SHRINK / 3)


def digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def beginning(unit: Column) -> Column:
    """The first three letters of a marked text's first word; no spelling changes them."""
    return F.substring_index(F.translate(F.substring(F.ltrim(unit, F.lit(" \n")), 1, 3), "\n", " "), " ", 1)


def notices(spark: SparkSession, texts: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    return spark.createDataFrame(list(texts), "license string, text string")


def known_texts(spark: SparkSession) -> DataFrame:
    """Whole licenses, file headers and short notices."""
    return notices(spark, [*NOTICES, *license_texts()])


# Kinds of units.
WHOLE, LINE, PARAGRAPH = 0, 1, 2
# Lines without letters and digits part paragraphs, in a marked text.
GAP = r"\n *(?:\n *)+"


def _paragraphs(marked: Column) -> Column:
    return F.filter(F.split(marked, GAP, -1), lambda x: F.ltrim(x, F.lit(" \n")) != "")


def _known(known: DataFrame) -> DataFrame:
    """(license, text, kind, at, n, unit, form): whole texts and their paragraphs, in order."""
    marked = known.select("license", _marked(F.col("text").cast("string")).alias("unit")).withColumn("form", _form(F.col("unit")))
    texts = (marked.where("form <> ''").withColumn("text", digest(F.col("form"))).groupBy("license", "unit", "form", "text").count())
    whole = texts.select("license", "text", F.lit(WHOLE).alias("kind"), F.lit(0).alias("at"), F.lit(1).alias("n"), "unit", "form")
    parts = (texts.select("license", digest(F.col("unit")).alias("text"), _paragraphs(F.col("unit")).alias("parts"))
             .select("license", "text", F.lit(PARAGRAPH).alias("kind"), F.size("parts").alias("n"), F.posexplode("parts").alias("at", "unit"))
             .select("license", "text", "kind", "at", "n", "unit", _form(F.col("unit")).alias("form")))
    return whole.unionByName(parts)


def scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, license, whole_text, n_lines) of documents that are a license or have lines that are one."""
    return find(docs, known, id_column, text_column).where("whole_text OR n_lines > 0").drop("n_places")


def find(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, license, whole_text, n_lines, n_places) of every document and license found in it.

    whole_text: the document is the license; n_lines: its lines that are the
    license; n_places: where the license stands as one or more paragraphs in a row.
    """
    table = _known(known)
    # Whole texts and lines are looked up alike.
    limits = {kind: (longest, sorted(firsts)) for kind, longest, firsts in table.groupBy("kind").agg(
        F.max(F.length("form")), F.collect_set(beginning(F.col("unit")))).collect()}
    table = table.select("license", "text", F.col("kind").alias("_kind"), "at", "n", digest(F.col("form")).alias("_digest")).distinct()

    def matches(unit: Column, breaks: Column, kind: int) -> Column:
        longest, firsts = limits.get(kind, (0, []))
        return beginning(unit).isin(firsts) & (least_form(unit, breaks) <= longest)

    def breaks(unit: Column) -> Column:
        return F.length(unit) - F.length(F.replace(unit, F.lit("\n"), F.lit("")))

    def unit_of(kind: int, place: Column, unit: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"), unit.alias("unit"))

    # The marked text is made once for all units.
    text, none = F.col(text_column).cast("string"), F.lit(0)
    units = F.flatten(F.transform(F.array(_marked(text)), lambda m: F.concat(
        F.transform(F.filter(F.array(m), lambda x: matches(x, breaks(x), WHOLE)), lambda x: unit_of(WHOLE, none, x)),
        F.transform(F.filter(F.split(m, "\n", -1), lambda x: matches(x, none, WHOLE)), lambda x: unit_of(LINE, none, x)),
        F.filter(F.transform(_paragraphs(m), lambda x, i: unit_of(PARAGRAPH, i, x)),
                 lambda u: matches(u["unit"], breaks(u["unit"]), PARAGRAPH)))))
    single = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text).alias("_row"), F.explode(units).alias("_u"))
    hashed = single.select("_id", "_row", F.col("_u.kind").alias("kind"), F.col("_u.place").alias("place"),
                           digest(_form(F.col("_u.unit"))).alias("digest"))
    same = (hashed["digest"] == table["_digest"]) & ((hashed["kind"] == PARAGRAPH) == (table["_kind"] == PARAGRAPH))
    hits = hashed.join(table, same).withColumn("start", F.col("place") - F.col("at"))
    # All paragraphs of a text, each at its place; a row that occurs twice gives every hit twice.
    stands = (hits.groupBy("_id", "_row", "license", "kind", "text", "n", "start")
              .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("at").alias("parts")).where("parts = n")
              .withColumn("times", (F.col("hits") / F.col("n")).cast("bigint")))
    # Two known texts of a license at one place are one find.
    other = F.when(F.col("kind") == PARAGRAPH, F.lit(None)).otherwise(F.col("text"))
    finds = stands.groupBy("_id", "_row", "license", "kind", "start", other.alias("text")).agg(F.max("times").alias("times"))

    def total(kind: int) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("times")).otherwise(0))

    return (finds.groupBy("_id", "license").agg((total(WHOLE) > 0).alias("whole_text"), total(LINE).alias("n_lines"),
                                                total(PARAGRAPH).alias("n_places"))
            .withColumnRenamed("_id", id_column))


def find_sql(texts: Sequence[tuple[str, str]] | None = None) -> str:
    """``find`` in ``documents`` for the check engine, paragraphs of a text as lists."""
    known = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in texts or [*NOTICES, *license_texts()])
    parts = f"list_filter(string_split_regex(marked, '{GAP}'), lambda x: trim(x, ' ' || chr(10)) <> '')"
    return f"""
    WITH texts AS (SELECT license, {marked_sql('text')} AS marked FROM (VALUES {known}) AS t(license, text)),
    known AS (SELECT DISTINCT license, {form_sql('marked')} AS form FROM texts),
    lists AS (SELECT DISTINCT license, list_transform({parts}, lambda x: {form_sql('x')}) AS forms FROM texts),
    docs AS (SELECT doc_id, row_number() OVER () AS rid, {marked_sql('text')} AS marked FROM documents),
    units AS (SELECT doc_id, true AS whole, marked AS unit FROM docs
              UNION ALL SELECT doc_id, false, unnest(string_split(marked, chr(10))) FROM docs),
    hits AS (SELECT doc_id, license, whole, 1 AS n FROM (SELECT doc_id, whole, {form_sql('unit')} AS form FROM units) u JOIN known USING (form)
             WHERE form <> ''),
    bodies AS (SELECT doc_id, rid, list_transform({parts}, lambda x: {form_sql('x')}) AS forms FROM docs),
    starts AS (SELECT doc_id, rid, forms, unnest(forms) AS head, generate_subscripts(forms, 1) AS start FROM bodies),
    places AS (SELECT DISTINCT doc_id, rid, license, start FROM starts s JOIN lists k
               ON k.forms[1] = s.head AND s.forms[s.start:s.start + len(k.forms) - 1] = k.forms),
    found AS (SELECT doc_id, license, whole, NOT whole AS line, false AS place FROM hits
              UNION ALL SELECT doc_id, license, false, false, true FROM places)
    SELECT doc_id, license, bool_or(whole) AS whole_text, count(*) FILTER (line) AS n_lines, count(*) FILTER (place) AS n_places
    FROM found GROUP BY doc_id, license"""
