import pytest

# Every shape of row the operators must take: NULL text, id and source, no words, ties, repeated rows, long texts.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t ", "de", "b"),
    (6, "Ünïcode wörds ß — “quoted” ẞ end", "de", "b"),
    (7, "a b c", "fr", "c"),
    (7, "a b c", "fr", "c"),
    (None, "no id at all", "fr", None),
    (None, None, None, None),
    (8, " ".join(f"w{i}" for i in range(30_000)), "en", "a"),
    (9, " ".join(f"w{i}" for i in range(60)) + "\nReleased under the MIT Licence!\n" + " ".join(f"w{i}" for i in range(60)), "en", "b"),
    (10, " ".join(f"w{i}" for i in range(60)), "en", "c"),
    (11, "x" * 20_000, "en", "c"),
    (12, "ODD <|endoftext|> it's DON'T bars', 3.14 ...", "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd_rows():
    return ROWS


@pytest.fixture(scope="session")
def odd(spark):
    """The rows, with columns that bear names the operators use themselves."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    from pyspark.sql import functions as F
    return rows.select("*", *[F.lit(i).alias(n) for i, n in enumerate(
        ["_id", "_text", "size", "n_words", "bits", "_spans", "_print", "_times", "_cut", "key", "chunk", "unit", "_n_words"])])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (6, None), (9, 1), (7, 0), (99, 0)],
                                 "doc_id bigint, quality int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
