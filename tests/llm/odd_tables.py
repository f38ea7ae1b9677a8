import pytest
from pyspark.sql import functions as F

EXTRA = ["score", "n_tokens", "key", "node", "row", "_row", "_base", "_spans", "label", "spans", "component", "bucket", "rate", "posterior", "_draw",
         "did", "number", "t", "seed", "held_out", "n", "doc", "start", "word"]


@pytest.fixture(scope="session")
def words():
    """Text of n words that no other seed has."""
    def text(seed, n):
        return " ".join(f"{chr(97 + seed % 26)}w{seed}x{i}" for i in range(n))
    return text


@pytest.fixture(scope="session")
def odd(spark, words):
    """Documents with nulls, blanks, long texts, ties, repeated rows and columns whose names operators use inside."""
    rows = [
        (1, words(1, 80)), (2, None), (3, ""), (4, "  \n\t "), (None, words(2, 60)), (None, None), (5, words(3, 30_000)), (6, words(4, 60)),
        (6, words(4, 60)), (6, words(5, 60)), (7, words(4, 60)), (8, "one"), (9, "é ü 漢字 🙂"), (10, "a " * 500),
    ]
    base = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.when(F.col("doc_id") > 3, "en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return base.withColumns({c: F.lit("x") for c in EXTRA}).coalesce(2).persist()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 1), (5, 1, 1), (6, 1, 0), (6, 0, 0), (8, 0, 0), (9, 1, 0), (99, 1, 1), (10, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
