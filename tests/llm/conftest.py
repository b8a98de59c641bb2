import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for their own columns.
CLASHING = ["kept", "keep_id", "component_id", "n_tokens", "score", "digest", "row_key", "base", "spans", "ids",
            "k1", "row", "length", "piece", "text_key", "train", "key", "held_out", "words", "meta"]

PLAIN = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, one very long text."""
    long_text = " ".join(f"word{i % 997} other{i % 89}" for i in range(30_000))
    return [(1, PLAIN, "en", "s1", 10), (1, PLAIN, "en", "s1", 10), (2, PLAIN.upper(), "en", None, None),
            (3, None, None, None, None), (4, "", "en", "s1", 0), (5, " \n\t ", "en", "s1", 4),
            (None, PLAIN + " indeed", "en", "s2", 5), (None, None, None, None, None), (6, long_text, "en", "s2", 1),
            (7, "123 456 !!", None, "s1", 3), (8, "+1 (555) 010-7788 mail me at a.b@c.example.org", "en", "s3", 7),
            (9, "él 漢字 \U0001F600 ñandú", "es", "s3", 8), (9, "une autre phrase", "fr", "s3", 8)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHING)).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet").cache()
