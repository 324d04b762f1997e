import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, ids string, shard int, n bigint"
LONG = "one two three four five six seven eight " * 4000


def rows():
    plain = "The quick brown fox jumps over the lazy dog while the sun is setting behind old hills."
    texts = [
        plain, plain, plain.upper(), plain + " Again.", "", None, " \t\n ", "!!! 123 ###", "word", LONG, LONG + "end",
        "漢字かな交じり文" * 700, "a" * 5000, "x <|endoftext|> y", "line\nline\nline\nother words here",
    ]
    out = [(k, t, ("en", "de", None)[k % 3], ("b", None, "a", "")[k % 4], 0, 1.0, "x", 1, 2) for k, t in enumerate(texts)]
    # A row twice, an id with two texts, no id.
    return [*out, out[0], (3, "something else entirely is written here today", "en", "a", 0, 1.0, "x", 1, 2), (None, plain, "en", "a", 0, 1.0, "x", 1, 2)]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Odd documents, read from a file as a scan is."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    from mailweave.session import ship

    ship(spark)
    assert F
