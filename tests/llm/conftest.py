import pytest

EXTRA = "id long, digest string, keep string, score double, path long, member long, n long, words string, target string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and extra columns whose names operators use inside."""
    long_text = " ".join(f"word{k % 977} number{k}" for k in range(20_000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \n\t ", None, "a", 4),
        (4, "Hello World of words and more", "en", "b", 11),
        (4, "Hello World of words and more", "en", "b", 11),
        (5, "hello wORLD of words and more", "en", "b", 11),
        (None, "Hello World of words and more", None, "c", 11),
        (7, long_text, "en", "a", len(long_text)),
        (8, long_text, "en", "c", len(long_text)),
        (9, "ÄÖÜ ß 日本 😀 ▁ \x00 end", "de", "c", 14),
        (10, "x" * 5000, "de", None, 5000),
        (11, "12345 67 --- 89", "fr", "c", 15),
    ]
    extra = (1, "d", "k", 0.5, 2, 3, 4, "w", "t")
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    return spark.createDataFrame([(*row, *extra) for row in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def labelled(spark):
    rows = [(k, k % 2, (k + 1) % 2) for k in range(1, 12)] + [(4, 1, 1), (None, 1, 0), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
