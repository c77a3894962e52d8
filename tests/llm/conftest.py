import pytest
from pyspark.sql import Row

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, id string, sha string, name int, label int, score double, words string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and repeated ids, null, empty, odd and very long texts, ties, repeated rows, columns with clashing names."""
    long_text = " ".join(f"word{i % 977} and" for i in range(30_000))
    texts = [
        (0, None), (1, ""), (2, "  \t\n "), (3, "Hello World again"), (4, "hello world AGAIN"), (4, "hello world AGAIN"),
        (5, "one"), (6, "one two"), (7, "ÄÖÜ straße été"), (8, "äöü straße été"), (9, long_text), (10, long_text + " x"),
        (11, long_text), (None, "nobody knows"), (None, "nobody knows"), (None, None), (12, "日本語 テキスト 🙂"), (13, "12 34 56"),
        (14, "a" * 5000), (15, "a" * 5000 + "b"), (16, "the idiot and the moron are stupid"), (16, "same id, other text"),
    ]
    langs = ["en", "de", None]
    rows = [
        Row(i, t, langs[k % 3], "s", len(t or ""), k, "x", "y", 1, 2, 0.5, "w") for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
