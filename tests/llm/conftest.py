import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty values, ties, repeated rows, a very long text and extra columns with clashing names."""
    long = "lorem ipsum dolor sit amet consectetur " * 4000
    rows = [(1, "", "en"), (2, None, "en"), (None, "some words without an id here", None), (4, long, "fr"),
            (5, "same text for two rows " * 6, "de"), (5, "same text for two rows " * 6, "de"),
            (6, "same text for two rows " * 6, "de"), (7, " \t\n  ", "es"), (8, "naïve café 日本語 ​ 😀 x", "fr")]
    cols = ("doc_id long, text string, lang string, source string, n_chars long, fp long, ledger string, score double, "
            "root long, n_words string, `from` string")
    return spark.createDataFrame([(i, t, g, None, None, 3, "x", 0.5, 9, "w", "f") for i, t, g in rows], cols)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
