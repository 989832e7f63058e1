import pytest

EDGES = [
    (1, None),
    (2, ""),
    (3, "\n\n  \t"),
    (4, "word"),
    (5, "ünïcödé 日本語 😀 text with a password = 'abcdefghijklmnop' in it"),
    (6, "same text twice over here to be seen again and again by all who look at it"),
    (6, "same text twice over here to be seen again and again by all who look at it"),
    (7, "same text twice over here to be seen again and again by all who look at it"),
    (None, "no id at all but some words to count here"),
    (None, None),
    (8, " ".join(f"w{i}" for i in range(30_000))),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empties, a long text, ties, repeated rows and columns that clash with results."""
    rows = [(i, t, "en", None if k % 3 else f"s{k % 2}", 7, "mine", k) for k, (i, t) in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, n_words int")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
