import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls everywhere, empty and long texts, repeated rows and texts."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
    near = base * 3 + "one more ending here"
    rows = [
        (1, base * 3, "en", "a", None), (2, base * 3, "en", "a", 5), (2, base * 3, "en", "a", 5), (3, near, "de", "b", 1),
        (4, None, "de", None, None), (5, "", None, "b", 0), (6, " \n\t ", "fr", "c", 4), (None, "no id at all", "en", "a", 3),
        (7, "zwei Wörter", "de", "b", 2), (8, "日本語のテキスト", None, None, 8), (9, "x" * 30_000, "en", "c", 30_000),
        (10, ("long words in a long text number %d " * 1) % 1 + " ".join(f"w{i}" for i in range(60_000)), "en", "c", 1),
        (11, "12345 !!! <|endoftext|> 99", "en", "d", None), (12, "Tab\tand\nline " * 40, "fr", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
