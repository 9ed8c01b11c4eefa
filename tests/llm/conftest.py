import pytest

LONG = " ".join(f"Word{i % 977}x{i}" for i in range(30_000))
COPIED = " ".join(f"copy{i}" for i in range(80))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, k string, component_id int, score string, _fl string"


@pytest.fixture(scope="session")
def nasty(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows and ids, clashing columns."""
    rows = [
        (1, COPIED, "en", "s", 5), (2, COPIED, "en", "s", 5), (2, COPIED, "en", "s", 5), (3, COPIED + " end", "en", None, None),
        (4, None, "en", "s", 0), (5, "", None, "s", 0), (6, " \t\n ", "de", "s", 3), (7, LONG, "en", "s", 1), (8, LONG + " more", "en", "s", 1),
        (9, "one two", "fr", "s", 7), (9, "another text with the same id", "fr", "s", 7), (10, "one two", "fr", "s", 7),
        (None, COPIED, "en", "s", 5), (None, None, None, None, None), (11, "12 34 5,6 ..!", "en", "s", 9),
        (12, "É ñ ß 漢字 ALL RIGHTS reserved cc BY cc by", "es", "s", 2), (13, "a   b \n\n\n c  ", None, "s", 2),
    ]
    full = [(*row, "x", 7, "y", "z") for row in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def rows():
    return lambda df, *names: sorted((tuple(r[n] for n in names) for r in df.toArrow().to_pylist()), key=repr)
