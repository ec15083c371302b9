import pytest

from equigauge.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "a passage of many words that stands in more than one document and is long enough to be found by its bytes, ä ö ü "
LONG = "".join(f"word{k % 977} other{k % 1013}. " for k in range(20_000))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty, blank and very long texts, ties, copies and near copies, passages, runs of one byte."""
    base = " ".join(f"w{k}" for k in range(120))
    return [
        (1, None, None, None, None), (2, "", "en", "s1", 0), (3, "   \n\t ", "en", "s2", 6), (4, LONG, "en", "s1", len(LONG)),
        (5, LONG + "end", "en", "s1", len(LONG) + 3), (6, base, "en", None, 1), (7, base, "de", "s2", 1), (8, base + " more", "en", "s3", 1),
        (9, PASSAGE + "first", "en", "s3", 1), (10, "other " + PASSAGE, "en", "s3", 1), (11, "a" * 400, "en", "s1", 400),
        (12, "b" + "a" * 150, "en", "s1", 151), (13, "ab" * 200, "en", "s\0x", 400), (14, "Two Words", "en", "s1", 9),
        (15, "two WORDS", "en", "s1", 9), (16, "one", "en", "s2", 3), (17, "日本語 😀 text " + PASSAGE, "ja", "s2", 1),
        (18, "You are a STUPID moron. Nice day", "en", "s2", 1), (19, base.upper(), "en", "s1", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
