import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("score", "lang_pred", "spans", "fp", "found", "blob", "n_words", "ids", "id", "row", "text_", "root", "x0", "n_tokens", "kept_id", "hits_0", "clean")
WORDS = "the of and wind river stone light under over seven green table window paper music garden".split()
FRENCH = "le la des une dans maison rivière pierre lumière fenêtre jardin musique vert sept papier table".split()


def prose(seed: int, n: int = 60, words=WORDS) -> str:
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty, blank, letterless, repeated and very long texts, and one id twice."""
    long = prose(1, 30_000)
    return [(1, None, "en", None, None), (2, "", None, "s", 0), (3, " \n\t ", "en", "s", 4), (4, "12 34 !! 😀", "en", "s", 9), (None, "the wind and the river", None, "s", 22),
            (5, prose(5), "en", "s", 300), (6, prose(5), "en", "s", 300), (6, prose(5), "en", "s", 300), (7, long, "en", "s", len(long)),
            (8, "x" * 200_000, "en", "s", 200_000), (9, prose(9, 50, FRENCH), "fr", "s", 300), (10, "токен = secret: abcdefgh12345", "ru", "s", 30),
            (11, "ª", "en", "s", 1), (12, "ßſK password=p4ssw0rd_x\u0000y", None, "s", 20), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with further columns named like everything an operator makes."""
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
