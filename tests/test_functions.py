import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from rallyframe.functions import classify as C
from rallyframe.functions import rating as R
from rallyframe.functions import text as T
from rallyframe.functions import values as V
from rallyframe.functions.similarity import near_token_match, seq_ratio


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw", ["Élodie Müller-Łukasz", "Ştefan  O'Neil", "José María Ñandú", "", "ﬁnn Ǆ", "Steﬀen Müller", "𝐀nna Bell", "Ǆon Doe", "ĳsbrand ㎏ ½ Ⅷ ⒜ 🄐"])
def test_normalize_name_matches_unicode_rules(spark, raw):
    base = "".join(c for c in unicodedata.normalize("NFKD", raw) if not unicodedata.combining(c)).lower()
    want = " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in base).split())
    assert one(spark, raw, T.normalize_name) == want


def test_every_character_follows_the_unicode_rules(spark):
    points = [p for p in range(0x80, 0x30000) if not 0xD800 <= p < 0xE000]
    rows = spark.createDataFrame([(p, f"a{chr(p)}b") for p in points], "p int, v string").select("p", T.normalize_name(F.col("v")).alias("x")).collect()
    for r in rows:
        base = "".join(c for c in unicodedata.normalize("NFKD", f"a{chr(r.p)}b") if not unicodedata.combining(c))
        lowered = "".join(c.lower() if c.isascii() else "i" if c in "\u0130" else "k" if c == "\u212a" else c for c in base)
        assert r.x == " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in lowered).split()), hex(r.p)


def test_slug_and_family(spark):
    assert one(spark, "  ", T.slug) == "unknown"
    assert one(spark, "Óscar – Peña", T.slug) == "oscar-pena"
    assert one(spark, "Van Der Berg J.", T.family_name) == "berg"


def test_two_word_particle_is_the_surname(spark):
    row = spark.createDataFrame([("Ana de la",)], "v string").select(*[c.alias(k) for k, c in T.name_features(F.col("v")).items()]).first()
    assert (row["surname"], row["last"], row["compact"], row["token_key"]) == ("de la", "la", "a de la", "ana de la")


@pytest.mark.parametrize("raw,history,fixture", [
    ("20240131", "2024-01-31", "2024-01-31"), ("20241399", "2024-13-99", "2024-13-99"), ("2024-01-31", None, "2024-01-31"),
    ("2024-01-31T10:00", None, "2024-01-31"), ("x", None, None), ("", None, None)])
def test_dates(spark, raw, history, fixture):
    assert one(spark, raw, V.parse_history_date) == history
    assert one(spark, raw, V.parse_fixture_date) == fixture


@pytest.mark.parametrize("raw,want", [("1.9", 1), ("-1.9", -1), ("nan", None), ("inf", None), ("", None), ("x", None)])
def test_safe_long(spark, raw, want):
    assert one(spark, raw, V.safe_long) == want


@pytest.mark.parametrize("raw,exact,substring,words", [
    ("Hard", "hard", "hard", "hard"), ("Hard (Indoor)", "unknown", "hard", "hard"), ("Har-Tru", "unknown", "unknown", "clay"),
    ("Orchard", "unknown", "hard", "unknown"), ("", "unknown", "unknown", "unknown")])
def test_surface_variants_differ(spark, raw, exact, substring, words):
    assert [one(spark, raw, f) for f in (C.surface_exact, C.surface_substring, C.surface_words)] == [exact, substring, words]


@pytest.mark.parametrize("text,want", [("quarterfinal", False), ("Q1", True), ("pre-qualifying", True), ("qual. r2", True), ("qf", False)])
def test_qualification(spark, text, want):
    assert one(spark, text, C.is_qualification) is want


def test_women_are_tested_before_men(spark):
    assert one(spark, "itf women singles", C.gender_from_text) == "women"


def test_slam_qualifying_differs_by_feed(spark):
    piped = lambda c: C.level_from_text(c, F.lit("men"))
    assert one(spark, "wimbledon qualification", piped) == "grand_slam"
    assert one(spark, "city qualification", piped) == "qualifying"


@pytest.mark.parametrize("text,want", [("Finished", "finished"), ("Retired", "void"), ("Postponed", "void"), ("2nd set", "pending"),
                                       ("", "unknown"), ("odd", "odd")])
def test_settle_status(spark, text, want):
    assert one(spark, text, C.settle_status) == want


def test_probability_bucket_edges(spark):
    assert [one(spark, p, R.probability_bucket, "double") for p in (0.5, 0.45, 0.95, 1.0)] == ["0.50-0.55", "0.55-0.60", "0.95-1.00", "0.95-1.00"]


def test_ratio_is_the_standard_one_and_skips_nulls(spark):
    pairs = [("abcd", "bcde"), ("", "x"), (None, "x"), ("garbiela", "gabriela")]
    got = [r["x"] for r in spark.createDataFrame(pairs, "a string, b string").select(seq_ratio("a", "b").alias("x")).collect()]
    want = [SequenceMatcher(None, "abcd", "bcde").ratio(), 0.0, None, SequenceMatcher(None, "garbiela", "gabriela").ratio()]
    assert got == want


def test_near_token_match(spark):
    pairs = [("garbiela vasilescu arina", "arina gabriela vasilescu"), ("a b", "a b"), ("x vasilescu arina", "arina gabriela vasilescu")]
    got = [r["x"] for r in spark.createDataFrame(pairs, "a string, b string").select(near_token_match("a", "b").alias("x")).collect()]
    assert got == [True, False, False]
