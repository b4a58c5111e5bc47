"""Dates, numbers, keys, score arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K


def parse_history_date(c: Column) -> Column:
    """Eight digits to ISO text. Only digits are checked, not the calendar."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]{8}$"), F.concat_ws(
        "-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))


def parse_fixture_date(c: Column, fallback: Column | None = None) -> Column:
    """ISO or eight digits as they stand; longer text by its first ten characters."""
    t = F.nullif(F.trim(c), F.lit(""))
    if fallback is not None:
        t = F.coalesce(t, fallback)
    return (F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t)
            .when(t.rlike(r"^\d{8}$"), parse_history_date(t))
            .otherwise(F.date_format(F.try_to_timestamp(F.substring(t, 1, 10), F.lit("yyyy-MM-dd")),
                                     "yyyy-MM-dd")))


def parse_birth_date(c: Column) -> Column:
    """YYYYMMDD with no zero part."""
    t = F.trim(c)
    ok = t.rlike("^[0-9]{8}$") & (F.substring(t, 1, 4) != "0000") & (
        F.substring(t, 5, 2) != "00") & (F.substring(t, 7, 2) != "00")
    return F.when(ok, parse_history_date(t))


def birth_year(c: Column) -> Column:
    """Year of day, month and year between dots, slashes or dashes, or of a text starting with the year."""
    dotted = F.regexp_extract(c, r"^\s*\d{1,2}[./-]\d{1,2}[./-](\d{4})\s*$", 1)
    leading = F.regexp_extract(c, r"^\s*(\d{4})", 1)
    return F.coalesce(F.nullif(dotted, F.lit("")), F.nullif(leading, F.lit(""))).cast("int")


def country_code(value: Column, code_of_name: Column) -> Column:
    """Three letters are a code already; other texts go by the name's code; blank is blank."""
    text = F.upper(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(text == "", "").when(text.rlike(r"^\p{L}{3}$"), text).otherwise(F.coalesce(code_of_name, F.lit("")))


def safe_double(c: Column) -> Column:
    v = F.trim(c.cast("string")).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def safe_long(c: Column) -> Column:
    """Number cut towards zero."""
    return safe_double(c).cast("bigint")


def safe_long_or_zero(c: Column) -> Column:
    return F.coalesce(safe_long(c), F.lit(0).cast("bigint"))


def rounded(c: Column, digits: int) -> Column:
    """Half-up at a fixed number of digits, the same on every engine."""
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def share(part: Column, whole: Column, digits: int = 6) -> Column:
    """Rounded ratio; NULL over nothing. Scaled before dividing, so exact ties stay ties."""
    scale = float(10 ** digits)
    scaled = part.cast("double") * F.lit(scale) / whole.cast("double")
    return F.when(whole != 0, F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(scale))


# --- player keys -----------------------------------------------------------
def player_key(gender: Column, source: str, player_id: Column, fallback_name: Column) -> Column:
    blank = player_id.isNull() | (player_id == "")
    return F.when(blank, F.concat_ws(":", gender, F.lit("name"), fallback_name)).otherwise(
        F.concat_ws(":", gender, F.lit(source), player_id))


def key_gender(key: Column) -> Column:
    return F.nullif(F.regexp_extract(key, "^(men|women):", 1), F.lit(""))


def bare_api_id(key: Column) -> Column:
    """Id without a gender and feed prefix."""
    return F.regexp_replace(F.trim(key), "^(men|women):api(_[a-z]+)?:", "")


def api_key_variants(key: Column, gender: Column) -> Column:
    """Lookup spellings of one key in order of priority."""
    bare = bare_api_id(key)
    return F.array_distinct(F.array(
        key, bare, F.concat_ws(":", gender, F.lit(K.FIXTURE_FEED), bare),
        F.concat_ws(":", gender, F.lit(K.FIXTURE_FEED_LONG), bare)))


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


# --- score arrays ----------------------------------------------------------
def set_game_totals(scores: Column, first: Column) -> Column:
    """Sets and games for and against one side of ``array<struct<a, b>>``."""
    mine = lambda s: F.when(first, s["a"]).otherwise(s["b"])
    other = lambda s: F.when(first, s["b"]).otherwise(s["a"])
    return F.struct(
        F.size(F.filter(scores, lambda s: mine(s) > other(s))).alias("sets_for"),
        F.size(F.filter(scores, lambda s: mine(s) < other(s))).alias("sets_against"),
        F.aggregate(scores, F.lit(0).cast("bigint"), lambda t, s: t + mine(s)).alias("games_for"),
        F.aggregate(scores, F.lit(0).cast("bigint"), lambda t, s: t + other(s)).alias("games_against"),
    )


def score_text(result: Column, scores: Column) -> Column:
    """Final result, else the set scores joined."""
    joined = F.array_join(F.transform(scores, lambda s: F.concat_ws(
        "-", s["a"].cast("string"), s["b"].cast("string"))), " ")
    return F.coalesce(F.nullif(F.trim(result), F.lit("")), joined, F.lit(""))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The table with further columns that are computed once a row: the optimiser puts no filter, and so no copy of them, below a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
