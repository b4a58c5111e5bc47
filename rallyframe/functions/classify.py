"""Gender, surface, level, status and winner classification.

Each classifier is an ordered list of (class, test); the first test that holds decides.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions.text import clean_ws, first_nonempty, slug

# --- fixed values: words and patterns that decide a class ------------------
SLAM_NAMES = ("australian open", "roland garros", "french open", "wimbledon", "us open", "u.s. open",
              "united states open")
SCAN_SLAM_NAMES = ("grand slam", "australian open", "roland garros", "wimbledon", "us open")
ITF_MARKS = (" itf ", "itf ", " itf", "m15", "m25", "m35", "w15", "w25", "w35", "w50", "w75", "w100",
             "w125")
QUALIFYING_MARKS = ("qualification", "qualifying", " qualifiers", " qualifier", " qual ", " qual.",
                    " - q")
TOUR_PATTERN = r"\batp\b|\bwta\b|tour finals|united cup|davis cup|bjk cup|fed cup"
QUALIFICATION_PATTERNS = (
    r"\bqualif(ication|ications|ying|ier|iers)?\b", r"\bpre qual", r"\bqual\.?\b",
    r"\bq(ual)?\s*(1|2|3|r1|r2|r3|round|final)\b")
WOMEN_CODE, MEN_CODE = r"\bw(15|35|50|75|100)\b", r"\bm(15|25)\b"
FINISHED_WORDS = ("finished", "ended", "complete", "completed", "final", "retired", "walkover", "wo",
                  "w/o")
SETTLE_FINISHED = ("finished", "ended", "complete", "completed", "final")
SETTLE_VOID = ("cancel", "canceled", "cancelled", "postpon", "suspend", "interrupt", "abandon",
               "retired", "walkover", "w/o", "wo")
SETTLE_PENDING = ("not started", "not_started", "scheduled", "upcoming", "pending", "live", "inplay",
                  "in play", "set", "break")
SURFACE_ALIASES = {
    "hard": ("hardcourt", "hard court", "outdoor hard", "indoor hard", "synthetic hard", "cement",
             "acrylic", "decoturf", "plexicushion", "greenset"),
    "clay": ("claycourt", "clay court", "outdoor clay", "indoor clay", "red clay", "green clay",
             "har tru"),
    "grass": ("grasscourt", "grass court", "lawn"),
    "carpet": ("carpet court", "indoor carpet"),
}
FIRST_LABELS = ("first player", "first", "1", "home", "event_first_player")
SECOND_LABELS = ("second player", "second", "2", "away", "event_second_player")
SETTLE_FIRST = ("first player", "first", "home", "player 1", "1")
SETTLE_SECOND = ("second player", "second", "away", "player 2", "2")
MEN_TOKENS = ("m", "man", "men", "male", "atp")
WOMEN_TOKENS = ("w", "woman", "women", "female", "wta")


def has_any(text: Column, words) -> Column:
    """One pass over the text for all words; also keeps generated code small."""
    return text.rlike("|".join(re.escape(w) for w in words))


def first_match(rules, otherwise) -> Column:
    """Ordered (label, test) list to one column."""
    out = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    for label, test in reversed(list(rules)):
        out = F.when(test, label).otherwise(out)
    return out


def context_text(*parts: Column) -> Column:
    """Joined lower case text with dashes and underscores as blanks."""
    joined = F.lower(F.concat_ws(" ", *[F.nullif(F.trim(p.cast("string")), F.lit("")) for p in parts]))
    return clean_ws(F.translate(joined, "-_", "  "))


def piped_text(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[F.lower(clean_ws(p)) for p in parts])


# --- gender ----------------------------------------------------------------
def gender_from_text(text: Column) -> Column:
    """Women first: every text with 'women' also contains 'men'."""
    return first_match([("women", text.rlike(r"\bwta\b|women|female|girls")),
                        ("men", text.rlike(r"\batp\b|men|male|boys"))], "unknown")


def gender_from_token(c: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return first_match([("men", t.isin(*MEN_TOKENS)), ("women", t.isin(*WOMEN_TOKENS))], t)


def gender_from_words(text: Column) -> Column:
    """Whole words, plus the prize-money codes."""
    return first_match([("women", text.rlike(r"\b(women|woman|female|wta)\b") | text.rlike(WOMEN_CODE)),
                        ("men", text.rlike(r"\b(men|man|male|atp)\b") | text.rlike(MEN_CODE))], "unknown")


def gender_from_path(path: Column) -> Column:
    p = F.lower(path)
    return first_match([("women", p.contains("wta")), ("men", p.contains("atp"))], "unknown")


# --- surface ---------------------------------------------------------------
def surface_exact(c: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t.isin(*K.SURFACES), t).otherwise("unknown")


def surface_substring(c: Column) -> Column:
    t = F.lower(clean_ws(c))
    return first_match([(s, t.contains(s)) for s in K.SURFACES], "unknown")


def surface_words(c: Column) -> Column:
    t = clean_ws(F.translate(F.lower(F.coalesce(c, F.lit(""))), "_-", "  "))
    exact = [(s, t == s) for s in K.SURFACES]
    alias = [(s, t.isin(*names)) for s, names in SURFACE_ALIASES.items()]
    word = [("hard", t.rlike(r"\bhard\b")), ("clay", t.rlike(r"\bclay\b")),
            ("grass", t.rlike(r"\b(grass|lawn)\b")), ("carpet", t.rlike(r"\bcarpet\b"))]
    return first_match(exact + alias + word, "unknown")


# --- level -----------------------------------------------------------------
def level_from_code(code: Column, name: Column, rnd: Column, hint: Column, source: Column) -> Column:
    c = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    r = F.upper(F.trim(F.coalesce(rnd, F.lit(""))))
    n = F.lower(F.coalesce(name, F.lit("")))
    fallback = F.coalesce(hint, F.when(source.contains("chall"), "challenger").otherwise("itf"))
    return first_match([("grand_slam", c == "G"), ("atp_wta", c.isin("D", "M", "A", "F")),
                        ("challenger", c == "C"), ("qualifying", c == "Q"),
                        ("qualifying", (r == "Q") | n.contains("qual"))], fallback)


def level_from_text(piped: Column, gender: Column) -> Column:
    """Slam names win over qualifying words here."""
    t = F.concat(F.lit(" "), piped, F.lit(" "))
    return first_match([("grand_slam", has_any(t, SLAM_NAMES)), ("qualifying", has_any(t, QUALIFYING_MARKS)),
                        ("challenger", has_any(t, ("challenger", " chall "))), ("itf", has_any(t, ITF_MARKS)),
                        ("atp_wta", gender.isin(*K.GENDERS) & t.rlike(TOUR_PATTERN))], "unknown")


def base_level_from_context(text: Column) -> Column:
    return first_match([
        ("grand_slam", has_any(text, SCAN_SLAM_NAMES)),
        ("challenger", text.contains("challenger") | text.rlike(r"\bch(allenger)?\b")),
        ("itf", text.contains("itf") | text.rlike(MEN_CODE) | text.rlike(WOMEN_CODE)),
        ("atp_wta", has_any(text, ("atp", "wta")))], "unknown")


def level_from_pick(level: Column, event_type: Column, qualification: Column) -> Column:
    """Other level names pass through."""
    t = F.translate(F.lower(F.trim(F.coalesce(level, F.lit("")))), "- ", "__")
    ev = F.lower(F.trim(F.coalesce(event_type, F.lit(""))))
    q = F.lower(F.trim(F.coalesce(qualification, F.lit("")))).isin("1", "true", "yes", "y")
    return first_match([("qualifying", q | has_any(ev, ("qualification", "qualifying"))),
                        ("atp_wta", t.isin("atp_wta", "main_tour", "tour")),
                        ("grand_slam", t.isin("grand_slam", "slam")),
                        ("unknown", t == "")], t)


def level_from_scan(level: Column, event_type: Column, qualification: Column) -> Column:
    """Level of a scan feed: known names, tour names, then words in the level and event text."""
    t = F.translate(F.lower(F.trim(F.coalesce(level, F.lit("")))), "- ", "__")
    ev = F.lower(F.trim(F.coalesce(event_type, F.lit(""))))
    q = F.lower(F.trim(F.coalesce(qualification, F.lit("")))).isin("1", "true", "yes", "y")
    text = F.concat_ws(" ", t, ev)
    return first_match([("qualifying", q | has_any(ev, ("qualification", "qualifying"))),
                        ("atp_wta", t.isin("main_tour", "tour", "atp", "wta", "atp_wta")), ("grand_slam", t.isin("grand_slam", "slam")),
                        ("challenger", t == "challenger"), ("itf", t == "itf"), ("grand_slam", text.contains("grand slam")),
                        ("challenger", text.contains("challenger")), ("itf", text.contains("itf")),
                        ("atp_wta", has_any(text, ("atp", "wta"))), ("unknown", t == "")], t)


def is_qualification(c: Column) -> Column:
    """Never true for quarterfinals."""
    t = clean_ws(F.translate(F.lower(F.coalesce(c, F.lit(""))), "-_", "  "))
    return t.rlike("|".join(QUALIFICATION_PATTERNS))


# --- doubles ---------------------------------------------------------------
def is_doubles(piped: Column, first: Column, second: Column) -> Column:
    pair = F.concat_ws(" | ", first, second).rlike("/| & ")
    return piped.contains("double") | pair


def is_doubles_or_team(piped: Column, first: Column, second: Column) -> Column:
    return is_doubles(piped, first, second) | piped.contains("team")


# --- status and winner -----------------------------------------------------
def is_finished(status: Column, winner: Column, score: Column) -> Column:
    return (has_any(F.lower(clean_ws(status)), FINISHED_WORDS) | first_nonempty(winner).isNotNull()
            | F.coalesce(score, F.lit("")).rlike(r"\d"))


def settle_status(*parts: Column) -> Column:
    """finished, void, pending, unknown, or the text itself."""
    raw = F.trim(F.lower(F.concat_ws(" ", *[F.coalesce(F.trim(p), F.lit("")) for p in parts])))
    return first_match([("unknown", raw == ""), ("finished", has_any(raw, SETTLE_FINISHED)),
                        ("void", has_any(raw, SETTLE_VOID)), ("pending", has_any(raw, SETTLE_PENDING))], raw)


def winner_side(label: Column, first_id: Column, second_id: Column,
                first_name: Column, second_name: Column) -> Column:
    """'first', 'second' or NULL from a label, a code, an id or a name."""
    w = F.lower(clean_ws(label))
    low = lambda c: F.lower(clean_ws(c))
    return first_match([
        ("first", w.isin(*FIRST_LABELS) | (w == low(first_id)) | (w == low(first_name))),
        ("second", w.isin(*SECOND_LABELS) | (w == low(second_id)) | (w == low(second_name))),
        ("first", w.contains("first")), ("second", w.contains("second"))], F.lit(None).cast("string"))


def settle_winner_side(label: Column, winner_key: Column, winner_name: Column, first_key: Column,
                       second_key: Column, first_name: Column, second_name: Column) -> Column:
    """'home', 'away' or NULL; labels, then ids, then names."""
    w = F.lower(F.trim(label))
    n = F.lower(F.trim(winner_name))
    return first_match([
        ("home", w.isin(*SETTLE_FIRST)), ("away", w.isin(*SETTLE_SECOND)),
        ("home", winner_key == first_key), ("away", winner_key == second_key),
        ("home", (n != "") & (n == F.lower(first_name))),
        ("away", (n != "") & (n == F.lower(second_name)))], F.lit(None).cast("string"))


def stable_fixture_key(event_key: Column, date: Column, *parts: Column) -> Column:
    return F.when(F.coalesce(event_key, F.lit("")) != "", F.concat(F.lit("api_event:"), event_key)).otherwise(
        F.concat(F.lit("fallback:"), F.concat_ws("|", date, *[slug(p) for p in parts])))
