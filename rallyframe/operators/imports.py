"""Import waterfalls: every row is kept or gets the first reason that applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import classify as C
from rallyframe.functions import text as T
from rallyframe.functions import values as V
from rallyframe.operators.cuts import grouped_cuts
from rallyframe.sources.fixtures import OTHER_SURFACE_FIELDS


def _no_surface() -> Column:
    return (F.col("surface") == "unknown") & ~F.col("level").isin(*K.LEVELS_WITHOUT_SURFACE_RULE)


def waterfall(rules: list[tuple[str, Column]]) -> Column:
    """First rule that holds names the reason; NULL keeps the row."""
    return C.first_match([(name, F.coalesce(test, F.lit(False))) for name, test in rules],
                         F.lit(None).cast("string"))


def import_history(raw: DataFrame) -> DataFrame:
    """History lines with normalised columns and ``skip_reason``."""
    named = (
        raw.withColumn("raw_surface", F.col("surface")).withColumn("raw_level", F.col("tourney_level"))
        .withColumn("date", V.parse_history_date(F.col("tourney_date")))
        .withColumn("level", C.level_from_code(F.col("tourney_level"), F.col("tourney_name"), F.col("round"),
                                               F.col("level_hint"), F.col("source_name")))
        .withColumn("surface", C.surface_exact(F.col("surface"))))
    reason = waterfall([
        ("missing_or_invalid_date", F.col("date").isNull()),
        ("missing_player_name", (F.coalesce("winner_name", F.lit("")) == "") | (F.coalesce("loser_name", F.lit("")) == "")),
        ("unknown_surface_not_allowed", _no_surface()),
    ])
    key = lambda s: V.player_key(F.col("gender"), K.HISTORY_FEED, F.col(f"{s}_id"),
                                 T.normalize_name(F.col(f"{s}_name"), "_"))
    return named.select(
        "*", reason.alias("skip_reason"), F.substring("date", 1, 4).cast("int").alias("year"),
        F.concat_ws(":", F.lit(K.HISTORY_FEED), "gender", "tourney_id", "match_num", "winner_id", "loser_id")
        .alias("match_id"), key("winner").alias("winner_key"), key("loser").alias("loser_key"))


# --- fixtures --------------------------------------------------------------
def resolve_surface(fixtures: DataFrame, tournaments: DataFrame) -> DataFrame:
    """Own fields in order, metadata of the tournament (else of the league), then a guess from the names; with its provenance."""
    raw = F.coalesce(T.first_nonempty(*[F.col(c) for c in ("event_surface", *OTHER_SURFACE_FIELDS) if c in fixtures.columns]), F.lit(""))
    meta = tournaments.select(
        F.col("tournament_key").alias("meta_key"), F.col("tournament_sourface").alias("meta_raw"),
        F.nullif(C.surface_substring(F.col("tournament_sourface")), F.lit("unknown")).alias("meta_surface"))
    own = F.nullif(C.surface_substring(raw), F.lit("unknown"))
    have = lambda *columns: [F.col(c) for c in columns if c in fixtures.columns]
    names = C.piped_text(*have("league_name", "tournament_name", "event_name"))
    guess = F.nullif(C.surface_substring(names), F.lit("unknown"))
    own_key = T.first_nonempty(*have("tournament_key", "league_key"))
    return fixtures.join(meta, own_key == F.col("meta_key"), "left").select(
        *fixtures.columns, F.coalesce(own, "meta_surface", guess, F.lit("unknown")).alias("surface"),
        F.when(own.isNotNull(), raw)
        .when(F.col("meta_surface").isNotNull(), F.concat(F.lit("tournament_metadata:"), "meta_raw"))
        .when(guess.isNotNull(), F.concat(F.lit("name_guess:"), names))
        .otherwise(raw).alias("surface_source"))


def enrich_names(fixtures: DataFrame, cache: DataFrame) -> DataFrame:
    """Full name of the cache, else its short name, else the fixture's own."""
    out = fixtures
    for side in ("first", "second"):
        hit = cache.select(
            F.col("player_key").alias(f"{side}_player_key"),
            T.blank_to_null(F.col("player_full_name")).alias("full"),
            T.blank_to_null(F.col("player_name")).alias("short"))
        out = out.join(hit, f"{side}_player_key", "left").select(
            *out.columns, F.coalesce("full", "short", T.clean_ws(F.col(f"event_{side}_player"))).alias(f"{side}_name"),
            F.when(F.col("full").isNotNull(), "cache_full_name").when(F.col("short").isNotNull(), "cache_short_name")
            .otherwise("fixture").alias(f"{side}_name_source"))
    return out


def import_fixtures(fixtures: DataFrame, tournaments: DataFrame, cache: DataFrame) -> DataFrame:
    """Fixtures with normalised columns and ``skip_reason``; duplicates are a later step."""
    piped = C.piped_text(F.col("tournament_name"), F.col("event_type_type"), F.col("tournament_round"))
    fallback = F.nullif(F.regexp_extract("source_file", r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))
    f = enrich_names(resolve_surface(fixtures, tournaments), cache)
    f = (f.withColumn("date", V.parse_fixture_date(F.col("event_date"), fallback))
         .withColumn("gender", C.gender_from_text(piped))
         .withColumn("level", C.level_from_text(piped, C.gender_from_text(piped)))
         .withColumn("side", C.winner_side(F.col("event_winner"), F.col("first_player_key"),
                                           F.col("second_player_key"), F.col("first_name"), F.col("second_name"))))
    reason = waterfall([
        ("missing_or_invalid_date", F.col("date").isNull()),
        ("doubles_or_team_match", C.is_doubles(piped, F.col("event_first_player"), F.col("event_second_player"))),
        ("not_finished", ~C.is_finished(F.col("event_status"), F.col("event_winner"), F.col("event_final_result"))),
        ("unknown_gender", F.col("gender") == "unknown"),
        ("missing_player_name", (F.col("first_name") == "") | (F.col("second_name") == "")),
        ("missing_or_unresolved_winner", F.col("side").isNull()),
        ("unknown_level", F.col("level") == "unknown"),
        ("unknown_surface_not_allowed", _no_surface()),
    ])
    won = F.col("side") == "first"
    pick = lambda a, b: F.when(won, F.col(a)).otherwise(F.col(b))
    f = f.select(
        "*", reason.alias("skip_reason"), pick("first_name", "second_name").alias("winner_name"),
        pick("second_name", "first_name").alias("loser_name"),
        pick("first_player_key", "second_player_key").alias("winner_id"),
        pick("second_player_key", "first_player_key").alias("loser_id"))
    key = lambda s: V.player_key(F.col("gender"), K.FIXTURE_FEED, F.col(f"{s}_id"), T.slug(F.col(f"{s}_name")))
    return f.select(
        "*", key("winner").alias("winner_key"), key("loser").alias("loser_key"),
        C.stable_fixture_key(F.col("event_key"), F.col("date"), F.col("tournament_key"), F.col("tournament_round"),
                             F.col("winner_name"), F.col("loser_name"), F.col("event_final_result"))
        .alias("stable_key"),
        F.concat_ws("|", "gender", "date", T.slug(F.col("tournament_name")), T.slug(F.col("tournament_round")),
                    T.slug(F.col("winner_name")), T.slug(F.col("loser_name"))).alias("hint_key"))


def mark_duplicates(rows: DataFrame, key: str, order: list[str], first_as: str = "source_file") -> DataFrame:
    """Adds ``is_first`` and the ``first_<column>`` of the row that came first with the same key.

    The first row of a key is a minimum, which combines before the shuffle; joining it back
    lets adaptive execution split a key that holds a large share of the rows.
    """
    first = rows.groupBy(key).agg(F.min(F.struct(*order, F.col(first_as).alias("_shown"))).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_first.{c}")) for c in order]
    is_first = same[0]
    for test in same[1:]:
        is_first = is_first & test
    return rows.join(first, key).select(
        *rows.columns, is_first.alias("is_first"), F.col("_first._shown").alias(f"first_{first_as}"))


def skip_summary(skipped: DataFrame) -> DataFrame:
    """Counts by reason, by file and reason, and by level and surface from one aggregate."""
    cells = skipped.groupBy("skip_reason", "source_file", "level", "surface").agg(F.count("*").alias("n"))
    cuts = {"reason": ["skip_reason"], "file_reason": ["source_file", "skip_reason"], "level_surface": ["level", "surface"]}
    return grouped_cuts(cells, cuts, [F.sum("n").alias("rows")]).select("cut", "skip_reason", "source_file", "level", "surface", "rows")


def source_file_audit(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per file and column: how often each value occurs, blanks shown as such."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("<blank>")).alias("value"))
        for c in columns])
    return (rows.select("source_file", F.explode(entries).alias("e"))
            .groupBy("source_file", F.col("e.column").alias("column"), F.col("e.value").alias("value"))
            .agg(F.count("*").alias("rows")))


def invalid_reason() -> Column:
    """Reason a normalised match cannot enter the canonical table."""
    return waterfall([
        ("invalid_gender", ~F.col("gender").isin(*K.GENDERS)),
        ("invalid_level", ~F.col("level").isin(*K.LEVELS)),
        ("invalid_surface", ~F.col("surface").isin(*K.SURFACES, "unknown")),
        ("invalid_date", ~F.coalesce(F.col("date").cast("string"), F.lit("")).rlike(r"^\d{4}-\d{2}-\d{2}$")),
        ("missing_player_key", (F.coalesce("winner_key", F.lit("")) == "") | (F.coalesce("loser_key", F.lit("")) == "")),
        ("winner_loser_same_player_key", F.col("winner_key") == F.col("loser_key")),
    ])


def correct_surfaces(matches: DataFrame, corrections: DataFrame) -> DataFrame:
    """Keyed override of a wrong surface (tournament, event type, year)."""
    fix = corrections.select("tournament_key", "event_type_type", "year", F.col("surface").alias("_surface"))
    return matches.join(fix, ["tournament_key", "event_type_type", "year"], "left").select(
        *[c for c in matches.columns if c != "surface"],
        F.coalesce("_surface", "surface").alias("surface"), F.col("_surface").isNotNull().alias("surface_corrected"))
