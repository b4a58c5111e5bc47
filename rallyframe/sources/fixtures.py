"""Daily fixture documents, tournament documents, caches and refresh lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.functions.classify import has_any, is_doubles, is_qualification, piped_text, surface_words
from rallyframe.functions.text import blank_to_null, clean_ws, first_nonempty

# fixed values: fields that hold a surface where event_surface is blank, in their order
OTHER_SURFACE_FIELDS = ("surface", "tournament_surface", "tournament_sourface", "league_surface", "court_surface", "court_type")
FIXTURE_FIELDS = (
    "event_key", "event_date", "event_time", "event_type_type", "event_status", "event_live",
    "event_qualification", "event_winner", "event_final_result", "event_first_player", "event_second_player",
    "first_player_key", "second_player_key", "tournament_key", "tournament_name", "tournament_round",
    "league_key", "league_name", "event_name",
    "event_surface", *OTHER_SURFACE_FIELDS)
FIXTURE_TYPE = "struct<" + ", ".join(f"{f}: string" for f in FIXTURE_FIELDS) + (
    ", scores: array<struct<score_set: string, score_first: string, score_second: string>>>")
# fixed values: keys a list of fixtures may stand under, and status words
LIST_KEYS = ("result", "fixtures", "events", "data", "matches")
FINAL_WORDS = ("finished", "finish", "ended", "complete", "completed", "closed", "cancelled", "canceled",
               "retired", "walkover", "w/o", "wo", "abandoned", "void")
NOT_FINAL_WORDS = ("not started", "scheduled", "pending", "postponed", "suspended", "interrupted", "live",
                   "in progress", "set", "rain", "delayed", "unknown")


def _is_object(c: Column) -> Column:
    return F.substring(F.trim(c), 1, 1) == "{"


def _as(kind: str, v: Column, path: str = "$") -> Column:
    """Part of a variant, NULL where it is missing, JSON null or of another kind."""
    part = F.try_variant_get(v, path, kind)
    return F.when(~F.is_variant_null(part), part) if kind == "variant" else part


def _listed(v: Column) -> Column:
    return _as("array<variant>", v)


def _keyed(v: Column) -> Column:
    return _as("map<string,variant>", v)


def payload_items(payloads: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(*keep, items): the objects of a document of unknown shape, as variants.

    A document is a list, an object of rows, an object of lists, or any of them below
    ``response`` or one of the list keys. It is parsed once; every later step walks the result.
    """
    below = lambda c: F.coalesce(*[_as("variant", F.col(c), f"$.{k}") for k in LIST_KEYS])
    inner = _as("variant", F.col("doc"), "$.response")
    steps = payloads.select(*keep, F.try_parse_json("payload").alias("doc"))
    steps = steps.select(*keep, F.when(_keyed(inner).isNotNull(), inner).otherwise(F.col("doc")).alias("body"))
    steps = steps.select(*keep, "body", _listed(F.col("body")).alias("top"), below("body").alias("below"))
    steps = steps.select(*keep, "top", F.when(F.col("top").isNull(), F.coalesce(below("below"), "below", "body")).alias("rows"))
    listed, values = _listed(F.col("rows")), F.map_values(_keyed(F.col("rows")))
    spread = F.flatten(F.transform(values, lambda v: F.coalesce(_listed(v), F.array(v))))
    return steps.select(*keep, F.coalesce("top", listed, spread).alias("items"))


def explode_fixtures(payloads: DataFrame, keep: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """One row per fixture of each document."""
    objects = F.filter("items", lambda x: _keyed(x).isNotNull())
    return (payload_items(payloads, keep).select(*keep, F.posexplode(objects).alias("raw_index", "item"))
            .select(*keep, "raw_index", F.try_variant_get("item", "$", FIXTURE_TYPE).alias("f"))
            .select(*keep, "raw_index", "f.*"))


MOST_LEVELS = 1000   # Spark's variants nest no deeper


def document_audit(payloads: DataFrame, keep: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """Per document: what became of it, and its fixtures.

    ``read``, ``no_fixtures`` (nothing that is an object), ``blank``, ``too_deep`` (it opens more than
    ``MOST_LEVELS`` lists and objects and cannot be read) or ``not_json``; only what is read yields fixtures.
    """
    objects = F.filter("items", lambda x: _keyed(x).isNotNull())
    opened = F.length(F.regexp_replace(F.regexp_replace("payload", r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[{]", ""))
    said = payloads.withColumns({"_blank": F.coalesce(F.trim("payload"), F.lit("")) == "", "_parsed": F.try_parse_json("payload").isNotNull(), "_opened": opened})
    found = payload_items(said, (*keep, "_blank", "_parsed", "_opened")).withColumn("fixtures", F.coalesce(F.size(objects), F.lit(0)).cast("bigint"))
    status = (F.when(F.col("_blank"), "blank").when(~F.col("_parsed"), F.when(F.col("_opened") > MOST_LEVELS, "too_deep").otherwise("not_json"))
              .when(F.col("fixtures") > 0, "read").otherwise("no_fixtures"))
    return found.select(*keep, status.alias("status"), F.when(status == "read", F.col("fixtures")).otherwise(0).alias("fixtures"))


# --- refresh lists ---------------------------------------------------------
def is_final(status: Column, winner: Column, score: Column) -> Column:
    text = clean_ws(F.translate(F.lower(F.coalesce(status, F.lit(""))), "_-", "  "))
    shows_result = blank_to_null(winner).isNotNull() | F.coalesce(score, F.lit("")).rlike("[0-9]")
    return ~has_any(text, NOT_FINAL_WORDS) & (has_any(text, FINAL_WORDS) | shows_result)


def days_to_refresh(days: DataFrame, fixtures: DataFrame, today: str, recent_days: int = 3) -> DataFrame:
    """Skip landed days that are final and older than the recent window. An empty day counts as final."""
    final = is_final(F.col("event_status"), F.col("event_winner"), F.col("event_final_result"))
    state = fixtures.groupBy("day").agg(F.bool_and(final).alias("final"))
    cutoff = F.date_sub(F.to_date(F.lit(today)), max(recent_days - 1, 0))
    reason = (F.when(~F.col("landed"), "missing_existing_file")
              .when(F.to_date("day") >= cutoff, "inside_recent_refresh_window")
              .when(F.coalesce("final", F.lit(True)), "existing_day_finalized")
              .otherwise("existing_day_not_finalized"))
    return (days.join(state, "day", "left").select("day", reason.alias("reason"))
            .withColumn("skip", F.col("reason") == "existing_day_finalized"))


def ids_to_refresh(fixtures: DataFrame, cache: DataFrame) -> DataFrame:
    """Singles players without a cache row or without a full name in it."""
    text = piped_text(F.col("event_type_type"), F.col("tournament_name"))
    singles = fixtures.where(~is_doubles(text, F.col("event_first_player"), F.col("event_second_player")))
    ids = singles.select(F.explode(F.array("first_player_key", "second_player_key")).alias("player_key")).where(
        blank_to_null(F.col("player_key")).isNotNull()).distinct()
    complete = cache.where(blank_to_null(F.col("player_full_name")).isNotNull())
    return ids.join(complete, "player_key", "left_anti")


# --- side documents --------------------------------------------------------
def read_mapping(docs: DataFrame) -> DataFrame:
    """(key, JSON value) rows; a value is an object, a plain target, or null."""
    v = F.trim("value")
    is_null = v.isNull() | v.isin("", "null")
    field = lambda name: F.when(_is_object(v), F.nullif(F.get_json_object(v, f"$.{name}"), F.lit("")))
    target = F.coalesce(field("target_key"), field("canonical_key"), field("target"),
                        F.when(~_is_object(v) & ~is_null, F.trim(F.translate(v, '"', ""))))
    status = F.coalesce(field("status"), F.when(target.isNotNull(), "mapped").otherwise("unmapped"))
    return docs.select("key", target.alias("target_key"), status.alias("status"))


def lookup_cache(queries: DataFrame, cache: DataFrame) -> DataFrame:
    """Cache row of each queried key: exact key first, then the same id, same gender preferred.

    ``queries``: key, gender, bare_id. ``cache``: cache_key, cache_gender, bare_id, value.
    """
    hits = queries.join(cache, "bare_id", "left")
    rank = (F.when(F.col("cache_key") == F.col("key"), 0)
            .when(F.col("cache_gender") == F.col("gender"), 1)
            .when(F.col("cache_key").isNotNull(), 2))
    # a minimum per key combines on the map side, so a hot id does not pile up in one task
    best = F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), "cache_key", "value")))
    return hits.groupBy("key").agg(best.alias("b")).select(
        "key", F.col("b.cache_key").alias("cache_key"), F.col("b.value").alias("value"),
        F.col("b.rank").alias("match_rank"))


def tournament_maps(tournaments: DataFrame) -> DataFrame:
    """Per tournament key: surface, normalised name, and whether it marks a qualification event."""
    raw = first_nonempty(F.col("tournament_sourface"))
    surface = surface_words(F.coalesce(raw, F.lit("")))
    name = clean_ws(F.translate(F.lower(F.coalesce("tournament_name", F.lit(""))), "-_", "  "))
    text = F.concat_ws(" ", "tournament_name", "event_type_type")
    return tournaments.where(blank_to_null(F.col("tournament_key")).isNotNull()).select(
        "tournament_key", F.nullif(surface, F.lit("unknown")).alias("map_surface"), name.alias("map_name"),
        is_qualification(text).alias("is_qualification"))


def clean_surface_map(rows: DataFrame) -> DataFrame:
    """Text -> surface pairs with a non-blank key and a real surface."""
    key = clean_ws(F.translate(F.lower(F.coalesce("text", F.lit(""))), "-_", "  "))
    surface = surface_words(F.col("surface"))
    return (rows.select(key.alias("map_key"), surface.alias("map_value"))
            .where((F.col("map_key") != "") & (F.col("map_value") != "unknown")).distinct())
