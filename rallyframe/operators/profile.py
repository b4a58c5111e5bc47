"""Profiles of raw JSON records and of normalised matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import text as T
from rallyframe.functions.json_tree import json_leaves
from rallyframe.functions.values import share

# fixed values: words in a path that put it into a group
GROUP_HINTS = (("surface_like", ("surface", "sourface", "court", "ground")), ("tournament_like", ("tournament", "league", "event_type")),
               ("status_like", ("status", "live", "winner", "result")), ("player_like", ("player", "first_", "second_")))
SHOWN = 200   # characters of a value in the report; counting takes whole values
SURFACE_WORDS = ("hard", "clay", "grass", "carpet", "court", "surface")


def field_group(path: Column) -> Column:
    out = F.lit("other")
    for name, words in reversed(GROUP_HINTS):
        out = F.when(F.lower(path).rlike("|".join(words)), name).otherwise(out)
    return out


def shown(value: Column) -> Column:
    return F.when(value.isNull(), "<null>").when(F.trim(value) == "", "<blank>").otherwise(F.trim(value))


def path_values(records: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per record and path; list positions are folded so that paths stay few."""
    return records.select("record", F.explode(json_leaves(F.col(raw))).alias("e")).select(
        "record", F.regexp_replace("e.path", r"\[\d+\]", "[]").alias("path"), F.col("e.value").alias("value"))


def json_field_profile(records: DataFrame, raw: str = "raw", top: int = 3) -> DataFrame:
    """Per path: group, presence, coverage, and the most common whole values (shown up to SHOWN characters) with exact counts."""
    from pyspark.sql import Window

    from rallyframe.workspace import materialise

    rows = materialise(path_values(records, raw).select("record", "path", shown(F.col("value")).alias("value")), "paths")
    total = records.agg(F.count("*").alias("total"))
    presence = rows.groupBy("path").agg(F.count("*").alias("presence"), F.countDistinct("record").alias("records"))
    counts = rows.groupBy("path", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("path").orderBy(F.desc("n"), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    texts = F.array_sort(F.collect_list(F.struct("rank", F.concat_ws("=", F.substring("value", 1, SHOWN), F.col("n").cast("string")).alias("t"))))
    tops = best.groupBy("path").agg(F.array_join(F.transform(texts, lambda x: x["t"]), ",").alias("top_values"))
    return (presence.join(tops, "path").crossJoin(F.broadcast(total))  # one row
            .select("path", field_group(F.col("path")).alias("field_group"), "presence", "records",
                    share(F.col("records") * 100, F.col("total"), 2).alias("coverage_pct"), "top_values"))


def hint_scan(records: DataFrame, patterns: list[str], raw: str = "raw") -> DataFrame:
    """Per record: paths or values that mention a surface, whether any does, and text pattern hits."""
    records = records.select("record", raw, json_leaves(F.col(raw)).alias("leaves"))
    hinted = F.filter("leaves", lambda e: F.lower(e["path"]).rlike("surface|sourface|court")
                      | F.lower(F.coalesce(e["value"], F.lit(""))).rlike("|".join(SURFACE_WORDS)))
    filled = F.filter(hinted, lambda e: F.trim(F.coalesce(e["value"], F.lit(""))) != "")
    return records.select(
        "record", F.size(hinted).cast("bigint").alias("hint_hits"), (F.size(filled) == 0).alias("no_surface"),
        *[F.lower(F.col(raw)).contains(p.lower()).alias(f"mentions_{p}") for p in patterns])


def match_source_findings(matches: DataFrame) -> DataFrame:
    """Severity and issue per match row; repeated ids come from counts per key, not from memory."""
    def repeated(df: DataFrame, column: str) -> DataFrame:
        first = df.where(F.coalesce(column, F.lit("")) != "").groupBy(column).agg(F.min("seq").alias(f"_{column}"))
        return df.join(first, column, "left").withColumn(f"dup_{column}", F.col(f"_{column}") < F.col("seq")).drop(f"_{column}")

    m = matches
    for column in ("match_id", "event_key", "hint_key"):
        m = repeated(m, column)
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    yes = lambda c: F.coalesce(c, F.lit(False))
    same_name = T.slug(F.col("winner_name")) == T.slug(F.col("loser_name"))
    checks = [
        ("error", "missing_match_id", blank("match_id")), ("error", "duplicate_match_id", yes(F.col("dup_match_id"))),
        ("error", "duplicate_event_key", yes(F.col("dup_event_key"))), ("warning", "missing_event_key", blank("event_key")),
        ("error", "invalid_date", ~F.coalesce("date", F.lit("")).rlike(r"^\d{4}-\d{2}-\d{2}$")),
        ("error", "invalid_gender", ~F.col("gender").isin(*K.GENDERS)), ("error", "invalid_level", ~F.col("level").isin(*K.LEVELS)),
        ("error", "invalid_surface", ~F.col("surface").isin(*K.SURFACES, "unknown")),
        ("error", "unknown_surface_not_allowed", (F.col("surface") == "unknown") & ~F.col("level").isin(*K.LEVELS_WITHOUT_SURFACE_RULE)),
        ("error", "missing_player_name", blank("winner_name") | blank("loser_name")),
        ("error", "same_winner_loser_name", ~blank("winner_name") & ~blank("loser_name") & same_name),
        ("error", "missing_player_key", blank("winner_key") | blank("loser_key")),
        ("error", "same_winner_loser_key", ~blank("winner_key") & (F.col("winner_key") == F.col("loser_key"))),
        ("warning", "duplicate_hint_key", yes(F.col("dup_hint_key"))), ("warning", "missing_hint_key", blank("hint_key"))]
    labels = F.array(*[F.when(test, F.struct(F.lit(s).alias("severity"), F.lit(n).alias("issue"))) for s, n, test in checks])
    return m.select("seq", F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("f")).select("seq", "f.severity", "f.issue")


def pipeline_status(source: DataFrame, canonical: DataFrame, players: DataFrame) -> DataFrame:
    """Counts of the three stages side by side."""
    count = lambda df, stage: df.agg(F.count("*").alias("rows")).select(F.lit(stage).alias("stage"), "rows")
    return count(source, "source").unionByName(count(canonical, "canonical")).unionByName(count(players, "ratings"))
