"""Checks that count findings instead of stopping a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K


def findings(df: DataFrame, keep: list[str], checks: dict[str, Column]) -> DataFrame:
    """One row per row and failed check."""
    labels = F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()])
    return df.select(*keep, F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("issue"))


def rating_summary(matches: DataFrame) -> DataFrame:
    sides = matches.select("gender", F.explode(F.array("winner_key", "loser_key")).alias("player_key"))
    players = sides.groupBy("gender").agg(F.countDistinct("player_key").alias("n"))
    cells = matches.groupBy("gender", "level", (F.col("surface") == "unknown").alias("no_surface")).agg(
        F.count("*").alias("n"))
    parts = [
        players.select(F.lit("players").alias("what"), F.col("gender").alias("part"), "n"),
        cells.groupBy(F.col("gender").alias("part")).agg(F.sum("n").alias("n"))
        .select(F.lit("processed").alias("what"), "part", "n"),
        cells.groupBy(F.col("level").alias("part")).agg(F.sum("n").alias("n"))
        .select(F.lit("processed_level").alias("what"), "part", "n"),
        cells.where("no_surface").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        .select(F.lit("unknown_surface").alias("what"), F.lit("all").alias("part"), "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


def rating_findings(players: DataFrame, low: float = K.RATING_MIN, high: float = K.RATING_MAX) -> DataFrame:
    """Per player: domain, prefix, name, counts, finite and plausible ratings, keys and sums that must agree.

    ``severity`` is a warning where sums of counts differ (matches without a surface do that), else fatal.
    """
    total = lambda c: F.aggregate(F.map_values(c), F.lit(0).cast("bigint"), lambda a, x: a + x)
    all_values = F.concat(F.array("overall"), *[F.map_values(c) for c in ("level", "surface", "level_surface")])
    key_sets_differ = reduce(lambda a, b: a | b, [
        F.array_sort(F.map_keys(c)) != F.array_sort(F.map_keys(f"{c}_matches"))
        for c in ("level", "surface", "level_surface")])
    bad_key = lambda c, allowed: F.exists(F.map_keys(c), lambda k: ~k.isin(*allowed))
    sums = {c: total(f"{c}_matches") for c in ("level", "surface", "level_surface")}
    pair = lambda i: F.transform(F.filter(F.map_keys("level_surface"), lambda k: k.contains("|")), lambda k: F.split_part(k, F.lit("|"), F.lit(i)))
    counts = F.concat(F.array("matches"), *[F.map_values(f"{c}_matches") for c in ("level", "surface", "level_surface")])
    found = findings(players, ["player_key"], {
        "invalid_gender": ~F.col("gender").isin(*K.GENDERS),
        "key_prefix_differs": ~F.col("player_key").startswith(F.concat("gender", F.lit(":"))),
        "missing_name": F.coalesce(F.trim("name"), F.lit("")) == "",
        "rating_not_finite": F.exists(all_values, lambda v: F.isnan(v) | (F.abs(v) == float("inf"))),
        "rating_out_of_range": F.exists(all_values, lambda v: (v < low) | (v > high)),
        "invalid_level": bad_key("level", K.LEVELS), "invalid_surface": bad_key("surface", K.SURFACES),
        "zero_matches": F.col("matches") == 0, "negative_count": F.exists(counts, lambda n: n < 0),
        "invalid_level_surface_key": F.exists(F.map_keys("level_surface"), lambda k: ~k.contains("|")),
        "invalid_level_surface_level": F.exists(pair(1), lambda k: ~k.isin(*K.LEVELS)),
        "invalid_level_surface_surface": F.exists(pair(2), lambda k: ~k.isin(*K.SURFACES)),
        "count_keys_differ": key_sets_differ,
        "level_sum_differs": sums["level"] != F.col("matches"),
        "surface_sum_above_matches": sums["surface"] > F.col("matches"),
        "surface_sum_below_matches": sums["surface"] < F.col("matches"),
        "level_surface_sum_differs": sums["level_surface"] != sums["surface"],
        "level_surface_sum_not_matches": sums["level_surface"] != F.col("matches"),
    })
    return found.withColumn("severity", F.when(F.col("issue").contains("_sum_"), "warning").otherwise("fatal"))
