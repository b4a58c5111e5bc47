"""Pre-match predictions without look-ahead, read from the ladder steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions.rating import elo_expected, sample_aware_weight, slam_component, weighted_blend
from rallyframe.functions.values import rounded

MODELS = ("level_only", "surface_only", *K.BLENDS, "sample_aware")


def prematch_wide(steps: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per match with the state of both sides on the ladders that count for it.

    The steps of a match are folded to one row by an aggregate on its id, then joined with
    the match on the same key: one shuffle of the steps serves both.
    """
    own_level = (F.col("layer") == "level") & ~F.col("probe")
    tour = (F.col("layer") == "level") & F.col("probe")
    on = {"overall": F.col("layer") == "overall", "level": own_level, "surface": F.col("layer") == "surface",
          "tour": tour}
    columns = [
        F.max(F.when(test, F.col(f"{side}_{what}"))).alias(f"{side}_{name}_{what}")
        for name, test in on.items() for side in ("winner", "loser") for what in ("rating", "n")]
    wide = steps.groupBy("seq").agg(*columns)
    return matches.join(wide, "seq")


def level_state(frame: DataFrame) -> DataFrame:
    """Adds the level rating and count of each side; slam matches blend in the tour ladder."""
    slam = F.col("level") == "grand_slam"
    out = frame
    for side in ("winner", "loser"):
        s = lambda name, side=side: F.col(f"{side}_{name}")
        blended = slam_component(s("level_rating"), s("level_n"), s("tour_rating"), s("tour_n"))
        out = (out.withColumn(f"{side}_component", F.when(slam, blended).otherwise(s("level_rating")))
               .withColumn(f"{side}_component_n", F.when(slam, s("level_n") + s("tour_n")).otherwise(s("level_n"))))
    return out


def predict(frame: DataFrame) -> DataFrame:
    """Six win probabilities of the side that went on to win."""
    known = F.col("surface").isin(*K.SURFACES)
    f = level_state(frame)
    weight = sample_aware_weight(F.col("winner_surface_n"), F.col("loser_surface_n"))

    def blended(level_w, surface_w) -> Column:
        both = [weighted_blend(F.col(f"{s}_component"), F.col(f"{s}_surface_rating"), level_w, surface_w)
                for s in ("winner", "loser")]
        return F.when(known, rounded(elo_expected(*both), 8))

    return f.select(
        "*",
        F.coalesce("winner_surface_n", F.lit(0)).alias("winner_surface_matches"),
        F.coalesce("loser_surface_n", F.lit(0)).alias("loser_surface_matches"),
        rounded(elo_expected(F.col("winner_component"), F.col("loser_component")), 8).alias("prob_level_only"),
        F.when(known, rounded(elo_expected(F.col("winner_surface_rating"), F.col("loser_surface_rating")), 8))
        .alias("prob_surface_only"),
        *[blended(lw, sw).alias(f"prob_{name}") for name, (lw, sw) in K.BLENDS.items()],
        F.when(known, weight).alias("sample_aware_surface_weight"),
        blended(F.lit(1.0) - weight, weight).alias("prob_sample_aware"),
    )


def match_index(matches: DataFrame, day: str = "match_date", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Global position without a single-partition window over the rows.

    Rows are range partitioned on the full order key, numbered inside a partition, and moved
    by the partition's offset; only the table of partition sizes is ordered in one place.
    """
    from pyspark.sql import Window

    from rallyframe.workspace import materialise

    # written once, so that partition numbers cannot change between the two uses below
    parts = materialise(matches.repartitionByRange(day, *order).withColumn("part", F.spark_partition_id()),
                        "match-index", "part")
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(day, *order))
    return (parts.withColumn("inside", inside).join(F.broadcast(offsets), "part")  # one row per partition
            .withColumn("match_index", F.col("offset") + F.col("inside")).drop("part", "offset", "inside"))


def overall_support(ratings: DataFrame) -> DataFrame:
    """The scan's overall rating: level ratings weighted by their counts."""
    level = F.col("layer") == "level"
    return (
        ratings.where(level & (F.col("n") > 0)).groupBy("player_key")
        .agg((F.sum(F.col("rating") * F.col("n")) / F.sum("n")).alias("support_rating"),
             F.sum("n").alias("support_n")))
