"""Model quality: calibration and accuracy cuts, threshold grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions.rating import log_loss, pick_probability, probability_bucket
from rallyframe.functions.values import share
from rallyframe.operators.cuts import grouped_cuts
from rallyframe.operators.predictions import MODELS

SUMS = ("n", "correct", "brier", "loss", "p_sum", "pick_sum")


def model_rows(predictions: DataFrame) -> DataFrame:
    """Long form: one row per match and model that has a probability."""
    entries = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"prob_{m}").alias("p")) for m in MODELS])
    return (
        predictions
        .select("level", "surface",
                F.least("winner_component_n", "loser_component_n").alias("min_level_n"),
                F.least("winner_surface_matches", "loser_surface_matches").alias("min_surface_n"),
                F.explode(F.filter(entries, lambda e: e["p"].isNotNull())).alias("e"))
        .select("level", "surface", "min_level_n", "min_surface_n", "e.model", "e.p"))


def sum_columns() -> list[Column]:
    """Additive parts of every metric. Fixed-point sums do not depend on row order."""
    p = F.col("p")
    exact = lambda c: F.sum(c.cast("decimal(20,12)"))
    return [F.count("*").alias("n"), F.sum((p >= 0.5).cast("bigint")).alias("correct"),
            exact((p - 1) * (p - 1)).alias("brier"), exact(log_loss(p)).alias("loss"),
            exact(p).alias("p_sum"), exact(pick_probability(p)).alias("pick_sum")]


def metric_columns() -> list[Column]:
    mean = lambda c: share(F.col(c), F.col("n"))
    return [F.col("n").alias("matches"), mean("correct").alias("accuracy"), mean("brier").alias("brier"),
            mean("loss").alias("log_loss"), mean("p_sum").alias("avg_prob_winner"),
            mean("pick_sum").alias("avg_pick_prob")]


def model_metrics(rows: DataFrame, *dims: str) -> DataFrame:
    return rows.groupBy("model", *dims).agg(*sum_columns()).select("model", *dims, *metric_columns())


def metrics_by_dims(rows: DataFrame) -> DataFrame:
    """Level, surface, level x surface and probability bucket from one scan.

    A first aggregate on all dimensions shrinks the rows to at most a few thousand cells, so
    the grouping sets expand cells instead of matches.
    """
    cells = (rows.withColumn("bucket", probability_bucket(F.col("p")))
             .groupBy("model", "level", "surface", "bucket").agg(*sum_columns()))
    cuts = {"level": ["model", "level"], "surface": ["model", "surface"], "level_surface": ["model", "level", "surface"],
            "bucket": ["model", "bucket"]}
    return grouped_cuts(cells, cuts, [F.sum(c).alias(c) for c in SUMS]).select(
        "cut", "model", "level", "surface", "bucket", *metric_columns())


def reached(value: Column, thresholds) -> Column:
    """Largest threshold a value reaches; NULL below the first."""
    return F.array_max(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t <= value))


def steps_below(value: Column, thresholds) -> Column:
    """Every threshold a reached step covers."""
    return F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t <= value)


def threshold_grid(rows: DataFrame) -> DataFrame:
    """Cumulative 7 x 7 grid: rows become 49 cells first, then cells are spread downwards."""
    cells = (
        rows.groupBy("model", reached(F.col("min_level_n"), K.COUNT_THRESHOLDS).alias("level_step"),
                     reached(F.col("min_surface_n"), K.COUNT_THRESHOLDS).alias("surface_step"))
        .agg(*sum_columns()))
    spread = (
        cells.withColumn("min_level", F.explode(steps_below(F.col("level_step"), K.COUNT_THRESHOLDS)))
        .withColumn("min_surface", F.explode(steps_below(F.col("surface_step"), K.COUNT_THRESHOLDS))))
    return (spread.groupBy("model", "min_level", "min_surface").agg(*[F.sum(c).alias(c) for c in SUMS])
            .select("model", "min_level", "min_surface", *metric_columns()))


def best_models(metrics: DataFrame) -> DataFrame:
    """Best model by each measure; equal values go to the first name."""
    low = lambda c: F.min(F.struct(c, "model"))["model"]
    return metrics.agg(
        low("log_loss").alias("best_by_log_loss"), low("brier").alias("best_by_brier"),
        F.min(F.struct((-F.col("accuracy")).alias("a"), "model"))["model"].alias("best_by_accuracy"))


# --- signal strength -------------------------------------------------------
def signal_reason(min_level: int, min_surface: int) -> Column:
    level_n = F.least("winner_component_n", "loser_component_n")
    surface_n = F.least("winner_surface_matches", "loser_surface_matches")
    return (F.when(~F.col("surface").isin(*K.SURFACES), "unknown_surface")
            .when(F.col("prob_blend_80_20").isNull(), "missing_probability")
            .when(level_n < min_level, "min_level_not_met")
            .when(surface_n < min_surface, "min_surface_not_met").otherwise("eligible"))


def signal_skips(predictions: DataFrame, min_level: int = K.MIN_LEVEL_MATCHES,
                 min_surface: int = K.MIN_SURFACE_MATCHES) -> DataFrame:
    return (predictions.groupBy(signal_reason(min_level, min_surface).alias("reason"))
            .agg(F.count("*").alias("matches")))


def signal_strength(predictions: DataFrame, min_level: int = K.MIN_LEVEL_MATCHES,
                    min_surface: int = K.MIN_SURFACE_MATCHES) -> DataFrame:
    """Cumulative pick-probability thresholds: overall, by level and by surface."""
    rows = (predictions.where(signal_reason(min_level, min_surface) == "eligible")
            .select("level", "surface", F.col("prob_blend_80_20").alias("p")))
    cells = (rows.groupBy("level", "surface", reached(pick_probability(F.col("p")), K.PICK_THRESHOLDS).alias("step"))
             .agg(*sum_columns()))
    spread = cells.withColumn("threshold", F.explode(steps_below(F.col("step"), K.PICK_THRESHOLDS)))
    cuts = {"overall": ["threshold"], "level": ["threshold", "level"], "surface": ["threshold", "surface"]}
    return grouped_cuts(spread, cuts, [F.sum(c).alias(c) for c in SUMS]).select(
        "cut", "threshold", "level", "surface", *metric_columns())
