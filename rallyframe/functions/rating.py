"""Rating and probability expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rallyframe import constants as K


def elo_expected(own: Column, other: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (other - own) / F.lit(400.0)))


def weighted_blend(level: Column, surface: Column, level_w, surface_w) -> Column:
    lw = level_w if isinstance(level_w, Column) else F.lit(level_w)
    sw = surface_w if isinstance(surface_w, Column) else F.lit(surface_w)
    return F.when(lw + sw > 0, (level * lw + surface * sw) / (lw + sw)).otherwise(F.lit(K.RATING_INITIAL))


def slam_component(slam_r: Column, slam_n: Column, tour_r: Column, tour_n: Column) -> Column:
    """Slam rating stabilised by the tour rating, weighted by counts plus a prior."""
    slam_w = slam_n + F.when(slam_n > 0, K.SLAM_PRIOR).otherwise(0)
    tour_w = tour_n + F.when(tour_n > 0, K.TOUR_PRIOR).otherwise(0)
    total = slam_w + tour_w
    return F.when(total > 0, (slam_r * slam_w + tour_r * tour_w) / total).otherwise(
        F.lit(K.RATING_INITIAL))


def sample_aware_weight(own_n: Column, other_n: Column) -> Column:
    n = F.least(own_n, other_n)
    weight = F.lit(0.0)
    for minimum, value in K.SAMPLE_AWARE_STEPS:
        weight = F.when(n >= minimum, F.lit(value)).otherwise(weight)
    return weight


def log_loss(p: Column) -> Column:
    """Loss of a probability given to the side that won."""
    return -F.log(F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12)))


def pick_probability(p: Column) -> Column:
    return F.greatest(p, F.lit(1.0) - p)


def probability_bucket(p: Column) -> Column:
    edges = K.BUCKET_EDGES
    label = F.lit("other")
    pick = pick_probability(p)
    for low, high in zip(edges, (*edges[1:], 1.01)):
        text = f"{low:.2f}-{min(high, 1.0):.2f}"
        label = F.when((pick >= F.lit(low)) & (pick < F.lit(high)), text).otherwise(label)
    return label
