"""One row per match and side: the base of every per-player aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_sides(matches: DataFrame, keep: list[str]) -> DataFrame:
    """Player and opponent of each side; flat (``winner_key``) or nested (``winner.player_key``) columns."""
    nested = "winner" in matches.columns

    def col(side: str, flat: str, inner: str) -> Column:
        return F.col(f"{side}.{inner}") if nested else F.col(f"{side}_{flat}")

    def entry(own: str, other: str) -> Column:
        return F.struct(
            col(own, "key", "player_key").alias("player_key"), col(own, "name", "name").alias("name"),
            col(other, "key", "player_key").alias("opponent_key"), col(other, "name", "name").alias("opponent_name"),
            F.lit(own == "winner").alias("won"))

    return matches.select(*keep, F.explode(F.array(entry("winner", "loser"), entry("loser", "winner"))).alias("s")
                          ).select(*keep, "s.*")


def top_values(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """Most common values per key as ``value=count`` text; ties go to the smaller value."""
    from pyspark.sql import Window

    counts = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(key).orderBy(F.desc("n"), value)
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    pairs = F.array_sort(F.collect_list(F.struct("rank", F.concat_ws("=", F.col(value), F.col("n")).alias("t"))))
    return top.groupBy(key).agg(F.array_join(F.transform(pairs, lambda p: p["t"]), ",").alias(f"top_{value}"))


def most_common(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most common value per key; ties go to the smaller value."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.v").alias(value))
