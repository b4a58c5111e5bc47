"""Recent form, head to head, support labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.functions.values import rounded, share


def played_sides(matches: DataFrame) -> DataFrame:
    """One row per player and match with set and game differences; matches without a decided set are out.

    ``matches`` holds ``scores``: array of (a, b) games from the winner's view.
    """
    sets = F.size(F.filter("scores", lambda s: s["a"] > s["b"])) - F.size(F.filter("scores", lambda s: s["a"] < s["b"]))
    decided = F.exists("scores", lambda s: s["a"] != s["b"])
    games = F.aggregate("scores", F.lit(0).cast("bigint"), lambda t, s: t + s["a"] - s["b"])
    base = matches.where("winner_key <> loser_key").where(decided).select(
        "seq", "match_date", "winner_key", "loser_key", sets.alias("sets"), games.alias("games"))
    side = lambda key, won, sign: F.struct(
        F.col(key).alias("player_key"), F.lit(won).alias("won"), (F.col("sets") * sign).alias("set_diff"),
        (F.col("games") * sign).alias("game_diff"))
    return base.select("seq", "match_date", F.explode(F.array(
        side("winner_key", 1, 1), side("loser_key", 0, -1))).alias("s")).select("seq", "match_date", "s.*")


def form_last_n(sides: DataFrame, as_of: str, longest: int = 10, short: int = 5) -> DataFrame:
    """Form of every player over the last matches before a day.

    The rank filter keeps ``longest`` rows per player before the shuffle, so players with very
    many matches cost no more than others. Day counts look only at those rows.
    """
    day = F.to_date(F.lit(as_of))
    order = Window.partitionBy("player_key").orderBy(F.desc("match_date"), F.desc("seq"))
    last = sides.where(F.col("match_date") < day).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= longest)
    days = F.date_diff(day, "match_date")

    def summary(n: int) -> list[Column]:
        inside = F.col("rank") <= n
        total = lambda c: F.sum(F.when(inside, F.col(c)).otherwise(0))
        count = F.count_if(inside)
        return [
            count.alias(f"matches_{n}"), total("won").cast("bigint").alias(f"wins_{n}"),
            share(total("won"), count, 4).alias(f"win_rate_{n}"),
            share(total("set_diff"), count, 4).alias(f"set_diff_avg_{n}"),
            share(total("game_diff"), count, 4).alias(f"game_diff_avg_{n}"),
            F.count_if(inside & days.between(0, 7)).alias(f"fatigue_7d_{n}"),
            F.count_if(inside & days.between(0, 3)).alias(f"fatigue_3d_{n}")]

    return last.groupBy("player_key").agg(*summary(longest), *summary(short))


def head_to_head(matches: DataFrame) -> DataFrame:
    """Wins of each side of an unordered pair; ``first_key`` is the smaller key."""
    a, b = F.least("winner_key", "loser_key"), F.greatest("winner_key", "loser_key")
    return matches.where("winner_key <> loser_key").groupBy(a.alias("first_key"), b.alias("second_key")).agg(
        F.count("*").alias("meetings"), F.count_if(F.col("winner_key") == F.least("winner_key", "loser_key")).alias("first_wins"),
        F.count_if(F.col("winner_key") == F.greatest("winner_key", "loser_key")).alias("second_wins"))


def support_labels(win_rate_diff: Column, meetings: Column, own_wins: Column, other_wins: Column,
                   fatigue_gap: Column) -> dict[str, Column]:
    return {
        "form_support": F.when(win_rate_diff >= 0.15, "FORM_SUPPORTS_PICK").when(
            win_rate_diff <= -0.15, "FORM_AGAINST_PICK").otherwise("FORM_NEUTRAL"),
        "h2h_support": F.when(F.coalesce(meetings, F.lit(0)) < 3, "H2H_TOO_SMALL").when(
            own_wins > other_wins, "H2H_SUPPORTS_PICK").when(own_wins < other_wins, "H2H_AGAINST_PICK").otherwise("H2H_NEUTRAL"),
        "fatigue_flag": F.when(fatigue_gap >= 2, "FATIGUE_RISK_PICK").when(
            fatigue_gap <= -2, "FATIGUE_EDGE_PICK").otherwise("FATIGUE_NEUTRAL"),
    }


def label_sides(sides: DataFrame, form: DataFrame, h2h: DataFrame) -> DataFrame:
    """Support labels of a pick (own_key, other_key) from form and head to head."""
    f = form.select("player_key", F.col("win_rate_10").alias("rate"), F.col("fatigue_3d_10").alias("tired"))
    named = lambda p: f.select(F.col("player_key").alias(f"{p}_key"), F.col("rate").alias(f"{p}_rate"),
                               F.col("tired").alias(f"{p}_tired"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    j = (sides.withColumn("first_key", F.least("own_key", "other_key")).withColumn("second_key", F.greatest("own_key", "other_key"))
         .join(named("own"), "own_key", "left").join(named("other"), "other_key", "left")
         .join(h2h, ["first_key", "second_key"], "left"))
    own_first = F.col("own_key") == F.col("first_key")
    own = F.when(own_first, zero("first_wins")).otherwise(zero("second_wins"))
    other = F.when(own_first, zero("second_wins")).otherwise(zero("first_wins"))
    diff = rounded(zero("own_rate") - zero("other_rate"), 6)
    labels = support_labels(diff, F.col("meetings"), own, other, zero("own_tired") - zero("other_tired"))
    return j.select(*sides.columns, diff.alias("win_rate_diff"), zero("meetings").alias("h2h_meetings"),
                    own.alias("h2h_own_wins"), other.alias("h2h_other_wins"), *[c.alias(n) for n, c in labels.items()])
