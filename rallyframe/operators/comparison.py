"""Another model's picks beside our predictions: enrichment, return scenarios, misses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import classify as C
from rallyframe.functions.values import rounded, share
from rallyframe.operators.cuts import grouped_cuts
from rallyframe.operators.ledgers import MONEY, profit


def mapping_status() -> Column:
    p, o = F.col("p_key").isNull(), F.col("o_key").isNull()
    return (F.when(p & o, F.concat(F.lit("both_unmapped:"), "p_status", F.lit("|"), "o_status"))
            .when(p, F.concat(F.lit("player_unmapped:"), "p_status"))
            .when(o, F.concat(F.lit("opponent_unmapped:"), "o_status")).otherwise("mapped"))


def enrich_picks(picks: DataFrame, predictions: DataFrame, min_level: int = K.MIN_LEVEL_MATCHES,
                 min_surface: int = K.MIN_SURFACE_MATCHES, probability: str = "prob_blend_80_20") -> DataFrame:
    """Pick side, our probability and edge, agreement, and why we would not bet. The pick's own profit and edge come first."""
    pred = predictions.select(
        F.col("seq").alias("prediction_seq"), F.col("winner_key").alias("w_key"), F.col("loser_key").alias("l_key"),
        "level", "surface", F.col(probability).alias("p"),
        F.least("winner_component_n", "loser_component_n").alias("min_level_n"),
        F.least("winner_surface_matches", "loser_surface_matches").alias("min_surface_n"))
    j = picks.join(pred, "prediction_seq", "left").withColumn("mapping_status", mapping_status())
    found = F.col("w_key").isNotNull()
    side = F.when(F.col("p_key") == F.col("w_key"), "winner").when(
        (F.col("p_key") == F.col("l_key")) & F.col("p").isNotNull(), "loser")
    own_p = F.when(side == "winner", F.col("p")).when(side == "loser", 1 - F.col("p"))
    implied = F.coalesce(F.col("implied_prob"), 1.0 / F.col("odds"))
    number = lambda text, path: F.get_json_object(text, path).try_cast("double")
    rates = (number("player_form", "$.last_10.win_rate"), number("opponent_form", "$.last_10.win_rate"))
    h2h = (number("h2h", "$.first_wins").cast("bigint"), number("h2h", "$.second_wins").cast("bigint"))
    j = j.withColumns({"picked_side": side, "elo_prob_pick": rounded(own_p, 8), "implied": implied})
    reason = (
        F.when(F.coalesce("date", F.lit("")) == "", "missing_date").when(~found, "no_prediction_match").when(F.col("mapping_status") != "mapped", "unmapped_player")
        .when(F.col("picked_side").isNull(), "picked_player_not_in_prediction")
        .when(F.col("p").isNull(), "missing_elo_probability")
        .when(F.col("surface") == "unknown", "unknown_surface")
        .when(F.col("min_level_n") < min_level, "min_level_not_met")
        .when(F.col("min_surface_n") < min_surface, "min_surface_not_met").otherwise(""))
    return j.select(
        "pick_id", "date", "gender", C.level_from_pick(F.col("tour_level"), F.col("event_type"), F.col("qualification")).alias("tour_level"),
        "level", "surface", "tournament", "match_name", "player_api_key", "opponent_api_key", "player_name", "opponent_name",
        "mapping_status", "match_status", "result", "stake", "odds", "picked_side", "elo_prob_pick",
        F.col("model_prob").alias("old_model_prob"), F.coalesce("edge", rounded(F.col("model_prob") - F.col("implied"), 8)).alias("old_edge"),
        rounded(F.col("elo_prob_pick") - F.col("implied"), 8).alias("elo_edge"),
        (F.col("elo_prob_pick") >= 0.5).alias("agrees"), (reason == "").alias("eligible"), reason.alias("no_bet_reason"),
        rounded(rates[0] - rates[1], 6).alias("last10_win_rate_diff"), (h2h[0] - h2h[1]).alias("h2h_diff"),
        F.coalesce(F.col("profit").cast(MONEY), profit(F.col("result"), F.col("stake"), F.col("odds"))).alias("profit"))


def scenarios() -> list[tuple[str, Column]]:
    ok = F.col("eligible")
    out = [("old_all_settled", F.lit(True)), ("matched_all_old_picks", F.col("match_status").startswith("matched")),
           ("elo_eligible_all_old_picks", ok), ("old_and_elo_agree", ok & F.col("agrees")),
           ("old_and_elo_disagree", ok & ~F.col("agrees"))]
    out += [(f"elo_edge_ge_{t:+.2f}", ok & (F.col("elo_edge") >= t)) for t in K.EDGE_THRESHOLDS]
    out += [(f"elo_prob_ge_{t:.2f}", ok & (F.col("elo_prob_pick") >= t)) for t in K.PICK_THRESHOLDS]
    return out


def roi_sums() -> list[Column]:
    """Additive parts of a scenario."""
    money = lambda c: F.coalesce(F.sum(F.col(c).cast(MONEY)), F.lit(0)).cast(MONEY)
    total = lambda c: F.sum(F.col(c).cast("decimal(20,10)"))
    means = {"odds": "odds", "old_p": "old_model_prob", "elo_p": "elo_prob_pick", "old_e": "old_edge", "elo_e": "elo_edge"}
    return [F.count("result").alias("picks"), F.count_if(F.col("result") == "win").alias("wins"),
            F.count_if(F.col("result") == "loss").alias("losses"), money("stake").alias("stake"), money("profit").alias("profit"),
            *[total(c).alias(f"{n}_s") for n, c in means.items()], *[F.count(c).alias(f"{n}_n") for n, c in means.items()]]


def in_each(rows: DataFrame, tests: list[tuple[str, Column]], name: str = "scenario") -> DataFrame:
    """One row per row and test it passes. The copies meet a partial aggregate before any shuffle."""
    labels = F.array(*[F.when(test, F.lit(label)) for label, test in tests])
    return rows.select(F.explode(F.filter(labels, lambda x: x.isNotNull())).alias(name), "*")


def all_labels(df: DataFrame, tests: list[tuple[str, Column]], name: str = "scenario") -> DataFrame:
    """The fixed list of labels, so that an empty one still gives a row."""
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(label) for label, _ in tests])).alias(name))


def roi_columns() -> list[Column]:
    c = lambda n: F.coalesce(F.col(n), F.lit(0))
    mean = lambda n: share(F.col(f"{n}_s"), c(f"{n}_n"))
    return [c("picks").alias("picks"), c("wins").alias("wins"), c("losses").alias("losses"),
            (c("picks") - c("wins") - c("losses")).alias("push_or_other"), share(c("wins"), c("wins") + c("losses")).alias("hit_rate"),
            c("stake").alias("total_stake"), c("profit").alias("total_profit"), share(c("profit"), c("stake")).alias("roi"),
            mean("odds").alias("avg_odds"), mean("old_p").alias("avg_old_model_prob"), mean("elo_p").alias("avg_elo_prob"),
            mean("old_e").alias("avg_old_edge"), mean("elo_e").alias("avg_elo_edge")]


def roi_scenarios(enriched: DataFrame) -> DataFrame:
    """Every scenario from one scan; an empty one still gives a row."""
    sums = in_each(enriched, scenarios()).groupBy("scenario").agg(*roi_sums())
    return all_labels(enriched, scenarios()).join(sums, "scenario", "left").select("scenario", *roi_columns())


LEVEL_SCENARIOS = ("old_all_settled", "elo_eligible_all_old_picks", "old_and_elo_agree", "elo_edge_ge_+0.04")


def roi_by_level(enriched: DataFrame) -> DataFrame:
    """Four scenarios per level; empty ones are left out."""
    tests = [(n, t) for n, t in scenarios() if n in LEVEL_SCENARIOS]
    level = F.coalesce("level", "tour_level", F.lit("unknown"))
    rows = in_each(enriched, tests).withColumn("level", level)
    return rows.groupBy("level", "scenario").agg(*roi_sums()).select("level", "scenario", *roi_columns())


# --- misses ----------------------------------------------------------------
def category() -> Column:
    return (F.when(F.col("mapping_status") != "mapped", "unmapped_player")
            .when(F.col("match_status") == "no_prediction_match", "no_prediction_match")
            .when(F.col("no_bet_reason") != "", F.col("no_bet_reason")).otherwise("eligible"))


def miss_categories(enriched: DataFrame) -> DataFrame:
    cells = enriched.groupBy(category().alias("category"), "tour_level", "mapping_status", "match_status", "no_bet_reason").agg(
        F.count("*").alias("n"))
    cuts = {"category": ["category"], "category_level": ["category", "tour_level"], "mapping": ["mapping_status"],
            "match": ["match_status"], "reason": ["no_bet_reason"]}
    dims = ("category", "tour_level", "mapping_status", "match_status", "no_bet_reason")
    return grouped_cuts(cells, cuts, [F.sum("n").alias("picks")]).select("cut", F.concat_ws("|", *dims).alias("value"), "picks")


def unmapped_roi(enriched: DataFrame, samples: int = 5) -> DataFrame:
    """Unmapped players by side with results and the first sample matches.

    Samples are ranked and cut before they are collected.
    """
    side = lambda s: F.struct(F.lit(s).alias("side"), F.col(f"{s}_api_key").alias("api_key"), F.col(f"{s}_name").alias("name"))
    missing = lambda s: F.col("mapping_status").startswith(f"{s}_unmapped") | F.col("mapping_status").startswith("both_unmapped")
    rows = enriched.select(
        "pick_id", "date", "match_name", "result", "stake", "profit", F.explode(F.filter(F.array(
            F.when(missing("player"), side("player")), F.when(missing("opponent"), side("opponent"))),
            lambda x: x.isNotNull())).alias("u")).select("*", "u.side", "u.api_key", "u.name")
    totals = rows.groupBy("side", "api_key").agg(
        F.min("name").alias("player_name"), F.count("*").alias("appearances"), F.count_if(F.col("result") == "win").alias("wins"),
        F.count_if(F.col("result") == "loss").alias("losses"), F.sum(F.col("stake").cast(MONEY)).cast(MONEY).alias("total_stake"),
        F.sum(F.coalesce("profit", F.lit(0))).cast(MONEY).alias("total_profit"))
    first = Window.partitionBy("side", "api_key").orderBy("date", "pick_id")
    kept = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= samples)
    texts = F.array_sort(F.collect_list(F.struct("rank", F.concat_ws(" | ", "date", "match_name").alias("t"))))
    shown = kept.groupBy("side", "api_key").agg(F.array_join(F.transform(texts, lambda x: x["t"]), " || ").alias("sample_matches"))
    return totals.join(shown, ["side", "api_key"])


def top_counts(rows: DataFrame, column: str, n: int | None) -> DataFrame:
    """Most frequent values of a report column; ties go to the smaller value."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("picks"))
    ranked = counts if n is None else counts.orderBy(F.desc("picks"), "value").limit(n)
    return ranked.select(F.lit(column).alias("what"), "value", "picks")


# --- context signals -------------------------------------------------------
def signal_buckets() -> list[tuple[str, list[tuple[str, Column]]]]:
    form, h2h = F.col("last10_win_rate_diff"), F.col("h2h_diff")
    label = lambda c, yes, no: [("supports_pick", F.col(c) == yes), ("against_pick", F.col(c) == no),
                                ("neutral_unknown", ~F.col(c).isin(yes, no))]
    flag = F.col("fatigue_flag") == "FATIGUE_RISK_PICK"
    return [
        ("all", [("all", F.lit(True))]),
        ("form_support", label("form_support", "FORM_SUPPORTS_PICK", "FORM_AGAINST_PICK")),
        ("h2h_support", label("h2h_support", "H2H_SUPPORTS_PICK", "H2H_AGAINST_PICK")),
        ("fatigue_flag", [("has_flag", flag), ("no_flag", ~flag)]),
        ("last10_win_rate_diff", [
            ("pick_plus_15pct", form >= 0.15), ("pick_plus_5_15pct", (form >= 0.05) & (form < 0.15)),
            ("neutral", (form > -0.05) & (form < 0.05)), ("opponent_plus_5pct", form <= -0.05), ("unknown", form.isNull())]),
        ("h2h_diff", [("pick_leads", h2h > 0), ("even", h2h == 0), ("opponent_leads", h2h < 0), ("unknown_no_h2h", h2h.isNull())]),
    ]


def context_signal_roi(ledger: DataFrame) -> DataFrame:
    """Return of win/loss picks by context bucket, one scan, empty buckets kept."""
    tests = [(f"{signal}|{name}", test) for signal, buckets in signal_buckets() for name, test in buckets]
    rows = in_each(ledger.where(F.col("result").isin("win", "loss")), tests, "label")
    sums = rows.groupBy("label").agg(*roi_sums())
    full = all_labels(ledger, tests, "label").join(sums, "label", "left")
    part = lambda i: F.split_part("label", F.lit("|"), F.lit(i))
    keep = ("picks", "wins", "losses", "hit_rate", "total_stake", "total_profit", "roi")
    return full.select(part(1).alias("signal"), part(2).alias("bucket"), *roi_columns()).select("signal", "bucket", *keep)
