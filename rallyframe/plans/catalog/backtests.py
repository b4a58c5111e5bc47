"""Model quality cuts and pick comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.functions import values as V
from rallyframe.operators import backtests as B
from rallyframe.operators import comparison as X
from rallyframe.operators import merging as M
from rallyframe.operators.form import support_labels
from rallyframe.plans import views
from rallyframe.plans.catalog.functions import BUCKET
from rallyframe.plans.catalog.merging import pick_keys, prediction_keys
from rallyframe.plans.catalog.ratings import predicted
from rallyframe.plans.registry import query
from rallyframe.workspace import materialise

METRICS = """count(*) AS matches, floor(sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) * 1e6 / count(*) + 0.5) / 1e6 AS accuracy,
  floor(sum(CAST((p - 1) * (p - 1) AS DECIMAL(20,12)))::DOUBLE * 1e6 / count(*) + 0.5) / 1e6 AS brier,
  floor(sum(CAST(-ln(least(greatest(p, 1e-12), 1 - 1e-12)) AS DECIMAL(20,12)))::DOUBLE * 1e6 / count(*) + 0.5) / 1e6 AS log_loss,
  floor(sum(CAST(p AS DECIMAL(20,12)))::DOUBLE * 1e6 / count(*) + 0.5) / 1e6 AS avg_prob_winner,
  floor(sum(CAST(pick AS DECIMAL(20,12)))::DOUBLE * 1e6 / count(*) + 0.5) / 1e6 AS avg_pick_prob"""


def rows(spark: SparkSession, sf: str) -> DataFrame:
    return B.model_rows(predicted(spark, sf))


@query("f1_model_metrics", f"SELECT model, {METRICS} FROM model_rows_v GROUP BY model")
def f1(spark, sf):
    return B.model_metrics(rows(spark, sf))


@query("f2_metrics_by_dims", f"""
SELECT CASE WHEN grouping(bucket) = 0 THEN 'bucket' WHEN grouping(level) = 0 AND grouping(surface) = 0 THEN 'level_surface'
    WHEN grouping(level) = 0 THEN 'level' ELSE 'surface' END AS cut, model, level, surface, bucket, {METRICS}
FROM (SELECT *, {BUCKET.format('p')} AS bucket FROM model_rows_v)
GROUP BY GROUPING SETS ((model, level), (model, surface), (model, level, surface), (model, bucket))""")
def f2(spark, sf):
    return B.metrics_by_dims(rows(spark, sf))


@query("f3_threshold_grid", f"""
SELECT model, a.t AS min_level, b.t AS min_surface, {METRICS}
FROM model_rows_v, (VALUES (0), (3), (5), (10), (20), (30), (50)) a(t), (VALUES (0), (3), (5), (10), (20), (30), (50)) b(t)
WHERE min_level_n >= a.t AND min_surface_n >= b.t GROUP BY model, a.t, b.t""")
def f3(spark, sf):
    return B.threshold_grid(rows(spark, sf))


@query("f4_best_model", f"""
WITH mm AS (SELECT model, {METRICS} FROM model_rows_v GROUP BY model)
SELECT (SELECT model FROM mm ORDER BY log_loss, model LIMIT 1) AS best_by_log_loss,
  (SELECT model FROM mm ORDER BY brier, model LIMIT 1) AS best_by_brier,
  (SELECT model FROM mm ORDER BY accuracy DESC, model LIMIT 1) AS best_by_accuracy""")
def f4(spark, sf):
    return B.best_models(B.model_metrics(rows(spark, sf)))


THRESHOLDS = "(VALUES (0.5::DOUBLE), (0.52), (0.55), (0.57), (0.6), (0.62), (0.65), (0.67), (0.7), (0.72), (0.75), (0.8)) t(threshold)"


@query("f5_signal_strength", f"""
SELECT CASE WHEN grouping(level) = 0 THEN 'level' WHEN grouping(surface) = 0 THEN 'surface' ELSE 'overall' END AS cut,
  threshold, level, surface, {METRICS}
FROM model_rows_v, {THRESHOLDS}
WHERE model = 'blend_80_20' AND min_level_n >= 10 AND min_surface_n >= 5 AND pick >= threshold
GROUP BY GROUPING SETS ((threshold), (threshold, level), (threshold, surface))""")
def f5(spark, sf):
    return B.signal_strength(predicted(spark, sf))


@query("f5_signal_skips", """
SELECT CASE WHEN surface = 'unknown' THEN 'unknown_surface' WHEN least(w_comp_n, l_comp_n) < 10 THEN 'min_level_not_met'
  WHEN least(w_surf_n, l_surf_n) < 5 THEN 'min_surface_not_met' ELSE 'eligible' END AS reason, count(*) AS matches
FROM predictions_v GROUP BY 1""")
def f5_skips(spark, sf):
    return B.signal_skips(predicted(spark, sf))


# --- comparison with another model's picks ---------------------------------
def enriched(spark: SparkSession, sf: str) -> DataFrame:
    picks = M.pick_to_prediction(pick_keys(spark, sf), prediction_keys(spark, sf))
    return X.enrich_picks(picks, predicted(spark, sf))


@query("f6_pick_enrichment", """
SELECT pick_id, tour_level, level, surface, mapping_status, match_status, picked_side, elo_prob_pick, old_edge, elo_edge, agrees,
  eligible, no_bet_reason, last10_win_rate_diff, h2h_diff, profit FROM enriched_v""")
def f6(spark, sf):
    return enriched(spark, sf).select(
        "pick_id", "tour_level", "level", "surface", "mapping_status", "match_status", "picked_side", V.rounded(F.col("elo_prob_pick"), 6).alias("elo_prob_pick"),
        V.rounded(F.col("old_edge"), 6).alias("old_edge"), V.rounded(F.col("elo_edge"), 6).alias("elo_edge"), "agrees", "eligible", "no_bet_reason",
        "last10_win_rate_diff", "h2h_diff", "profit")


MEAN = "floor(sum(CAST({0} AS DECIMAL(20,10)))::DOUBLE * 1e6 / count({0}) + 0.5) / 1e6"
ROI = f"""count(pick_id) AS picks, count(*) FILTER (result = 'win') AS wins, count(*) FILTER (result = 'loss') AS losses,
  count(*) FILTER (result = 'void') AS push_or_other,
  floor(count(*) FILTER (result = 'win') * 1e6 / nullif(count(*) FILTER (result IN ('win', 'loss')), 0) + 0.5) / 1e6 AS hit_rate,
  coalesce(sum(CAST(stake AS DECIMAL(18,6))), 0)::DOUBLE AS total_stake, coalesce(sum(profit), 0)::DOUBLE AS total_profit,
  floor(sum(profit)::DOUBLE * 1e6 / nullif(sum(CAST(stake AS DECIMAL(18,6)))::DOUBLE, 0) + 0.5) / 1e6 AS roi,
  {MEAN.format('odds')} AS avg_odds, {MEAN.format('model_prob')} AS avg_old_model_prob, {MEAN.format('elo_prob_full')} AS avg_elo_prob,
  {MEAN.format('old_edge_full')} AS avg_old_edge, {MEAN.format('elo_edge_full')} AS avg_elo_edge"""
SCENARIOS = """(VALUES ('old_all_settled', 0, 0.0), ('matched_all_old_picks', 1, 0), ('elo_eligible_all_old_picks', 2, 0), ('old_and_elo_agree', 3, 0),
  ('old_and_elo_disagree', 4, 0), ('elo_edge_ge_-0.02', 5, -0.02), ('elo_edge_ge_+0.00', 5, 0), ('elo_edge_ge_+0.02', 5, 0.02),
  ('elo_edge_ge_+0.04', 5, 0.04), ('elo_edge_ge_+0.06', 5, 0.06), ('elo_edge_ge_+0.08', 5, 0.08), ('elo_edge_ge_+0.10', 5, 0.1),
  ('elo_prob_ge_0.50', 6, 0.5), ('elo_prob_ge_0.52', 6, 0.52), ('elo_prob_ge_0.55', 6, 0.55), ('elo_prob_ge_0.57', 6, 0.57),
  ('elo_prob_ge_0.60', 6, 0.6), ('elo_prob_ge_0.62', 6, 0.62), ('elo_prob_ge_0.65', 6, 0.65), ('elo_prob_ge_0.67', 6, 0.67),
  ('elo_prob_ge_0.70', 6, 0.7), ('elo_prob_ge_0.72', 6, 0.72), ('elo_prob_ge_0.75', 6, 0.75), ('elo_prob_ge_0.80', 6, 0.8)) s(scenario, kind, t)"""
IN_SCENARIO = """(kind = 0 OR (kind = 1 AND match_status LIKE 'matched%') OR (eligible AND (kind = 2 OR (kind = 3 AND agrees) OR (kind = 4 AND NOT agrees)
  OR (kind = 5 AND elo_edge_full >= t) OR (kind = 6 AND elo_prob_full >= t))))"""


@query("f7_roi_scenarios", f"SELECT scenario, {ROI} FROM {SCENARIOS} LEFT JOIN enriched_v ON {IN_SCENARIO} GROUP BY scenario")
def f7(spark, sf):
    return X.roi_scenarios(enriched(spark, sf))


@query("f8_roi_by_level", f"""
SELECT coalesce(level, tour_level) AS level, scenario, {ROI} FROM {SCENARIOS} JOIN enriched_v ON {IN_SCENARIO}
WHERE scenario IN ('old_all_settled', 'elo_eligible_all_old_picks', 'old_and_elo_agree', 'elo_edge_ge_+0.04') GROUP BY 1, 2""")
def f8(spark, sf):
    return X.roi_by_level(enriched(spark, sf))


CATEGORY = """CASE WHEN mapping_status <> 'mapped' THEN 'unmapped_player' WHEN match_status = 'no_prediction_match' THEN 'no_prediction_match'
  WHEN no_bet_reason <> '' THEN no_bet_reason ELSE 'eligible' END"""


@query("f9_miss_categories", f"""
SELECT c.cut, c.value, count(*) AS picks FROM (SELECT *, {CATEGORY} AS category FROM enriched_v), LATERAL (VALUES ('category', category),
  ('category_level', category || '|' || tour_level), ('mapping', mapping_status), ('match', match_status), ('reason', no_bet_reason)) c(cut, value) GROUP BY ALL""")
def f9(spark, sf):
    return X.miss_categories(enriched(spark, sf))


@query("f10_unmapped_roi", """
WITH u AS (SELECT 'player' AS side, player_api_key AS api_key, player_name AS name, * FROM enriched_v WHERE mapping_status LIKE 'player%' OR mapping_status LIKE 'both%'
  UNION ALL SELECT 'opponent', opponent_api_key, opponent_name, * FROM enriched_v WHERE mapping_status LIKE 'opponent%' OR mapping_status LIKE 'both%')
SELECT side, api_key, min(name) AS player_name, count(*) AS appearances, count(*) FILTER (result = 'win') AS wins, count(*) FILTER (result = 'loss') AS losses,
  sum(CAST(stake AS DECIMAL(18,6)))::DOUBLE AS total_stake, sum(profit)::DOUBLE AS total_profit,
  string_agg(date || ' | ' || match_name, ' || ' ORDER BY date, pick_id) FILTER (rn <= 5) AS sample_matches
FROM (SELECT *, row_number() OVER (PARTITION BY side, api_key ORDER BY date, pick_id) AS rn FROM u) GROUP BY side, api_key""")
def f10(spark, sf):
    return X.unmapped_roi(enriched(spark, sf))


@query("f11_top_n_counts", f"""
WITH r AS (SELECT * FROM enriched_v WHERE {CATEGORY} = 'no_prediction_match')
SELECT * FROM (SELECT 'date' AS what, date AS value, count(*) AS picks FROM r GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)
UNION ALL SELECT * FROM (SELECT 'tournament', tournament, count(*) FROM r GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 20)
UNION ALL SELECT 'tour_level', tour_level, count(*) FROM r GROUP BY 2""")
def f11(spark, sf):
    rows = materialise(enriched(spark, sf).where(X.category() == "no_prediction_match").select("date", "tournament", "tour_level"),
                       "no-match")
    return X.top_counts(rows, "date", 20).unionByName(X.top_counts(rows, "tournament", 20)).unionByName(
        X.top_counts(rows, "tour_level", None))


@query("f12_context_signal_roi", """
WITH l AS (SELECT e.*, CASE WHEN last10_win_rate_diff >= 0.15 THEN 'S' WHEN last10_win_rate_diff <= -0.15 THEN 'A' ELSE 'N' END AS form,
  CASE WHEN h2h_sum < 3 THEN 'N' WHEN h2h_diff > 0 THEN 'S' WHEN h2h_diff < 0 THEN 'A' ELSE 'N' END AS meet, h2h_diff >= 2 AS tired FROM enriched_v e),
b AS (SELECT * FROM (VALUES ('all', 'all'), ('form_support', 'supports_pick'), ('form_support', 'against_pick'), ('form_support', 'neutral_unknown'),
  ('h2h_support', 'supports_pick'), ('h2h_support', 'against_pick'), ('h2h_support', 'neutral_unknown'), ('fatigue_flag', 'has_flag'), ('fatigue_flag', 'no_flag'),
  ('last10_win_rate_diff', 'pick_plus_15pct'), ('last10_win_rate_diff', 'pick_plus_5_15pct'), ('last10_win_rate_diff', 'neutral'),
  ('last10_win_rate_diff', 'opponent_plus_5pct'), ('last10_win_rate_diff', 'unknown'), ('h2h_diff', 'pick_leads'), ('h2h_diff', 'even'),
  ('h2h_diff', 'opponent_leads'), ('h2h_diff', 'unknown_no_h2h')) v(signal, bucket)),
t AS (SELECT l.*, x.signal, x.bucket FROM l, LATERAL (VALUES ('all', 'all'),
  ('form_support', CASE form WHEN 'S' THEN 'supports_pick' WHEN 'A' THEN 'against_pick' ELSE 'neutral_unknown' END),
  ('h2h_support', CASE meet WHEN 'S' THEN 'supports_pick' WHEN 'A' THEN 'against_pick' ELSE 'neutral_unknown' END),
  ('fatigue_flag', CASE WHEN tired THEN 'has_flag' ELSE 'no_flag' END),
  ('last10_win_rate_diff', CASE WHEN last10_win_rate_diff IS NULL THEN 'unknown' WHEN last10_win_rate_diff >= 0.15 THEN 'pick_plus_15pct'
     WHEN last10_win_rate_diff >= 0.05 THEN 'pick_plus_5_15pct' WHEN last10_win_rate_diff <= -0.05 THEN 'opponent_plus_5pct' ELSE 'neutral' END),
  ('h2h_diff', CASE WHEN h2h_diff > 0 THEN 'pick_leads' WHEN h2h_diff < 0 THEN 'opponent_leads' ELSE 'even' END)) x(signal, bucket) WHERE result IN ('win', 'loss'))
SELECT signal, bucket, count(pick_id) AS picks, count(*) FILTER (result = 'win') AS wins, count(*) FILTER (result = 'loss') AS losses,
  floor(count(*) FILTER (result = 'win') * 1e6 / nullif(count(pick_id), 0) + 0.5) / 1e6 AS hit_rate,
  coalesce(sum(CAST(stake AS DECIMAL(18,6))), 0)::DOUBLE AS total_stake, coalesce(sum(profit), 0)::DOUBLE AS total_profit,
  floor(sum(profit)::DOUBLE * 1e6 / nullif(sum(CAST(stake AS DECIMAL(18,6)))::DOUBLE, 0) + 0.5) / 1e6 AS roi
FROM b LEFT JOIN t USING (signal, bucket) GROUP BY signal, bucket""")
def f12(spark, sf):
    number = lambda path: F.get_json_object("h2h", path).cast("bigint")
    meetings = views.external_picks(spark, sf).select(
        "pick_id", number("$.first_wins").alias("own"), number("$.second_wins").alias("other"))
    rows = enriched(spark, sf).join(meetings, "pick_id")
    labels = support_labels(F.col("last10_win_rate_diff"), F.col("own") + F.col("other"), F.col("own"), F.col("other"), F.col("h2h_diff"))
    return X.context_signal_roi(rows.withColumns(labels))
