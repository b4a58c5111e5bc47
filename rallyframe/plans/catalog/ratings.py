"""Ladders and everything read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions.values import rounded
from rallyframe.operators import audits, ladders, predictions
from rallyframe.operators.asof import as_of
from rallyframe.plans import views
from rallyframe.plans.registry import query


def steps(spark: SparkSession, sf: str) -> DataFrame:
    return ladders.fold_ladders(views.valid_matches(spark, sf))


@query("r1_elo_ladders", """
SELECT gender, layer, value, player_key, floor(rating * 1000 + 0.5) / 1000 AS rating, n FROM ladder_state_v""")
def r1(spark, sf):
    return ladders.ladder_ratings(steps(spark, sf)).withColumn("rating", rounded(F.col("rating"), 3))


@query("r1_elo_ladders_sliced", """
SELECT gender, layer, value, player_key, floor(rating * 1000 + 0.5) / 1000 AS rating, n FROM ladder_state_v""")
def r1_sliced(spark, sf):
    """The same in six time slices and up to four parts of each, as a large table is folded."""
    m = views.valid_matches(spark, sf)
    rows = m.count()
    sliced = ladders.fold_ladders(m, slice_rows=max(1, rows // 6), task_rows=max(1, rows // 24))
    return ladders.ladder_ratings(sliced).withColumn("rating", rounded(F.col("rating"), 3))


@query("r2_prematch_state", """
SELECT gender, layer, value, seq, probe, floor(winner_rating * 1000 + 0.5) / 1000 AS winner_rating,
  floor(loser_rating * 1000 + 0.5) / 1000 AS loser_rating, winner_n, loser_n FROM ladder_steps_v""")
def r2(spark, sf):
    s = steps(spark, sf)
    return s.select("gender", "layer", "value", "seq", "probe",
                    rounded(F.col("winner_rating"), 3).alias("winner_rating"),
                    rounded(F.col("loser_rating"), 3).alias("loser_rating"), "winner_n", "loser_n")


@query("r3_player_ratings", """
SELECT r.player_key, any_value(f.name) AS name, any_value(f.gender) AS gender,
  max(r3) FILTER (layer = 'overall') AS overall, max(n) FILTER (layer = 'overall') AS matches,
  coalesce(string_agg(value || '=' || n, ',' ORDER BY value) FILTER (layer = 'level'), '') AS levels,
  coalesce(string_agg(value || '=' || n, ',' ORDER BY value) FILTER (layer = 'surface'), '') AS surfaces,
  coalesce(string_agg(value || '=' || n, ',' ORDER BY value) FILTER (layer = 'level_surface'), '') AS level_surfaces,
  coalesce(floor(sum(r3) FILTER (layer = 'level') * 1000 + 0.5) / 1000, 0) AS level_sum,
  coalesce(floor(sum(r3) FILTER (layer = 'surface') * 1000 + 0.5) / 1000, 0) AS surface_sum,
  coalesce(floor(sum(r3) FILTER (layer = 'level_surface') * 1000 + 0.5) / 1000, 0) AS level_surface_sum
FROM (SELECT *, floor(rating * 1000 + 0.5) / 1000 AS r3 FROM ladder_state_v) r JOIN first_names_v f USING (player_key)
GROUP BY r.player_key""")
def r3(spark, sf):
    m = views.valid_matches(spark, sf)
    players = ladders.player_ratings(ladders.ladder_ratings(ladders.fold_ladders(m)), ladders.first_names(m))
    counts = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws(
        "=", e["key"], e["value"].cast("string"))), ",")
    total = lambda c: rounded(F.aggregate(F.map_values(c), F.lit(0.0), lambda a, x: a + x), 3)
    return players.select(
        "player_key", "name", "gender", "overall", "matches",
        counts("level_matches").alias("levels"), counts("surface_matches").alias("surfaces"),
        counts("level_surface_matches").alias("level_surfaces"),
        total("level").alias("level_sum"), total("surface").alias("surface_sum"),
        total("level_surface").alias("level_surface_sum"))


@query("r4_rating_summary", """
SELECT 'players' AS what, gender AS part, count(DISTINCT player_key) AS n FROM sides_v GROUP BY gender
UNION ALL SELECT 'processed', gender, count(*) FROM valid_v GROUP BY gender
UNION ALL SELECT 'processed_level', level, count(*) FROM valid_v GROUP BY level
UNION ALL SELECT 'unknown_surface', 'all', count(*) FROM valid_v WHERE surface = 'unknown'""")
def r4(spark, sf):
    return audits.rating_summary(views.valid_matches(spark, sf))


@query("r5_rating_audit", """
SELECT issue, CASE WHEN issue LIKE '%\\_sum\\_%' ESCAPE '\\' THEN 'warning' ELSE 'fatal' END AS severity, count(*) AS players FROM (
  SELECT player_key, unnest(list_filter([
    CASE WHEN lv <> m THEN 'level_sum_differs' END, CASE WHEN sf > m THEN 'surface_sum_above_matches' END,
    CASE WHEN sf < m THEN 'surface_sum_below_matches' END, CASE WHEN low < 700 OR high > 2800 OR d = 1 THEN 'rating_out_of_range' END,
    CASE WHEN m = 0 THEN 'zero_matches' END, CASE WHEN m < 0 THEN 'negative_count' END, CASE WHEN d = 4 THEN 'invalid_level_surface_key' END,
    CASE WHEN d = 5 THEN 'invalid_level_surface_level' END, CASE WHEN d = 6 THEN 'invalid_level_surface_surface' END, CASE WHEN d = 7 THEN 'missing_name' END,
    CASE WHEN sf <> ls THEN 'level_surface_sum_differs' END, CASE WHEN ls <> m THEN 'level_surface_sum_not_matches' END], lambda x: x IS NOT NULL)) AS issue
  FROM (SELECT *, CASE d WHEN 2 THEN 0 WHEN 3 THEN -1 ELSE total END AS m FROM (
    SELECT player_key, CAST(split_part(player_key, ':', 3) AS BIGINT) % 31 AS d, max(n) FILTER (layer = 'overall') AS total, sum(n) FILTER (layer = 'level') AS lv,
      coalesce(sum(n) FILTER (layer = 'surface'), 0) AS sf, coalesce(sum(n) FILTER (layer = 'level_surface'), 0) AS ls,
      min(rating) AS low, max(rating) AS high FROM ladder_state_v GROUP BY player_key))) GROUP BY 1, 2""")
def r5(spark, sf):
    m = views.valid_matches(spark, sf)
    players = ladders.player_ratings(ladders.ladder_ratings(ladders.fold_ladders(m)), ladders.first_names(m))
    damage = F.split_part("player_key", F.lit(":"), F.lit(3)).cast("bigint") % 31   # a few players with each kind of damage
    odd = F.when(damage == 4, "odd").when(damage == 5, "junior|hard").when(damage == 6, "itf|mud")
    more = lambda c, v: F.when(odd.isNotNull(), F.map_concat(c, F.map_from_arrays(F.array(F.coalesce(odd, F.lit(""))), F.array(v)))).otherwise(F.col(c))
    damaged = players.withColumns({
        "overall": F.when(damage == 1, 3000.0).otherwise(F.col("overall")), "name": F.when(damage == 7, " ").otherwise(F.col("name")),
        "matches": F.when(damage == 2, 0).when(damage == 3, -1).otherwise(F.col("matches")),
        "level_surface": more("level_surface", F.lit(1500.0)), "level_surface_matches": more("level_surface_matches", F.lit(0).cast("bigint"))})
    return audits.rating_findings(damaged).groupBy("issue", "severity").agg(F.countDistinct("player_key").alias("players"))


@query("r8_overall_support_component", """
SELECT player_key, floor(sum(rating * n) / sum(n) * 1000 + 0.5) / 1000 AS support_rating, sum(n)::BIGINT AS support_n
FROM ladder_state_v WHERE layer = 'level' GROUP BY player_key""")
def r8(spark, sf):
    out = predictions.overall_support(ladders.ladder_ratings(steps(spark, sf)))
    return out.withColumn("support_rating", rounded(F.col("support_rating"), 3))


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    m = views.valid_matches(spark, sf)
    return predictions.predict(predictions.prematch_wide(ladders.fold_ladders(m), m))


@query("r6_gs_component", """
SELECT seq, floor(w_comp * 1000 + 0.5) / 1000 AS winner_component, floor(l_comp * 1000 + 0.5) / 1000 AS loser_component,
  w_comp_n AS winner_component_n, l_comp_n AS loser_component_n FROM predictions_v WHERE level = 'grand_slam'""")
def r6(spark, sf):
    return predicted(spark, sf).where(F.col("level") == "grand_slam").select(
        "seq", rounded(F.col("winner_component"), 3).alias("winner_component"),
        rounded(F.col("loser_component"), 3).alias("loser_component"), "winner_component_n", "loser_component_n")


@query("r7_historical_predictions", """
SELECT seq, level, surface, winner_key, loser_key, w_all_n AS winner_overall_n, l_all_n AS loser_overall_n,
  w_surf_n AS winner_surface_matches, l_surf_n AS loser_surface_matches, weight AS sample_aware_surface_weight,
  floor(p_level_only * 1e6 + 0.5) / 1e6 AS prob_level_only, floor(p_surface_only * 1e6 + 0.5) / 1e6 AS prob_surface_only,
  floor(p_blend_80_20 * 1e6 + 0.5) / 1e6 AS prob_blend_80_20, floor(p_blend_70_30 * 1e6 + 0.5) / 1e6 AS prob_blend_70_30,
  floor(p_blend_60_40 * 1e6 + 0.5) / 1e6 AS prob_blend_60_40, floor(p_sample_aware * 1e6 + 0.5) / 1e6 AS prob_sample_aware
FROM predictions_v""")
def r7(spark, sf):
    p = predicted(spark, sf)
    return p.select("seq", "level", "surface", "winner_key", "loser_key", "winner_overall_n", "loser_overall_n",
                    "winner_surface_matches", "loser_surface_matches", "sample_aware_surface_weight",
                    *[rounded(F.col(f"prob_{m}"), 6).alias(f"prob_{m}") for m in predictions.MODELS])


@query("d6_total_order", """
SELECT seq, row_number() OVER (ORDER BY match_date, seq) AS match_index FROM matches_v""")
def d6(spark, sf):
    return predictions.match_index(views.matches(spark, sf).select("match_date", "seq")).select("seq", "match_index")


@query("d11_as_of_level_state", """
SELECT seq, winner_key, loser_key, floor(winner_rating * 1000 + 0.5) / 1000 AS winner_tour_rating,
  floor(loser_rating * 1000 + 0.5) / 1000 AS loser_tour_rating, winner_n AS winner_tour_n, loser_n AS loser_tour_n
FROM ladder_steps_v WHERE probe""")
def d11(spark, sf):
    """The tour ladder as of each slam match, from the ladder's own matches alone."""
    m = views.valid_matches(spark, sf)
    played = steps(spark, sf).where("layer = 'level' AND value = 'atp_wta' AND NOT probe").join(m.select("seq", "match_date"), "seq")
    side = lambda name: F.struct(F.col(f"{name}_key").alias("player_key"), F.col(f"{name}_after").alias("tour_rating"), (F.col(f"{name}_n") + 1).alias("tour_n"))
    after = played.select("gender", "match_date", "seq", F.explode(F.array(side("winner"), side("loser"))).alias("s")).select("gender", "match_date", "seq", "s.*")
    slams = m.where("level = 'grand_slam' AND winner_key <> loser_key").select("gender", "match_date", "seq", "winner_key", "loser_key")
    sides = slams.select("*", F.posexplode(F.array("winner_key", "loser_key")).alias("at", "player_key"))
    found = as_of(sides, after, ["gender", "player_key"], ["match_date", "seq"], ["tour_rating", "tour_n"])
    of = lambda at, name: F.max(F.when(F.col("at") == at, F.col(name)))
    both = found.groupBy("seq", "winner_key", "loser_key").agg(*[
        F.coalesce(of(at, name), F.lit(first)).alias(f"{who}_{name}") for at, who in enumerate(("winner", "loser")) for name, first in (("tour_rating", K.RATING_INITIAL), ("tour_n", 0))])
    return both.withColumns({f"{who}_tour_rating": rounded(F.col(f"{who}_tour_rating"), 3) for who in ("winner", "loser")})
