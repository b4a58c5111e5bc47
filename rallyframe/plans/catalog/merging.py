"""Aliases, canonical merge and prioritised joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rallyframe.functions import classify as C
from rallyframe.functions.values import pair_key
from rallyframe.operators import aliases as A
from rallyframe.operators import merging as M
from rallyframe.operators.sides import explode_sides
from rallyframe.plans import views
from rallyframe.plans.registry import query
from rallyframe.workspace import new_path


def closure(spark, sf):
    return A.resolve_aliases(A.valid_aliases(views.raw_aliases(spark, sf)))


@query("d1_resolve_aliases", "SELECT alias_key, canonical_key, is_cycle FROM alias_closure_v")
def d1(spark, sf):
    return closure(spark, sf)


def aliased(spark, sf, ends=None):
    return A.apply_aliases(views.matches(spark, sf), ends or closure(spark, sf))


@query("d2_apply_aliases", """
SELECT seq, winner_key, loser_key, winner_key_original, loser_key_original FROM aliased_v""")
def d2(spark, sf):
    return aliased(spark, sf).select("seq", "winner_key", "loser_key", "winner_key_original", "loser_key_original")


@query("d3_canonical_dedupe", """
SELECT seq, match_date, winner_key, loser_key, round FROM (
  SELECT *, row_number() OVER (PARTITION BY match_date, gender, level, surface, tourney_id, tourney_name, round, winner_key, loser_key,
    w1 || '-' || l1 ORDER BY seq) AS rn FROM aliased_v WHERE winner_key <> loser_key) WHERE rn = 1""")
def d3(spark, sf):
    m = aliased(spark, sf).withColumn("score", F.concat_ws("-", F.col("w1").cast("string"), F.col("l1").cast("string")))
    return M.canonical_dedupe(m.select("seq", *M.DEDUPE_KEY)).select("seq", "match_date", "winner_key", "loser_key", "round")


def mapped(spark, sf, ends=None):
    return M.map_sides(views.fixture_matches(spark, sf), views.mapping(spark, sf), ends or closure(spark, sf))


@query("d4_map_sides", """
SELECT seq, winner_api_key, loser_api_key, winner_key, loser_key, winner_status, loser_status, coverage FROM mapped_feed_v""")
def d4(spark, sf):
    return mapped(spark, sf).select("seq", "winner_api_key", "loser_api_key", "winner_key", "loser_key", "winner_status",
                                    "loser_status", "coverage")


def decisions(spark, sf):
    ends = closure(spark, sf)   # once for both feeds
    primary = aliased(spark, sf, ends).where("winner_key <> loser_key")
    return primary, M.cross_source_merge(primary, mapped(spark, sf, ends))


@query("d5_cross_source_merge", """
SELECT seq, match_date, gender, level, surface, winner_key, loser_key, strategy, met_id, outcome FROM merge_v""")
def d5(spark, sf):
    return decisions(spark, sf)[1]


@query("d5_merged_table", """
SELECT seq, match_date, gender, level, surface, winner_key, loser_key, source, 'm:' || substr(sha256(source || '|' || seq || '|' ||
  CAST(match_date AS VARCHAR) || '|' || gender || '|' || winner_key || '|' || loser_key), 1, 24) AS canonical_id
FROM (SELECT seq, match_date, gender, level, surface, winner_key, loser_key, 'history' AS source FROM primary_v
  UNION ALL SELECT seq, match_date, gender, level, surface, winner_key, loser_key, 'feed' FROM merge_v WHERE outcome = 'added')""")
def d5_table(spark, sf):
    return M.merged_table(*decisions(spark, sf))


FAMILY = """coalesce(list_filter(string_split(trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) > 1)[-1], '')"""


@query("d7_overlap_candidates", f"""
SELECT f.seq, p.seq AS primary_seq, p.rank, CASE WHEN len(list_intersect(string_split(lower(f.tourney_name), ' '), string_split(lower(p.tourney_name), ' '))) > 0
  THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT *, {FAMILY.format('winner_name')} AS w, {FAMILY.format('loser_name')} AS l FROM feed_v) f
JOIN (SELECT *, row_number() OVER (PARTITION BY gender, match_date, w, l ORDER BY seq) AS rank
  FROM (SELECT *, {FAMILY.format('winner_name')} AS w, {FAMILY.format('loser_name')} AS l FROM matches_v)) p USING (gender, match_date, w, l)
WHERE p.rank <= 3 AND l <> ''""")
def d7(spark, sf):
    return M.overlap_candidates(views.fixture_matches(spark, sf), views.matches(spark, sf))


def prediction_keys(spark, sf):
    return views.valid_matches(spark, sf).select(
        "seq", F.date_format("match_date", "yyyy-MM-dd").alias("date"), "gender", views.match_number().alias("digits"),
        pair_key(F.col("winner_key"), F.col("loser_key")).alias("pair"))


def pick_keys(spark, sf):
    """Picks with the mapped keys of both players."""
    out = views.external_picks(spark, sf)
    for side, short in (("player", "p"), ("opponent", "o")):
        hit = views.mapping(spark, sf).select(F.col("api_key").alias(f"{side}_api_key"), F.col("target_key").alias(f"{short}_key"),
                                              F.col("status").alias(f"{short}_status"))
        out = out.join(hit, f"{side}_api_key", "left").withColumn(
            f"{short}_status", F.coalesce(f"{short}_status", F.lit("not_in_mapping")))
    known = F.col("p_key").isNotNull() & F.col("o_key").isNotNull()
    return out.withColumn("digits", F.regexp_replace("fixture_id", "[^0-9]+", "")).withColumn(
        "pair", F.when(known, pair_key(F.col("p_key"), F.col("o_key"))))


@query("d8_pick_to_prediction", "SELECT pick_id, match_status, prediction_seq FROM pick_match_v")
def d8(spark, sf):
    return M.pick_to_prediction(pick_keys(spark, sf), prediction_keys(spark, sf)).select("pick_id", "match_status", "prediction_seq")


@query("d9_key_variant_settle", """
WITH src AS (SELECT 0 AS priority, 'pick_id:' || pick_id AS key, * FROM source_results_v WHERE pick_id IS NOT NULL
  UNION ALL SELECT 1, 'event_key:' || event_key, * FROM source_results_v WHERE event_key IS NOT NULL
  UNION ALL SELECT 2, 'fixture_id:' || fixture_id, * FROM source_results_v WHERE fixture_id IS NOT NULL
  UNION ALL SELECT 3, 'combo:' || date || '|' || player_key || '|' || opponent_key || '|' || side, * FROM source_results_v),
last AS (SELECT key, any_value(priority) AS priority, lower(arg_max(result, row_no)) AS result, arg_max({'p': profit}, row_no).p AS profit, max(row_no) AS row_no
  FROM src WHERE lower(result) IN ('win', 'loss', 'void', 'push') GROUP BY key),
hit AS (SELECT a.pick_id, l.* FROM (SELECT pick_id, unnest(['pick_id:' || pick_id, 'event_key:' || event_key, 'fixture_id:' || fixture_id,
    'combo:' || date || '|' || player_key || '|' || opponent_key || '|' || side]) AS key FROM active_v) a JOIN last l USING (key)
  QUALIFY row_number() OVER (PARTITION BY a.pick_id ORDER BY l.priority) = 1)
SELECT a.pick_id, h.priority AS matched_priority, h.result AS source_result, h.profit AS source_profit, h.row_no AS source_row_no
FROM active_v a LEFT JOIN hit h USING (pick_id)""")
def d9(spark, sf):
    src = views.source_results(spark, sf).withColumn("order_no", F.col("row_no"))
    out = M.settle_by_key_variants(views.active_picks(spark, sf), src, "order_no", ["row_no", "result", "profit"])
    return out.select("pick_id", F.col("matched_priority").cast("int").alias("matched_priority"), "source_result",
                      "source_profit", "source_row_no")


def surface_map(spark, sf):
    """One surface per tournament name, numbered in name order."""
    rows = views.fixtures(spark, sf).where("true_surface <> 'unknown'")
    return rows.groupBy(F.lower("tournament_name").alias("map_key")).agg(
        F.min("true_surface").alias("map_value"), F.min("seq").alias("position"))


def context_texts(spark, sf):
    return views.fixtures(spark, sf).select(C.context_text(
        F.col("event_type_type"), F.col("tournament_name"), F.col("tournament_round")).alias("text"))


@query("d10_surface_text_lookup", """
WITH mp AS (SELECT lower(tournament_name) AS map_key, min(true_surface) AS map_value, min(seq) AS position FROM fixtures_v
  WHERE true_surface <> 'unknown' GROUP BY 1),
t AS (SELECT DISTINCT lower(event_type_type || ' ' || tournament_name || ' ' || tournament_round) AS text FROM fixtures_v),
hits AS (SELECT text, map_key, map_value, position FROM t JOIN mp ON contains(t.text, mp.map_key))
SELECT text, arg_min(map_key, {'l': -length(map_key), 'k': map_key}) AS map_key, arg_min(map_value, {'l': -length(map_key), 'k': map_key}) AS surface,
  arg_min(map_key, position) AS first_map_key FROM hits GROUP BY text""")
def d10(spark, sf):
    texts, smap = context_texts(spark, sf), surface_map(spark, sf)
    first = M.surface_text_lookup(texts, smap, longest=False).select("text", F.col("map_key").alias("first_map_key"))
    return M.surface_text_lookup(texts, smap).join(first, "text")


@query("d12_trace_ids", """
WITH s AS (SELECT 'history' AS source, player_key, lower(name) AS name FROM (SELECT winner_key AS player_key, winner_name AS name FROM matches_v
    UNION ALL SELECT loser_key, loser_name FROM matches_v)
  UNION ALL SELECT 'feed', player_key, replace(lower(name), '.', '') FROM (SELECT winner_api_key AS player_key, winner_name AS name FROM feed_v
    UNION ALL SELECT loser_api_key, loser_name FROM feed_v)),
q AS (SELECT c_custkey AS query, 'men:history:' || c_custkey AS player_key, 'p ' || c_custkey AS name FROM customer)
SELECT query, 'key' AS kind, source, count(*) AS appearances FROM q JOIN s USING (player_key) GROUP BY ALL
UNION ALL SELECT query, 'name', source, count(*) FROM q JOIN s USING (name) GROUP BY ALL""")
def d12(spark, sf):
    own = explode_sides(views.matches(spark, sf), []).withColumn("source", F.lit("history"))
    feed = explode_sides(views.fixture_matches(spark, sf).withColumnsRenamed(
        {"winner_api_key": "winner_key", "loser_api_key": "loser_key"}), []).withColumn("source", F.lit("feed"))
    queries = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("query"), F.concat(F.lit("men:history:"), "c_custkey").alias("player_key"),
        F.concat(F.lit("P. "), "c_custkey").alias("name"))
    return M.trace_ids(own.unionByName(feed), queries)


@query("d12_trace_rows", """
WITH s AS (SELECT seq, match_date, level, surface, winner_key AS player_key, winner_name AS name, loser_key AS opponent_key, loser_name AS opponent_name, true AS won FROM matches_v
  UNION ALL SELECT seq, match_date, level, surface, loser_key, loser_name, winner_key, winner_name, false FROM matches_v),
q AS (SELECT c_custkey AS query, 'men:history:' || c_custkey AS k, 'Player ' || (c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END) AS name FROM customer)
SELECT q.query, s.*, CASE WHEN player_key = k THEN 'key' ELSE 'name' END AS matched_by FROM q JOIN s ON s.player_key = q.k OR s.name = q.name""")
def d12_rows(spark, sf):
    sides = explode_sides(views.matches(spark, sf), ["seq", "match_date", "level", "surface"])
    c = F.col("c_custkey")
    queries = views.table(spark, sf, "customer").select(
        c.alias("query"), F.concat(F.lit("men:history:"), c).alias("player_key"), F.concat(F.lit("Player "), c + F.when(c % 2 == 0, 1).otherwise(0)).alias("name"))
    return M.trace_rows(sides, queries)


@query("d12_trace_few", """
WITH s AS (SELECT seq, match_date, level, surface, winner_key AS player_key, winner_name AS name, loser_key AS opponent_key, loser_name AS opponent_name, true AS won FROM matches_v
  UNION ALL SELECT seq, match_date, level, surface, loser_key, loser_name, winner_key, winner_name, false FROM matches_v),
q AS (SELECT row_number() OVER (ORDER BY count(*) DESC, player_key) AS query, player_key AS k, min(name) AS name FROM s GROUP BY player_key QUALIFY query <= 20)
SELECT q.query, s.*, CASE WHEN player_key = k THEN 'key' ELSE 'name' END AS matched_by FROM q JOIN s ON s.player_key = q.k OR s.name = q.name""")
def d12_few(spark, sf):
    """All rows of the twenty players with most matches, and of others of their name, read from an index."""
    sides = explode_sides(views.matches(spark, sf), ["seq", "match_date", "level", "surface"])
    path = new_path(spark, "side-index")
    M.index_sides(sides, path, ["match_date", "seq"])
    most = spark.read.parquet(f"{path}/by_key").groupBy("player_key").agg(F.count("*").alias("n"), F.min("name").alias("name"))
    top = most.orderBy(F.desc("n"), "player_key").limit(20)
    queries = top.select(F.row_number().over(Window.orderBy(F.desc("n"), "player_key")).alias("query"), "player_key", "name")  # twenty rows
    return M.trace_few(spark, path, queries)


@query("d13_many_to_one_check", """
SELECT gender || ':history:' || (user_id // 5) AS target_key, count(DISTINCT api_key) AS feed_keys, min(api_key) AS first_key, max(api_key) AS last_key
FROM mapping_v WHERE target_key IS NOT NULL GROUP BY 1 HAVING count(DISTINCT api_key) > 3""")
def d13(spark, sf):
    m = views.mapping(spark, sf).withColumn("target_key", F.when(
        F.col("target_key").isNotNull(), F.concat_ws(":", "gender", F.lit("history"), F.expr("user_id div 5"))))
    return M.many_to_one(m)
