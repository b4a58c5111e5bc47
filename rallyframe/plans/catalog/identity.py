"""Entity resolution and its review loops."""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.functions import text as T
from rallyframe.functions.similarity import seq_ratio
from rallyframe.functions.values import rounded
from rallyframe.operators import aliases as A
from rallyframe.operators import candidate_search as S
from rallyframe.operators import identity as E
from rallyframe.operators import ladders
from rallyframe.operators import review as R
from rallyframe.operators.sides import explode_sides
from rallyframe.plans import views
from rallyframe.plans.catalog.imports import history as imported_history
from rallyframe.plans.catalog.merging import closure
from rallyframe.plans.registry import query
from rallyframe.workspace import materialise

NORM = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"
TOKS = f"list_filter(string_split({NORM}, ' '), lambda x: x <> '')"


def feed_players(spark, sf):
    return materialise(views.names(spark, sf).select(
        F.concat_ws(":", "gender", F.lit("api"), "doc_id").alias("player_key"), "gender", F.col("feed_name").alias("name"), "matches", "doc_id"), "feed-players")


def own_players(spark, sf):
    return materialise(views.names(spark, sf).select(
        F.concat_ws(":", "gender", F.lit("history"), "doc_id").alias("player_key"), "gender", "name", "matches", "country", "birth_year", "doc_id"),
        "own-players")


@query("b16_seq_ratio")
def b16(spark, sf):
    n = views.names(spark, sf)
    return n.select("doc_id", rounded(seq_ratio(T.normalize_name(F.col("name")), T.normalize_name(F.col("feed_name"))), 6).alias("ratio"))


@query("e1_canonical_player_profiles", """
WITH r AS (SELECT s.*, coalesce(a.canonical_key, player_key) AS key FROM ladder_state_v s LEFT JOIN alias_closure_v a ON a.alias_key = player_key),
c AS (SELECT key, string_agg(value || '=' || n, ',' ORDER BY value) FILTER (layer = 'level') AS levels, string_agg(value || '=' || n, ',' ORDER BY value) FILTER (layer = 'surface') AS surfaces
  FROM (SELECT key, layer, value, sum(n)::BIGINT AS n FROM r WHERE layer IN ('level', 'surface') GROUP BY 1, 2, 3) GROUP BY 1)
SELECT key, split_part(key, ':', 1) AS gender, arg_min(f.name, player_key) AS name, sum(total)::BIGINT AS matches, sum(sf)::BIGINT AS surface_matches,
  count(*) AS merged_keys, any_value(levels) AS levels, coalesce(any_value(surfaces), '') AS surfaces
FROM (SELECT player_key, key, sum(n) FILTER (layer = 'overall') AS total, coalesce(sum(n) FILTER (layer = 'surface'), 0) AS sf FROM r GROUP BY 1, 2)
JOIN first_names_v f USING (player_key) JOIN c USING (key) GROUP BY key""")
def e1(spark, sf):
    m = views.valid_matches(spark, sf)
    profiles = E.canonical_profiles(ladders.ladder_ratings(ladders.fold_ladders(m)), ladders.first_names(m), closure(spark, sf))
    shown = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(c)
    return profiles.select(*[c for c in profiles.columns if c not in ("levels", "surfaces")], shown("levels"), shown("surfaces"))


def flat_feed(spark, sf):
    return views.fixture_matches(spark, sf).withColumnsRenamed({"winner_api_key": "winner_key", "loser_api_key": "loser_key"})


TOP = """SELECT player_key, string_agg({0} || '=' || n, ',' ORDER BY n DESC, {0}) AS top_{0} FROM (SELECT player_key, {0}, count(*) AS n,
  row_number() OVER (PARTITION BY player_key ORDER BY count(*) DESC, {0}) AS rn FROM s GROUP BY 1, 2) WHERE rn <= {1} GROUP BY 1"""


@query("e2_source_player_profiles", f"""
WITH raw AS (SELECT winner_api_key AS player_key, winner_name AS name, loser_api_key AS opponent_key, loser_name AS opponent_name, gender, level, surface, tourney_name FROM feed_v
  UNION ALL SELECT loser_api_key, loser_name, winner_api_key, winner_name, gender, level, surface, tourney_name FROM feed_v),
s AS (SELECT raw.* REPLACE (coalesce(nullif(a.player_full_name, ''), a.player_name, raw.name) AS name, coalesce(nullif(b.player_full_name, ''), b.player_name, raw.opponent_name) AS opponent_name)
  FROM raw LEFT JOIN cache_v a ON a.player_key = split_part(raw.player_key, ':', 3) LEFT JOIN cache_v b ON b.player_key = split_part(raw.opponent_key, ':', 3))
SELECT b.*, n.name, l.top_level, f.top_surface, o.top_opponent_name, t.top_tourney_name FROM (SELECT player_key, min(gender) AS gender, count(*) AS matches,
  count(DISTINCT opponent_key) AS opponents, count(DISTINCT tourney_name) AS tournaments FROM s GROUP BY 1) b
JOIN (SELECT player_key, min(name) AS name FROM s GROUP BY 1) n USING (player_key) JOIN ({TOP.format('level', 5)}) l USING (player_key)
JOIN ({TOP.format('surface', 5)}) f USING (player_key) JOIN ({TOP.format('opponent_name', 3)}) o USING (player_key) JOIN ({TOP.format('tourney_name', 5)}) t USING (player_key)""")
def e2(spark, sf):
    return E.source_profiles(flat_feed(spark, sf), views.player_cache(spark, sf))


@query("e3_blocking", """
SELECT DISTINCT gender, a.norm AS feed_norm, b.norm AS cand_norm FROM feed_blocks_v a JOIN own_blocks_v b USING (gender, kind, key)""")
def e3(spark, sf):
    return E.equal_key_pairs(E.distinct_names(feed_players(spark, sf)), E.distinct_names(own_players(spark, sf)))


@query("e3_candidate_pairs")
def e3_all(spark, sf):
    return E.candidate_pairs(E.distinct_names(feed_players(spark, sf)), E.distinct_names(own_players(spark, sf)))


@query("e4_exact_tiers", "SELECT gender, feed_norm, cand_norm, base_score, method FROM exact_pairs_v")
def e4(spark, sf):
    pairs = E.equal_key_pairs(E.distinct_names(feed_players(spark, sf)), E.distinct_names(own_players(spark, sf)), E.EXACT_KINDS)
    return E.score_pairs(pairs, exact=True)


@query("e4_score_pairs")
def e4_all(spark, sf):
    s = E.score_pairs(E.candidate_pairs(E.distinct_names(feed_players(spark, sf)), E.distinct_names(own_players(spark, sf))))
    return s.where("base_score >= 0.76").withColumn("base_score", rounded(F.col("base_score"), 6))


def exact_ranked(spark, sf):
    own = own_players(spark, sf)
    pairs = E.equal_key_pairs(E.distinct_names(feed_players(spark, sf)), E.distinct_names(own), E.EXACT_KINDS).withColumn("stage", F.lit(1))
    return E.rank_candidates(E.score_pairs(pairs, exact=True), own)


RANKED = f"""SELECT *, least(0.999, uncapped) AS score, CASE WHEN rank = 1 THEN least(0.999, uncapped) - coalesce(lead(least(0.999, uncapped)) OVER
    (PARTITION BY gender, feed_norm ORDER BY rank), 0) END AS margin
FROM (SELECT p.gender, p.feed_norm, p.method, c.player_key AS cand_key, c.matches AS cand_matches, base_score + least(0.012, ln(1 + c.matches) / 1000) AS uncapped,
  row_number() OVER (PARTITION BY p.gender, p.feed_norm ORDER BY base_score + least(0.012, ln(1 + c.matches) / 1000) DESC, c.matches DESC, c.player_key) AS rank
  FROM exact_pairs_v p JOIN (SELECT gender, gender || ':history:' || doc_id AS player_key, matches, {NORM.format('name')} AS norm FROM names_v) c
  ON c.gender = p.gender AND c.norm = p.cand_norm) WHERE rank <= 10"""


@query("w5_rank_candidates", f"""
SELECT gender, feed_norm, rank, cand_key, cand_matches, method, floor(score * 1e6 + 0.5) / 1e6 AS score FROM ({RANKED})""")
def w5(spark, sf):
    return exact_ranked(spark, sf).select("gender", "feed_norm", "rank", "cand_key", "cand_matches", "method", rounded(F.col("score"), 6).alias("score"))


@query("w4_margin_to_second", f"SELECT gender, feed_norm, floor(margin * 1e6 + 0.5) / 1e6 AS margin FROM ({RANKED}) WHERE rank = 1")
def w4(spark, sf):
    return exact_ranked(spark, sf).where("rank = 1").select("gender", "feed_norm", rounded(F.col("margin"), 6).alias("margin"))


@query("e5_rank_and_accept_exact", f"""
SELECT gender, feed_norm, CASE WHEN ok THEN 'auto_mapped' WHEN score >= 0.83 THEN 'ambiguous' ELSE 'unmapped' END AS status,
  CASE WHEN ok THEN cand_key END AS target_key, floor(score * 1e6 + 0.5) / 1e6 AS confidence, method, floor(margin * 1e6 + 0.5) / 1e6 AS margin
FROM (SELECT *, (score >= 0.935 AND margin >= 0.055) OR (score >= 0.965 AND margin >= 0.020) AS ok FROM ({RANKED}) WHERE rank = 1)""")
def e5(spark, sf):
    return E.decide(exact_ranked(spark, sf))


@query("e5_rank_and_accept")
def e5_all(spark, sf):
    return E.build_mapping(feed_players(spark, sf), own_players(spark, sf))


OVERRIDES = """SELECT CASE doc_id % 3 WHEN 0 THEN CAST(doc_id AS VARCHAR) WHEN 1 THEN g || ':api:' || doc_id ELSE g || ':api_feed:' || doc_id END AS override_key,
  CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN g || ':history:' || doc_id ELSE g || ':history:' || (doc_id + 1000000000) END AS target_key, doc_id
FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN 'men' ELSE 'women' END AS g FROM labels)"""


def overrides(spark, sf):
    d = F.col("doc_id")
    g = F.when(d % 2 == 0, "men").otherwise("women")
    key = (F.when(d % 3 == 0, d.cast("string")).when(d % 3 == 1, F.concat_ws(":", g, F.lit("api"), d)).otherwise(F.concat_ws(":", g, F.lit("api_feed"), d)))
    target = (F.when(F.col("toxic") == 1, None).when(F.col("quality") == 1, F.concat_ws(":", g, F.lit("history"), d))
              .otherwise(F.concat_ws(":", g, F.lit("history"), d + 1000000000)))
    return views.table(spark, sf, "labels").select(key.alias("override_key"), target.alias("target_key"))


@query("e6_apply_overrides", f"""
SELECT n.gender || ':api:' || n.doc_id AS api_key,
  CASE WHEN o.doc_id IS NULL THEN CASE WHEN matches % 2 = 0 THEN 'auto_mapped' ELSE 'unmapped' END WHEN o.target_key IS NULL THEN 'manual_unmapped'
    WHEN e.key IS NULL THEN 'manual_invalid_target' ELSE 'manual_mapped' END AS status,
  CASE WHEN o.doc_id IS NULL THEN CASE WHEN matches % 2 = 0 THEN n.gender || ':history:' || n.doc_id END ELSE e.key END AS target_key,
  CASE WHEN o.doc_id IS NULL THEN 'automatic' ELSE 'manual_override' END AS source, o.override_key
FROM names_v n LEFT JOIN ({OVERRIDES}) o USING (doc_id) LEFT JOIN alias_closure_v a ON a.alias_key = o.target_key
LEFT JOIN (SELECT gender || ':history:' || doc_id AS key FROM names_v) e ON e.key = coalesce(a.canonical_key, o.target_key)""")
def e6(spark, sf):
    own = own_players(spark, sf)
    even = F.col("matches") % 2 == 0
    base = own.select(F.concat_ws(":", "gender", F.lit("api"), "doc_id").alias("api_key"), "gender",
                      F.when(even, "auto_mapped").otherwise("unmapped").alias("status"), F.when(even, F.col("player_key")).alias("target_key"))
    return E.apply_overrides(base, overrides(spark, sf), closure(spark, sf), own)


@query("e7_candidate_search_global")
def e7(spark, sf):
    return S.search_global(feed_players(spark, sf), own_players(spark, sf))


@query("e8_candidate_search_deep")
def e8(spark, sf):
    return S.search_deep(feed_players(spark, sf), own_players(spark, sf))


def pool_tables(spark, sf):
    """The four kinds of table that hold players: listed years, match lines, the merged table of all feeds, raw history files."""
    columns = ["match_id", "match_date", "gender", "tourney_name", "winner_key", "winner_name", "loser_key", "loser_name"]
    own = views.matches(spark, sf).withColumn("match_id", F.col("seq"))
    other = flat_feed(spark, sf).withColumn("match_id", F.col("seq"))
    merged = own.select(*columns, F.lit("history").alias("feed")).unionByName(other.select(*columns, F.lit("api").alias("feed")))
    raw = imported_history(spark, sf).withColumn("match_id", F.col("seq")).withColumn("match_date", F.col("date").try_cast("date"))
    return {"listed": own.where("winner_key <> loser_key").select(*columns), "lines": own.select(*columns), "merged": merged, "raw": raw.select(*columns)}


@query("e8_candidate_pool", """
WITH t AS (SELECT 'listed' AS tab, seq, match_date, gender, tourney_name, winner_key, winner_name, loser_key, loser_name FROM valid_v
  UNION ALL SELECT x.tab, seq, match_date, gender, tourney_name, winner_key, winner_name, loser_key, loser_name FROM matches_v, (VALUES ('lines'), ('merged')) x(tab)
  UNION ALL SELECT 'raw', seq, TRY_CAST(date AS DATE), gender, tourney_name,
    gender || CASE WHEN winner_id = '' THEN ':name:' || replace(lower(winner_name), ' ', '_') ELSE ':history:' || winner_id END, winner_name, gender || ':history:' || loser_id, loser_name FROM history_import_v),
s AS (SELECT tab, seq, match_date, gender, tourney_name, winner_key AS player_key, winner_name AS name FROM t UNION ALL SELECT tab, seq, match_date, gender, tourney_name, loser_key, loser_name FROM t),
k AS (SELECT * FROM s WHERE trim(name) <> '' AND trim(player_key) <> ''),
per AS (SELECT player_key, tab, count(*) AS n, min(match_date) AS low, max(match_date) AS high, min(gender) AS gender FROM k GROUP BY 1, 2),
tops AS (SELECT player_key, string_agg(tourney_name || '=' || n, ',' ORDER BY n DESC, tourney_name) AS top_tourney_name
  FROM (SELECT player_key, tourney_name, count(*) AS n FROM k GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY n DESC, tourney_name) <= 3) GROUP BY 1),
said AS (SELECT player_key, name FROM (SELECT player_key, name, count(*) AS n FROM k GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY n DESC, name) = 1))
SELECT player_key, min(per.gender) AS gender, sum(n)::BIGINT AS appearances, string_agg(tab || '=' || n, ',' ORDER BY tab) AS tables, min(low) AS first_day, max(high) AS last_day,
  (SELECT count(DISTINCT seq) FROM k WHERE k.player_key = per.player_key) AS matches, any_value(said.name) AS name, any_value(top_tourney_name) AS top_tourney_name
FROM per JOIN said USING (player_key) LEFT JOIN tops USING (player_key) GROUP BY player_key""")
def e8_pool(spark, sf):
    return S.candidate_pool(pool_tables(spark, sf))


GROUPS = f"""SELECT *, CASE WHEN countries <= 1 AND years <= 1 THEN CASE WHEN low <= 2 AND high >= 10 THEN 'LOW' ELSE 'MEDIUM' END
    WHEN countries > 1 AND years > 1 THEN 'HIGH' ELSE 'CHECK' END AS risk_level
FROM (SELECT gender, norm, count(*) AS keys, count(DISTINCT country) AS countries, count(DISTINCT birth_year) AS years, min(matches) AS low, max(matches) AS high,
  max({{'m': matches, 'd': doc_id}}).d AS rec FROM (SELECT *, {NORM.format('name')} AS norm FROM names_v) WHERE norm <> '' GROUP BY 1, 2) WHERE keys >= 2"""
DUPLICATES = f"""SELECT g.risk_level, g.gender, g.norm, g.gender || ':history:' || n.doc_id AS player_key, n.matches, n.country, n.birth_year, g.keys AS keys_in_group,
  g.gender || ':history:' || g.rec AS recommended_key
FROM ({GROUPS}) g JOIN (SELECT *, {NORM.format('name')} AS norm FROM names_v) n USING (gender, norm)"""


@query("e9_duplicate_groups", DUPLICATES)
def e9(spark, sf):
    return R.duplicate_groups(own_players(spark, sf))


@query("e10_merge_alias_template", """
WITH t AS (SELECT g.gender || ':history:' || c_custkey AS alias_key, g.gender || ':history:' || (c_custkey - 1 - c_custkey % 2) AS proposed
  FROM customer, (VALUES ('men'), ('women')) g(gender))
SELECT alias_key, coalesce(a.canonical_key, t.proposed) AS canonical_key, CASE WHEN a.canonical_key IS NULL THEN 'added' WHEN t.proposed = a.canonical_key THEN 'unchanged'
  ELSE 'conflict' END AS outcome FROM t FULL JOIN aliases_v a USING (alias_key)""")
def e10(spark, sf):
    c = F.col("c_custkey")
    template = (views.table(spark, sf, "customer").select("c_custkey", F.explode(F.array(F.lit("men"), F.lit("women"))).alias("gender"))
                .select(F.concat_ws(":", "gender", F.lit("history"), c).alias("alias_key"),
                        F.concat_ws(":", "gender", F.lit("history"), c - 1 - c % 2).alias("canonical_key")))
    return A.merge_alias_template(A.valid_aliases(views.raw_aliases(spark, sf)), template)


def history_with_gender(spark, sf):
    return views.history_rows(spark, sf).withColumn("gender", F.when(F.col("source_file").startswith("atp"), "men").otherwise("women"))


def master(spark, sf):
    c = F.col("c_custkey")
    return (views.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.explode(F.array(F.lit("men"), F.lit("women"))).alias("gender"))
            .select(F.concat_ws(":", "gender", F.lit("history"), c).alias("player_key"), F.concat(F.lit("Player "), c).alias("name"),
                    F.when(F.col("c_nationkey") < 12, F.concat(F.lit("N"), "c_nationkey")).alias("country"),
                    F.lit("Player").alias("first_name"), c.cast("string").alias("last_name"), F.when(c % 4 == 0, (c % 40 + 160).cast("string")).alias("height"),
                    F.when(F.col("c_mktsegment") == "BUILDING", "A").alias("hand"), F.concat(F.lit("19"), F.lpad((c % 90 + 10).cast("string"), 2, "0"), F.lit("-01-01")).alias("birth_date")))


META_TOP = """SELECT player_key, arg_min({0}, rn) AS {0}, string_agg({0} || '=' || n, ',' ORDER BY rn) AS top_{0} FROM (SELECT player_key, {0}, count(*) AS n,
  row_number() OVER (PARTITION BY player_key ORDER BY count(*) DESC, {0}) AS rn FROM s WHERE {0} IS NOT NULL GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1"""


@query("e11_player_metadata", f"""
WITH s AS (SELECT gender || ':history:' || x.player_id AS player_key, x.name, nullif(x.ioc, '') AS country, nullif(x.hand, '') AS hand, nullif(x.ht, '') AS height,
    CASE WHEN regexp_full_match(tourney_date, '[0-9]{{8}}') THEN CAST(CAST(round_even(CAST(tourney_date[1:4] AS INTEGER) - CAST(x.age AS DOUBLE), 0) AS INTEGER) AS VARCHAR) END AS approx_birth_year
  FROM (SELECT *, CASE WHEN source_file LIKE 'atp%' THEN 'men' ELSE 'women' END AS gender FROM history_v), LATERAL (VALUES (winner_id, winner_name, winner_ioc, winner_hand, winner_ht, winner_age),
    (loser_id, loser_name, loser_ioc, loser_hand, loser_ht, loser_age)) x(player_id, name, ioc, hand, ht, age) WHERE x.player_id <> '' AND x.name <> ''),
m AS (SELECT g.gender || ':history:' || c_custkey AS player_key, 'Player ' || c_custkey AS name, CASE WHEN c_nationkey < 12 THEN 'N' || c_nationkey END AS country,
  'Player' AS first_name, CAST(c_custkey AS VARCHAR) AS last_name, CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 40 + 160 AS VARCHAR) END AS height,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'A' END AS hand, '19' || lpad(CAST(c_custkey % 90 + 10 AS VARCHAR), 2, '0') || '-01-01' AS birth_date
  FROM customer, (VALUES ('men'), ('women')) g(gender)),
b AS (SELECT player_key, min(name) AS name, count(*) AS sides FROM s GROUP BY 1)
SELECT player_key, coalesce(m.name, b.name) AS name, coalesce(m.country, c.country) AS country, coalesce(m.hand, h.hand) AS hand, coalesce(m.height, t.height) AS height, y.approx_birth_year, m.birth_date,
  m.first_name, m.last_name, c.top_country, h.top_hand, t.top_height, y.top_approx_birth_year, coalesce(b.sides, 0) AS sides
FROM b FULL JOIN m USING (player_key) LEFT JOIN ({META_TOP.format('country')}) c USING (player_key) LEFT JOIN ({META_TOP.format('hand')}) h USING (player_key)
LEFT JOIN ({META_TOP.format('height')}) t USING (player_key) LEFT JOIN ({META_TOP.format('approx_birth_year')}) y USING (player_key)""")
def e11(spark, sf):
    return R.player_metadata(history_with_gender(spark, sf), master(spark, sf))


@query("e11_metadata_coverage", """
WITH m AS (SELECT DISTINCT CASE WHEN source_file LIKE 'atp%' THEN 'men' ELSE 'women' END || ':history:' || x.i AS player_key FROM history_v,
    LATERAL (VALUES (winner_id, winner_name), (loser_id, loser_name)) x(i, n) WHERE x.i <> '' AND x.n <> ''
  UNION SELECT g.gender || ':history:' || c_custkey FROM customer, (VALUES ('men'), ('women')) g(gender)),
r AS (SELECT DISTINCT player_key FROM sides_v)
SELECT count(m.player_key) AS metadata_players, count(r.player_key) AS rating_players, count(*) FILTER (m.player_key IS NOT NULL AND r.player_key IS NOT NULL) AS rating_players_with_metadata,
  count(*) FILTER (m.player_key IS NULL) AS rating_players_missing_metadata, count(*) FILTER (r.player_key IS NULL) AS metadata_players_not_in_ratings
FROM m FULL JOIN r ON m.player_key = r.player_key""")
def e11_coverage(spark, sf):
    keys = explode_sides(views.valid_matches(spark, sf), ["seq"]).select("player_key")
    return R.metadata_coverage(R.player_metadata(history_with_gender(spark, sf), master(spark, sf)), keys)


@query("e12_override_verdict", f"""
WITH o AS (SELECT a.gender || ':api:' || a.doc_id AS api_key, a.feed_name, b.name AS own_name, a.country AS feed_country, b.country AS own_country,
    a.birth_year + a.doc_id % 3 AS feed_year, CASE WHEN b.doc_id % 7 = 0 THEN NULL ELSE b.birth_year END AS own_year
  FROM names_v a JOIN names_v b ON b.doc_id = CASE WHEN a.matches % 3 = 0 THEN a.doc_id + 2 ELSE a.doc_id END),
t AS (SELECT *, {TOKS.format('feed_name')} AS a, {TOKS.format('own_name')} AS b FROM o),
c AS (SELECT api_key, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 'missing_name' WHEN a = b THEN 'exact' WHEN list_sort(a) = list_sort(b) THEN 'token_set_exact'
    WHEN array_to_string(a, '') = array_to_string(b, '') THEN 'compact_exact' WHEN len(a) = 2 AND length(a[1]) = 1 AND len(b) >= 2 AND a[1] = b[1][1] AND a[-1] = b[-1] THEN 'initial_surname'
    WHEN a[-1] = b[-1] THEN 'same_surname' WHEN list_has_any(a, b) THEN 'partial_token_overlap' ELSE 'weak' END AS name_class,
  CASE WHEN feed_country = own_country THEN 'match' ELSE 'mismatch' END AS country_class,
  CASE WHEN own_year IS NULL THEN 'unknown' WHEN feed_year = own_year THEN 'match' WHEN abs(feed_year - own_year) = 1 THEN 'near' ELSE 'mismatch' END AS year_class FROM t)
SELECT *, name_class || ' country:' || country_class || ' year:' || year_class AS reasons,
  CASE WHEN name_class LIKE '%exact' THEN CASE WHEN country_class = 'mismatch' OR year_class = 'mismatch' THEN 'CHECK' ELSE 'SAFE' END
    WHEN country_class = 'mismatch' OR year_class = 'mismatch' THEN 'RISKY' WHEN name_class = 'initial_surname' THEN 'LIKELY_OK'
    WHEN name_class IN ('same_surname', 'partial_token_overlap') THEN CASE WHEN year_class IN ('match', 'near') THEN 'LIKELY_OK' ELSE 'CHECK' END ELSE 'RISKY' END AS verdict FROM c""")
def e12(spark, sf):
    n = materialise(views.names(spark, sf), "names")
    a = n.select(F.concat_ws(":", "gender", F.lit("api"), "doc_id").alias("api_key"), "feed_name", F.col("country").alias("feed_country"),
                 (F.col("birth_year") + F.col("doc_id") % 3).alias("feed_year"), F.when(F.col("matches") % 3 == 0, F.col("doc_id") + 2).otherwise(F.col("doc_id")).alias("target"))
    b = n.select(F.col("doc_id").alias("target"), F.col("name").alias("own_name"), F.col("country").alias("own_country"),
                 F.when(F.col("doc_id") % 7 != 0, F.col("birth_year")).alias("own_year"))
    return R.override_verdicts(a.join(b, "target"))


def status(spark, sf):
    return R.side_status(views.fixture_matches(spark, sf), views.mapping(spark, sf))


COVERED = """SELECT f.*, a.status AS ws, b.status AS ls, a.target_key IS NOT NULL AS wm, b.target_key IS NOT NULL AS lm,
  CASE WHEN a.target_key IS NOT NULL AND b.target_key IS NOT NULL THEN 'both_mapped' WHEN a.target_key IS NOT NULL OR b.target_key IS NOT NULL THEN 'one_mapped' ELSE 'none_mapped' END AS coverage
FROM feed_v f LEFT JOIN mapping_v a ON a.api_key = winner_api_key LEFT JOIN mapping_v b ON b.api_key = loser_api_key"""


@query("e13_mapping_coverage", f"""
SELECT x.cut, x.value, count(*) AS matches, floor(count(*) * 100 * 1e3 / (SELECT count(*) FROM feed_v) + 0.5) / 1e3 AS pct
FROM ({COVERED}), LATERAL (VALUES ('coverage', coverage), ('coverage_level', coverage || '|' || level)) x(cut, value) GROUP BY ALL""")
def e13(spark, sf):
    return R.mapping_coverage(status(spark, sf))


@query("e13_unmapped_impact", f"""
WITH s AS (SELECT winner_api_key AS player_key, ws AS status, level, surface, tourney_name FROM ({COVERED}) WHERE NOT wm
  UNION ALL SELECT loser_api_key, ls, level, surface, tourney_name FROM ({COVERED}) WHERE NOT lm)
SELECT b.player_key AS api_key, b.* EXCLUDE (player_key), f.top_surface, t.top_tourney_name FROM (SELECT player_key, min(status) AS mapping_status, count(*) AS matches,
  count(*) FILTER (level = 'grand_slam') AS grand_slam_matches, count(*) FILTER (level = 'atp_wta') AS atp_wta_matches, count(*) FILTER (level = 'challenger') AS challenger_matches,
  count(*) FILTER (level = 'itf') AS itf_matches, count(*) FILTER (level = 'qualifying') AS qualifying_matches FROM s GROUP BY 1) b
JOIN ({TOP.format('surface', 5)}) f USING (player_key) JOIN ({TOP.format('tourney_name', 5)}) t USING (player_key)""")
def e13_impact(spark, sf):
    return R.unmapped_impact(status(spark, sf))


@query("e17_many_issue_audit", """
WITH m AS (SELECT CASE WHEN m0.status = 'ambiguous' THEN api_key || 'x' ELSE api_key END AS api_key, CASE WHEN user_id % 17 = 3 THEN 'odd' ELSE status END AS status, CASE WHEN user_id % 23 = 5 THEN 'x' ELSE gender END AS gender,
  CASE WHEN user_id % 19 = 7 THEN NULL WHEN user_id % 19 = 8 THEN 'women:history:1' ELSE target_key END AS target_key FROM mapping_v m0)
SELECT api_key, x.issue FROM m, LATERAL (VALUES ('invalid_status', status = 'odd'), ('invalid_gender', gender = 'x'),
  ('accepted_mapping_without_target', status IN ('auto_mapped', 'manual_mapped') AND target_key IS NULL),
  ('nonaccepted_mapping_has_target', status NOT IN ('auto_mapped', 'manual_mapped') AND target_key IS NOT NULL),
  ('target_gender_mismatch', target_key IS NOT NULL AND split_part(target_key, ':', 1) <> gender)) x(issue, hit) WHERE x.hit
UNION ALL SELECT DISTINCT k, 'source_player_missing_mapping_entry' FROM (SELECT winner_api_key AS k FROM feed_v UNION SELECT loser_api_key FROM feed_v)
WHERE k NOT IN (SELECT api_key FROM m)""")
def e17(spark, sf):
    u = F.col("user_id")
    # entries with each kind of damage; those of ambiguous players stand under a key the feed does not have
    m = views.mapping(spark, sf).withColumns({
        "api_key": F.when(F.col("status") == "ambiguous", F.concat("api_key", F.lit("x"))).otherwise(F.col("api_key")),
        "status": F.when(u % 17 == 3, "odd").otherwise(F.col("status")), "gender": F.when(u % 23 == 5, "x").otherwise(F.col("gender")),
        "target_key": F.when(u % 19 == 7, None).when(u % 19 == 8, "women:history:1").otherwise(F.col("target_key"))}).drop("user_id")
    keys = views.fixture_matches(spark, sf).select(F.explode(F.array("winner_api_key", "loser_api_key")).alias("api_key"))
    return R.mapping_issues(m, keys)


# --- one day ---------------------------------------------------------------
DAY = "2024-01-10"
CANDIDATES = """SELECT api_key, g.j + 1 AS rank, gender || ':history:' || (user_id + g.j) AS cand_key, floor((0.97 - 0.01 * g.j * (user_id % 3)) * 1e6 + 0.5) / 1e6 AS score,
  CASE WHEN (user_id + g.j) % 2 = 0 THEN 'exact_initial_form' ELSE 'initial_surname' END AS method, CASE WHEN user_id % 4 = 0 THEN 'safe_override' ELSE 'manual_review' END AS action
FROM mapping_v, (VALUES (0), (1), (2), (3)) g(j) WHERE g.j < user_id % 5"""


def candidates(spark, sf):
    u, j = F.col("user_id"), F.col("j")
    return (views.mapping(spark, sf).select("api_key", "gender", "user_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j")).where(j < u % 5)
            .select("api_key", (j + 1).cast("bigint").alias("rank"), F.concat_ws(":", "gender", F.lit("history"), u + j).alias("cand_key"),
                    rounded(0.97 - 0.01 * j * (u % 3), 6).alias("score"),
                    F.when((u + j) % 2 == 0, "exact_initial_form").otherwise("initial_surname").alias("method"),
                    F.when(u % 4 == 0, "safe_override").otherwise("manual_review").alias("action")))


DAY_SIDES = f"""SELECT f.seq, f.true_gender || ':api:' || x.k AS api_key, CASE WHEN m.status = 'ambiguous' THEN 'manual_mapped' ELSE m.status END AS status,
  CASE WHEN m.status = 'ambiguous' THEN m.gender || ':history:1' ELSE m.target_key END AS target_key
FROM fixtures_v f, LATERAL (VALUES (first_player_key), (second_player_key)) x(k) JOIN mapping_v m ON m.api_key = f.true_gender || ':api:' || x.k
WHERE f.match_date = DATE '{DAY}' AND f.event_type_type NOT LIKE '%Doubles%'"""


def day_players(spark, sf):
    f = views.fixtures(spark, sf).where((F.col("match_date") == F.lit(DAY).cast("date")) & ~F.col("event_type_type").contains("Doubles"))
    manual = views.mapping(spark, sf).where("status = 'ambiguous'").select(
        F.concat_ws(":", "gender", F.lit("api_feed"), F.col("user_id") + 100000).alias("api_key"), F.lit("manual_mapped").alias("status"),
        F.concat_ws(":", "gender", F.lit("history"), F.lit("1")).alias("target_key"))
    return R.daily_players(f.withColumnRenamed("true_gender", "gender"), views.mapping(spark, sf), manual)


@query("e14_daily_mapping_audit", f"""
WITH s AS ({DAY_SIDES}), m AS (SELECT seq, count(*) FILTER (target_key IS NOT NULL) AS n FROM s GROUP BY 1),
p AS (SELECT api_key, max(target_key IS NOT NULL) AS ok FROM s GROUP BY 1)
SELECT (SELECT count(*) FROM m) AS matches, (SELECT count(*) FROM m WHERE n = 2) AS both_mapped, (SELECT count(*) FROM m WHERE n = 1) AS one_mapped,
  (SELECT count(*) FROM m WHERE n = 0) AS none_mapped, (SELECT count(*) FROM p) AS players, (SELECT count(*) FROM p WHERE ok) AS mapped_players,
  (SELECT count(*) FROM m WHERE n < 2) AS blocked_matches, (SELECT count(*) FROM m WHERE n < 2) = 0 AND (SELECT count(*) FROM m) > 0 AS scanner_ready""")
def e14(spark, sf):
    return R.daily_coverage(day_players(spark, sf))


@query("e14_daily_review", f"""
WITH s AS (SELECT api_key, min(status) AS mapping_status, count(DISTINCT seq) AS match_count FROM ({DAY_SIDES}) WHERE target_key IS NULL GROUP BY 1),
c AS (SELECT *, row_number() OVER (PARTITION BY api_key ORDER BY score DESC, cand_key) AS rn, count(*) OVER (PARTITION BY api_key) AS cnt FROM ({CANDIDATES})),
w AS (SELECT api_key, any_value(cnt) AS cnt, max(cand_key) FILTER (rn = 1) AS candidate_1_key, max(score) FILTER (rn = 1) AS candidate_1_score,
  max(cand_key) FILTER (rn = 2) AS candidate_2_key, max(score) FILTER (rn = 2) AS candidate_2_score, max(cand_key) FILTER (rn = 3) AS candidate_3_key, max(score) FILTER (rn = 3) AS candidate_3_score
  FROM c GROUP BY 1),
j AS (SELECT s.*, w.* EXCLUDE (api_key), floor((candidate_1_score - candidate_2_score) * 1e6 + 0.5) / 1e6 AS candidate_margin FROM s LEFT JOIN w USING (api_key))
SELECT api_key, mapping_status, match_count, coalesce(cnt, 0) AS candidate_count, candidate_1_key, candidate_1_score, candidate_2_key, candidate_2_score, candidate_3_key, candidate_3_score,
  candidate_margin, coalesce(candidate_margin < 0.025, false) AS ambiguous, CASE WHEN cnt IS NULL THEN 'no_candidate' ELSE 'review' END AS outcome,
  CASE WHEN cnt IS NOT NULL AND NOT coalesce(candidate_margin < 0.025, false) THEN candidate_1_key END AS suggested_target FROM j""")
def e14_review(spark, sf):
    return R.daily_review(day_players(spark, sf), candidates(spark, sf))


REVIEW = """SELECT c_custkey AS row_no, CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'bad:' || c_custkey ELSE 'men:api:' || (c_custkey // 4) END AS api_key,
  CASE WHEN c_custkey % 5 = 0 THEN 'yes' ELSE '' END AS reject, CASE WHEN c_custkey % 7 = 0 THEN 'men:history:' || c_custkey WHEN c_custkey % 7 = 1 THEN 'odd' ELSE '' END AS manual_key,
  CASE c_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '3' WHEN 2 THEN '9' ELSE '' END AS accept_rank, 'men:history:' || (c_custkey + 1) AS candidate_1_key,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'men:history:' || (c_custkey + 3) END AS candidate_3_key FROM customer"""
OUTCOMES = f"""SELECT row_no, api_key, CASE WHEN api_key = '' THEN 'missing_api_player_key' WHEN api_key NOT LIKE 'men:api:%' THEN 'invalid_api_player_key' WHEN reject <> '' THEN NULL
    WHEN target IS NULL THEN 'no_accepted_candidate' WHEN target NOT LIKE 'men:history:%' THEN 'invalid_target_key' END AS skip_reason, reject, target
FROM (SELECT *, coalesce(nullif(manual_key, ''), CASE accept_rank WHEN '1' THEN candidate_1_key WHEN '3' THEN nullif(candidate_3_key, '') END) AS target FROM ({REVIEW}))"""


def review_rows(spark, sf):
    c = F.col("c_custkey")
    key = lambda x: F.concat(F.lit("men:history:"), x)
    return views.table(spark, sf, "customer").select(
        c.alias("row_no"), F.when(c % 6 == 0, "").when(c % 6 == 1, F.concat(F.lit("bad:"), c)).otherwise(F.concat(F.lit("men:api:"), F.expr("c_custkey div 4"))).alias("api_key"),
        F.when(c % 5 == 0, "yes").otherwise("").alias("reject"), F.when(c % 7 == 0, key(c)).when(c % 7 == 1, "odd").otherwise("").alias("manual_key"),
        F.when(c % 4 == 0, "1").when(c % 4 == 1, "3").when(c % 4 == 2, "9").otherwise("").alias("accept_rank"), key(c + 1).alias("candidate_1_key"),
        F.lit("").alias("candidate_2_key"), F.when(c % 3 == 0, "").otherwise(key(c + 3)).alias("candidate_3_key"))


@query("e15_apply_review", f"""
WITH n AS (SELECT api_key, arg_max({{'t': CASE WHEN reject <> '' THEN NULL ELSE target END}}, row_no).t AS target FROM ({OUTCOMES}) WHERE skip_reason IS NULL GROUP BY 1),
o AS (SELECT 'men:api:' || c_custkey AS api_key, 'men:history:' || c_custkey AS old FROM customer)
SELECT api_key, CASE WHEN n.api_key IS NOT NULL THEN n.target ELSE o.old END AS target_key, CASE WHEN n.api_key IS NULL THEN 'kept' WHEN o.api_key IS NOT NULL THEN 'replaced' ELSE 'added' END AS change
FROM o FULL JOIN n USING (api_key)""")
def e15(spark, sf):
    c = F.col("c_custkey")
    old = views.table(spark, sf, "customer").select(F.concat(F.lit("men:api:"), c).alias("api_key"), F.concat(F.lit("men:history:"), c).alias("target_key"))
    return R.apply_review(old, R.review_outcomes(review_rows(spark, sf)))


@query("e15_review_outcomes", f"""
SELECT row_no, api_key, skip_reason, CASE WHEN skip_reason IS NULL THEN CASE WHEN reject <> '' THEN 'manual_unmapped' ELSE 'manual_mapped' END END AS action,
  CASE WHEN skip_reason IS NULL AND reject = '' THEN target END AS target_key FROM ({OUTCOMES})""")
def e15_outcomes(spark, sf):
    return R.review_outcomes(review_rows(spark, sf))


@query("e16_verification_queue", f"""
WITH op AS (SELECT api_key FROM mapping_v WHERE target_key IS NULL),
s AS (SELECT * FROM (SELECT seq, match_date, level, surface, tourney_name, round, winner_api_key AS api_key, loser_api_key AS opponent_key, true AS won FROM feed_v
  UNION ALL SELECT seq, match_date, level, surface, tourney_name, round, loser_api_key, winner_api_key, false FROM feed_v) JOIN op USING (api_key)
  QUALIFY row_number() OVER (PARTITION BY api_key, seq, match_date, opponent_key ORDER BY won DESC) = 1),
n AS (SELECT api_key, count(*) AS matches, count(*) FILTER (level IN ('atp_wta', 'grand_slam')) AS high, count(*) FILTER (level = 'challenger') AS ch FROM s GROUP BY 1),
c AS (SELECT api_key, max(action) FILTER (rank = 1) AS action, count(*) AS candidate_count, string_agg(cand_key || ' | ' || score, ' ; ' ORDER BY rank) FILTER (rank <= 2) AS top_candidates FROM ({CANDIDATES}) GROUP BY 1),
x AS (SELECT *, row_number() OVER (PARTITION BY api_key ORDER BY match_date DESC, level DESC, tourney_name DESC, seq DESC, won DESC) AS example_index FROM s)
SELECT op.api_key, CASE WHEN action = 'safe_override' THEN 'safe_candidate' WHEN high > 0 THEN 'high_level' WHEN ch > 0 THEN 'challenger' WHEN matches >= 5 THEN 'many_matches'
    ELSE 'low_priority' END AS priority, coalesce(matches, 0) AS match_count, coalesce(example_index, 0) AS example_index, match_date, level, surface, tourney_name, round, won, opponent_key,
  CASE WHEN opponent_key IS NOT NULL THEN coalesce(m.target_key IS NOT NULL, false) END AS opponent_mapped, coalesce(candidate_count, 0) AS candidate_count, top_candidates
FROM op LEFT JOIN n USING (api_key) LEFT JOIN c USING (api_key) LEFT JOIN (SELECT * FROM x WHERE example_index <= 3) x USING (api_key) LEFT JOIN mapping_v m ON m.api_key = opponent_key""")
def e16(spark, sf):
    m = views.mapping(spark, sf)
    open_players = m.where("target_key IS NULL").select("api_key")
    feed = flat_feed(spark, sf)
    twice = feed.unionByName(feed.where("seq % 50 = 0"))  # some matches come twice
    return R.verification_queue(open_players, candidates(spark, sf), twice, m, listed_candidates=2)


@query("w6_first_last_seen", """
WITH s AS (SELECT 'history' AS source, seq, match_date, player_key, name, tourney_name FROM sides_v
  UNION ALL SELECT 'merged', seq, match_date, player_key, upper(name), tourney_name FROM sides_v)
SELECT b.*, n.name, t.tourney_name AS example_tournament FROM (SELECT player_key, min(match_date) AS first_seen, max(match_date) AS last_seen, count(*) AS appearances,
  count(DISTINCT seq) AS distinct_matches, count(*) FILTER (source = 'history') AS history_rows, count(*) FILTER (source = 'merged') AS merged_rows FROM s GROUP BY 1) b
JOIN (SELECT player_key, name FROM s GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY count(*) DESC, name) = 1) n USING (player_key)
JOIN (SELECT player_key, tourney_name FROM s GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY count(*) DESC, tourney_name) = 1) t USING (player_key)""")
def w6(spark, sf):
    own = explode_sides(views.valid_matches(spark, sf), ["seq", "match_date", "level", "tourney_name"])
    merged = own.withColumn("name", F.upper("name"))
    return R.first_last_seen([("history", own), ("merged", merged)])


@query("e7_review_priority", f"""
WITH s AS (SELECT winner_api_key AS player_key, level FROM ({COVERED}) WHERE NOT wm UNION ALL SELECT loser_api_key, level FROM ({COVERED}) WHERE NOT lm),
c AS (SELECT player_key, count(*) FILTER (level IN ('atp_wta', 'grand_slam')) AS high, count(*) FILTER (level = 'challenger') AS ch, count(*) AS n FROM s GROUP BY 1)
SELECT player_key AS api_key, n AS matches, CASE WHEN high > 0 THEN 'high' WHEN ch >= 3 OR n >= 8 THEN 'medium' ELSE 'low' END AS priority FROM c""")
def e7_priority(spark, sf):
    impact = R.unmapped_impact(status(spark, sf))
    level = lambda n: F.col(f"{n}_matches")
    return impact.select("api_key", "matches", S.priority(level("atp_wta"), level("grand_slam"), level("challenger"), F.col("matches")).alias("priority"))
