"""The same derived shapes in the SQL dialect of the checking engine."""

_K = "CAST(json_extract_string({0}.props, '$.k') AS BIGINT)"

CHECK_VIEWS = {
    "matches_v": f"""
SELECT a.event_id // 2 AS seq, CAST(a.ts AS DATE) AS match_date,
  year(a.ts) AS year,
  CASE WHEN (a.event_id // 2) % 2 = 0 THEN 'men' ELSE 'women' END AS gender,
  CASE a.event_type WHEN 'view' THEN 'itf' WHEN 'click' THEN 'challenger'
    WHEN 'purchase' THEN 'atp_wta' WHEN 'signup' THEN 'qualifying' ELSE 'grand_slam' END AS level,
  CASE WHEN {_K.format('a')} % 8 = 0 THEN 'grass' WHEN {_K.format('a')} % 8 = 1 THEN 'carpet'
    WHEN {_K.format('a')} % 8 = 2 THEN 'unknown' WHEN {_K.format('a')} % 8 <= 4 THEN 'clay'
    ELSE 'hard' END AS surface,
  a.user_id AS winner_id, b.user_id AS loser_id,
  CASE WHEN (a.event_id // 2) % 2 = 0 THEN 'men' ELSE 'women' END || ':history:' || a.user_id AS winner_key,
  CASE WHEN (a.event_id // 2) % 2 = 0 THEN 'men' ELSE 'women' END || ':history:' || b.user_id AS loser_key,
  'Player ' || a.user_id AS winner_name, 'Player ' || b.user_id AS loser_name,
  'R' || ((a.event_id // 2) % 6) AS round,
  strftime(a.ts, '%Y-%m-%d') AS tourney_id,
  'Open ' || strftime(a.ts, '%m%d') || ' ' || a.event_type AS tourney_name,
  CAST(floor(a.value) AS BIGINT) % 8 AS w1, CAST(floor(b.value) AS BIGINT) % 8 AS l1,
  {_K.format('a')} % 8 AS w2, {_K.format('b')} % 8 AS l2,
  {_K.format('a')} AS k, {_K.format('b')} AS loser_k, a.event_type,
  a.value AS winner_value, b.value AS loser_value
FROM events a JOIN events b ON b.event_id = a.event_id + 1 WHERE a.event_id % 2 = 0""",
    "valid_v": "SELECT * FROM matches_v WHERE winner_key <> loser_key",
    "feed_v": """
SELECT seq, CASE WHEN seq % 5 = 3 THEN CAST(match_date + 60 AS DATE) ELSE match_date END AS match_date,
  gender, level, surface, CASE WHEN seq % 4 = 0 THEN 'R9' ELSE round END AS round, tourney_id, tourney_name,
  gender || ':api:' || (CASE WHEN seq % 30 = 0 THEN loser_id ELSE winner_id END + 100000) AS winner_api_key,
  gender || ':api:' || (CASE WHEN seq % 30 = 0 THEN winner_id ELSE loser_id END + 100000) AS loser_api_key,
  'P. ' || CASE WHEN seq % 30 = 0 THEN loser_id ELSE winner_id END AS winner_name,
  'P. ' || CASE WHEN seq % 30 = 0 THEN winner_id ELSE loser_id END AS loser_name
FROM matches_v""",
    "mapping_v": """
SELECT g.gender || ':api:' || (u.user_id + 100000) AS api_key, g.gender,
  CASE WHEN u.user_id % 11 = 0 THEN 'unmapped' WHEN u.user_id % 13 = 0 THEN 'ambiguous'
    WHEN u.user_id % 7 = 0 THEN 'manual_mapped' ELSE 'auto_mapped' END AS status,
  CASE WHEN u.user_id % 11 <> 0 AND u.user_id % 13 <> 0
    THEN g.gender || ':history:' || u.user_id END AS target_key, u.user_id
FROM (SELECT DISTINCT user_id FROM events) u, (VALUES ('men'), ('women')) g(gender)""",
    "raw_aliases_v": """
SELECT g.gender || ':history:' || c_custkey AS alias_key,
  CASE c_mktsegment WHEN 'BUILDING' THEN g.gender || ':history:' || (c_custkey - 1)
    WHEN 'FURNITURE' THEN g.gender || ':history:' || (c_custkey + 1 - 2 * (c_custkey % 2))
    WHEN 'AUTOMOBILE' THEN CASE g.gender WHEN 'men' THEN 'women' ELSE 'men' END || ':history:' || c_custkey
    WHEN 'MACHINERY' THEN g.gender || ':name:' || c_custkey
    ELSE g.gender || ':history:' || c_custkey END AS canonical_key
FROM customer, (VALUES ('men'), ('women')) g(gender)""",
    "aliases_v": """
SELECT alias_key, canonical_key FROM raw_aliases_v
WHERE alias_key <> canonical_key AND regexp_matches(alias_key, '^(men|women):history:')
  AND regexp_matches(canonical_key, '^(men|women):history:')
  AND split_part(alias_key, ':', 1) = split_part(canonical_key, ':', 1)""",
    "alias_walk_v": """alias_walk_v(alias_key, cur, path, done) AS (
  SELECT alias_key, canonical_key, [alias_key], false FROM aliases_v
  UNION ALL
  SELECT w.alias_key, CASE WHEN list_contains(w.path, w.cur) THEN w.cur ELSE a.canonical_key END,
    list_append(w.path, w.cur), list_contains(w.path, w.cur)
  FROM alias_walk_v w JOIN aliases_v a ON a.alias_key = w.cur WHERE NOT w.done)""",
    "alias_closure_v": """
SELECT alias_key, cur AS canonical_key, done AS is_cycle FROM (
  SELECT *, row_number() OVER (PARTITION BY alias_key ORDER BY len(path) DESC) AS rn FROM alias_walk_v)
WHERE rn = 1""",
    "quotes_v": """
SELECT l_orderkey AS event_key,
  CASE WHEN (l_partkey + l_linenumber) % 2 = 0 THEN 'home' ELSE 'away' END AS side,
  'bk' || l_suppkey AS bookmaker,
  CAST(floor(l_discount * 100 + 0.5) * 4 + 150 + floor(l_quantity) AS DOUBLE) / 100 AS odds
FROM lineitem""",
    "picks_v": """
SELECT o_orderkey AS pick_id, o_custkey AS player_id, CAST(o_orderdate AS DATE) AS pick_date,
  lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30' AS pick_time,
  'Open ' || (o_custkey % 20) AS tournament, 'Match ' || o_custkey AS match_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'home' ELSE 'away' END AS side,
  CASE WHEN o_orderstatus = 'F' THEN 'win' WHEN o_orderstatus = 'O' THEN 'loss'
    WHEN o_orderpriority = '5-LOW' THEN 'void' ELSE 'pending' END AS status,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.25 ELSE 1.0 END AS DECIMAL(18,6)) AS stake,
  CAST(CAST(CAST(floor(o_totalprice) AS BIGINT) % 320 + 130 AS DECIMAL(18,6)) * 0.01 AS DECIMAL(18,6)) AS odds,
  CAST(o_orderkey * 37 % 500 + 300 AS DOUBLE) / 1000 AS model_prob
FROM orders""",
    "settle_picks_v": """
SELECT pick_id, pick_id AS event_key, pick_date,
  CASE WHEN pick_id % 41 = 0 THEN 'both' WHEN side = 'home' THEN (['home', 'first', 'First Player', '1'])[(pick_id // 2) % 4 + 1]
    ELSE (['away', 'second', 'Second Player', '2'])[(pick_id // 2) % 4 + 1] END AS side,
  CASE WHEN pick_id % 13 <> 0 THEN stake END AS stake, CASE WHEN pick_id % 19 <> 0 THEN odds END AS odds,
  CASE WHEN pick_id % 38 <> 0 THEN CAST(odds + 0.1 AS DECIMAL(18,6)) END AS avg_odds
FROM picks_v""",
    "results_v": """
SELECT CASE WHEN pick_id % 29 = 0 THEN -pick_id ELSE pick_id END AS event_key, row_order,
  CASE WHEN row_order = 0 THEN 'Scheduled' WHEN status IN ('win', 'loss') THEN CASE WHEN pick_id % 7 <> 0 AND pick_id % 11 <> 0 THEN 'Finished' END
    WHEN status = 'void' THEN 'Cancelled' WHEN pick_id % 3 = 0 THEN 'Not Started' ELSE '' END AS event_status,
  CASE WHEN row_order = 1 AND status IN ('win', 'loss') AND pick_id % 7 = 0 THEN 'Retired' END AS event_status_info,
  CASE WHEN row_order = 1 AND status IN ('win', 'loss') AND pick_id % 11 = 0 AND pick_id % 7 <> 0 THEN 'Match ended' END AS event_status_type,
  CASE WHEN won AND pick_id % 4 <= 1 THEN CASE WHEN home_won THEN 'First Player' ELSE '2' END END AS event_winner,
  CASE WHEN won AND pick_id % 4 = 2 THEN pick_id * 10 + CASE WHEN home_won THEN 1 ELSE 2 END END AS winner_key,
  CASE WHEN won AND pick_id % 4 = 3 THEN upper('Player ' || pick_id || CASE WHEN home_won THEN 'a' ELSE 'b' END) END AS winner_name,
  pick_id * 10 + 1 AS first_player_key, pick_id * 10 + 2 AS second_player_key,
  'Player ' || pick_id || 'a' AS event_first_player, 'Player ' || pick_id || 'b' AS event_second_player,
  CAST(CASE WHEN pick_id % 31 = 0 THEN pick_date + 10 ELSE pick_date END AS DATE) AS event_date
FROM (SELECT *, row_order = 1 AND status IN ('win', 'loss') AND pick_id % 17 <> 0 AS won, (side = 'home') = (status = 'win') AS home_won
  FROM (SELECT *, unnest(CASE WHEN pick_id % 5 = 0 THEN [0, 1] ELSE [1] END) AS row_order FROM picks_v))""",
    "ranked_words_v": r"""
SELECT doc_id, lang, n_chars, list_reverse_sort(list_transform(
    list_distinct(regexp_extract_all(lower(text), '([\p{L}]{3,})', 1)),
    lambda w: {'n': length(w), 'w': w})) AS r
FROM documents""",
    "names_v": """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'men' ELSE 'women' END AS gender, lang AS country,
  CASE WHEN n_chars % 5 = 3 THEN given || ' ' || middle || ' ' || surname
    ELSE trim(given || ' ' || surname) END AS name,
  CASE n_chars % 5 WHEN 0 THEN substr(given, 1, 1) || '. ' || surname
    WHEN 1 THEN surname || ' ' || given
    WHEN 2 THEN given || ' ' || substr(surname, 2)
    WHEN 3 THEN substr(given, 1, 1) || '. ' || substr(middle, 1, 1) || '. ' || surname
    ELSE trim(given || ' ' || surname) END AS feed_name,
  1980 + n_chars % 30 AS birth_year, n_chars % 50 AS matches
FROM (SELECT doc_id, lang, n_chars, coalesce(r[1].w, '') AS surname, coalesce(r[2].w, '') AS given,
  coalesce(r[3].w, '') AS middle FROM ranked_words_v)""",
    "ladder_rows_v": """
SELECT gender || '~' || layer || '~' || value AS ladder, probe, seq, winner_key AS w, loser_key AS l,
  row_number() OVER (PARTITION BY gender, layer, value ORDER BY seq) AS pos
FROM (
  SELECT gender, 'overall' AS layer, 'all' AS value, false AS probe, seq, winner_key, loser_key FROM valid_v
  UNION ALL SELECT gender, 'level', level, false, seq, winner_key, loser_key FROM valid_v
  UNION ALL SELECT gender, 'surface', surface, false, seq, winner_key, loser_key FROM valid_v
    WHERE surface <> 'unknown'
  UNION ALL SELECT gender, 'level_surface', level || '|' || surface, false, seq, winner_key, loser_key
    FROM valid_v WHERE surface <> 'unknown'
  UNION ALL SELECT gender, 'level', 'atp_wta', true, seq, winner_key, loser_key FROM valid_v
    WHERE level = 'grand_slam')""",
    # integer ids keep the recursion cheap: ladder number * 1e9 + player number
    "ladder_ids_v": """ladder_ids_v AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY ladder) * 1000000000 + CAST(split_part(w, ':', 3) AS BIGINT) AS wi,
    dense_rank() OVER (ORDER BY ladder) * 1000000000 + CAST(split_part(l, ':', 3) AS BIGINT) AS li,
    -(dense_rank() OVER (ORDER BY ladder) * 1000000000 + seq * 2 + CASE WHEN probe THEN 1 ELSE 0 END) AS si
  FROM ladder_rows_v)""",
    "ladder_walk_v": """ladder_walk_v(id, pos, r, n, other_r, other_n) USING KEY (id) AS (
  SELECT p, 0::BIGINT, 1500.0::DOUBLE, 0::BIGINT, 0.0::DOUBLE, 0::BIGINT
  FROM (SELECT wi AS p FROM ladder_ids_v UNION SELECT li FROM ladder_ids_v)
  UNION
  SELECT u.id, z.pos, u.r, u.n, u.other_r, u.other_n
  FROM (
    SELECT m.pos, m.wi, m.li, m.si, a.r AS wr, b.r AS lr, a.n AS wn, b.n AS ln,
      CASE WHEN m.probe THEN 0.0 ELSE 32 * (1 - 1 / (1 + pow(10, (b.r - a.r) / 400))) END AS gain,
      CASE WHEN m.probe THEN 0 ELSE 1 END AS one
    FROM ladder_ids_v m
    JOIN recurring.ladder_walk_v a ON a.id = m.wi
    JOIN recurring.ladder_walk_v b ON b.id = m.li
    WHERE m.pos = (SELECT max(pos) + 1 FROM ladder_walk_v)) z,
  LATERAL (VALUES
    (z.wi, z.wr + z.gain, z.wn + z.one, 0.0, 0), (z.li, z.lr - z.gain, z.ln + z.one, 0.0, 0),
    (z.si, z.wr, z.wn, z.lr, z.ln)) u(id, r, n, other_r, other_n))""",
    "ladder_state_v": """
SELECT split_part(ladder, '~', 1) AS gender, split_part(ladder, '~', 2) AS layer,
  split_part(ladder, '~', 3) AS value, player_key, r AS rating, n
FROM ladder_walk_v JOIN (SELECT wi AS id, ladder, w AS player_key FROM ladder_ids_v
  UNION SELECT li, ladder, l FROM ladder_ids_v) USING (id) WHERE n > 0""",
    "ladder_steps_v": """
SELECT split_part(ladder, '~', 1) AS gender, split_part(ladder, '~', 2) AS layer,
  split_part(ladder, '~', 3) AS value, seq, probe, w AS winner_key, l AS loser_key,
  r AS winner_rating, other_r AS loser_rating, n AS winner_n, other_n AS loser_n
FROM ladder_walk_v JOIN ladder_ids_v ON si = id""",
    "sides_v": """
SELECT seq, match_date, gender, level, surface, tourney_name, winner_key AS player_key,
  winner_name AS name, loser_key AS opponent_key, loser_name AS opponent_name, true AS won FROM valid_v
UNION ALL SELECT seq, match_date, gender, level, surface, tourney_name, loser_key, loser_name, winner_key,
  winner_name, false FROM valid_v""",
    "first_names_v": """
SELECT player_key, arg_min(name, seq) AS name, any_value(gender) AS gender FROM sides_v GROUP BY player_key""",
    "fixtures_v": """
SELECT seq, k, level AS true_level, surface AS true_surface, match_date,
  CASE WHEN seq % 41 = 0 THEN '' ELSE CAST(seq - CASE WHEN seq % 53 = 0 THEN 1 ELSE 0 END AS VARCHAR) END AS event_key,
  CASE WHEN seq % 86 = 0 THEN '' WHEN seq % 43 = 0 THEN 'n/a' ELSE tourney_id END AS event_date,
  lpad(CAST(seq % 24 AS VARCHAR), 2, '0') || ':30' AS event_time,
  CASE WHEN seq % 17 = 0 THEN 'Atp Doubles' WHEN seq % 31 = 0 THEN 'Exhibition'
    WHEN level = 'challenger' THEN 'Challenger ' || CASE gender WHEN 'men' THEN 'Men' ELSE 'Women' END || ' Singles'
    WHEN level = 'itf' THEN 'Itf ' || CASE gender WHEN 'men' THEN 'Men' ELSE 'Women' END || ' Singles'
    ELSE CASE gender WHEN 'men' THEN 'Atp' ELSE 'Wta' END || ' Singles' END AS event_type_type,
  CASE WHEN level = 'grand_slam' THEN CASE k % 4 WHEN 0 THEN 'Australian Open' WHEN 1 THEN 'Roland Garros'
      WHEN 2 THEN 'Wimbledon' ELSE 'US Open' END
    WHEN level = 'qualifying' THEN 'City' || (winner_id % 40) || ' Qualification'
    WHEN level = 'itf' THEN CASE gender WHEN 'men' THEN 'M15 ' ELSE 'W15 ' END || 'City' || (winner_id % 40)
    ELSE 'City' || (winner_id % 40) END AS tournament_name,
  CAST(k AS VARCHAR) AS tournament_key, round AS tournament_round,
  CASE WHEN seq % 19 = 0 THEN 'Not Started' WHEN seq % 23 = 0 THEN 'Retired'
    WHEN seq % 29 = 0 THEN 'Cancelled' ELSE 'Finished' END AS event_status,
  CASE WHEN seq % 19 = 0 AND seq % 2 = 0 THEN '1' ELSE '0' END AS event_live,
  CASE WHEN seq % 19 = 0 OR seq % 29 = 0 OR seq % 37 = 0 THEN ''
    WHEN k % 2 = 0 THEN 'First Player' ELSE 'Second Player' END AS event_winner,
  CASE WHEN seq % 19 = 0 OR seq % 29 = 0 THEN '' ELSE w1 || ' - ' || l1 END AS event_final_result,
  CASE WHEN seq % 47 = 0 THEN '' ELSE 'P. ' || CASE WHEN k % 2 = 0 THEN winner_id ELSE loser_id END END AS event_first_player,
  'P. ' || CASE WHEN k % 2 = 0 THEN loser_id ELSE winner_id END AS event_second_player,
  CAST(CASE WHEN k % 2 = 0 THEN winner_id ELSE loser_id END + 100000 AS VARCHAR) AS first_player_key,
  CAST(CASE WHEN k % 2 = 0 THEN loser_id ELSE winner_id END + 100000 AS VARCHAR) AS second_player_key,
  CASE WHEN k % 3 = 0 THEN '' ELSE CASE surface WHEN 'hard' THEN 'Hard (Indoor)' WHEN 'unknown' THEN ''
    ELSE upper(surface[1]) || surface[2:] END END AS event_surface,
  CASE WHEN (k % 3 = 0 OR surface = 'unknown') AND seq % 7 = 5 THEN 'Clay Court' ELSE '' END AS court_type,
  'day_' || tourney_id || '.json' AS source_file, w1, l1, w2, l2, gender AS true_gender
FROM matches_v""",
    "tournaments_v": """
SELECT CAST(p_partkey AS VARCHAR) AS tournament_key,
  p_name || CASE WHEN p_size % 9 = 0 THEN ' - Qualifying' ELSE '' END AS tournament_name,
  CASE p_size % 6 WHEN 0 THEN 'Hard' WHEN 1 THEN 'Clay' WHEN 2 THEN 'Grass' WHEN 3 THEN 'Carpet'
    WHEN 4 THEN 'Hard (Indoor)' ELSE '' END AS tournament_sourface,
  p_type AS event_type_type
FROM part""",
    "cache_v": """
SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'other-' ELSE '' END || (c_custkey + 100000) AS player_key, 'P. ' || c_custkey AS player_name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'Player ' || c_custkey END AS player_full_name,
  'NATION_' || c_nationkey AS player_country,
  lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || '.' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0')
    || '.' || (1980 + c_custkey % 25) AS player_bday
FROM customer""",
    "wide_v": """
SELECT seq,
  max(winner_rating) FILTER (layer = 'level' AND NOT probe) AS w_lvl, max(loser_rating) FILTER (layer = 'level' AND NOT probe) AS l_lvl,
  max(winner_n) FILTER (layer = 'level' AND NOT probe) AS w_lvl_n, max(loser_n) FILTER (layer = 'level' AND NOT probe) AS l_lvl_n,
  max(winner_rating) FILTER (probe) AS w_tour, max(loser_rating) FILTER (probe) AS l_tour,
  max(winner_n) FILTER (probe) AS w_tour_n, max(loser_n) FILTER (probe) AS l_tour_n,
  max(winner_rating) FILTER (layer = 'surface') AS w_surf, max(loser_rating) FILTER (layer = 'surface') AS l_surf,
  coalesce(max(winner_n) FILTER (layer = 'surface'), 0) AS w_surf_n, coalesce(max(loser_n) FILTER (layer = 'surface'), 0) AS l_surf_n,
  max(winner_n) FILTER (layer = 'overall') AS w_all_n, max(loser_n) FILTER (layer = 'overall') AS l_all_n
FROM ladder_steps_v GROUP BY seq""",
    "components_v": """
SELECT m.*, w.* EXCLUDE (seq),
  CASE WHEN level <> 'grand_slam' THEN w_lvl WHEN w_lvl_n + w_tour_n = 0 THEN 1500.0
    ELSE (w_lvl * (w_lvl_n + CASE WHEN w_lvl_n > 0 THEN 8 ELSE 0 END) + w_tour * (w_tour_n + CASE WHEN w_tour_n > 0 THEN 12 ELSE 0 END))
      / (w_lvl_n + CASE WHEN w_lvl_n > 0 THEN 8 ELSE 0 END + w_tour_n + CASE WHEN w_tour_n > 0 THEN 12 ELSE 0 END) END AS w_comp,
  CASE WHEN level <> 'grand_slam' THEN l_lvl WHEN l_lvl_n + l_tour_n = 0 THEN 1500.0
    ELSE (l_lvl * (l_lvl_n + CASE WHEN l_lvl_n > 0 THEN 8 ELSE 0 END) + l_tour * (l_tour_n + CASE WHEN l_tour_n > 0 THEN 12 ELSE 0 END))
      / (l_lvl_n + CASE WHEN l_lvl_n > 0 THEN 8 ELSE 0 END + l_tour_n + CASE WHEN l_tour_n > 0 THEN 12 ELSE 0 END) END AS l_comp,
  w_lvl_n + coalesce(w_tour_n, 0) AS w_comp_n, l_lvl_n + coalesce(l_tour_n, 0) AS l_comp_n,
  CASE WHEN surface = 'unknown' THEN NULL WHEN least(w_surf_n, l_surf_n) < 5 THEN 0.0::DOUBLE
    WHEN least(w_surf_n, l_surf_n) < 10 THEN 0.15 WHEN least(w_surf_n, l_surf_n) < 25 THEN 0.25 ELSE 0.35 END AS weight
FROM valid_v m JOIN wide_v w USING (seq)""",
    "predictions_v": """
SELECT *, floor(1e8 / (1 + pow(10, (l_comp - w_comp) / 400)) + 0.5) / 1e8 AS p_level_only,
  floor(1e8 / (1 + pow(10, (l_surf - w_surf) / 400)) + 0.5) / 1e8 AS p_surface_only,
  floor(1e8 / (1 + pow(10, ((l_comp * 0.8 + l_surf * 0.2) - (w_comp * 0.8 + w_surf * 0.2)) / 400)) + 0.5) / 1e8 AS p_blend_80_20,
  floor(1e8 / (1 + pow(10, ((l_comp * 0.7 + l_surf * 0.3) - (w_comp * 0.7 + w_surf * 0.3)) / 400)) + 0.5) / 1e8 AS p_blend_70_30,
  floor(1e8 / (1 + pow(10, ((l_comp * 0.6 + l_surf * 0.4) - (w_comp * 0.6 + w_surf * 0.4)) / 400)) + 0.5) / 1e8 AS p_blend_60_40,
  floor(1e8 / (1 + pow(10, ((l_comp * (1 - weight) + l_surf * weight) - (w_comp * (1 - weight) + w_surf * weight)) / 400)) + 0.5) / 1e8
    AS p_sample_aware
FROM components_v""",
    "model_rows_v": """
SELECT seq, level, surface, model, p, least(w_comp_n, l_comp_n) AS min_level_n, least(w_surf_n, l_surf_n) AS min_surface_n,
  greatest(p, 1 - p) AS pick
FROM (
  SELECT *, 'level_only' AS model, p_level_only AS p FROM predictions_v
  UNION ALL SELECT *, 'surface_only', p_surface_only FROM predictions_v
  UNION ALL SELECT *, 'blend_80_20', p_blend_80_20 FROM predictions_v
  UNION ALL SELECT *, 'blend_70_30', p_blend_70_30 FROM predictions_v
  UNION ALL SELECT *, 'blend_60_40', p_blend_60_40 FROM predictions_v
  UNION ALL SELECT *, 'sample_aware', p_sample_aware FROM predictions_v) WHERE p IS NOT NULL""",
    "history_v": """
SELECT seq, CASE WHEN gender = 'men' THEN CASE level WHEN 'itf' THEN 'atp_matches_futures_' WHEN 'grand_slam' THEN 'atp_matches_'
      WHEN 'atp_wta' THEN 'atp_matches_' ELSE 'atp_matches_qual_chall_' END
    ELSE CASE level WHEN 'grand_slam' THEN 'wta_matches_' WHEN 'atp_wta' THEN 'wta_matches_' ELSE 'wta_matches_qual_itf_' END END
    || year || '.csv' AS source_file,
  tourney_id, tourney_name, CASE WHEN surface = 'unknown' THEN '' ELSE upper(surface[1]) || surface[2:] END AS surface,
  CASE level WHEN 'grand_slam' THEN 'G' WHEN 'atp_wta' THEN ['M', 'A', 'F'][seq % 3 + 1] WHEN 'challenger' THEN 'C'
    WHEN 'qualifying' THEN CASE WHEN seq % 2 = 0 THEN 'Q' ELSE '' END ELSE '' END AS tourney_level,
  CASE WHEN seq % 37 = 0 THEN 'n/a' ELSE replace(tourney_id, '-', '') END AS tourney_date, CAST(seq AS VARCHAR) AS match_num,
  CASE WHEN level = 'qualifying' AND k % 2 = 0 THEN 'Q' ELSE round END AS round, '3' AS best_of,
  CASE WHEN seq % 31 = 0 THEN '' ELSE CAST(winner_id AS VARCHAR) END AS winner_id,
  CASE WHEN seq % 29 = 0 THEN '' ELSE winner_name END AS winner_name,
  ['SLO', 'USA', 'FRA', ''][winner_id % 4 + 1] AS winner_ioc, ['R', 'L', 'U'][k % 3 + 1] AS winner_hand,
  CAST(170 + winner_id % 30 AS VARCHAR) AS winner_ht, CAST(18 + (winner_id * 7 + k) % 20 AS VARCHAR) || '.3' AS winner_age,
  CAST(loser_id AS VARCHAR) AS loser_id, loser_name, ['SLO', 'USA', 'FRA', ''][loser_id % 4 + 1] AS loser_ioc,
  ['R', 'L', 'U'][loser_k % 3 + 1] AS loser_hand, CAST(170 + loser_id % 30 AS VARCHAR) AS loser_ht,
  CAST(18 + (loser_id * 7 + loser_k) % 20 AS VARCHAR) || '.3' AS loser_age
FROM matches_v""",
    "history_import_v": r"""
SELECT *, CASE WHEN date IS NULL THEN 'missing_or_invalid_date'
    WHEN winner_name = '' OR loser_name = '' THEN 'missing_player_name'
    WHEN nsurface = 'unknown' AND level NOT IN ('itf', 'qualifying') THEN 'unknown_surface_not_allowed' END AS skip_reason
FROM (
  SELECT *, CASE WHEN regexp_full_match(tourney_date, '[0-9]{8}') THEN tourney_date[1:4] || '-' || tourney_date[5:6] || '-'
      || tourney_date[7:8] END AS date,
    CASE WHEN source_file LIKE 'atp%' THEN 'men' ELSE 'women' END AS gender,
    CASE WHEN lower(surface) IN ('hard', 'clay', 'grass', 'carpet') THEN lower(surface) ELSE 'unknown' END AS nsurface,
    CASE WHEN tourney_level = 'G' THEN 'grand_slam' WHEN tourney_level IN ('D', 'M', 'A', 'F') THEN 'atp_wta'
      WHEN tourney_level = 'C' THEN 'challenger' WHEN tourney_level = 'Q' THEN 'qualifying'
      WHEN upper(round) = 'Q' OR lower(tourney_name) LIKE '%qual%' THEN 'qualifying'
      WHEN source_file LIKE '%futures%' THEN 'itf' WHEN regexp_matches(source_file, '(atp|wta)_matches_[0-9]') THEN 'atp_wta'
      WHEN source_file LIKE '%chall%' THEN 'challenger' ELSE 'itf' END AS level
  FROM history_v)""",
    "fixture_steps_v": r"""
SELECT f.*, CASE WHEN regexp_full_match(raw_date, '\d{4}-\d{2}-\d{2}') THEN raw_date END AS date,
  coalesce(nullif(c1.player_full_name, ''), c1.player_name, f.event_first_player) AS first_name,
  coalesce(nullif(c2.player_full_name, ''), c2.player_name, f.event_second_player) AS second_name,
  CASE WHEN nullif(c1.player_full_name, '') IS NOT NULL THEN 'cache_full_name' WHEN c1.player_name IS NOT NULL
    THEN 'cache_short_name' ELSE 'fixture' END AS first_name_source,
  CASE WHEN lower(event_surface) LIKE '%hard%' THEN 'hard' WHEN lower(event_surface) LIKE '%clay%' THEN 'clay'
    WHEN lower(event_surface) LIKE '%grass%' THEN 'grass' WHEN lower(event_surface) LIKE '%carpet%' THEN 'carpet' END AS own_surface,
  CASE WHEN lower(tournament_sourface) LIKE '%hard%' THEN 'hard' WHEN lower(tournament_sourface) LIKE '%clay%' THEN 'clay'
    WHEN lower(tournament_sourface) LIKE '%grass%' THEN 'grass' WHEN lower(tournament_sourface) LIKE '%carpet%' THEN 'carpet' END
    AS meta_surface, t.tournament_sourface
FROM (SELECT * REPLACE (CASE WHEN event_surface <> '' THEN event_surface ELSE court_type END AS event_surface),
    CASE WHEN event_date = '' THEN regexp_extract(source_file, '\d{4}-\d{2}-\d{2}') ELSE event_date END AS raw_date
  FROM fixtures_v) f
LEFT JOIN cache_v c1 ON c1.player_key = f.first_player_key
LEFT JOIN cache_v c2 ON c2.player_key = f.second_player_key
LEFT JOIN tournaments_v t USING (tournament_key)""",
    "fixture_import_v": r"""
SELECT *, CASE WHEN date IS NULL THEN 'missing_or_invalid_date' WHEN lower(event_type_type) LIKE '%double%' THEN 'doubles_or_team_match'
    WHEN NOT (regexp_matches(lower(event_status), 'finished|ended|complete|final|retired|walkover|wo|w/o') OR event_winner <> ''
      OR regexp_matches(event_final_result, '\d')) THEN 'not_finished'
    WHEN gender = 'unknown' THEN 'unknown_gender' WHEN first_name = '' OR second_name = '' THEN 'missing_player_name'
    WHEN event_winner = '' THEN 'missing_or_unresolved_winner' WHEN level = 'unknown' THEN 'unknown_level'
    WHEN surface = 'unknown' AND level NOT IN ('itf', 'qualifying') THEN 'unknown_surface_not_allowed' END AS skip_reason,
  CASE WHEN event_winner LIKE 'First%' THEN first_name ELSE second_name END AS winner_name,
  CASE WHEN event_winner LIKE 'First%' THEN second_name ELSE first_name END AS loser_name,
  CASE WHEN event_winner LIKE 'First%' THEN first_player_key ELSE second_player_key END AS winner_id,
  CASE WHEN event_winner LIKE 'First%' THEN second_player_key ELSE first_player_key END AS loser_id
FROM (
  SELECT *, CASE WHEN regexp_matches(t, '\bwta\b|women|female|girls') THEN 'women'
      WHEN regexp_matches(t, '\batp\b|men|male|boys') THEN 'men' ELSE 'unknown' END AS gender,
    CASE WHEN regexp_matches(t, 'australian open|roland garros|french open|wimbledon|us open') THEN 'grand_slam'
      WHEN regexp_matches(t, 'qualification|qualifying') THEN 'qualifying' WHEN t LIKE '%challenger%' THEN 'challenger'
      WHEN regexp_matches(t, 'itf | itf|m15|w15') THEN 'itf' WHEN regexp_matches(t, '\batp\b|\bwta\b') THEN 'atp_wta'
      ELSE 'unknown' END AS level,
    coalesce(own_surface, meta_surface, 'unknown') AS surface,
    CASE WHEN own_surface IS NOT NULL THEN event_surface
      WHEN meta_surface IS NOT NULL THEN 'tournament_metadata:' || tournament_sourface ELSE event_surface END AS surface_source
  FROM (SELECT *, ' ' || lower(tournament_name || ' | ' || event_type_type || ' | ' || tournament_round) || ' ' AS t
    FROM fixture_steps_v))""",
    "closure_key_v": "SELECT alias_key, canonical_key FROM alias_closure_v",
    "aliased_v": """
SELECT m.* EXCLUDE (winner_key, loser_key), coalesce(a.canonical_key, winner_key) AS winner_key,
  coalesce(b.canonical_key, loser_key) AS loser_key,
  CASE WHEN a.canonical_key <> winner_key THEN winner_key END AS winner_key_original,
  CASE WHEN b.canonical_key <> loser_key THEN loser_key END AS loser_key_original
FROM matches_v m LEFT JOIN alias_closure_v a ON a.alias_key = m.winner_key
  LEFT JOIN alias_closure_v b ON b.alias_key = m.loser_key""",
    "mapped_feed_v": """
SELECT *, CASE WHEN winner_key IS NULL AND loser_key IS NULL THEN 'none_mapped' WHEN winner_key IS NULL OR loser_key IS NULL THEN 'one_mapped'
  WHEN winner_key = loser_key THEN 'mapped_winner_loser_same_player' ELSE 'both_mapped' END AS coverage
FROM (SELECT f.*, coalesce(ca.canonical_key, a.target_key) AS winner_key, coalesce(cb.canonical_key, b.target_key) AS loser_key,
    coalesce(a.status, 'missing_mapping_entry') AS winner_status, coalesce(b.status, 'missing_mapping_entry') AS loser_status
  FROM feed_v f LEFT JOIN mapping_v a ON a.api_key = f.winner_api_key LEFT JOIN mapping_v b ON b.api_key = f.loser_api_key
  LEFT JOIN alias_closure_v ca ON ca.alias_key = a.target_key LEFT JOIN alias_closure_v cb ON cb.alias_key = b.target_key)""",
    "primary_v": """
SELECT seq, match_date, gender, level, surface, lower(round) AS round_norm, winner_key, loser_key,
  least(winner_key, loser_key) || '|' || greatest(winner_key, loser_key) AS pair
FROM aliased_v WHERE winner_key <> loser_key
QUALIFY row_number() OVER (PARTITION BY match_date, gender, level, surface, lower(round), pair ORDER BY seq) = 1""",
    "feed_keys_v": """
SELECT seq, match_date, gender, level, surface, lower(round) AS round_norm, winner_key, loser_key,
  least(winner_key, loser_key) || '|' || greatest(winner_key, loser_key) AS pair
FROM mapped_feed_v WHERE coverage = 'both_mapped'""",
    "merge_pairs_v": """
SELECT f.seq, p.seq AS p_seq, p.winner_key AS p_winner, p.round_norm = f.round_norm AS same_round,
  p.level = f.level AND p.surface = f.surface AS same_court
FROM feed_keys_v f JOIN primary_v p USING (match_date, gender, pair)""",
    "merge_v": """
SELECT seq, match_date, gender, level, surface, winner_key, loser_key, strategy,
  CASE WHEN strategy IS NULL OR strategy = 'ambiguous' THEN NULL ELSE met_id END AS met_id,
  CASE WHEN strategy IS NULL THEN 'added' WHEN strategy = 'ambiguous' THEN 'ambiguous' WHEN met_winner = winner_key THEN 'duplicate'
    ELSE 'conflict' END AS outcome
FROM (
  SELECT f.*, CASE WHEN c.n IS NULL THEN CASE WHEN f.seq = f.first_seq THEN NULL WHEN f.first_court AND f.first_round THEN 'strict' ELSE 'date_gender_players' END
      WHEN c.n_strict > 0 THEN 'strict' WHEN c.n = 1 THEN 'date_gender_players' WHEN c.n_round = 1 THEN 'round_refined'
      WHEN c.n_court = 1 THEN 'level_surface_refined' ELSE 'ambiguous' END AS strategy,
    CASE WHEN c.n IS NULL THEN f.first_seq WHEN c.n_strict > 0 THEN c.id_strict WHEN c.n = 1 THEN c.id_any WHEN c.n_round = 1 THEN c.id_round ELSE c.id_court END AS met_id,
    CASE WHEN c.n IS NULL THEN f.first_winner WHEN c.n_strict > 0 THEN c.w_strict WHEN c.n = 1 THEN c.w_any WHEN c.n_round = 1 THEN c.w_round ELSE c.w_court END AS met_winner
  FROM (SELECT *, first_value(seq) OVER w AS first_seq, first_value(winner_key) OVER w AS first_winner,
      first_value(round_norm) OVER w = round_norm AS first_round,
      first_value(level) OVER w = level AND first_value(surface) OVER w = surface AS first_court
    FROM feed_keys_v WINDOW w AS (PARTITION BY match_date, gender, pair ORDER BY seq)) f
  LEFT JOIN (SELECT seq, count(*) AS n, count(*) FILTER (same_round AND same_court) AS n_strict, count(*) FILTER (same_round) AS n_round,
      count(*) FILTER (same_court) AS n_court, min(p_seq) FILTER (same_round AND same_court) AS id_strict, min(p_seq) AS id_any,
      min(p_seq) FILTER (same_round) AS id_round, min(p_seq) FILTER (same_court) AS id_court,
      arg_min(p_winner, p_seq) FILTER (same_round AND same_court) AS w_strict, arg_min(p_winner, p_seq) AS w_any,
      arg_min(p_winner, p_seq) FILTER (same_round) AS w_round, arg_min(p_winner, p_seq) FILTER (same_court) AS w_court
    FROM merge_pairs_v GROUP BY seq) c USING (seq))""",
    "ext_picks_v": """
SELECT 'x' || f.seq AS pick_id, f.seq, CAST(f.match_date AS VARCHAR) AS date, f.gender,
  CASE f.level WHEN 'atp_wta' THEN CASE WHEN f.seq % 2 = 0 THEN 'main-tour' ELSE 'ATP' END WHEN 'grand_slam' THEN 'Slam' ELSE f.level END AS tour_level,
  CASE f.seq % 3 WHEN 0 THEN 'ev-' || (CASE WHEN f.seq % 10 < 5 THEN f.seq ELSE 1000000 + f.seq // 4 END) WHEN 1 THEN '' ELSE 'ev-' || (900000000 + f.seq) END AS fixture_id,
  'Open ' || (f.seq % 25) AS tournament, 'Match ' || f.seq AS match_name,
  CASE WHEN m.k % 2 = 0 THEN f.winner_api_key ELSE f.loser_api_key END AS player_api_key,
  CASE WHEN m.k % 2 = 0 THEN f.loser_api_key ELSE f.winner_api_key END AS opponent_api_key,
  CASE WHEN m.k % 2 = 0 THEN f.winner_name ELSE f.loser_name END AS player_name,
  CASE WHEN m.k % 2 = 0 THEN f.loser_name ELSE f.winner_name END AS opponent_name,
  CASE WHEN f.seq % 50 = 0 THEN 'void' WHEN m.k % 2 = 0 THEN 'win' ELSE 'loss' END AS result,
  CASE WHEN m.k % 5 = 0 THEN 1.25 ELSE 1.0 END::DOUBLE AS stake, (130 + m.k * 7 % 320)::DOUBLE / 100 AS odds,
  (300 + f.seq * 37 % 500)::DOUBLE / 1000 AS model_prob, CASE WHEN f.seq % 2 = 0 THEN (200 + f.seq * 13 % 600)::DOUBLE / 1000 END AS implied_prob,
  (m.k % 11)::DOUBLE / 10 AS player_win_rate, CASE WHEN m.loser_k % 7 = 0 THEN NULL ELSE (m.loser_k % 11)::DOUBLE / 10 END AS opponent_win_rate,
  m.k % 4 AS h2h_player, m.loser_k % 4 AS h2h_opponent,
  CASE WHEN f.seq % 12 = 1 THEN (f.seq % 7)::DOUBLE / 4 END AS own_profit, CASE WHEN f.seq % 9 = 2 THEN (f.seq % 11)::DOUBLE / 100 END AS own_edge,
  f.seq % 14 = 3 OR f.seq % 28 = 4 AS qualifies
FROM feed_v f JOIN matches_v m USING (seq)""",
    "pred_keys_v": """
SELECT seq, CAST(match_date AS VARCHAR) AS date, gender, CAST(CASE WHEN seq % 10 < 5 THEN seq ELSE 1000000 + seq // 4 END AS VARCHAR) AS digits,
  least(winner_key, loser_key) || '|' || greatest(winner_key, loser_key) AS pair, winner_key, loser_key, level, surface
FROM valid_v""",
    "pick_keys_v": """
SELECT p.*, a.target_key AS p_key, b.target_key AS o_key, coalesce(a.status, 'not_in_mapping') AS p_status, coalesce(b.status, 'not_in_mapping') AS o_status,
  regexp_replace(fixture_id, '[^0-9]+', '', 'g') AS digits,
  CASE WHEN a.target_key IS NOT NULL AND b.target_key IS NOT NULL THEN least(a.target_key, b.target_key) || '|' || greatest(a.target_key, b.target_key) END AS pair
FROM ext_picks_v p LEFT JOIN mapping_v a ON a.api_key = p.player_api_key LEFT JOIN mapping_v b ON b.api_key = p.opponent_api_key""",
    "pick_match_v": """
SELECT p.*, CASE WHEN i.n = 1 THEN 'matched_by_match_id' WHEN i.n > 1 AND p.pair IS NOT NULL AND ip.n = 1 THEN 'matched_by_match_id_pair'
    WHEN i.n > 1 AND p.pair IS NOT NULL THEN 'matched_by_match_id_ambiguous' WHEN pr.n = 1 THEN 'matched_by_date_gender_pair'
    WHEN pr.n > 1 THEN 'matched_by_date_gender_pair_ambiguous' ELSE 'no_prediction_match' END AS match_status,
  CASE WHEN i.n = 1 THEN i.s WHEN i.n > 1 AND p.pair IS NOT NULL AND ip.n = 1 THEN ip.s WHEN i.n > 1 AND p.pair IS NOT NULL THEN i.s
    WHEN pr.n >= 1 THEN pr.s END AS prediction_seq
FROM pick_keys_v p
LEFT JOIN (SELECT date, gender, digits, count(*) AS n, min(seq) AS s FROM pred_keys_v GROUP BY ALL) i USING (date, gender, digits)
LEFT JOIN (SELECT date, gender, digits, pair, count(*) AS n, min(seq) AS s FROM pred_keys_v GROUP BY ALL) ip USING (date, gender, digits, pair)
LEFT JOIN (SELECT date, gender, pair, count(*) AS n, min(seq) AS s FROM pred_keys_v GROUP BY ALL) pr USING (date, gender, pair)""",
    "source_results_v": """
SELECT o_orderkey * 2 + again AS row_no, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS pick_id,
  CASE WHEN o_orderkey % 4 = 1 THEN 'e' || o_orderkey END AS event_key, CASE WHEN o_orderkey % 4 = 2 THEN 'f' || (o_orderkey - o_orderkey % 8) END AS fixture_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_custkey AS VARCHAR) AS player_key, CAST(o_custkey % 10 AS VARCHAR) AS opponent_key,
  CASE WHEN o_orderkey % 2 = 0 THEN 'home' ELSE 'away' END AS side,
  CASE WHEN again = 1 THEN 'Pending' WHEN o_orderkey % 9 = 0 THEN upper(r) WHEN o_orderkey % 21 = 0 THEN 'open' ELSE r END AS result,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 50 AS DOUBLE) END AS profit
FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'win' WHEN 'O' THEN 'loss' ELSE 'void' END AS r,
  unnest(CASE WHEN o_orderkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS again FROM orders)""",
    "active_v": """
SELECT CAST(pick_id AS VARCHAR) AS pick_id, 'e' || pick_id AS event_key, 'f' || (pick_id - pick_id % 8) AS fixture_id,
  CAST(pick_date AS VARCHAR) AS date, CAST(player_id AS VARCHAR) AS player_key, CAST(player_id % 10 AS VARCHAR) AS opponent_key, side,
  CAST(stake AS DOUBLE) AS stake, CAST(odds AS DOUBLE) AS odds
FROM picks_v""",
    "enriched_v": """
SELECT *, CASE WHEN w_key IS NULL THEN 'no_prediction_match' WHEN mapping_status <> 'mapped' THEN 'unmapped_player'
    WHEN picked_side IS NULL THEN 'picked_player_not_in_prediction' WHEN p_blend_80_20 IS NULL THEN 'missing_elo_probability'
    WHEN surface = 'unknown' THEN 'unknown_surface'
    WHEN min_level_n < 10 THEN 'min_level_not_met' WHEN min_surface_n < 5 THEN 'min_surface_not_met' ELSE '' END AS no_bet_reason,
  no_bet_reason = '' AS eligible, elo_prob_full >= 0.5 AS agrees, floor(elo_prob_full * 1e6 + 0.5) / 1e6 AS elo_prob_pick,
  floor(old_edge_full * 1e6 + 0.5) / 1e6 AS old_edge, floor(elo_edge_full * 1e6 + 0.5) / 1e6 AS elo_edge
FROM (
  SELECT *, coalesce(own_edge, floor((model_prob - implied) * 1e8 + 0.5) / 1e8) AS old_edge_full, floor((elo_prob_full - implied) * 1e8 + 0.5) / 1e8 AS elo_edge_full
  FROM (
    SELECT p.* EXCLUDE (tour_level), CASE WHEN p.qualifies THEN 'qualifying' ELSE CASE p.tour_level WHEN 'main-tour' THEN 'atp_wta' WHEN 'Slam' THEN 'grand_slam' ELSE lower(p.tour_level) END END AS tour_level,
      r.winner_key AS w_key, r.level, r.surface, least(r.w_comp_n, r.l_comp_n) AS min_level_n, least(r.w_surf_n, r.l_surf_n) AS min_surface_n,
      CASE WHEN p_key IS NULL AND o_key IS NULL THEN 'both_unmapped:' || p_status || '|' || o_status WHEN p_key IS NULL THEN 'player_unmapped:' || p_status
        WHEN o_key IS NULL THEN 'opponent_unmapped:' || o_status ELSE 'mapped' END AS mapping_status,
      CASE WHEN p_key = r.winner_key THEN 'winner' WHEN p_key = r.loser_key AND p_blend_80_20 IS NOT NULL THEN 'loser' END AS picked_side,
      r.p_blend_80_20,
      floor(CASE WHEN p_key = r.winner_key THEN p_blend_80_20 WHEN p_key = r.loser_key THEN 1 - p_blend_80_20 END * 1e8 + 0.5) / 1e8 AS elo_prob_full,
      coalesce(p.implied_prob, 1.0 / p.odds) AS implied,
      floor((player_win_rate - opponent_win_rate) * 1e6 + 0.5) / 1e6 AS last10_win_rate_diff, h2h_player - h2h_opponent AS h2h_diff,
      h2h_player + h2h_opponent AS h2h_sum,
      CAST(CASE WHEN own_profit IS NOT NULL THEN own_profit WHEN result = 'win' THEN CAST(p.stake AS DECIMAL(18,6)) * (CAST(p.odds AS DECIMAL(18,6)) - 1)
        WHEN result = 'loss' THEN -CAST(p.stake AS DECIMAL(18,6)) ELSE 0 END AS DECIMAL(18,6)) AS profit
    FROM pick_match_v p LEFT JOIN predictions_v r ON r.seq = p.prediction_seq))""",
    "played_v": """
SELECT seq, match_date, winner_key AS player_key, 1 AS won, sign(w1 - l1) + sign(w2 - l2) AS set_diff, w1 + w2 - l1 - l2 AS game_diff
FROM valid_v WHERE w1 <> l1 OR w2 <> l2
UNION ALL SELECT seq, match_date, loser_key, 0, -(sign(w1 - l1) + sign(w2 - l2)), l1 + l2 - w1 - w2 FROM valid_v WHERE w1 <> l1 OR w2 <> l2""",
    "ledger_v": """
SELECT *, CAST(CASE status WHEN 'win' THEN stake * (odds - 1) WHEN 'loss' THEN -stake WHEN 'void' THEN 0 END AS DECIMAL(18,6)) AS profit FROM picks_v""",
    "scan_v": r"""
SELECT f.* REPLACE (CASE WHEN seq % 11 = 0 THEN 'Finished' WHEN seq % 13 = 0 THEN 'Postponed' ELSE '' END AS event_status,
    CASE WHEN seq % 23 = 0 THEN '1' ELSE '0' END AS event_live, CAST(match_date AS VARCHAR) AS event_date),
  CASE WHEN k % 10 = 0 THEN '1' ELSE '0' END AS event_qualification,
  t.map_name, coalesce(t.map_qualification, false) AS map_qualification, t.map_surface
FROM fixtures_v f LEFT JOIN (SELECT tournament_key, trim(regexp_replace(translate(lower(tournament_name), '-_', '  '), '\s+', ' ', 'g')) AS map_name,
  tournament_name LIKE '%Qualifying%' AS map_qualification,
  CASE WHEN lower(tournament_sourface) LIKE '%hard%' THEN 'hard' ELSE nullif(lower(tournament_sourface), '') END AS map_surface FROM tournaments_v) t USING (tournament_key)""",
    "scan_context_v": r"""
SELECT *, CASE WHEN qualification THEN 'qualifying' ELSE base_level END AS level FROM (
  SELECT *, CASE WHEN regexp_matches(c, '\b(women|woman|female|wta)\b') OR regexp_matches(c, '\bw(15|35|50|75|100)\b') THEN 'women'
      WHEN regexp_matches(c, '\b(men|man|male|atp)\b') OR regexp_matches(c, '\bm(15|25)\b') THEN 'men' ELSE 'unknown' END AS gender,
    CASE WHEN regexp_matches(c, 'grand slam|australian open|roland garros|wimbledon|us open') THEN 'grand_slam'
      WHEN regexp_matches(c, 'challenger') OR regexp_matches(c, '\bch\b') THEN 'challenger'
      WHEN regexp_matches(c, 'itf') OR regexp_matches(c, '\b(m(15|25)|w(15|35|50|75|100))\b') THEN 'itf'
      WHEN regexp_matches(c, 'atp|wta') THEN 'atp_wta' ELSE 'unknown' END AS base_level,
    event_qualification = '1' OR regexp_matches(c, '\bqualif(ication|ications|ying|ier|iers)?\b|\bqual\.?\b') OR map_qualification AS qualification
  FROM (SELECT *, trim(regexp_replace(translate(lower(event_type_type || ' ' || tournament_name || ' ' || tournament_round || ' ' || tournament_key || ' ' ||
    coalesce(map_name, '')), '-_', '  '), '\s+', ' ', 'g')) AS c FROM scan_v))""",
    "slam_map_v": "SELECT lower(tournament_name) AS map_key, min(true_surface) AS map_value, min(seq) AS position FROM fixtures_v WHERE true_level = 'grand_slam' AND true_surface <> 'unknown' GROUP BY 1",
    "scan_surface_v": """
SELECT s.*, CASE WHEN event_surface <> '' THEN 'api_field:event_surface' WHEN seq % 9 = 4 THEN 'api_field:court_surface' WHEN seq % 9 = 0 THEN 'api_field:venue.court.type'
    WHEN seq % 9 = 2 THEN 'api_field:meta.a.b.c.d.e.surface' WHEN seq % 9 = 1 THEN 'api_text:notes[0]'
    WHEN map_surface IS NOT NULL THEN 'tournaments_metadata' WHEN h.surface IS NOT NULL THEN 'tournament_surface_map' ELSE 'missing' END AS surface_source,
  coalesce(CASE WHEN event_surface LIKE 'Hard%' THEN 'hard' ELSE nullif(lower(event_surface), '') END, CASE WHEN seq % 9 IN (0, 2) THEN 'clay' WHEN seq % 9 IN (1, 4) THEN 'grass' END,
    map_surface, h.surface, 'unknown') AS surface
FROM scan_context_v s LEFT JOIN (SELECT t.c, arg_min(map_value, {'l': -length(map_key), 'k': map_key}) AS surface
  FROM (SELECT DISTINCT c FROM scan_context_v) t JOIN slam_map_v m ON contains(t.c, m.map_key) GROUP BY t.c) h ON h.c = s.c""",
    "scan_skip_v": r"""
SELECT *, CASE WHEN event_status <> '' THEN 'status_' || lower(event_status) WHEN event_live = '1' THEN 'live'
  WHEN lower(event_type_type) LIKE '%double%' THEN 'doubles_or_team' WHEN event_key = '' THEN 'missing_event_key'
  WHEN event_first_player = '' THEN 'missing_player_name' END AS scan_skip FROM scan_surface_v""",
    "odds_v": """
WITH own AS (SELECT event_key, side, bookmaker, max(odds) AS odds FROM quotes_v WHERE odds > 1 GROUP BY 1, 2, 3),
m AS (SELECT event_key, side, median(odds) AS mid, count(*) AS raw_n FROM own GROUP BY 1, 2 HAVING count(*) >= 3),
j AS (SELECT q.*, m.mid, m.raw_n, abs(q.odds - mid) / mid <= 0.12 AS near FROM own q JOIN m USING (event_key, side)),
n AS (SELECT event_key, side, count(*) FILTER (near) AS near_n FROM j GROUP BY 1, 2),
u AS (SELECT j.* FROM j JOIN n USING (event_key, side) WHERE near_n < 3 OR near),
o AS (SELECT event_key, side, floor(sum(CAST(odds AS DECIMAL(18,6)))::DOUBLE / count(*) * 1e4 + 0.5) / 1e4 AS avg_odds, floor(median(odds) * 1e4 + 0.5) / 1e4 AS median_odds,
  max({'o': odds, 'b': bookmaker}).o AS best_odds, max({'o': odds, 'b': bookmaker}).b AS best_bookmaker, any_value(raw_n) AS quotes_raw, count(*) AS quotes_clean,
  any_value(raw_n) - count(*) AS outliers_removed FROM u GROUP BY 1, 2)
SELECT * FROM o WHERE event_key IN (SELECT event_key FROM o GROUP BY 1 HAVING count(*) = 2)""",
    "profile_v": """
SELECT player_key, coalesce(max(rating) FILTER (layer = 'level' AND value = 'grand_slam'), 1500.0) AS grand_slam_r, coalesce(max(n) FILTER (layer = 'level' AND value = 'grand_slam'), 0) AS grand_slam_n, coalesce(max(rating) FILTER (layer = 'level' AND value = 'atp_wta'), 1500.0) AS atp_wta_r, coalesce(max(n) FILTER (layer = 'level' AND value = 'atp_wta'), 0) AS atp_wta_n, coalesce(max(rating) FILTER (layer = 'level' AND value = 'challenger'), 1500.0) AS challenger_r, coalesce(max(n) FILTER (layer = 'level' AND value = 'challenger'), 0) AS challenger_n, coalesce(max(rating) FILTER (layer = 'level' AND value = 'itf'), 1500.0) AS itf_r, coalesce(max(n) FILTER (layer = 'level' AND value = 'itf'), 0) AS itf_n, coalesce(max(rating) FILTER (layer = 'level' AND value = 'qualifying'), 1500.0) AS qualifying_r, coalesce(max(n) FILTER (layer = 'level' AND value = 'qualifying'), 0) AS qualifying_n, coalesce(max(rating) FILTER (layer = 'surface' AND value = 'hard'), 1500.0) AS hard_r, coalesce(max(n) FILTER (layer = 'surface' AND value = 'hard'), 0) AS hard_n, coalesce(max(rating) FILTER (layer = 'surface' AND value = 'clay'), 1500.0) AS clay_r, coalesce(max(n) FILTER (layer = 'surface' AND value = 'clay'), 0) AS clay_n, coalesce(max(rating) FILTER (layer = 'surface' AND value = 'grass'), 1500.0) AS grass_r, coalesce(max(n) FILTER (layer = 'surface' AND value = 'grass'), 0) AS grass_n, coalesce(max(rating) FILTER (layer = 'surface' AND value = 'carpet'), 1500.0) AS carpet_r, coalesce(max(n) FILTER (layer = 'surface' AND value = 'carpet'), 0) AS carpet_n,
  coalesce(sum(rating * n) FILTER (layer = 'level') / sum(n) FILTER (layer = 'level'), 1500.0) AS overall_r, coalesce(sum(n) FILTER (layer = 'level'), 0)::BIGINT AS overall_n
FROM ladder_state_v GROUP BY player_key""",
    "scan_sides_v": """
SELECT e.seq, e.event_key, e.gender, e.level, e.base_level, e.surface, e.surface_source, e.c, e.event_first_player || ' - ' || e.event_second_player AS match_name, x.*,
  a.target_key AS own_key, b.target_key AS other_key
FROM (SELECT * FROM scan_skip_v WHERE scan_skip IS NULL AND gender IN ('men', 'women')) e,
  LATERAL (VALUES ('home', first_player_key, second_player_key), ('away', second_player_key, first_player_key)) x(side, own_player_key, other_player_key)
LEFT JOIN mapping_v a ON a.api_key = e.gender || ':api:' || x.own_player_key LEFT JOIN mapping_v b ON b.api_key = e.gender || ':api:' || x.other_player_key""",
    "scan_components_v": """
SELECT s.*, own.player_key IS NOT NULL AND oth.player_key IS NOT NULL AS rated, 
  CASE s.level WHEN 'grand_slam' THEN CASE WHEN own.grand_slam_n + own.atp_wta_n = 0 THEN 1500.0 ELSE (own.grand_slam_r * (own.grand_slam_n + CASE WHEN own.grand_slam_n > 0 THEN 8 ELSE 0 END)
      + own.atp_wta_r * (own.atp_wta_n + CASE WHEN own.atp_wta_n > 0 THEN 12 ELSE 0 END)) / (own.grand_slam_n + CASE WHEN own.grand_slam_n > 0 THEN 8 ELSE 0 END
      + own.atp_wta_n + CASE WHEN own.atp_wta_n > 0 THEN 12 ELSE 0 END) END
    WHEN 'atp_wta' THEN own.atp_wta_r WHEN 'challenger' THEN own.challenger_r WHEN 'itf' THEN own.itf_r WHEN 'qualifying' THEN own.qualifying_r ELSE 1500.0 END AS own_plain_r, CASE s.level WHEN 'grand_slam' THEN own.grand_slam_n + own.atp_wta_n WHEN 'atp_wta' THEN own.atp_wta_n WHEN 'challenger' THEN own.challenger_n
    WHEN 'itf' THEN own.itf_n WHEN 'qualifying' THEN own.qualifying_n ELSE 0 END AS own_plain_n,
  CASE WHEN s.base_level = 'unknown' OR CASE s.base_level WHEN 'grand_slam' THEN own.grand_slam_n + own.atp_wta_n WHEN 'atp_wta' THEN own.atp_wta_n WHEN 'challenger' THEN own.challenger_n
    WHEN 'itf' THEN own.itf_n WHEN 'qualifying' THEN own.qualifying_n ELSE 0 END = 0 THEN own.overall_r ELSE CASE s.base_level WHEN 'grand_slam' THEN CASE WHEN own.grand_slam_n + own.atp_wta_n = 0 THEN 1500.0 ELSE (own.grand_slam_r * (own.grand_slam_n + CASE WHEN own.grand_slam_n > 0 THEN 8 ELSE 0 END)
      + own.atp_wta_r * (own.atp_wta_n + CASE WHEN own.atp_wta_n > 0 THEN 12 ELSE 0 END)) / (own.grand_slam_n + CASE WHEN own.grand_slam_n > 0 THEN 8 ELSE 0 END
      + own.atp_wta_n + CASE WHEN own.atp_wta_n > 0 THEN 12 ELSE 0 END) END
    WHEN 'atp_wta' THEN own.atp_wta_r WHEN 'challenger' THEN own.challenger_r WHEN 'itf' THEN own.itf_r WHEN 'qualifying' THEN own.qualifying_r ELSE 1500.0 END * 0.7 + own.overall_r * 0.3 END AS own_qual_r,
  CASE WHEN s.base_level = 'unknown' THEN 0 ELSE CASE s.base_level WHEN 'grand_slam' THEN own.grand_slam_n + own.atp_wta_n WHEN 'atp_wta' THEN own.atp_wta_n WHEN 'challenger' THEN own.challenger_n
    WHEN 'itf' THEN own.itf_n WHEN 'qualifying' THEN own.qualifying_n ELSE 0 END END AS own_qual_n, own.overall_n AS own_overall_n,
  CASE s.surface WHEN 'hard' THEN own.hard_r WHEN 'clay' THEN own.clay_r WHEN 'grass' THEN own.grass_r WHEN 'carpet' THEN own.carpet_r ELSE 1500.0 END AS own_surf_r,
  CASE s.surface WHEN 'hard' THEN own.hard_n WHEN 'clay' THEN own.clay_n WHEN 'grass' THEN own.grass_n WHEN 'carpet' THEN own.carpet_n ELSE 0 END AS own_surf_n, 
  CASE s.level WHEN 'grand_slam' THEN CASE WHEN oth.grand_slam_n + oth.atp_wta_n = 0 THEN 1500.0 ELSE (oth.grand_slam_r * (oth.grand_slam_n + CASE WHEN oth.grand_slam_n > 0 THEN 8 ELSE 0 END)
      + oth.atp_wta_r * (oth.atp_wta_n + CASE WHEN oth.atp_wta_n > 0 THEN 12 ELSE 0 END)) / (oth.grand_slam_n + CASE WHEN oth.grand_slam_n > 0 THEN 8 ELSE 0 END
      + oth.atp_wta_n + CASE WHEN oth.atp_wta_n > 0 THEN 12 ELSE 0 END) END
    WHEN 'atp_wta' THEN oth.atp_wta_r WHEN 'challenger' THEN oth.challenger_r WHEN 'itf' THEN oth.itf_r WHEN 'qualifying' THEN oth.qualifying_r ELSE 1500.0 END AS oth_plain_r, CASE s.level WHEN 'grand_slam' THEN oth.grand_slam_n + oth.atp_wta_n WHEN 'atp_wta' THEN oth.atp_wta_n WHEN 'challenger' THEN oth.challenger_n
    WHEN 'itf' THEN oth.itf_n WHEN 'qualifying' THEN oth.qualifying_n ELSE 0 END AS oth_plain_n,
  CASE WHEN s.base_level = 'unknown' OR CASE s.base_level WHEN 'grand_slam' THEN oth.grand_slam_n + oth.atp_wta_n WHEN 'atp_wta' THEN oth.atp_wta_n WHEN 'challenger' THEN oth.challenger_n
    WHEN 'itf' THEN oth.itf_n WHEN 'qualifying' THEN oth.qualifying_n ELSE 0 END = 0 THEN oth.overall_r ELSE CASE s.base_level WHEN 'grand_slam' THEN CASE WHEN oth.grand_slam_n + oth.atp_wta_n = 0 THEN 1500.0 ELSE (oth.grand_slam_r * (oth.grand_slam_n + CASE WHEN oth.grand_slam_n > 0 THEN 8 ELSE 0 END)
      + oth.atp_wta_r * (oth.atp_wta_n + CASE WHEN oth.atp_wta_n > 0 THEN 12 ELSE 0 END)) / (oth.grand_slam_n + CASE WHEN oth.grand_slam_n > 0 THEN 8 ELSE 0 END
      + oth.atp_wta_n + CASE WHEN oth.atp_wta_n > 0 THEN 12 ELSE 0 END) END
    WHEN 'atp_wta' THEN oth.atp_wta_r WHEN 'challenger' THEN oth.challenger_r WHEN 'itf' THEN oth.itf_r WHEN 'qualifying' THEN oth.qualifying_r ELSE 1500.0 END * 0.7 + oth.overall_r * 0.3 END AS oth_qual_r,
  CASE WHEN s.base_level = 'unknown' THEN 0 ELSE CASE s.base_level WHEN 'grand_slam' THEN oth.grand_slam_n + oth.atp_wta_n WHEN 'atp_wta' THEN oth.atp_wta_n WHEN 'challenger' THEN oth.challenger_n
    WHEN 'itf' THEN oth.itf_n WHEN 'qualifying' THEN oth.qualifying_n ELSE 0 END END AS oth_qual_n, oth.overall_n AS oth_overall_n,
  CASE s.surface WHEN 'hard' THEN oth.hard_r WHEN 'clay' THEN oth.clay_r WHEN 'grass' THEN oth.grass_r WHEN 'carpet' THEN oth.carpet_r ELSE 1500.0 END AS oth_surf_r,
  CASE s.surface WHEN 'hard' THEN oth.hard_n WHEN 'clay' THEN oth.clay_n WHEN 'grass' THEN oth.grass_n WHEN 'carpet' THEN oth.carpet_n ELSE 0 END AS oth_surf_n
FROM scan_sides_v s LEFT JOIN profile_v own ON own.player_key = s.own_key LEFT JOIN profile_v oth ON oth.player_key = s.other_key""",
    "scan_prob_v": """
SELECT *, CASE WHEN rated AND lw IS NOT NULL THEN 1 / (1 + pow(10, ((oth_r * lw + oth_surf_r * sw) / (lw + sw) - (own_r * lw + own_surf_r * sw) / (lw + sw)) / 400)) END AS side_prob,
  CASE WHEN rated THEN least(own_n, oth_n) END AS min_level_n, CASE WHEN rated AND level = 'qualifying' THEN least(own_overall_n, oth_overall_n) END AS min_overall_n,
  CASE WHEN rated THEN least(own_surf_n, oth_surf_n) END AS min_surface_n
FROM (SELECT *, CASE WHEN level = 'qualifying' THEN own_qual_r ELSE own_plain_r END AS own_r, CASE WHEN level = 'qualifying' THEN oth_qual_r ELSE oth_plain_r END AS oth_r,
    CASE WHEN level = 'qualifying' THEN own_qual_n ELSE own_plain_n END AS own_n, CASE WHEN level = 'qualifying' THEN oth_qual_n ELSE oth_plain_n END AS oth_n,
    CASE level WHEN 'atp_wta' THEN 0.7::DOUBLE WHEN 'grand_slam' THEN 0.7 WHEN 'challenger' THEN 0.6 WHEN 'itf' THEN 1.0 WHEN 'qualifying' THEN 1.0 END AS lw,
    CASE level WHEN 'atp_wta' THEN 0.3::DOUBLE WHEN 'grand_slam' THEN 0.3 WHEN 'challenger' THEN 0.4 ELSE 0.0 END AS sw FROM scan_components_v)""",
    "scan_strict_v": """
SELECT * REPLACE (CASE WHEN level = 'qualifying' THEN CASE WHEN rated THEN 1 / (1 + pow(10, (oth_plain_r - own_plain_r) / 400)) END ELSE side_prob END AS side_prob,
  CASE WHEN level = 'qualifying' AND rated THEN least(own_plain_n, oth_plain_n) ELSE min_level_n END AS min_level_n, NULL AS min_overall_n) FROM scan_prob_v""",
    "feed_blocks_v": """
SELECT DISTINCT gender, norm, x.kind, x.key FROM (SELECT *, list_filter(string_split(norm, ' '), lambda x: x <> '') AS t FROM (SELECT DISTINCT gender, trim(regexp_replace(lower(strip_accents(feed_name)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM names_v) WHERE norm <> ''),
  LATERAL (VALUES ('norm', norm), ('token_key', array_to_string(list_sort(t), ' ')), ('compact', CASE WHEN len(t) = 1 THEN t[1] ELSE t[1][1] || ' ' || array_to_string(t[2:], ' ') END),
    ('surname', t[-1]), ('last', t[-1])) x(kind, key)""",
    "own_blocks_v": """
SELECT DISTINCT gender, norm, x.kind, x.key FROM (SELECT *, list_filter(string_split(norm, ' '), lambda x: x <> '') AS t FROM (SELECT DISTINCT gender, trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM names_v) WHERE norm <> ''),
  LATERAL (VALUES ('norm', norm), ('token_key', array_to_string(list_sort(t), ' ')), ('compact', CASE WHEN len(t) = 1 THEN t[1] ELSE t[1][1] || ' ' || array_to_string(t[2:], ' ') END),
    ('surname', t[-1]), ('last', t[-1])) x(kind, key)""",
    "exact_pairs_v": """
SELECT gender, feed_norm, cand_norm, max(s) AS base_score, arg_max(method, s) AS method FROM (
  SELECT gender, a.norm AS feed_norm, b.norm AS cand_norm, CASE kind WHEN 'norm' THEN 1.0::DOUBLE WHEN 'token_key' THEN 0.995 ELSE 0.97 END AS s,
    CASE kind WHEN 'norm' THEN 'exact_normalized' WHEN 'token_key' THEN 'exact_token_set' ELSE 'exact_initial_form' END AS method
  FROM feed_blocks_v a JOIN own_blocks_v b USING (gender, kind, key) WHERE kind IN ('norm', 'token_key', 'compact')) GROUP BY 1, 2, 3""",
}
