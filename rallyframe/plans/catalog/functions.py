"""Column functions, each run over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.functions import classify as C
from rallyframe.functions import rating as R
from rallyframe.functions import text as T
from rallyframe.functions import values as V
from rallyframe.plans import views
from rallyframe.plans.registry import query

NORM = "trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g'))"


@query("b1_normalize_name", f"""
SELECT doc_id, {NORM.format('text')} AS norm,
  replace({NORM.format("replace(text, '&', ' and ')")}, ' ', '_') AS norm_event,
  trim(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^a-z0-9'' ]+', ' ', 'g'), '\\s+', ' ', 'g'))
    AS norm_apostrophe FROM documents""")
def b1(spark, sf):
    text = F.col("text")
    return views.table(spark, sf, "documents").select(
        "doc_id", T.normalize_name(text).alias("norm"), T.normalize_event_name(text).alias("norm_event"),
        T.normalize_name_keep_apostrophe(text).alias("norm_apostrophe"))


@query("b2_clean_ws_slug", r"""
SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS cleaned,
  coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(
    trim(regexp_replace(text, '\s+', ' ', 'g')))), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g'),
    '^-+|-+$', '', 'g'), ''), 'unknown') AS slug FROM documents""")
def b2(spark, sf):
    return views.table(spark, sf, "documents").select(
        "doc_id", T.clean_ws(F.col("text")).alias("cleaned"), T.slug(F.col("text")).alias("slug"))


@query("b3_parse_match_date", r"""
SELECT seq, CASE WHEN regexp_full_match(trim(raw), '[0-9]{8}') THEN
    substr(trim(raw), 1, 4) || '-' || substr(trim(raw), 5, 2) || '-' || substr(trim(raw), 7, 2) END AS history_date,
  CASE WHEN regexp_full_match(trim(raw), '\d{4}-\d{2}-\d{2}') THEN trim(raw)
    WHEN regexp_full_match(trim(raw), '\d{8}') THEN
      substr(trim(raw), 1, 4) || '-' || substr(trim(raw), 5, 2) || '-' || substr(trim(raw), 7, 2)
    ELSE strftime(try_strptime(substr(trim(raw), 1, 10), '%Y-%m-%d'), '%Y-%m-%d') END AS fixture_date,
  CASE WHEN regexp_full_match(trim(raw), '[0-9]{8}') AND substr(trim(raw), 1, 4) <> '0000'
      AND substr(trim(raw), 5, 2) <> '00' AND substr(trim(raw), 7, 2) <> '00'
    THEN substr(trim(raw), 1, 4) || '-' || substr(trim(raw), 5, 2) || '-' || substr(trim(raw), 7, 2) END AS birth_date
FROM (SELECT seq, CASE k % 6 WHEN 0 THEN replace(tourney_id, '-', '') WHEN 1 THEN tourney_id
    WHEN 2 THEN year || '1399' WHEN 3 THEN tourney_id || ' 10:00' WHEN 4 THEN ' ' || year || '0000 '
    ELSE 'n/a' END AS raw FROM matches_v)""")
def b3(spark, sf):
    day, k = F.col("tourney_id"), F.col("k") % 6
    raw = (F.when(k == 0, F.replace(day, F.lit("-"), F.lit(""))).when(k == 1, day)
           .when(k == 2, F.concat("year", F.lit("1399"))).when(k == 3, F.concat(day, F.lit(" 10:00")))
           .when(k == 4, F.concat(F.lit(" "), "year", F.lit("0000 "))).otherwise("n/a"))
    return views.matches(spark, sf).select("seq", raw.alias("raw")).select(
        "seq", V.parse_history_date(F.col("raw")).alias("history_date"),
        V.parse_fixture_date(F.col("raw")).alias("fixture_date"),
        V.parse_birth_date(F.col("raw")).alias("birth_date"))


@query("b4_safe_number", """
SELECT event_id, v AS as_double, CAST(trunc(v) AS BIGINT) AS as_long, coalesce(CAST(trunc(v) AS BIGINT), 0) AS as_long_or_zero
FROM (SELECT event_id, CASE WHEN isfinite(TRY_CAST(trim(raw) AS DOUBLE)) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS v
  FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'NaN' WHEN 1 THEN ' ' || CAST(value AS VARCHAR)
      WHEN 2 THEN '-' || CAST(value AS VARCHAR) WHEN 3 THEN '' WHEN 4 THEN 'Infinity' ELSE 'x' || event_type END AS raw
    FROM events))""")
def b4(spark, sf):
    i, v = F.col("event_id") % 6, F.col("value").cast("string")
    raw = (F.when(i == 0, "NaN").when(i == 1, F.concat(F.lit(" "), v)).when(i == 2, F.concat(F.lit("-"), v))
           .when(i == 3, "").when(i == 4, "Infinity").otherwise(F.concat(F.lit("x"), "event_type")))
    return views.table(spark, sf, "events").select("event_id", raw.alias("raw")).select(
        "event_id", V.safe_double(F.col("raw")).alias("as_double"), V.safe_long(F.col("raw")).alias("as_long"),
        V.safe_long_or_zero(F.col("raw")).alias("as_long_or_zero"))


@query("b5_first_nonempty", """
SELECT seq, coalesce(nullif(trim(event_winner), ''), nullif(trim(event_surface), ''), nullif(trim(event_status), ''))
  AS first_value FROM fixtures_v""")
def b5(spark, sf):
    return views.fixtures(spark, sf).select("seq", T.first_nonempty(
        F.col("event_winner"), F.col("event_surface"), F.col("event_status")).alias("first_value"))


CONTEXT = r"trim(regexp_replace(translate(lower(event_type_type || ' ' || tournament_name || ' ' || tournament_round), '-_', '  '), '\s+', ' ', 'g'))"
PIPED = "lower(tournament_name || ' | ' || event_type_type || ' | ' || tournament_round)"


@query("b6_infer_gender", rf"""
SELECT seq, CASE WHEN regexp_matches(t, '\bwta\b|women|female|girls') THEN 'women'
    WHEN regexp_matches(t, '\batp\b|men|male|boys') THEN 'men' ELSE 'unknown' END AS from_text,
  CASE WHEN t1 IN ('m', 'man', 'men', 'male', 'atp') THEN 'men'
    WHEN t1 IN ('w', 'woman', 'women', 'female', 'wta') THEN 'women' ELSE t1 END AS from_token,
  CASE WHEN regexp_matches(c, '\b(women|woman|female|wta)\b') OR regexp_matches(c, '\bw(15|35|50|75|100)\b') THEN 'women'
    WHEN regexp_matches(c, '\b(men|man|male|atp)\b') OR regexp_matches(c, '\bm(15|25)\b') THEN 'men'
    ELSE 'unknown' END AS from_words,
  CASE WHEN p LIKE '%wta%' THEN 'women' WHEN p LIKE '%atp%' THEN 'men' ELSE 'unknown' END AS from_path
FROM (SELECT seq, {PIPED} AS t, {CONTEXT} AS c, lower(split_part(event_type_type, ' ', 1)) AS t1,
  lower(split_part(event_type_type, ' ', 1)) || '_matches.csv' AS p FROM fixtures_v)""")
def b6(spark, sf):
    f = views.fixtures(spark, sf)
    first_word = F.split_part(F.col("event_type_type"), F.lit(" "), F.lit(1))
    names = [F.col(c) for c in ("event_type_type", "tournament_name", "tournament_round")]
    return f.select(
        "seq", C.gender_from_text(C.piped_text(names[1], names[0], names[2])).alias("from_text"),
        C.gender_from_token(first_word).alias("from_token"),
        C.gender_from_words(C.context_text(*names)).alias("from_words"),
        C.gender_from_path(F.concat(first_word, F.lit("_matches.csv"))).alias("from_path"))


@query("b7_normalize_surface", r"""
SELECT seq, CASE WHEN lower(raw) IN ('hard', 'clay', 'grass', 'carpet') THEN lower(raw) ELSE 'unknown' END AS exact,
  CASE WHEN lower(raw) LIKE '%hard%' THEN 'hard' WHEN lower(raw) LIKE '%clay%' THEN 'clay'
    WHEN lower(raw) LIKE '%grass%' THEN 'grass' WHEN lower(raw) LIKE '%carpet%' THEN 'carpet' ELSE 'unknown' END AS substring,
  CASE WHEN w IN ('hard', 'clay', 'grass', 'carpet') THEN w WHEN w IN ('cement', 'hardcourt') THEN 'hard'
    WHEN w IN ('har tru', 'red clay') THEN 'clay' WHEN w = 'lawn' THEN 'grass'
    WHEN regexp_matches(w, '\bhard\b') THEN 'hard' WHEN regexp_matches(w, '\bclay\b') THEN 'clay'
    WHEN regexp_matches(w, '\bgrass\b|\blawn\b') THEN 'grass' WHEN regexp_matches(w, '\bcarpet\b') THEN 'carpet'
    ELSE 'unknown' END AS words
FROM (SELECT seq, raw, trim(regexp_replace(translate(lower(raw), '_-', '  '), '\s+', ' ', 'g')) AS w
  FROM (SELECT seq, CASE k % 7 WHEN 0 THEN 'Har-Tru' WHEN 1 THEN 'CEMENT' WHEN 2 THEN 'Lawn' WHEN 3 THEN 'hardcourt 2'
    ELSE event_surface END AS raw FROM fixtures_v))""")
def b7(spark, sf):
    k = F.col("k") % 7
    raw = C.first_match([("Har-Tru", k == 0), ("CEMENT", k == 1), ("Lawn", k == 2), ("hardcourt 2", k == 3)],
                        F.col("event_surface"))
    return views.fixtures(spark, sf).select("seq", raw.alias("raw")).select(
        "seq", C.surface_exact(F.col("raw")).alias("exact"), C.surface_substring(F.col("raw")).alias("substring"),
        C.surface_words(F.col("raw")).alias("words"))


LEVEL_TEXT = rf"""
  CASE WHEN regexp_matches(t, 'australian open|roland garros|french open|wimbledon|us open|u\.s\. open|united states open')
      THEN 'grand_slam'
    WHEN regexp_matches(t, 'qualification|qualifying| qualifiers| qualifier| qual | qual\.| - q') THEN 'qualifying'
    WHEN regexp_matches(t, 'challenger| chall ') THEN 'challenger'
    WHEN regexp_matches(t, 'itf | itf|m15|m25|m35|w15|w25|w35|w50|w75|w100|w125') THEN 'itf'
    WHEN g IN ('men', 'women') AND regexp_matches(t,
      '\batp\b|\bwta\b|tour finals|united cup|davis cup|bjk cup|fed cup') THEN 'atp_wta' ELSE 'unknown' END"""
BASE_LEVEL = r"""
  CASE WHEN regexp_matches(c, 'grand slam|australian open|roland garros|wimbledon|us open') THEN 'grand_slam'
    WHEN regexp_matches(c, 'challenger') OR regexp_matches(c, '\bch(allenger)?\b') THEN 'challenger'
    WHEN regexp_matches(c, 'itf') OR regexp_matches(c, '\b(m(15|25)|w(15|35|50|75|100))\b') THEN 'itf'
    WHEN regexp_matches(c, 'atp|wta') THEN 'atp_wta' ELSE 'unknown' END"""
GENDER_TEXT = r"""CASE WHEN regexp_matches({0}, '\bwta\b|women|female|girls') THEN 'women'
    WHEN regexp_matches({0}, '\batp\b|men|male|boys') THEN 'men' ELSE 'unknown' END"""


@query("b8_infer_level", rf"""
SELECT seq, CASE code WHEN 'G' THEN 'grand_slam' WHEN 'D' THEN 'atp_wta' WHEN 'M' THEN 'atp_wta' WHEN 'A' THEN 'atp_wta'
    WHEN 'F' THEN 'atp_wta' WHEN 'C' THEN 'challenger' WHEN 'Q' THEN 'qualifying'
    ELSE CASE WHEN lower(tournament_name) LIKE '%qual%' OR tournament_round = 'Q' THEN 'qualifying'
      WHEN true_gender = 'men' THEN 'atp_wta' WHEN source_file LIKE '%chall%' THEN 'challenger' ELSE 'itf' END END AS from_code,
  {LEVEL_TEXT} AS from_text, {BASE_LEVEL} AS base_level,
  CASE WHEN lower(event_type_type) LIKE '%qualifi%' THEN 'qualifying'
    WHEN lv IN ('atp_wta', 'main_tour', 'tour') THEN 'atp_wta' WHEN lv IN ('grand_slam', 'slam') THEN 'grand_slam'
    WHEN lv = '' THEN 'unknown' ELSE lv END AS from_pick,
  CASE WHEN lower(event_type_type) LIKE '%qualifi%' THEN 'qualifying' WHEN lv IN ('atp', 'main_tour') THEN 'atp_wta' WHEN lv = 'slam' THEN 'grand_slam'
    WHEN lv = 'challenger' THEN lv WHEN lv = '' AND lower(event_type_type) LIKE '%challenger%' THEN 'challenger' WHEN lv = '' AND lower(event_type_type) LIKE '%itf%' THEN 'itf'
    WHEN lv = '' AND regexp_matches(lower(event_type_type), 'atp|wta') THEN 'atp_wta' WHEN lv = '' THEN 'unknown' ELSE lv END AS from_scan
FROM (SELECT *, {GENDER_TEXT.format('t')} AS g FROM (SELECT *, ' ' || {PIPED} || ' ' AS t, {CONTEXT} AS c,
  ['G', 'D', 'm', 'C', 'Q', 'x', ''][k % 7 + 1] AS raw_code, upper(raw_code) AS code,
  ['Main-Tour', 'Slam', 'challenger', '', 'ATP'][k % 5 + 1] AS raw_level,
  translate(lower(raw_level), '- ', '__') AS lv FROM fixtures_v))""")
def b8(spark, sf):
    f = views.fixtures(spark, sf)
    code = F.element_at(F.array(*map(F.lit, ("G", "D", "m", "C", "Q", "x", ""))), (F.col("k") % 7 + 1).cast("int"))
    level = F.element_at(F.array(*map(F.lit, ("Main-Tour", "Slam", "challenger", "", "ATP"))),
                         (F.col("k") % 5 + 1).cast("int"))
    hint = F.when(F.col("true_gender") == "men", "atp_wta")
    piped = C.piped_text(F.col("tournament_name"), F.col("event_type_type"), F.col("tournament_round"))
    context = C.context_text(F.col("event_type_type"), F.col("tournament_name"), F.col("tournament_round"))
    return f.select(
        "seq", C.level_from_code(code, F.col("tournament_name"), F.col("tournament_round"), hint,
                                 F.col("source_file")).alias("from_code"),
        C.level_from_text(piped, C.gender_from_text(piped)).alias("from_text"),
        C.base_level_from_context(context).alias("base_level"),
        C.level_from_pick(level, F.col("event_type_type"), F.lit("")).alias("from_pick"),
        C.level_from_scan(level, F.col("event_type_type"), F.lit("")).alias("from_scan"))


@query("b9_is_qualification", r"""
SELECT p_partkey, regexp_matches(t, '\bqualif(ication|ications|ying|ier|iers)?\b|\bpre qual|\bqual\.?\b|\bq(ual)?\s*(1|2|3|r1|r2|r3|round|final)\b')
  AS is_qualification
FROM (SELECT p_partkey, trim(regexp_replace(translate(lower(p_name || ' ' ||
  ['Quarterfinal', 'Q1', 'pre-qualifying', 'qual. R2', 'Final', 'QF'][p_size % 6 + 1]), '-_', '  '), '\s+', ' ', 'g')) AS t
  FROM part)""")
def b9(spark, sf):
    words = ("Quarterfinal", "Q1", "pre-qualifying", "qual. R2", "Final", "QF")
    label = F.element_at(F.array(*map(F.lit, words)), F.col("p_size") % 6 + 1)
    return views.table(spark, sf, "part").select(
        "p_partkey", C.is_qualification(F.concat_ws(" ", "p_name", label)).alias("is_qualification"))


@query("b10_is_doubles", f"""
SELECT seq, {PIPED} LIKE '%double%' OR n LIKE '%/%' OR n LIKE '% & %' AS is_doubles,
  {PIPED} LIKE '%double%' OR {PIPED} LIKE '%team%' OR n LIKE '%/%' OR n LIKE '% & %' AS is_doubles_or_team
FROM (SELECT *, CASE k % 11 WHEN 0 THEN event_first_player || '/' || event_second_player
  WHEN 1 THEN event_first_player || ' & x' ELSE event_first_player END AS n FROM fixtures_v)""")
def b10(spark, sf):
    k = F.col("k") % 11
    name = (F.when(k == 0, F.concat_ws("/", "event_first_player", "event_second_player"))
            .when(k == 1, F.concat("event_first_player", F.lit(" & x"))).otherwise(F.col("event_first_player")))
    piped = C.piped_text(F.col("tournament_name"), F.col("event_type_type"), F.col("tournament_round"))
    args = (piped, name, F.col("event_second_player"))
    return views.fixtures(spark, sf).select(
        "seq", C.is_doubles(*args).alias("is_doubles"), C.is_doubles_or_team(*args).alias("is_doubles_or_team"))


FINISHED = r"""(regexp_matches(lower(event_status), 'finished|ended|complete|final|retired|walkover|wo|w/o')
  OR event_winner <> '' OR regexp_matches(event_final_result, '\d'))"""
SETTLE_STATUS = r"""CASE WHEN trim({0}) = '' THEN 'unknown'
  WHEN regexp_matches(lower({0}), 'finished|ended|complete|final') THEN 'finished'
  WHEN regexp_matches(lower({0}), 'cancel|postpon|suspend|interrupt|abandon|retired|walkover|w/o|wo') THEN 'void'
  WHEN regexp_matches(lower({0}), 'not started|not_started|scheduled|upcoming|pending|live|inplay|in play|set|break') THEN 'pending'
  ELSE lower(trim({0})) END"""


@query("b11_match_status", f"""
SELECT seq, {FINISHED} AS is_finished, {SETTLE_STATUS.format('event_status')} AS settle_status FROM fixtures_v""")
def b11(spark, sf):
    return views.fixtures(spark, sf).select(
        "seq", C.is_finished(F.col("event_status"), F.col("event_winner"), F.col("event_final_result"))
        .alias("is_finished"), C.settle_status(F.col("event_status")).alias("settle_status"))


WINNER_SIDE = """CASE WHEN lower({0}) IN ('first player', 'first', '1', 'home', 'event_first_player', first_player_key, lower(event_first_player))
    THEN 'first' WHEN lower({0}) IN ('second player', 'second', '2', 'away', 'event_second_player', second_player_key,
    lower(event_second_player)) THEN 'second' WHEN lower({0}) LIKE '%first%' THEN 'first'
    WHEN lower({0}) LIKE '%second%' THEN 'second' END"""


@query("b12_winner_side", f"""
SELECT seq, {WINNER_SIDE.format('label')} AS side,
  CASE WHEN lower(label) IN ('first player', 'first', 'home', 'player 1', '1') THEN 'home'
    WHEN lower(label) IN ('second player', 'second', 'away', 'player 2', '2') THEN 'away'
    WHEN wk = first_player_key THEN 'home' WHEN wk = second_player_key THEN 'away'
    WHEN label <> '' AND lower(label) = lower(event_first_player) THEN 'home'
    WHEN label <> '' AND lower(label) = lower(event_second_player) THEN 'away' END AS settle_side
FROM (SELECT *, CASE k % 6 WHEN 0 THEN event_first_player WHEN 1 THEN second_player_key WHEN 2 THEN 'The first one'
    WHEN 3 THEN 'Player 2' WHEN 4 THEN '' ELSE event_winner END AS label,
  CASE WHEN k % 6 = 2 THEN second_player_key END AS wk FROM fixtures_v)""")
def b12(spark, sf):
    k = F.col("k") % 6
    label = (F.when(k == 0, F.col("event_first_player")).when(k == 1, F.col("second_player_key"))
             .when(k == 2, "The first one").when(k == 3, "Player 2").when(k == 4, "")
             .otherwise(F.col("event_winner")))
    ids = (F.col("first_player_key"), F.col("second_player_key"))
    names = (F.col("event_first_player"), F.col("event_second_player"))
    return views.fixtures(spark, sf).select(
        "seq", C.winner_side(label, *ids, *names).alias("side"),
        C.settle_winner_side(label, F.when(k == 2, F.col("second_player_key")), label, *ids, *names)
        .alias("settle_side"))


@query("b13_player_key", r"""
SELECT api_key, split_part(api_key, ':', 1) AS key_gender, regexp_replace(api_key, '^(men|women):api(_[a-z]+)?:', '') AS bare,
  api_key || ',' || bare || ',' || gender || ':api_feed:' || bare AS variants,
  CASE WHEN user_id % 5 = 0 THEN gender || ':name:player_' || user_id ELSE gender || ':history:' || user_id END AS built
FROM mapping_v""")
def b13(spark, sf):
    m = views.mapping(spark, sf)
    some_id = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.col("user_id").cast("string"))
    name = T.normalize_name(F.concat(F.lit("Player "), "user_id"), "_")
    return m.select(
        "api_key", V.key_gender(F.col("api_key")).alias("key_gender"), V.bare_api_id(F.col("api_key")).alias("bare"),
        F.array_join(V.api_key_variants(F.col("api_key"), F.col("gender")), ",").alias("variants"),
        V.player_key(F.col("gender"), "history", some_id, name).alias("built"))


@query("b14_name_features", f"""
SELECT doc_id, norm, toks[-1] AS last,
  CASE WHEN len(toks) > 1 AND toks[-2] || ' ' || toks[-1] IN ('de la') THEN toks[-2] || ' ' || toks[-1] ELSE toks[-1] END AS surname,
  toks[1][1] AS initial,
  CASE WHEN len(toks) = 1 THEN toks[1] ELSE toks[1][1] || ' ' || array_to_string(toks[2:], ' ') END AS compact,
  array_to_string(list_sort(toks), ' ') AS token_key,
  array_to_string(list_transform(toks, lambda x: x[1]), '') AS all_initials,
  array_to_string(list_filter(toks, lambda x: regexp_full_match(x, '[a-z]')), ' ') AS one_letter
FROM (SELECT doc_id, {NORM.format('feed_name')} AS norm,
  list_filter(string_split({NORM.format('feed_name')}, ' '), lambda x: x <> '') AS toks FROM names_v) WHERE len(toks) > 0""")
def b14(spark, sf):
    f = T.name_features(F.col("feed_name"))
    return (views.names(spark, sf).select("doc_id", *[c.alias(n) for n, c in f.items()])
            .where(F.size("toks") > 0).drop("toks"))


@query("b15_token_jaccard", f"""
SELECT doc_id, floor(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) * 1.0 /
    len(list_distinct(list_concat(a, b))) END * 1000000 + 0.5) / 1000000 AS jaccard
FROM (SELECT doc_id, list_filter(string_split({NORM.format('name')}, ' '), lambda x: x <> '') AS a,
  list_filter(string_split({NORM.format('feed_name')}, ' '), lambda x: x <> '') AS b FROM names_v)""")
def b15(spark, sf):
    own, other = (T.tokens(T.normalize_name(F.col(c))) for c in ("name", "feed_name"))
    return views.names(spark, sf).select("doc_id", V.rounded(T.token_jaccard(own, other), 6).alias("jaccard"))


@query("b17_stable_ids", """
SELECT seq, substr(sha256('hist|' || seq || '|' || tourney_id || '|' || winner_key || '|' || loser_key), 1, 24) AS match_id,
  md5('v1|' || seq || '|home|' || winner_id) AS pick_id FROM matches_v""")
def b17(spark, sf):
    s = F.col("seq").cast("string")
    return views.matches(spark, sf).select(
        "seq", T.sha_id(24, F.lit("hist"), s, F.col("tourney_id"), F.col("winner_key"), F.col("loser_key"))
        .alias("match_id"),
        T.md5_id(F.lit("v1"), s, F.lit("home"), F.col("winner_id").cast("string")).alias("pick_id"))


@query("b18_birth_year_country", r"""
SELECT c.player_key, CAST(regexp_extract(c.player_bday, '(\d{4})', 1) AS INTEGER) AS birth_year,
  CAST(regexp_extract(c.player_bday, '(\d{4})', 1) AS INTEGER) AS slashed_year,
  CASE WHEN pk % 5 = 0 THEN upper(chr((97 + pk % 26)::INTEGER) || 'uv') WHEN pk % 7 = 0 THEN '' ELSE coalesce('C' || n.n_nationkey, '') END AS country_code
FROM (SELECT *, CAST(regexp_extract(player_key, '(\d+)$', 1) AS BIGINT) AS pk FROM cache_v) c LEFT JOIN nation n ON n.n_name = c.player_country""")
def b18(spark, sf):
    nation = views.table(spark, sf, "nation")
    number = F.regexp_extract("player_key", r"(\d+)$", 1).cast("bigint")
    code = F.concat(F.char(number % 26 + 97), F.lit("uv"))   # three letters are a code; every seventh is blank
    country = F.when(number % 5 == 0, code).when(number % 7 == 0, " ").otherwise(F.col("player_country"))
    slashed = F.translate("player_bday", ".", "/")
    return (views.player_cache(spark, sf)
            .join(F.broadcast(nation), F.col("player_country") == F.col("n_name"), "left")  # fixed: 25 rows
            .select("player_key", V.birth_year(F.col("player_bday")).alias("birth_year"), V.birth_year(slashed).alias("slashed_year"),
                    V.country_code(country, F.concat(F.lit("C"), "n_nationkey")).alias("country_code")))


def score_array(first: str = "w", second: str = "l"):
    return F.array(*[F.struct(F.col(f"{first}{i}").alias("a"), F.col(f"{second}{i}").alias("b")) for i in (1, 2)])


@query("b19_set_game_totals", """
SELECT seq, CAST(w1 > l1 AS INTEGER) + CAST(w2 > l2 AS INTEGER) AS sets_for,
  CAST(w1 < l1 AS INTEGER) + CAST(w2 < l2 AS INTEGER) AS sets_against, w1 + w2 AS games_for, l1 + l2 AS games_against
FROM matches_v""")
def b19(spark, sf):
    return views.matches(spark, sf).select(
        "seq", V.set_game_totals(score_array(), F.lit(True)).alias("t")).select("seq", "t.*")


@query("b20_score_text", """
SELECT seq, coalesce(nullif(trim(event_final_result), ''), w1 || '-' || l1 || ' ' || w2 || '-' || l2) AS score FROM fixtures_v""")
def b20(spark, sf):
    return views.fixtures(spark, sf).select(
        "seq", V.score_text(F.col("event_final_result"), score_array()).alias("score"))


@query("b21_elo_expected", """
SELECT event_id, floor(1e6 / (1 + pow(10, (user_id - value) / 400)) + 0.5) / 1e6 AS expected FROM events""")
def b21(spark, sf):
    return views.table(spark, sf, "events").select(
        "event_id", V.rounded(R.elo_expected(F.col("value"), F.col("user_id")), 6).alias("expected"))


@query("b22_weighted_blend", """
SELECT event_id, floor((CASE WHEN user_id % 5 = 0 THEN 1500.0 ELSE (value * (user_id % 5) * 0.2 + user_id * (user_id % 5) * 0.1) /
  ((user_id % 5) * 0.2 + (user_id % 5) * 0.1) END) * 1e6 + 0.5) / 1e6 AS blended FROM events""")
def b22(spark, sf):
    w = F.col("user_id") % 5
    return views.table(spark, sf, "events").select("event_id", V.rounded(R.weighted_blend(
        F.col("value"), F.col("user_id").cast("double"), w * 0.2, w * 0.1), 6).alias("blended"))


BUCKET = """CASE {cases} ELSE 'other' END""".format(cases=" ".join(
    f"WHEN greatest({{0}}, 1 - {{0}}) >= {lo} AND greatest({{0}}, 1 - {{0}}) < {hi} THEN '{lo:.2f}-{min(hi, 1.0):.2f}'"
    for lo, hi in zip((0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95),
                      (0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95, 1.01))))


@query("b23_log_loss_bucket", f"""
SELECT event_id, floor(-ln(least(greatest(p, 1e-12), 1 - 1e-12)) * 1e6 + 0.5) / 1e6 AS log_loss, {BUCKET.format('p')} AS bucket
FROM (SELECT event_id, (event_id * 37 % 1001) / 1000.0::DOUBLE AS p FROM events)""")
def b23(spark, sf):
    p = (F.col("event_id") * 37 % 1001).cast("double") / 1000.0
    return views.table(spark, sf, "events").select(
        "event_id", V.rounded(R.log_loss(p), 6).alias("log_loss"), R.probability_bucket(p).alias("bucket"))


@query("b24_family_name", f"""
SELECT doc_id, coalesce(list_filter(string_split({NORM.format('feed_name')}, ' '), lambda x: length(x) > 1)[-1], '') AS family
FROM names_v""")
def b24(spark, sf):
    return views.names(spark, sf).select("doc_id", T.family_name(F.col("feed_name")).alias("family"))
