"""Scans and sinks. Files are written by Spark from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.functions import text as T
from rallyframe.functions import values as V
from rallyframe.operators.sides import explode_sides
from rallyframe.plans import views
from rallyframe.plans.registry import query
from rallyframe.sources import fixtures as X
from rallyframe.sources import history as H
from rallyframe.sources import matches as M
from rallyframe.workspace import new_path


@query("a1_read_history_csv", """
SELECT match_num, source_file, year(CAST('2024-01-01' AS DATE)) AS file_year,
  CASE WHEN source_file LIKE 'atp_matches_futures%' THEN 'atp_futures' WHEN source_file LIKE 'atp_matches_qual%' THEN 'atp_qual_chall'
    WHEN source_file LIKE 'atp%' THEN 'atp_main' WHEN source_file LIKE 'wta_matches_qual%' THEN 'wta_qual_itf' ELSE 'wta_main' END AS source_name,
  CASE WHEN source_file LIKE 'atp%' THEN 'men' ELSE 'women' END AS gender,
  CASE WHEN source_file LIKE '%futures%' THEN 'itf' WHEN source_file NOT LIKE '%qual%' THEN 'atp_wta' END AS level_hint,
  tourney_name, surface, winner_name, loser_age FROM history_v""")
def a1(spark, sf):
    path = new_path(spark, "history-csv")
    raw = views.history_rows(spark, sf).drop("seq")
    raw.withColumn("file", F.col("source_file")).drop("source_file").write.partitionBy("file").option(
        "header", True).option("emptyValue", "").csv(path)
    return H.read_history_csv(spark, path).select(
        "match_num", "source_file", "file_year", "source_name", "gender", "level_hint", "tourney_name", "surface",
        "winner_name", "loser_age")


def match_documents(spark, sf):
    m = views.matches(spark, sf)
    return M.nested(m.select(
        F.col("seq").cast("string").alias("match_id"), F.lit("history").alias("source"),
        F.lit("matches.jsonl").alias("source_file"), F.col("tourney_id").alias("date"), F.col("year").cast("int").alias("year"),
        "gender", "level", "surface", "tourney_id", "tourney_name", "round",
        F.concat_ws("-", F.col("w1").cast("string"), F.col("l1").cast("string")).alias("score"), "winner_name", "winner_key", "winner_id",
        "loser_name", "loser_key", "loser_id"))


@query("a2_read_matches_jsonl", """
SELECT CAST(seq AS VARCHAR) AS match_id, tourney_id AS date, CAST(year AS INTEGER) AS year, gender, level, surface, round,
  w1 || '-' || l1 AS score, winner_key, loser_key, winner_name, CAST(loser_id AS VARCHAR) AS loser_id FROM matches_v""")
def a2(spark, sf):
    path = new_path(spark, "matches-jsonl")
    match_documents(spark, sf).write.option("compression", "gzip").json(path)
    return M.flat(M.read_matches_jsonl(spark, path, tolerant=True)).select(
        "match_id", "date", "year", "gender", "level", "surface", "round", "score", "winner_key", "loser_key",
        "winner_name", "loser_id")


def fixture_payloads(spark, sf):
    """Documents of at most 50 fixtures in the four wrapper shapes."""
    f = views.fixtures(spark, sf).withColumn("scores", F.array(*[
        F.struct(F.lit(str(i)).alias("score_set"), F.col(f"w{i}").cast("string").alias("score_first"),
                 F.col(f"l{i}").cast("string").alias("score_second")) for i in (1, 2)]))
    row = F.struct(*[c for c in X.FIXTURE_FIELDS if c in f.columns], "scores")
    chunks = f.groupBy(F.expr("seq div 50").alias("chunk")).agg(
        F.min("source_file").alias("source_file"),
        F.collect_list(F.struct(F.col("seq").cast("string").alias("id"), row.alias("row"))).alias("rows"))
    rows = F.transform("rows", lambda r: r["row"])
    by_key = F.map_from_entries(F.transform("rows", lambda r: F.struct(r["id"], r["row"])))
    lists = F.create_map(F.lit("a"), rows)
    payload = (F.when(F.col("chunk") % 4 == 0, F.to_json(rows))
               .when(F.col("chunk") % 4 == 1, F.to_json(F.struct(by_key.alias("result"))))
               .when(F.col("chunk") % 4 == 2, F.to_json(F.struct(lists.alias("result"))))
               .otherwise(F.to_json(F.struct(F.lit(1).alias("schema_version"),
                                             F.struct(rows.alias("result")).alias("response")))))
    return chunks.select("source_file", payload.alias("payload"))


@query("a3_explode_fixtures", """
SELECT event_key, event_date, event_type_type, tournament_name, event_status, event_winner, event_final_result,
  first_player_key, second_player_key, event_surface, w1 || '-' || l1 || ' ' || w2 || '-' || l2 AS set_scores FROM fixtures_v""")
def a3(spark, sf):
    f = X.explode_fixtures(fixture_payloads(spark, sf))
    sets = F.array_join(F.transform("scores", lambda s: F.concat_ws("-", s["score_first"], s["score_second"])), " ")
    return f.select("event_key", "event_date", "event_type_type", "tournament_name", "event_status", "event_winner",
                    "event_final_result", "first_player_key", "second_player_key", "event_surface",
                    sets.alias("set_scores"))


@query("a3_document_audit", "SELECT 'read' AS status, count(*) AS fixtures FROM fixtures_v")
def a3_audit(spark, sf):
    """What became of the documents that a3 reads."""
    return X.document_audit(fixture_payloads(spark, sf)).groupBy("status").agg(F.sum("fixtures").alias("fixtures"))


def yearly_picks(spark, sf):
    return views.picks(spark, sf).withColumn("year", F.year("pick_date"))


@query("a4_manifest_scan", """
SELECT pick_id, year(pick_date) AS year, status, odds FROM picks_v""")
def a4(spark, sf):
    path = new_path(spark, "year-partitions")
    rows = yearly_picks(spark, sf)
    manifest = M.write_year_partitions(rows, path, ["pick_date", "pick_id"])
    years = [r["year"] for r in manifest.select("year").collect()]  # one row per year
    return M.manifest_scan(spark, path, years, rows.schema).select("pick_id", "year", "status", "odds")


@query("a5_write_year_partitions", "SELECT year(pick_date) AS year, count(*) AS matches FROM picks_v GROUP BY 1")
def a5(spark, sf):
    return M.write_year_partitions(yearly_picks(spark, sf), new_path(spark, "year-partitions"), ["pick_date", "pick_id"])


@query("a6_write_report", """
SELECT CAST(pick_id AS VARCHAR) AS pick_id, status, '' AS event_status, CAST(pick_date AS VARCHAR) AS pick_date, '' AS note FROM picks_v
UNION ALL SELECT CAST(event_key AS VARCHAR), '', coalesce(event_status, ''), '', '' FROM results_v""")
def a6(spark, sf):
    path, columns = new_path(spark, "report"), ["pick_id", "status", "event_status", "pick_date", "note"]
    results = views.results(spark, sf).withColumnRenamed("event_key", "pick_id")
    M.write_report([views.picks(spark, sf), results], columns, path)
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.schema(schema).option("header", True).csv(path).na.fill("")


DAYS = """(SELECT day, bool_or(landed) AS landed FROM (SELECT CAST(match_date AS VARCHAR) AS day, true AS landed FROM fixtures_v
  UNION ALL SELECT CAST(CAST(match_date + 20 AS DATE) AS VARCHAR), seq % 3 <> 0 FROM fixtures_v) GROUP BY day)"""
FINAL = r"""(NOT regexp_matches(lower(event_status), 'not started|scheduled|pending|postponed|suspended|interrupted|live|in progress|set|rain|delayed|unknown')
  AND (regexp_matches(lower(event_status), 'finish|ended|complete|closed|cancel|retired|walkover|w/o|wo|abandoned|void')
    OR event_winner <> '' OR regexp_matches(event_final_result, '[0-9]')))"""


@query("a7_days_to_refresh", f"""
SELECT day, CASE WHEN NOT landed THEN 'missing_existing_file' WHEN CAST(day AS DATE) >= DATE '2024-02-05' - 2 THEN 'inside_recent_refresh_window'
    WHEN coalesce(final, true) THEN 'existing_day_finalized' ELSE 'existing_day_not_finalized' END AS reason,
  landed AND CAST(day AS DATE) < DATE '2024-02-05' - 2 AND coalesce(final, true) AS skip
FROM {DAYS} LEFT JOIN (SELECT CAST(match_date AS VARCHAR) AS day, bool_and({FINAL}) AS final FROM fixtures_v GROUP BY 1) USING (day)""")
def a7(spark, sf):
    f = views.fixtures(spark, sf).withColumn("day", F.date_format("match_date", "yyyy-MM-dd"))
    later = f.select(F.date_format(F.date_add("match_date", 20), "yyyy-MM-dd").alias("day"), (F.col("seq") % 3 != 0).alias("landed"))
    days = f.select("day", F.lit(True).alias("landed")).unionByName(later).groupBy("day").agg(F.bool_or("landed").alias("landed"))
    return X.days_to_refresh(days, f, "2024-02-05")


@query("a8_ids_to_refresh", """
SELECT DISTINCT player_key FROM (SELECT unnest([first_player_key, second_player_key]) AS player_key FROM fixtures_v
  WHERE lower(event_type_type) NOT LIKE '%double%')
WHERE player_key NOT IN (SELECT player_key FROM cache_v WHERE player_full_name <> '')""")
def a8(spark, sf):
    return X.ids_to_refresh(views.fixtures(spark, sf), views.player_cache(spark, sf))


@query("a9_landing_coverage", """
SELECT source_file, lines > 0 AS downloaded, lines FROM (
  SELECT p || y.year || '.csv' AS source_file, (SELECT count(*) FROM history_v h WHERE h.source_file = p || y.year || '.csv') AS lines
  FROM (VALUES ('atp_matches_'), ('atp_matches_qual_chall_'), ('atp_matches_futures_'), ('wta_matches_'), ('wta_matches_qual_itf_')) s(p),
    (SELECT DISTINCT unnest([year, year - 1]) AS year FROM matches_v) y)""")
def a9(spark, sf):
    years = views.matches(spark, sf).select(F.explode(F.array("year", F.col("year") - 1)).alias("year")).distinct()
    prefixes = F.array(*[F.lit(prefix) for _, _, prefix, _ in H.SOURCES])
    expected = years.select(F.explode(F.transform(prefixes, lambda p: F.concat(p, F.col("year").cast("string"), F.lit(".csv")))).alias("source_file"))
    return M.landing_coverage(views.history_rows(spark, sf), expected)


@query("a9_surface_coverage", """
SELECT count(*) AS rows_total, count(*) FILTER (tournament_sourface <> '') AS rows_with_surface,
  count(*) FILTER (tournament_sourface = '') AS rows_without_surface FROM tournaments_v""")
def a9_surface(spark, sf):
    return M.surface_coverage(views.tournaments(spark, sf))


@query("a10_read_side_tables", """
SELECT api_key AS key, CASE WHEN user_id % 4 = 2 THEN NULL WHEN user_id % 4 = 3 THEN gender || ':history:' || user_id ELSE target_key END AS target_key,
  CASE user_id % 4 WHEN 2 THEN 'unmapped' WHEN 3 THEN 'mapped' WHEN 1 THEN CASE WHEN target_key IS NULL THEN 'unmapped' ELSE 'mapped' END ELSE status END AS status
FROM mapping_v""")
def a10(spark, sf):
    m = views.mapping(spark, sf)
    kind = F.col("user_id") % 4
    value = (F.when(kind == 0, F.to_json(F.struct("status", "target_key")))
             .when(kind == 1, F.to_json(F.struct(F.col("target_key").alias("canonical_key"))))
             .when(kind == 3, F.concat(F.lit('"'), "gender", F.lit(":history:"), F.col("user_id").cast("string"), F.lit('"'))))
    return X.read_mapping(m.select(F.col("api_key").alias("key"), value.alias("value")))


@query("a10_lookup_cache", """
SELECT q.api_key AS key, CASE WHEN q.user_id % 5 = 4 THEN NULL WHEN q.user_id % 5 = 3 THEN q.api_key ELSE CAST(100000 + q.user_id AS VARCHAR) END AS cache_key,
  CASE WHEN q.user_id % 5 = 4 THEN NULL ELSE 'Player ' || q.user_id END AS value,
  CASE q.user_id % 5 WHEN 4 THEN NULL WHEN 3 THEN 0 ELSE 2 END AS match_rank FROM mapping_v q""")
def a10_cache(spark, sf):
    m = views.mapping(spark, sf)
    kind = F.col("user_id") % 5
    bare = (F.col("user_id") + 100000).cast("string")
    # ids in the cache are plain, gendered, or absent
    cache = m.select(F.when(kind == 3, F.col("api_key")).when(kind != 4, bare).alias("cache_key"),
                     F.when(kind == 3, F.col("gender")).alias("cache_gender"), bare.alias("bare_id"),
                     F.concat(F.lit("Player "), "user_id").alias("value")).where(F.col("cache_key").isNotNull()).distinct()
    queries = m.select(F.col("api_key").alias("key"), "gender", V.bare_api_id(F.col("api_key")).alias("bare_id"))
    return X.lookup_cache(queries, cache)


@query("a11_explode_sides", """
SELECT CAST(seq AS VARCHAR) AS match_id, winner_key AS player_key, winner_name AS name, loser_key AS opponent_key, loser_name AS opponent_name, true AS won
FROM matches_v UNION ALL SELECT CAST(seq AS VARCHAR), loser_key, loser_name, winner_key, winner_name, false FROM matches_v""")
def a11(spark, sf):
    return explode_sides(match_documents(spark, sf), ["match_id"])


@query("a12_read_tournament_maps", r"""
SELECT tournament_key, CASE WHEN lower(tournament_sourface) LIKE '%hard%' THEN 'hard' ELSE nullif(lower(tournament_sourface), '') END AS map_surface,
  trim(regexp_replace(translate(lower(tournament_name), '-_', '  '), '\s+', ' ', 'g')) AS map_name,
  tournament_name LIKE '%Qualifying%' AS is_qualification FROM tournaments_v""")
def a12(spark, sf):
    return X.tournament_maps(views.tournaments(spark, sf))


@query("a12_clean_surface_map", """
SELECT DISTINCT lower(tournament_name) AS map_key, surface AS map_value FROM fixtures_v JOIN matches_v USING (seq) WHERE surface <> 'unknown'""")
def a12_map(spark, sf):
    rows = views.fixtures(spark, sf).select(F.col("tournament_name").alias("text"), F.col("true_surface").alias("surface"))
    return X.clean_surface_map(rows)
