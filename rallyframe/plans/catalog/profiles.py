"""Profiles of raw records and source audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.operators import ladders
from rallyframe.operators import profile as J
from rallyframe.plans import views
from rallyframe.plans.catalog.imports import fixtures as imported
from rallyframe.plans.registry import query
from rallyframe.workspace import materialise

GROUPS = """CASE WHEN regexp_matches(path, 'surface|sourface|court|ground') THEN 'surface_like' WHEN regexp_matches(path, 'tournament|league|event_type') THEN 'tournament_like'
  WHEN regexp_matches(path, 'status|live|winner|result') THEN 'status_like' WHEN regexp_matches(path, 'player|first_|second_') THEN 'player_like' ELSE 'other' END"""
PROFILE = f"""
SELECT path, {GROUPS} AS field_group, sum(n)::BIGINT AS presence, sum(n)::BIGINT AS records,
  floor(sum(n) * 100 * 1e2 / (SELECT count(*) FROM {{0}}) + 0.5) / 1e2 AS coverage_pct,
  string_agg(left(value, 200) || '=' || n, ',' ORDER BY n DESC, value) FILTER (rn <= 3) AS top_values
FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY n DESC, value) AS rn FROM (
  SELECT path, CASE WHEN trim(value) = '' THEN '<blank>' ELSE trim(value) END AS value, count(*) AS n FROM ({{1}}) GROUP BY 1, 2)) GROUP BY path"""


@query("j1_json_field_profile", PROFILE.format(
    "events", "SELECT 'k' AS path, json_extract_string(props, '$.k') AS value FROM events"))
def j1(spark, sf):
    return J.json_field_profile(views.table(spark, sf, "events").select(F.col("event_id").alias("record"), F.col("props").alias("raw")))


def records(spark, sf):
    return views.scan_fixtures(spark, sf).select(F.col("seq").alias("record"), "raw")


@query("j1_fixture_field_profile", PROFILE.format("scan_v", """
SELECT 'event_key' AS path, event_key AS value FROM scan_v UNION ALL SELECT 'event_type_type', event_type_type FROM scan_v
UNION ALL SELECT 'tournament_name', tournament_name FROM scan_v UNION ALL SELECT 'event_surface', event_surface FROM scan_v
UNION ALL SELECT 'venue.court.type', 'Clay' FROM scan_v WHERE seq % 9 = 0 UNION ALL SELECT 'notes[]', 'played on grass' FROM scan_v WHERE seq % 9 = 1
UNION ALL SELECT 'meta.a.b.c.d.e.surface', 'Clay' FROM scan_v WHERE seq % 9 = 2 UNION ALL SELECT 'remark', repeat('x', 200) || seq % 2 FROM scan_v WHERE seq % 9 = 3
UNION ALL SELECT 'ground.type', 'clay' FROM scan_v WHERE seq % 9 = 4 UNION ALL SELECT 'court_surface', 'Grass Court' FROM scan_v WHERE seq % 9 = 4"""))
def j1_fixtures(spark, sf):
    return J.json_field_profile(records(spark, sf))


@query("j2_hint_scan", """
SELECT seq AS record, 1 + CAST(seq % 9 IN (0, 1, 2) AS BIGINT) + CASE WHEN seq % 9 = 4 THEN 2 ELSE 0 END AS hint_hits,
  event_surface = '' AND seq % 9 NOT IN (0, 1, 2, 4) AS no_surface,
  lower(tournament_name) LIKE '%wimbledon%' AS mentions_wimbledon, lower(tournament_name) LIKE '%qualification%' AS mentions_qualification FROM scan_v""")
def j2(spark, sf):
    return J.hint_scan(records(spark, sf), ["wimbledon", "qualification"])


@query("j3_pipeline_status", """
SELECT 'source' AS stage, count(*) AS rows FROM matches_v UNION ALL SELECT 'canonical', count(*) FROM valid_v
UNION ALL SELECT 'ratings', count(DISTINCT player_key) FROM sides_v""")
def j3(spark, sf):
    m = views.valid_matches(spark, sf)
    return J.pipeline_status(views.matches(spark, sf), m, ladders.first_names(m))


@query("j4_match_source_audit", """
WITH m AS (SELECT seq, date, gender, level, surface, event_key, winner_name, loser_name, gender || ':api:' || winner_id AS wk, gender || ':api:' || loser_id AS lk,
    CASE WHEN event_key = '' THEN '' ELSE 'api:' || event_key END AS match_id,
    gender || '|' || date || '|' || lower(replace(tournament_name, ' ', '-')) || '|' || lower(tournament_round) || '|' ||
      replace(replace(lower(winner_name), '. ', '-'), ' ', '-') || '|' || replace(replace(lower(loser_name), '. ', '-'), ' ', '-') AS hint_key
  FROM fixture_import_v WHERE skip_reason IS NULL),
d AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY seq) > 1 AND match_id <> '' AS dm, row_number() OVER (PARTITION BY event_key ORDER BY seq) > 1 AND event_key <> '' AS de,
    row_number() OVER (PARTITION BY hint_key ORDER BY seq) > 1 AS dh FROM m)
SELECT seq, x.severity, x.issue FROM d, LATERAL (VALUES ('error', 'missing_match_id', match_id = ''), ('error', 'duplicate_match_id', dm), ('error', 'duplicate_event_key', de),
  ('warning', 'missing_event_key', event_key = ''), ('error', 'same_winner_loser_name', winner_name = loser_name), ('error', 'same_winner_loser_key', wk = lk),
  ('warning', 'duplicate_hint_key', dh)) x(severity, issue, hit) WHERE x.hit""")
def j4(spark, sf):
    kept = imported(spark, sf).where(F.col("skip_reason").isNull()).withColumn(
        "match_id", F.when(F.col("event_key") != "", F.concat(F.lit("api:"), "event_key")).otherwise(""))
    columns = ("seq", "match_id", "event_key", "hint_key", "date", "gender", "level", "surface", "winner_name", "loser_name",
               "winner_key", "loser_key")
    return J.match_source_findings(materialise(kept.select(*columns), "imported"))
