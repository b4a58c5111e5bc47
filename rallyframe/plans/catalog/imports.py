"""Import waterfalls and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.operators import imports as I
from rallyframe.plans import views
from rallyframe.plans.registry import query
from rallyframe.sources.history import with_source
from rallyframe.workspace import materialise


def history(spark, sf):
    raw = views.history_rows(spark, sf)
    return I.import_history(with_source(raw, F.col("source_file")))


@query("c1_import_history", """
SELECT seq, date, gender, level, nsurface AS surface, skip_reason,
  gender || CASE WHEN winner_id = '' THEN ':name:' || replace(lower(winner_name), ' ', '_') ELSE ':history:' || winner_id END AS winner_key,
  gender || ':history:' || loser_id AS loser_key,
  'history:' || gender || ':' || tourney_id || ':' || match_num || ':' || winner_id || ':' || loser_id AS match_id
FROM history_import_v""")
def c1(spark, sf):
    return history(spark, sf).select("seq", "date", "gender", "level", "surface", "skip_reason", "winner_key",
                                     "loser_key", "match_id")


def fixtures(spark, sf):
    cache = views.player_cache(spark, sf)
    return I.import_fixtures(views.fixtures(spark, sf), views.tournaments(spark, sf), cache)


@query("c2_import_results", """
SELECT seq, date, gender, level, surface, surface_source, skip_reason, winner_name, loser_name,
  CASE WHEN skip_reason IS NULL THEN gender || ':api:' || winner_id END AS winner_key FROM fixture_import_v WHERE skip_reason IS NULL
UNION ALL SELECT seq, date, gender, level, surface, surface_source, skip_reason, NULL, NULL, NULL FROM fixture_import_v WHERE skip_reason IS NOT NULL""")
def c2(spark, sf):
    keep = F.col("skip_reason").isNull()
    return fixtures(spark, sf).select(
        "seq", "date", "gender", "level", "surface", "surface_source", "skip_reason",
        *[F.when(keep, F.col(c)).alias(c) for c in ("winner_name", "loser_name", "winner_key")])


@query("c3_skip_summary", """
SELECT CASE WHEN grouping(level) = 0 THEN 'level_surface' WHEN grouping(source_file) = 0 THEN 'file_reason' ELSE 'reason' END AS cut,
  skip_reason, source_file, level, nsurface AS surface, count(*) AS rows
FROM history_import_v WHERE skip_reason IS NOT NULL
GROUP BY GROUPING SETS ((skip_reason), (source_file, skip_reason), (level, nsurface))""")
def c3(spark, sf):
    return I.skip_summary(history(spark, sf).where(F.col("skip_reason").isNotNull()))


@query("c4_source_file_audit", """
SELECT source_file, e.c AS "column", coalesce(nullif(trim(e.v), ''), '<blank>') AS value, count(*) AS rows
FROM history_import_v, LATERAL (VALUES ('gender', gender), ('raw_level', tourney_level), ('round', round), ('raw_surface', surface),
  ('level', level), ('surface', nsurface), ('skip_reason', skip_reason)) e(c, v) GROUP BY ALL""")
def c4(spark, sf):
    return I.source_file_audit(history(spark, sf), ["gender", "raw_level", "round", "raw_surface", "level", "surface", "skip_reason"])


@query("c5_surface_resolution", "SELECT seq, surface, surface_source FROM fixture_import_v")
def c5(spark, sf):
    return I.resolve_surface(views.fixtures(spark, sf), views.tournaments(spark, sf)).select("seq", "surface", "surface_source")


@query("c6_name_enrichment", "SELECT seq, first_name, second_name, first_name_source FROM fixture_steps_v")
def c6(spark, sf):
    cache = views.player_cache(spark, sf)
    return I.enrich_names(views.fixtures(spark, sf), cache).select("seq", "first_name", "second_name", "first_name_source")


@query("c7_dedupe_first", """
SELECT seq, stable_key, row_number() OVER w = 1 AS is_first, first_value(source_file) OVER w AS first_source_file
FROM (SELECT seq, source_file, CASE WHEN event_key <> '' THEN 'api_event:' || event_key ELSE 'fallback:' || date || '|' || tournament_key || '|' ||
    lower(tournament_round) || '|' || replace(lower(winner_name), ' ', '-') || '|' || replace(lower(loser_name), ' ', '-') || '|' ||
    replace(event_final_result, ' - ', '-') END AS stable_key
  FROM (SELECT * REPLACE (replace(winner_name, 'P. ', 'p ') AS winner_name, replace(loser_name, 'P. ', 'p ') AS loser_name)
    FROM fixture_import_v WHERE skip_reason IS NULL))
WINDOW w AS (PARTITION BY stable_key ORDER BY source_file, seq)""")
def c7(spark, sf):
    kept = materialise(  # the import runs once, the rows are read twice
        fixtures(spark, sf).where(F.col("skip_reason").isNull()).select("seq", "source_file", "stable_key"), "imported")
    return I.mark_duplicates(kept, "stable_key", ["source_file", "seq"]).select(
        "seq", "stable_key", "is_first", "first_source_file")


@query("c8_validate_match", """
SELECT seq, CASE WHEN l NOT IN ('grand_slam', 'atp_wta', 'challenger', 'itf', 'qualifying') THEN 'invalid_level'
  WHEN NOT regexp_full_match(d, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'invalid_date' WHEN w = '' THEN 'missing_player_key'
  WHEN w = loser_key THEN 'winner_loser_same_player_key' END AS reason
FROM (SELECT *, CASE WHEN seq % 41 = 0 THEN 'other' ELSE level END AS l, CASE WHEN seq % 43 = 0 THEN 'n/a' ELSE tourney_id END AS d,
  CASE WHEN seq % 47 = 0 THEN '' ELSE winner_key END AS w FROM matches_v)""")
def c8(spark, sf):
    m = views.matches(spark, sf)
    seq = F.col("seq")
    broken = (m.withColumn("level", F.when(seq % 41 == 0, "other").otherwise(F.col("level")))
              .withColumn("date", F.when(seq % 43 == 0, "n/a").otherwise(F.col("tourney_id")))
              .withColumn("winner_key", F.when(seq % 47 == 0, "").otherwise(F.col("winner_key"))))
    return broken.select("seq", I.invalid_reason().alias("reason"))


@query("c9_surface_corrections", """
SELECT f.seq, CASE WHEN f.event_type_type = 'Atp Singles' AND p.p_partkey IS NOT NULL THEN ['hard', 'clay', 'grass', 'carpet'][p.p_size % 4 + 1]
    ELSE f.true_surface END AS surface, f.event_type_type = 'Atp Singles' AND p.p_partkey IS NOT NULL AS surface_corrected
FROM fixtures_v f LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = f.tournament_key AND year(f.match_date) = 2024""")
def c9(spark, sf):
    f = views.fixtures(spark, sf).select("seq", "tournament_key", "event_type_type", F.year("match_date").alias("year"),
                                         F.col("true_surface").alias("surface"))
    surfaces = F.array(*map(F.lit, ("hard", "clay", "grass", "carpet")))
    corrections = views.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("tournament_key"), F.lit("Atp Singles").alias("event_type_type"),
        F.lit(2024).alias("year"), F.element_at(surfaces, F.col("p_size") % 4 + 1).alias("surface"))
    return I.correct_surfaces(f, corrections).select("seq", "surface", "surface_corrected")
