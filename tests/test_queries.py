"""Registered queries against their check SQL. RALLYFRAME_ALL=1 runs every one."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, connect

QUICK = ("a2_read_matches_jsonl", "a8_ids_to_refresh", "b3_parse_match_date", "b14_name_features", "c1_import_history", "c4_source_file_audit",
         "d4_map_sides", "d9_key_variant_settle", "e9_duplicate_groups", "e15_apply_review", "f1_model_metrics", "p5_clean_market_odds", "r2_prematch_state",
         "a3_explode_fixtures", "b8_infer_level", "b18_birth_year_country", "c5_surface_resolution", "d5_cross_source_merge", "d12_trace_rows", "e2_source_player_profiles",
         "e11_player_metadata", "e16_verification_queue", "e17_many_issue_audit", "f6_pick_enrichment", "j1_fixture_field_profile", "p3_event_surface", "p7_bet_decision",
         "r1_elo_ladders_sliced", "r5_rating_audit", "s2_settle_by_keys", "t2_stream_settle", "t3_stream_dedupe", "w6_first_last_seen",
         "s1_settle_by_event", "s4_ledger_summary", "w2_h2h", "w3_running_ledger", "j2_hint_scan")
NAMES = sorted(queries()) if os.environ.get("RALLYFRAME_ALL") else QUICK


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, sf, name):
    text, ok = compare(spark, connect(sf), sf, queries()[name], oracle_sql().get(name))
    assert ok, text


def test_every_check_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_gives_ranked_players(spark):
    df = entry(spark)
    assert df.count() > 0 and {"player_key", "overall", "matches"} <= set(df.columns)
