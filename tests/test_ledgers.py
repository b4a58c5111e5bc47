"""Settlement: one test per rule, each on a table of its own."""

import pytest
from pyspark.sql import functions as F

from rallyframe.operators import ledgers as L
from rallyframe.operators import merging as M

PICK = "pick_id long, event_key string, side string, stake decimal(18,6), odds decimal(18,6), avg_odds decimal(18,6), pick_date date"


def pick(spark, side="home", stake=None, odds="2.5", avg=None, n=1):
    from decimal import Decimal as D

    value = lambda x: None if x is None else D(x)
    return spark.createDataFrame([(n, f"e{n}", side, value(stake), value(odds), value(avg), None)], PICK)


def settle(spark, picks, **fields):
    names = {"event_key": "e1", "row_order": 0} | fields
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in names.items())
    row = L.settle_by_event(picks, spark.createDataFrame([tuple(names.values())], schema), ["row_order"]).first()
    return row["settle_reason"], row["result"], None if row["profit"] is None else float(row["profit"])


@pytest.mark.parametrize("side", ["home", "first", "First Player", "1", " HOME "])
def test_spellings_of_the_home_side(spark, side):
    assert settle(spark, pick(spark, side), event_status="Finished", event_winner="First Player") == ("settled_win", "win", 1.5)
    assert settle(spark, pick(spark, side), event_status="Finished", event_winner="2") == ("settled_loss", "loss", -1.0)


@pytest.mark.parametrize("side", ["away", "second", "Second Player", "2"])
def test_spellings_of_the_away_side(spark, side):
    assert settle(spark, pick(spark, side), event_status="Finished", event_winner="Away")[1] == "win"


def test_an_unknown_side_is_no_loss(spark):
    assert settle(spark, pick(spark, "draw"), event_status="Finished", event_winner="home") == ("unknown_side", "pending", None)


def test_winner_by_id_and_by_name(spark):
    ids = {"event_status": "Finished", "first_player_key": "7", "second_player_key": "8"}
    assert settle(spark, pick(spark), **ids, winner_key="7")[1] == "win"
    assert settle(spark, pick(spark), **ids, winner_key="8")[1] == "loss"
    names = {"event_status": "Finished", "event_first_player": "A. Bee", "event_second_player": "C. Dee"}
    assert settle(spark, pick(spark), **names, winner_name="a. BEE")[1] == "win"
    assert settle(spark, pick(spark), **names, winner_name="Nobody")[0] == "finished_without_winner"


@pytest.mark.parametrize("field", ["event_status", "event_status_info", "event_status_type", "status"])
def test_every_status_field_counts(spark, field):
    assert settle(spark, pick(spark), event_winner="1", **{field: "Match ended"})[1] == "win"
    assert settle(spark, pick(spark), event_winner="1", **{field: "Walkover"}) == ("settled_void", "void", 0.0)
    assert settle(spark, pick(spark), event_winner="1", **{field: "Not started"})[1] == "pending"


def test_missing_stake_and_odds(spark):
    won = {"event_status": "Finished", "event_winner": "1"}
    assert settle(spark, pick(spark, stake="2", odds=None, avg="1.8"), **won)[2] == pytest.approx(1.6)
    assert settle(spark, pick(spark, odds="0", avg="1.8"), **won)[2] == pytest.approx(0.8)
    assert settle(spark, pick(spark, odds=None), **won) == ("settled_win", "win", None)


def test_the_last_row_of_an_event_decides_once(spark):
    rows = spark.createDataFrame([("e1", 0, "Not started", None), ("e1", 2, "Finished", "1"), ("e1", 1, "Finished", "2"), (None, 3, "Finished", "1"), ("", 3, "Finished", "1")],
                                 "event_key string, row_order int, event_status string, event_winner string")
    assert [(r["settle_reason"]) for r in L.settle_by_event(pick(spark), rows, ["row_order"]).collect()] == ["settled_win"]
    assert L.settle_by_event(pick(spark, n=9), rows, ["row_order"]).first()["settle_reason"] == "fixture_not_found"


def test_source_rows_without_a_final_result_are_not_looked_at(spark):
    columns = "pick_id string, event_key string, fixture_id string, date string, player_key string, opponent_key string, side string"
    active = spark.createDataFrame([("p1", "e1", None, "2024-01-01", "a", "b", "home"), ("p2", "e2", None, "2024-01-01", "c", "d", "home")], columns)
    source = spark.createDataFrame([
        ("p1", None, None, None, None, None, None, 1, "WIN", 1.5), ("p1", None, None, None, None, None, None, 2, "pending", None),
        (None, "e2", None, None, None, None, None, 3, " Void ", 0.0), ("p2", None, None, None, None, None, None, 4, "open", None)],
        f"{columns}, row_no int, result string, profit double")
    got = {r["pick_id"]: (r["source_result"], r["source_profit"]) for r in M.settle_by_key_variants(active, source, "row_no", ["result", "profit"]).collect()}
    assert got == {"p1": ("win", 1.5), "p2": ("void", 0.0)}
