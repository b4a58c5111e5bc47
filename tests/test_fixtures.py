import json

from pyspark.sql import functions as F

from rallyframe.operators import imports as I
from rallyframe.sources import fixtures as X


def test_every_document_has_a_status(spark):
    deep = lambda n: '{"a": [' * n + "1" + "]}" * n
    rows = [("ok", json.dumps({"result": [{"event_key": "1"}, {"event_key": "2"}]})), ("none", "[1, 2]"), ("blank", "  "), ("null", None),
            ("deep", json.dumps({"result": [{"event_key": "3"}], "x": "[" * 3000})), ("too_deep", '[{"event_key": "4", "x": ' + deep(600) + "}]"), ("broken", '{"result": [')]
    found = {r.source_file: (r.status, r.fixtures) for r in X.document_audit(spark.createDataFrame(rows, "source_file string, payload string")).collect()}
    assert found == {"ok": ("read", 2), "none": ("no_fixtures", 0), "blank": ("blank", 0), "null": ("blank", 0), "deep": ("read", 1), "too_deep": ("too_deep", 0), "broken": ("not_json", 0)}


def test_surface_from_league_and_event_names(spark):
    """The league's key where the tournament has none; names of league, tournament and event in this order."""
    tournaments = spark.createDataFrame([("t1", "Clay"), ("l9", "Grass court"), ("l8", "")], "tournament_key string, tournament_sourface string")
    columns = "id int, event_surface string, tournament_key string, league_key string, league_name string, tournament_name string, event_name string"
    rows = [(1, "Hard", "t1", "l9", "", "", ""), (2, "", "t1", "l9", "", "", ""), (3, "", "", "l9", "", "", ""), (4, "", None, "l8", "Indoor Hard", "Clay Cup", ""),
            (5, "", "", "", "League", "Open", "Carpet Final"), (6, "", "x", "l9", "", "", "")]
    found = {r.id: (r.surface, r.surface_source) for r in I.resolve_surface(spark.createDataFrame(rows, columns), tournaments).collect()}
    assert [found[i][0] for i in range(1, 7)] == ["hard", "clay", "grass", "hard", "carpet", "unknown"]
    assert found[3][1] == "tournament_metadata:Grass court" and found[5][1].startswith("name_guess:league | open | carpet final")
    plain = spark.createDataFrame([(1, "", "none", "Clay Cup")], "id int, event_surface string, tournament_key string, tournament_name string")
    assert I.resolve_surface(plain, tournaments).where(F.col("surface") == "clay").count() == 1
