import datetime

import pytest
from pyspark.sql import functions as F

from rallyframe.operators import aliases as A
from rallyframe.operators import imports as I
from rallyframe.operators import merging as M

K = "men:history:"


def closure(spark, links):
    df = spark.createDataFrame([(K + a, K + b) for a, b in links], "alias_key string, canonical_key string")
    return {r["alias_key"][12:]: (r["canonical_key"][12:], r["is_cycle"]) for r in A.resolve_aliases(A.valid_aliases(df)).collect()}


def walk(links, start):
    table, seen, cur = dict(links), set(), start
    while cur in table:
        if cur in seen:
            return cur
        seen.add(cur)
        cur = table[cur]
    return cur


@pytest.mark.parametrize("links", [
    [("a", "b"), ("b", "c"), ("c", "d")], [("a", "b"), ("b", "a")], [("x", "a"), ("w", "x"), ("a", "b"), ("b", "c"), ("c", "a"), ("z", "w")],
    [(str(i), str(i + 1)) for i in range(23)], [("p", "q"), ("q", "r"), ("r", "q"), ("s", "t")]])
def test_alias_closure_equals_a_walk(spark, links):
    got = closure(spark, links)
    assert {k: v for k, (v, _) in got.items()} == {a: walk(links, a) for a, _ in links}


def test_bad_aliases_are_left_out(spark):
    rows = [(K + "1", K + "1"), (K + "2", "women:history:2"), ("men:name:x", K + "3"), (K + "4", ""), (" " + K + "5 ", K + "6")]
    got = A.valid_aliases(spark.createDataFrame(rows, "alias_key string, canonical_key string")).collect()
    assert [tuple(r) for r in got] == [(K + "5", K + "6")]


DAY = datetime.date(2024, 1, 1)
SCHEMA = "seq bigint, match_date date, gender string, level string, surface string, round string, winner_key string, loser_key string"


def row(seq, level="itf", surface="hard", rnd="R1", w="a", l="b"):
    return (seq, DAY, "men", level, surface, rnd, w, l)


@pytest.mark.parametrize("primary,feed,want", [
    ([row(1)], [row(10)], [("strict", 1, "duplicate")]),
    ([row(1)], [row(10, rnd="R2")], [("date_gender_players", 1, "duplicate")]),
    ([row(1)], [row(10, w="b", l="a")], [("strict", 1, "conflict")]),
    ([row(1), row(2, level="atp_wta", rnd="R2")], [row(10, surface="clay", rnd="R2")], [("round_refined", 2, "duplicate")]),
    ([row(1), row(2, level="atp_wta")], [row(10, level="atp_wta", rnd="R9")], [("level_surface_refined", 2, "duplicate")]),
    ([row(1), row(2, level="atp_wta")], [row(10, surface="clay", rnd="R9")], [("ambiguous", None, "ambiguous")]),
    ([], [row(10), row(11), row(12, rnd="R2"), row(13, w="b", l="a")],
     [(None, None, "added"), ("strict", 10, "duplicate"), ("date_gender_players", 10, "duplicate"), ("strict", 10, "conflict")]),
    ([row(1), row(5)], [row(10)], [("strict", 1, "duplicate")])])
def test_merge_strategies(spark, primary, feed, want):
    f = spark.createDataFrame(feed, SCHEMA).withColumn("coverage", F.lit("both_mapped"))
    got = M.cross_source_merge(spark.createDataFrame(primary, SCHEMA), f).orderBy("seq").collect()
    assert [(r["strategy"], r["met_id"], r["outcome"]) for r in got] == want


def test_first_failing_rule_names_the_skip(spark):
    cols = ("tourney_date tourney_level tourney_name round surface winner_id winner_name loser_id loser_name gender level_hint "
            "source_name tourney_id match_num").split()
    base = dict(tourney_date="20240101", tourney_level="A", tourney_name="Open", round="F", surface="Hard", winner_id="1", winner_name="A B",
                loser_id="2", loser_name="C D", gender="men", level_hint="atp_wta", source_name="atp_main", tourney_id="t", match_num="1")
    cases = [({}, None), ({"tourney_date": "2024", "winner_name": ""}, "missing_or_invalid_date"), ({"winner_name": "", "surface": ""}, "missing_player_name"),
             ({"surface": "Hard (Indoor)"}, "unknown_surface_not_allowed"), ({"surface": "", "tourney_level": "Q"}, None)]
    rows = [tuple({**base, **c}[k] for k in cols) for c, _ in cases]
    got = I.import_history(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))).select("skip_reason").collect()
    assert [r["skip_reason"] for r in got] == [w for _, w in cases]


def test_surface_lookup_prefers_the_longest_key_or_the_first(spark):
    texts = spark.createDataFrame([("atp london queens club",), ("nowhere",)], "text string")
    smap = spark.createDataFrame([("london", "hard", 1), ("london queens", "grass", 2), ("paris", "clay", 0)], "map_key string, map_value string, position int")
    assert [tuple(r) for r in M.surface_text_lookup(texts, smap).collect()] == [("atp london queens club", "london queens", "grass")]
    assert [tuple(r) for r in M.surface_text_lookup(texts, smap, longest=False).collect()] == [("atp london queens club", "london", "hard")]


def test_surface_lookup_equals_contains(spark):
    """Keys shorter than the piece, without a hit, twice in a text, and an empty one."""
    import random

    draw = random.Random(2)
    letters = lambda n: "".join(draw.choice("abc ") for _ in range(n))
    keys = sorted({letters(draw.randrange(1, 9)) for _ in range(40)} - {""}) + ["zzzzzz"]
    texts = [letters(draw.randrange(0, 40)) for _ in range(60)]
    for own in (keys, [k for k in keys if len(k) > 5]):
        smap = spark.createDataFrame([(k, f"s{i}", i) for i, k in enumerate(own)] + [("", "none", 99)], "map_key string, map_value string, position int")
        for longest in (True, False):
            want = {}
            for t in set(texts):
                held = [(-len(k) if longest else i, k, f"s{i}") for i, k in enumerate(own) if k in t]
                if held:
                    want[t] = min(held)[1:]
            found = M.surface_text_lookup(spark.createDataFrame([(t,) for t in texts], "text string"), smap, longest)
            assert {r.text: (r.map_key, r.surface) for r in found.collect()} == want


def test_few_ids_read_few_rows(spark):
    """The same rows as the join, and far fewer of them read by the scan."""
    from rallyframe.workspace import new_path

    sides = spark.range(60_000).select(
        F.concat(F.lit("k"), F.col("id") % 3000).alias("player_key"), F.concat(F.lit("Player No. "), F.col("id") % 2999).alias("name"), F.col("id").alias("seq"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    queries = spark.createDataFrame([(1, "k17", "Player No. 5"), (2, "k2999", ""), (3, "none", "nobody")], "query int, player_key string, name string")
    path = new_path(spark, "index")
    M.index_sides(sides, path, ["seq"])
    found = M.trace_few(spark, path, queries)
    columns = ["query", "player_key", "name", "seq", "payload", "matched_by"]
    want = sorted(tuple(r[c] for c in columns) for r in M.trace_rows(sides, queries).collect())
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == want and len(want) > 50
    many = queries.unionByName(spark.range(10, 80).select(F.col("id").cast("int").alias("query"), F.concat(F.lit("k"), "id").alias("player_key"), F.lit("").alias("name")))
    assert M.trace_few(spark, path, many).count() == M.trace_rows(sides, many).count()  # beyond FEW_IDS

    def scanned(frame):
        frame.collect()
        todo, rows = [frame._jdf.queryExecution().executedPlan()], 0
        while todo:
            node = todo.pop()
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(node.executedPlan())
                continue
            if "QueryStage" in name:
                todo.append(node.plan())
                continue
            if name.startswith("Scan parquet"):
                rows += node.metrics().get("numOutputRows").get().value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return rows

    rows = spark.read.parquet(f"{path}/by_key")
    assert scanned(rows.where("player_key = 'k17'")) < 0.2 * scanned(rows)
