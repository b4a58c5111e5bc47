import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rallyframe.operators import ladders as L
from rallyframe.operators import predictions as P
from rallyframe.plans import views


def plain_fold(rows):
    """Every ladder by a plain loop."""
    state = {}
    for r in sorted(rows, key=lambda r: (r["match_date"], r["seq"])):
        keys = [("overall", "all"), ("level", r["level"])]
        if r["surface"] != "unknown":
            keys += [("surface", r["surface"]), ("level_surface", f"{r['level']}|{r['surface']}")]
        for layer, value in keys:
            a, b = ((r["gender"], layer, value, r[k]) for k in ("winner_key", "loser_key"))
            ra, na = state.get(a, (1500.0, 0))
            rb, nb = state.get(b, (1500.0, 0))
            gain = 32.0 * (1.0 - 1.0 / (1.0 + math.pow(10.0, (rb - ra) / 400.0)))
            state[a], state[b] = (ra + gain, na + 1), (rb - gain, nb + 1)
    return state


def as_dict(df):
    return {(r["gender"], r["layer"], r["value"], r["player_key"]): (r["rating"], r["n"]) for r in df.collect()}


@pytest.fixture(scope="module")
def matches(spark, sf):
    return views.valid_matches(spark, sf).cache()


@pytest.fixture(scope="module")
def truth(matches):
    return plain_fold([r.asDict() for r in matches.collect()])


def test_fold_equals_plain_loop(matches, truth):
    assert as_dict(L.ladder_ratings(L.fold_ladders(matches))) == truth


@pytest.mark.parametrize(("slice_rows", "task_rows"), [(150, 1000), (60, 15), (10_000, 100)])
def test_slices_parts_and_shuffled_input_change_nothing(matches, truth, slice_rows, task_rows):
    shuffled = matches.repartition(7, F.rand(seed=3))
    assert as_dict(L.ladder_ratings(L.fold_ladders(shuffled, slice_rows=slice_rows, task_rows=task_rows))) == truth


def test_parts_share_no_player(matches):
    """And the part of a match does not depend on the order of rows."""
    sliced, count = L.time_slices(matches, L.ORDER, 60, 10)
    sides = sliced.select("slice", "part", F.explode(F.array("winner_key", "loser_key")).alias("player"))
    assert count > 3 and sides.groupBy("slice", "player").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0
    assert sliced.select("slice", "part").distinct().count() > count


def test_a_slice_is_read_by_several_tasks(spark, monkeypatch):
    """One file of one row group was one busy task for each pass over a slice."""
    written = []
    monkeypatch.setattr(L, "materialise", lambda df, name, by=None: written.append(df) or df.localCheckpoint())
    day = F.expr("date_add(date'2024-01-01', cast(id div 50 as int))")
    rows = spark.range(2000).select(F.col("id").alias("seq"), day.alias("match_date"), F.lit("a").alias("winner_key"), F.col("id").cast("string").alias("loser_key"))
    _, count = L.time_slices(rows, L.ORDER, 500, 100)
    found = written[0].select("slice", F.spark_partition_id().alias("range"), "seq").groupBy("slice", "range").agg(
        F.min("seq").alias("low"), F.max("seq").alias("high")).orderBy("low").collect()
    assert len(found) > 2 * count and {r["slice"] for r in found} == set(range(count))
    assert [r["slice"] for r in found] == sorted(r["slice"] for r in found) and all(a["high"] < b["low"] for a, b in zip(found, found[1:]))


def test_runs_hold_what_was_touched(spark):
    """Every run is written once and merged with runs of its rank: no player is rewritten by a slice that leaves them alone."""
    runs = L.PlayerRuns()
    row = lambda player, n: ("men", "overall", "all", player, 1500.0 + n, n)
    for n in range(1, 8):
        runs.add(spark.createDataFrame([row("a", n), row(f"p{n}", 1)], L.STATE_SCHEMA))
    assert [(rank, run.count()) for rank, run in runs.runs] == [(2, 5), (1, 3), (0, 2)]
    state = {r.player_key: r.n for r in L.newest(runs.state(), [*L.LADDER, "player_key"]).collect()}
    assert state == {"a": 7} | {f"p{n}": 1 for n in range(1, 8)}


def test_ratings_are_zero_sum(matches):
    sums = L.ladder_ratings(L.fold_ladders(matches)).groupBy("gender", "layer", "value").agg(
        F.sum("rating").alias("s"), F.count("*").alias("n")).collect()
    assert all(abs(r["s"] - 1500.0 * r["n"]) < 1e-6 for r in sums)


def test_probe_rows_read_without_writing(matches, truth):
    steps = L.fold_ladders(matches)
    tour = {k: v for k, v in as_dict(L.ladder_ratings(steps)).items() if k[1:3] == ("level", "atp_wta")}
    assert tour == {k: v for k, v in truth.items() if k[1:3] == ("level", "atp_wta")}
    assert steps.where("probe").count() == matches.where("level = 'grand_slam'").count()


def test_match_index_is_a_total_order(spark, sf):
    m = views.matches(spark, sf).select("match_date", "seq")
    rows = P.match_index(m.repartition(5)).orderBy("match_index").collect()
    assert [r["match_index"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["seq"] for r in rows] == sorted(r["seq"] for r in rows)


def test_components_of_slices_take_one_round(spark, monkeypatch):
    """No table is written per round: the number of jobs does not grow with the length of a chain."""
    from rallyframe.operators import components as G

    rng = np.random.default_rng(3)
    edges = [(0, i, i + 1) for i in range(300)] + [(1, 1000 + 2 * i, 1001 + 2 * i) for i in range(50)] + [
        (2, int(a), int(b)) for a, b in 2000 + rng.integers(0, 400, (350, 2))] + [(3, 9000 - 2 * i, 8998 - 2 * i) for i in range(100)]
    frame = spark.createDataFrame(edges, "part int, w long, l long")
    slow = {r.node: r.root for r in G.components(frame, "w", "l").collect()}
    monkeypatch.setattr(G, "materialise", None)  # would fail if it were used
    fast = {r.node: r.root for r in G.components_within(frame, "part", "w", "l").collect()}
    assert {n: r for n, r in fast.items() if n != r} == slow and set(fast.values()) >= set(slow.values())


def test_a_slice_is_played_over_arrow_columns(matches):
    """As by the pandas loop the stream uses, from a given state and without one; no task turns keys into Python objects."""
    rows = L.ladder_rows(matches).where("gender = 'men' AND layer = 'overall'").toArrow()
    start = {k: (1500.0 + i, i) for i, k in enumerate(rows.column("winner_key").to_pylist()[:40:3])}
    state = pa.table({"player_key": list(start), "rating": [r for r, _ in start.values()], "n": [n for _, n in start.values()]})
    for given, table in ((start, state), ({}, None)):
        want = L._walk(rows.to_pandas(), L.ORDER, given)
        assert L._walk_slice(rows, L.ORDER, table).to_pylist() == want.to_dict("records")
    plan = L.fold_ladders(matches)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in plan and "FlatMapGroupsInPandas" not in plan
