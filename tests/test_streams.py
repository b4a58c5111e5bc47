import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rallyframe.plans import views
from rallyframe.streaming import events as X
from rallyframe.streaming.ratings import LadderStream
from rallyframe.streaming.state import run_to_parquet
from rallyframe.workspace import new_path

from .test_ladders import as_dict, plain_fold

START = datetime.date(2024, 1, 1)


def day(n):
    return START + datetime.timedelta(days=n)


def land(spark, path, schema, parts):
    """One file per part, in this order."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def dealt(rows, parts, landed):
    """Rows in order of landing, cut into parts."""
    rows = sorted(rows, key=landed)
    size = -(-len(rows) // parts)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


# --- settlement -----------------------------------------------------------------
PICKS = "pick_id long, event_key string, side string, stake decimal(18,6), odds decimal(18,6), pick_date date"
RESULTS = "event_key string, row_order int, event_status string, event_winner string, event_date date"


def betting(n=60):
    """(day landed, row): results 0 to 30 days late, on day 7, on day 8, before their pick, twice, never; two picks land late."""
    draw = random.Random(2)
    picks, results, want = [], [], {}
    for i in range(n):
        on = draw.randrange(80)
        picks.append((on if i not in (5, 6) else on + 45, (i, f"e{i}", "home", Decimal(1), Decimal(2), day(on))))
        kind = i % 6
        gap = {0: 0, 1: 7, 2: 8, 3: 2, 4: None, 5: -1}[kind]
        want[i] = "fixture_not_found"
        if gap is None:
            continue
        played = on + gap
        if 0 <= gap <= 7:
            want[i] = "settled_win" if i % 4 else "settled_loss"
        results.append((played + draw.choice([0, 1, 5, 30]), (f"e{i}", 1, "Finished", "1" if i % 4 else "2", day(played))))
        if kind == 3:
            results.append((played + draw.choice([0, 20]), (f"e{i}", 0, "Not started", "", day(played))))
    return picks, results, want


@pytest.mark.parametrize("parts", [1, 6])
def test_settlement_does_not_depend_on_batches(spark, parts):
    picks, results, want = betting()
    paths = [new_path(spark, f"settle-{x}") for x in ("picks", "results")]
    tables = []
    for path, schema, rows in zip(paths, (PICKS, RESULTS), (picks, results)):
        land(spark, path, schema, [[r for _, r in part] for part in dealt(rows, parts, lambda r: r[0])])
        tables.append(spark.read.schema(schema).parquet(path))
    found = X.Settlement(*(stream(spark, p, s) for p, s in zip(paths, (PICKS, RESULTS))), *tables, new_path(spark, "settle-run"), late_days=3).run(["row_order"])
    rows = {r.pick_id: r for r in found.collect()}
    assert {i: r.settle_reason for i, r in rows.items()} == want and len(rows) == len(picks)
    if parts > 1:  # windows long past are closed, the newest are open, and no settled pick is closed
        old = [i for i, (_, r) in enumerate(picks) if r[5] < day(30) and i not in (5, 6)]
        assert all(rows[i].closed for i in old if want[i] == "fixture_not_found")
        assert not any(r.closed for r in rows.values() if r.settle_reason != "fixture_not_found")
        assert not any(rows[i].closed for i, (_, r) in enumerate(picks) if r[5] >= day(70))


# --- first rows, landing classes ----------------------------------------------------
def test_first_rows_whatever_the_arrival(spark):
    """Repeats in one batch, in later ones, and after the key has been dropped."""
    schema, path, out = "k string, seq long, day date, v string", new_path(spark, "first"), new_path(spark, "first-out")
    parts = [[("a", 5, day(1), "late"), ("a", 7, day(1), "x"), ("c", 1, day(1), "early")], [("a", 2, day(2), "first")], [("b", 9, day(3), "only"), ("a", 3, day(3), "x")],
             [("b", 9, day(30), "only")], [("z", 1, day(40), "z")], [("a", 8, day(41), "again"), ("c", 0, day(41), "least")], [("a", 1, day(2), "far behind")]]
    land(spark, path, schema, parts)
    rows = X.run_first_rows(stream(spark, path, schema), out, "k", "seq", "day")
    assert {r.k: (r.seq, r.v) for r in rows.collect()} == {"a": (1, "far behind"), "b": (9, "only"), "c": (0, "least"), "z": (1, "z")}
    appended = {}
    for r in spark.read.parquet(f"{out}/out").collect():
        appended.setdefault(r.k, []).append(r.seq)
    assert sorted(appended["a"]) == [1, 2, 5, 8]  # 3 is held back by state; 8 comes after the state has gone


def test_rows_up_to_thirty_days_late_are_counted(spark):
    schema, path = "match_date date, landed_date date", new_path(spark, "landing")
    draw = random.Random(4)
    rows = [(day(d), day(d + draw.choice([0, 0, 1, 3, 4, 11, 30]))) for d in [draw.randrange(60) for _ in range(300)]]
    land(spark, path, schema, dealt(rows, 9, lambda r: r[1]))
    counts = X.run_updates(X.landing_windows(stream(spark, path, schema)), new_path(spark, "landing-out"), ["landed", "day", "class"])
    want = {}
    for about, landed in rows:
        gap = (landed - about).days
        key = landed, about, "on_time" if gap <= 0 else "refreshed" if gap <= 3 else "late"
        want[key] = want.get(key, 0) + 1
    assert {(r.landed, r.day, r["class"]): r.rows for r in counts.collect()} == want


# --- ratings ---------------------------------------------------------------------
COLUMNS = ["match_date", "seq", "gender", "level", "surface", "winner_key", "loser_key"]


@pytest.fixture(scope="module")
def played(spark, sf):
    frame = views.valid_matches(spark, sf).select(*COLUMNS)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
    return sorted(frame.collect(), key=lambda r: (r.match_date, r.seq)), schema


def thirds(rows):
    """Parts with one match a part too late, shuffled, and one match far too late."""
    third = len(rows) // 3
    late, first = rows[0], rows[1:third]
    moved = [first.pop(), *rows[third:2 * third]]
    random.Random(1).shuffle(moved)
    return [first, moved, [*rows[2 * third:], late]], [r for r in rows if r is not late], late


def test_ladders_wait_for_their_turn_and_set_late_rows_aside(spark, played):
    rows, schema = played
    parts, kept, late = thirds(rows)
    path, run = new_path(spark, "matches"), LadderStream(new_path(spark, "ladders"), delay_days=4)
    for part in parts:  # the stream stops after each part and goes on from its checkpoint
        land(spark, path, schema, [part])
        run.run(stream(spark, path, schema))
    assert as_dict(run.finish(spark)) == plain_fold([r.asDict() for r in kept])
    assert [r.seq for r in run.late(spark).collect()] == [late.seq]
    assert run.waiting(spark).count() > 0
    before = as_dict(run.state(spark))
    run.run(stream(spark, path, schema))  # nothing new
    assert as_dict(run.state(spark)) == before


def test_ladders_go_on_after_a_failure(spark, played):
    """A run that dies in the middle of a batch and is started again ends in the same state."""
    rows, schema = played
    parts, kept, _ = thirds(rows)
    path, run = new_path(spark, "matches"), LadderStream(new_path(spark, "ladders"), delay_days=4)
    land(spark, path, schema, parts)
    poisoned = stream(spark, path, schema)
    bad = parts[1][0].seq
    with pytest.raises(Exception, match="poison"):
        run.run(poisoned.withColumn("seq", F.when(F.col("seq") == bad, F.raise_error(F.lit("poison")).cast("long")).otherwise(F.col("seq"))))
    run.run(stream(spark, path, schema))
    assert as_dict(run.finish(spark)) == plain_fold([r.asDict() for r in kept])


def test_results_are_read_back_with_the_stream_schema(spark):
    path = new_path(spark, "copy")
    land(spark, path, "a long", [[(1,)], [(2,)]])
    assert sorted(r.a for r in run_to_parquet(stream(spark, path, "a long"), new_path(spark, "copy-out")).collect()) == [1, 2]


def test_batches_of_a_landed_table_do_not_grow_with_it(spark, monkeypatch):
    """Each chunk is one batch, however many files it has."""
    from rallyframe.plans.catalog import streams as C

    monkeypatch.setattr(C, "FILE_ROWS", 10)
    rows = spark.range(200, numPartitions=9).select("id", (F.col("id") % 4).alias("part"))
    landed, out = C.land(spark, rows, F.col("part"), 4, "grown"), new_path(spark, "grown-out")

    def keep(df, version):
        df.withColumn("batch", F.lit(version).cast("long")).write.mode("append").parquet(f"{out}/rows")

    landed.writeStream.foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.parquet(f"{out}/rows")
    assert seen.count() == 200
    assert sorted(tuple(r) for r in seen.select("part", "batch").distinct().collect()) == [(0, 0), (1, 1), (2, 2), (3, 3)]
