"""Elo ladders: an ordered fold, run in time slices and independent groups of bounded size.

A match belongs to up to four ladders of its gender: overall, its level, its surface and
its level on that surface. Inside a ladder the order of matches decides the result. The matches are
range partitioned on their full order key (which ends in a unique id, so a hot day or a hot
player splits like any other data) into time slices, which are played one after the other. Players
who are not linked by matches of a slice do not touch each other in it, so the connected components
of a slice are played side by side. What a slice changes, the last row of each player in it, is written as a
run; runs of the same rank are merged two by two, so a row is written again a logarithmic
number of times and no slice rewrites the players it has not touched.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions.values import rounded
from rallyframe.operators.components import components_within
from rallyframe.workspace import materialise, new_path

ORDER = ("match_date", "seq")
LADDER = ("gender", "layer", "value")
SLICE_ROWS = 1_000_000   # matches of one time slice
TASK_ROWS = 200_000      # matches of a slice that are played in one task, about, unless they hang together

STEP_SCHEMA = (
    "gender string, layer string, value string, seq bigint, probe boolean, "
    "winner_key string, loser_key string, winner_rating double, loser_rating double, "
    "winner_n bigint, loser_n bigint, winner_after double, loser_after double")
STATE_SCHEMA = "gender string, layer string, value string, player_key string, rating double, n bigint"


def ladder_rows(matches: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One row per match and ladder.

    Grand slam matches also look at the tour ladder. Such a probe row reads the state in
    its place in the order and changes nothing, which makes the as-of lookup part of the fold.
    """
    known = F.col("surface") != "unknown"

    def entry(layer: str, value: Column, probe: bool = False) -> Column:
        return F.struct(F.lit(layer).alias("layer"), value.alias("value"), F.lit(probe).alias("probe"))

    entries = F.array(
        entry("overall", F.lit("all")),
        entry("level", F.col("level")),
        F.when(known, entry("surface", F.col("surface"))),
        F.when(known, entry("level_surface", F.concat_ws("|", "level", "surface"))),
        F.when(F.col("level") == "grand_slam", entry("level", F.lit("atp_wta"), True)),
    )
    return (
        matches.where("winner_key <> loser_key")
        .select(*dict.fromkeys((*order, "seq")), "gender", "winner_key", "loser_key", *[c for c in matches.columns if c == "part"],
                F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e"))
        .select("*", "e.layer", "e.value", "e.probe").drop("e")
    )


def _played(winners: list, losers: list, probes: list, state: dict) -> list[np.ndarray]:
    """Ratings, counts and ratings after, winner before loser, of matches in their order; ``state`` moves on with them."""
    fresh = (K.RATING_INITIAL, 0)
    wrs, lrs, gains = np.empty(len(probes)), np.empty(len(probes)), np.empty(len(probes))
    wns, lns = np.empty(len(probes), np.int64), np.empty(len(probes), np.int64)
    for i, (winner, loser, probe) in enumerate(zip(winners, losers, probes)):
        wr, wn = state.get(winner, fresh)
        lr, ln = state.get(loser, fresh)
        gain = 0.0 if probe else K.RATING_K * (1.0 - 1.0 / (1.0 + math.pow(10.0, (lr - wr) / 400.0)))
        if not probe:
            state[winner] = (wr + gain, wn + 1)
            state[loser] = (lr - gain, ln + 1)
        wrs[i], lrs[i], wns[i], lns[i], gains[i] = wr, lr, wn, ln, gain
    return [wrs, lrs, wns, lns, wrs + gains, lrs - gains]


PLAYED = ("winner_rating", "loser_rating", "winner_n", "loser_n", "winner_after", "loser_after")
KEPT = (*LADDER, "seq", "probe", "winner_key", "loser_key")


def _walk(rows: pd.DataFrame, order: tuple[str, ...], start: dict[str, tuple[float, int]]) -> pd.DataFrame:
    """Play the matches of one ladder in order."""
    rows = rows.sort_values(list(order), kind="stable")
    played = _played(rows["winner_key"].tolist(), rows["loser_key"].tolist(), rows["probe"].tolist(), dict(start))
    return rows[list(KEPT)].assign(**dict(zip(PLAYED, played)))


def _walk_slice(rows: pa.Table, order: tuple[str, ...], start: pa.Table | None = None) -> pa.Table:
    """``_walk`` over Arrow columns: players are numbered, no key becomes a Python object."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in dict.fromkeys(order)]))
    size = rows.num_rows
    keys = [rows.column("winner_key"), rows.column("loser_key"), *([start.column("player_key")] if start is not None else [])]
    codes = pa.chunked_array([chunk for k in keys for chunk in k.chunks], keys[0].type).combine_chunks().dictionary_encode().indices.to_numpy()
    state = {} if start is None else dict(zip(codes[2 * size:].tolist(), zip(start.column("rating").to_pylist(), start.column("n").to_pylist())))
    played = _played(codes[:size].tolist(), codes[size:2 * size].tolist(), rows.column("probe").to_pylist(), state)
    return pa.table([*(rows.column(c) for c in KEPT), *map(pa.array, played)], names=[*KEPT, *PLAYED])


def fold_slice(rows: DataFrame, order: tuple[str, ...], state: DataFrame | None) -> DataFrame:
    """Steps of one time slice, starting from the given state (of several rows of a player the one with most matches counts)."""
    groups = [*LADDER, *[c for c in rows.columns if c == "part"]]
    rows = rows.select(*dict.fromkeys((*groups, *KEPT, *order)))
    if state is None:
        return rows.groupBy(*groups).applyInArrow(lambda table: _walk_slice(table, order), STEP_SCHEMA)

    # only the players of this slice travel with it
    present = rows.select(*groups, F.explode(F.array("winner_key", "loser_key")).alias("player_key")).distinct()
    needed = newest(state.join(present, [*LADDER, "player_key"]), [*groups, "player_key"])
    needed = needed.toDF(*needed.columns)  # columns of its own, for the cogroup
    return rows.groupBy(*groups).cogroup(needed.groupBy(*groups)).applyInArrow(lambda left, right: _walk_slice(left, order, right), STEP_SCHEMA)


def newest(state: DataFrame, keys: list[str]) -> DataFrame:
    """Of several states of a player the one after most matches."""
    return state.groupBy(*keys).agg(F.max(F.struct("n", "rating")).alias("last")).select(*keys, "last.rating", "last.n")


def final_state(steps: DataFrame) -> DataFrame:
    """Rating and count of every player after the last of the given steps."""
    def side(name: str) -> Column:
        return F.struct(F.col(f"{name}_key").alias("player_key"), F.col(f"{name}_after").alias("rating"),
                        (F.col(f"{name}_n") + 1).alias("n"))

    return (
        steps.where(~F.col("probe"))
        .select(*LADDER, F.explode(F.array(side("winner"), side("loser"))).alias("s"))
        .groupBy(*LADDER, F.col("s.player_key").alias("player_key"))
        .agg(F.max(F.struct(F.col("s.n").alias("n"), F.col("s.rating").alias("rating"))).alias("last"))
        .select(*LADDER, "player_key", "last.rating", "last.n")
    )


def advance_state(state: DataFrame | None, steps: DataFrame) -> DataFrame:
    """State after a slice: players it touched replaced, the rest kept."""
    moved = final_state(steps)
    if state is None:
        return moved
    return state.join(moved, [*LADDER, "player_key"], "left_anti").unionByName(moved)


class PlayerRuns:
    """What the slices so far have changed, as written runs of (ladder, player) rows."""

    def __init__(self):
        self.runs: list[tuple[int, DataFrame]] = []   # rank and rows, oldest first

    def add(self, moved: DataFrame) -> None:
        self.runs.append((0, materialise(moved, "ladder-run")))
        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            (rank, new), (_, old) = self.runs.pop(), self.runs.pop()
            self.runs.append((rank + 1, materialise(newest(old.unionByName(new), [*LADDER, "player_key"]), "ladder-run")))

    def state(self) -> DataFrame | None:
        """All runs; of a player who is in several the one after most matches counts."""
        out = None
        for _, run in self.runs:
            out = run if out is None else out.unionByName(run)
        return out


def time_slices(matches: DataFrame, order: tuple[str, ...], slice_rows: int, task_rows: int) -> tuple[DataFrame, int]:
    """Matches with a ``slice`` that grows with the order key and a ``part`` of the slice, and the number of slices.

    Matches of one component of a slice are in the same part. Every slice is bounded, so its components are found in one task, slices side by side.
    """
    rows = matches.count()
    count = max(1, math.ceil(rows / slice_rows))
    parts = math.ceil(min(rows, slice_rows) / task_rows)
    sliced = matches.withColumn("slice", F.lit(0))
    if count > 1:  # a slice is several ranges, and as many files, so that more than one task reads it
        ranges = matches.repartitionByRange(count * max(1, parts), *order)
        sliced = materialise(ranges.withColumn("slice", F.expr(f"spark_partition_id() div {max(1, parts)}").cast("int")), "slices", "slice")
    if parts <= 1:
        return sliced.withColumn("part", F.lit(0)), count
    node = lambda side: F.xxhash64("slice", f"{side}_key")  # noqa: E731  two players of one hash are played together
    roots = components_within(sliced.select("slice", node("winner").alias("w"), node("loser").alias("l")), "slice", "w", "l")
    sliced = sliced.withColumn("node", node("winner")).join(roots, "node", "left")
    part = F.pmod(F.xxhash64(F.coalesce("root", "node")), F.lit(parts)).cast("int")
    return materialise(sliced.withColumn("part", part).drop("node", "root"), "slices", "slice"), count


def fold_ladders(matches: DataFrame, order: tuple[str, ...] = ORDER, slice_rows: int = SLICE_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """State of both sides before and after every match, on every ladder."""
    sliced, count = time_slices(matches, order, slice_rows, task_rows)
    runs, out, spark = PlayerRuns(), new_path(matches.sparkSession, "ladder-steps"), matches.sparkSession
    for number in range(count):
        rows = ladder_rows(sliced.where(F.col("slice") == number), order)
        steps = fold_slice(rows, order, runs.state())
        if number == count - 1:  # nothing waits for the last slice
            break
        steps.write.mode("overwrite").parquet(f"{out}/slice={number}")
        runs.add(final_state(spark.read.schema(STEP_SCHEMA).parquet(f"{out}/slice={number}")))
    if count == 1:
        return steps
    return spark.read.schema(STEP_SCHEMA).parquet(*[f"{out}/slice={n}" for n in range(count - 1)]).unionByName(steps)


# --- products of the fold --------------------------------------------------
def ladder_ratings(steps: DataFrame) -> DataFrame:
    return final_state(steps)


def first_names(matches: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Name of a player's first match."""
    def side(s: str) -> Column:
        return F.struct(F.col(f"{s}_key").alias("player_key"), F.col(f"{s}_name").alias("name"))

    return (
        matches.where("winner_key <> loser_key")
        .select(*order, "gender", F.explode(F.array(side("winner"), side("loser"))).alias("s"))
        .groupBy(F.col("s.player_key").alias("player_key"))
        .agg(F.min(F.struct(*order, F.col("s.name").alias("name"), "gender")).alias("f"))
        .select("player_key", "f.name", "f.gender")
    )


def player_ratings(ratings: DataFrame, names: DataFrame) -> DataFrame:
    """One row per player with its ladder maps, keys in order, ratings to three digits."""
    value = rounded(F.col("rating"), 3)

    def as_map(layer: str, what: Column) -> Column:
        entries = F.collect_list(F.when(F.col("layer") == layer, F.struct("value", what)))
        return F.map_from_entries(F.array_sort(entries))

    columns = [F.max(F.when(F.col("layer") == "overall", value)).alias("overall"),
               F.max(F.when(F.col("layer") == "overall", F.col("n"))).alias("matches")]
    for layer in ("level", "surface", "level_surface"):
        columns += [as_map(layer, value).alias(layer), as_map(layer, F.col("n")).alias(f"{layer}_matches")]
    return ratings.groupBy("player_key").agg(*columns).join(names, "player_key")
