"""Player aliases: validation, closure, application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions.values import key_gender
from rallyframe.workspace import cut_lineage

_MAX_ROUNDS = 64  # chains of up to 2**64 links


def valid_aliases(raw: DataFrame) -> DataFrame:
    """History keys of one gender that name another key; the last line of a key wins upstream."""
    a, c = F.trim("alias_key"), F.trim("canonical_key")
    history = f"^(men|women):{K.HISTORY_FEED}:"
    return raw.select(a.alias("alias_key"), c.alias("canonical_key")).where(
        (a != "") & (c != "") & (a != c) & a.rlike(history) & c.rlike(history) & (key_gender(a) == key_gender(c)))


def _double(links: DataFrame) -> tuple[DataFrame, int, int]:
    """One doubling step: every target moves to its own target.

    Returns the links with ``open`` (the target is itself an alias) and the counts of open
    links and of their distinct targets.
    """
    hop = links.select(F.col("alias_key").alias("target"), F.col("target").alias("beyond"))
    moved = cut_lineage(links.join(hop, "target", "left").select(
        "alias_key", F.coalesce("beyond", "target").alias("target"), F.col("target").alias("passed"),
        F.col("beyond").isNotNull().alias("open")))
    seen = moved.where("open").agg(F.count("*").alias("n"), F.countDistinct("passed").alias("t")).first()
    return moved, seen["n"], seen["t"]


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """End of every alias chain by pointer doubling: log2(longest chain) self joins.

    Chains that never end lead into a cycle. Once a doubling changes neither the number of
    such links nor their distinct targets, those targets are exactly the keys on cycles. A key
    on a cycle stands for itself; a key that leads to one resolves to the key where it enters.
    """
    links = aliases.select("alias_key", F.col("canonical_key").alias("target"))
    before = (-1, -1)
    state = links
    for _ in range(_MAX_ROUNDS):
        state, n_open, n_targets = _double(state.select("alias_key", "target"))
        if n_open == 0:
            return state.select("alias_key", F.col("target").alias("canonical_key"), F.lit(False).alias("is_cycle"))
        if (n_open, n_targets) == before:
            break
        before = (n_open, n_targets)
    else:
        raise ValueError(f"alias chains are still open after {_MAX_ROUNDS} doublings")
    on_cycle = cut_lineage(state.where("open").select(F.col("passed").alias("alias_key")).distinct())
    endless = state.where("open").select("alias_key")
    ended = state.where("NOT open").select("alias_key", F.col("target").alias("canonical_key"), F.lit(False).alias("is_cycle"))
    # cut the cycles open: their keys become ends, and the rest of the endless links end there
    tails = links.join(endless, "alias_key", "left_semi").join(on_cycle, "alias_key", "left_anti")
    cycle = on_cycle.select("alias_key", F.col("alias_key").alias("canonical_key"), F.lit(True).alias("is_cycle"))
    if tails.isEmpty():
        return ended.unionByName(cycle)
    for _ in range(_MAX_ROUNDS):
        tails, n_open, _ = _double(tails.select("alias_key", "target"))
        if n_open == 0:
            break
    else:
        raise ValueError(f"alias chains are still open after {_MAX_ROUNDS} doublings")
    entered = tails.select("alias_key", F.col("target").alias("canonical_key"), F.lit(True).alias("is_cycle"))
    return ended.unionByName(cycle).unionByName(entered)


def resolve_column(df: DataFrame, column: str, closure: DataFrame) -> DataFrame:
    """Replace a key by the end of its alias chain; ``<column>_original`` keeps the old key."""
    ends = closure.select(F.col("alias_key").alias(column), F.col("canonical_key").alias("_end"))
    return df.join(ends, column, "left").select(
        *[F.coalesce("_end", column).alias(column) if c == column else c for c in df.columns],
        F.when(F.col("_end") != F.col(column), F.col(column)).alias(f"{column}_original"))


def apply_aliases(matches: DataFrame, closure: DataFrame) -> DataFrame:
    """Both sides of every match on canonical keys."""
    return resolve_column(resolve_column(matches, "winner_key", closure), "loser_key", closure)


def changed() -> Column:
    return F.col("winner_key_original").isNotNull() | F.col("loser_key_original").isNotNull()


def merge_alias_template(aliases: DataFrame, template: DataFrame) -> DataFrame:
    """Existing aliases win; every key gets its outcome."""
    both = (aliases.withColumnRenamed("canonical_key", "current")
            .join(template.withColumnRenamed("canonical_key", "proposed"), "alias_key", "full_outer"))
    outcome = (F.when(F.col("proposed").isNull(), "kept").when(F.col("current").isNull(), "added")
               .when(F.col("current") == F.col("proposed"), "unchanged").otherwise("conflict"))
    return both.select("alias_key", F.coalesce("current", "proposed").alias("canonical_key"), outcome.alias("outcome"))
