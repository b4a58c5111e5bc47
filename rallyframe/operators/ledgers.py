"""Settlement, upserts, running totals and summaries. Money is fixed point, so sums do not depend on order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe import constants as K
from rallyframe.functions import classify as C
from rallyframe.functions.values import share
from rallyframe.workspace import materialise

MONEY = "decimal(18,6)"


def profit(result: Column, stake: Column, odds: Column) -> Column:
    s, o = stake.cast(MONEY), odds.cast(MONEY)
    return (F.when(result == "win", (s * (o - F.lit(1).cast(MONEY))).cast(MONEY)).when(result == "loss", (-s).cast(MONEY))
            .when(result.isin("void", "push"), F.lit(0).cast(MONEY)))


RESULT_COLUMNS = ("event_status", "event_status_info", "event_status_type", "status", "event_winner", "winner_key", "winner_name",
                  "first_player_key", "second_player_key", "event_first_player", "event_second_player")


def last_results(results: DataFrame, order: list[str]) -> DataFrame:
    """The last row per event, and NULL for what a feed does not carry."""
    whole = results.select("event_key", *order, *[
        (F.col(c) if c in results.columns else F.lit(None)).cast("string").alias(f"r_{c}") for c in RESULT_COLUMNS])
    names = [f"r_{c}" for c in RESULT_COLUMNS]
    return whole.where(F.coalesce(F.col("event_key").cast("string"), F.lit("")) != "").groupBy("event_key").agg(
        F.max(F.struct(*order, *names)).alias("last")).select("event_key", *[f"last.{n}" for n in names], F.lit(True).alias("found"))


def settle_by_event(active: DataFrame, results: DataFrame, order: list[str]) -> DataFrame:
    """Outcome of each active pick from the last result (by ``order``) of its event."""
    joined = active.join(last_results(results, order), "event_key", "left")
    return settle_outcome(joined.withColumn("found", F.coalesce("found", F.lit(False))))


def picked_side(side: Column) -> Column:
    """'home', 'away' or NULL from the spellings of a side."""
    s = F.lower(F.trim(side))
    return F.when(s.isin(*K.PICKED_HOME), "home").when(s.isin(*K.PICKED_AWAY), "away")


def settle_outcome(joined: DataFrame) -> DataFrame:
    """Result, reason and profit of picks joined with their event (columns r_*).

    Unfinished, unknown and winnerless events leave the pick pending with a reason. So does a status
    or a side that nobody recognises. A pick without stake staked 1; without odds the average counts.
    """
    r = {c: F.col(f"r_{c}") for c in RESULT_COLUMNS}
    state = C.settle_status(r["event_status"], r["event_status_info"], r["event_status_type"], r["status"])
    side = C.settle_winner_side(r["event_winner"], r["winner_key"], r["winner_name"], r["first_player_key"], r["second_player_key"],
                                r["event_first_player"], r["event_second_player"])
    own = picked_side(F.col("side"))
    outcome = (F.when(~F.col("found"), "fixture_not_found").when(state == "void", "settled_void")
               .when(state != "finished", state).when(side.isNull(), "finished_without_winner").when(own.isNull(), "unknown_side")
               .when(side == own, "settled_win").otherwise("settled_loss"))
    result = F.when(outcome.startswith("settled_"), F.substring(outcome, 9, 10))
    odds = F.when(F.col("odds") != 0, F.col("odds"))
    if "avg_odds" in joined.columns:
        odds = F.coalesce(odds, F.col("avg_odds"))
    value = profit(F.col("result"), F.coalesce("stake", F.lit(1).cast(MONEY)), odds)
    return joined.withColumn("settle_reason", outcome).withColumn("result", F.coalesce(result, F.lit("pending"))).withColumn("profit", value)


def settle_by_source(matched: DataFrame) -> DataFrame:
    """Result and profit of picks matched with another tracker: its profit, else from own odds."""
    result = F.col("source_result")
    value = F.coalesce(F.col("source_profit").cast(MONEY), profit(result, F.col("stake"), F.col("odds")))
    return matched.withColumn("result", F.coalesce(result, F.lit("pending"))).withColumn(
        "profit", F.when(result.isNotNull(), value)).withColumn(
        "roi", share(F.col("profit"), F.col("stake")))


def upsert(frames: list[DataFrame], key: str, tie: str) -> DataFrame:
    """One row per key: the first frame that has it wins, then the smallest ``tie``."""
    out = None
    for priority, frame in enumerate(frames):
        part = frame.withColumn("_priority", F.lit(priority))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in (key, "_priority", tie)]
    best = F.min_by(F.struct(tie, *rest), F.struct("_priority", tie))
    return out.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("b")).select(key, f"b.{tie}", *[f"b.{c}" for c in rest])


def ledger_upsert(ledger: DataFrame, settled: DataFrame, pending: DataFrame) -> DataFrame:
    """Settled rows overwrite by pick id; pending rows only fill gaps."""
    return upsert([settled, ledger, pending], "pick_id", "pick_date")


def active_upsert(current: DataFrame, new: DataFrame) -> DataFrame:
    """Existing picks stay; new ids are added."""
    return upsert([current, new], "pick_id", "pick_date")


def is_settled() -> Column:
    return F.col("status").isin(*K.SETTLED)


def running_ledger(ledger: DataFrame, order: tuple[str, ...], carry_pending: bool = False) -> DataFrame:
    """Cumulative wins, losses, stake, profit and return in ledger order.

    Range partitions on the full order (ending in the pick id) are summed, the partition sums
    are accumulated in a table of one row per partition, and each partition adds its offset
    to its own running sums. Rows that are pending stay blank, or carry the last totals.
    """
    zero = F.lit(0).cast(MONEY)
    counted = ledger.withColumns({
        "_win": (F.col("status") == "win").cast("bigint"), "_loss": (F.col("status") == "loss").cast("bigint"),
        "_stake": F.when(is_settled(), F.coalesce("stake", zero)).otherwise(zero).cast(MONEY),
        "_profit": F.when(is_settled(), F.coalesce("profit", zero)).otherwise(zero).cast(MONEY)})
    names = ("_win", "_loss", "_stake", "_profit")
    parts = materialise(counted.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ledger", "part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part").agg(*[F.sum(n).alias(n) for n in names])
    offsets = sums.select("part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_0") for n in names])
    upto = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = {n: (F.sum(n).over(upto) + F.col(f"{n}_0")) for n in names}
    shown = F.lit(True) if carry_pending else is_settled()
    out = parts.join(F.broadcast(offsets), "part").select(*ledger.columns, *[c.alias(n) for n, c in run.items()])
    money = lambda n: F.when(shown, F.col(n).cast(MONEY))
    return out.select(
        *ledger.columns, F.when(shown, F.col("_win")).alias("running_wins"), F.when(shown, F.col("_loss")).alias("running_losses"),
        F.when(shown, F.concat_ws("-", F.col("_win").cast("string"), F.col("_loss").cast("string"))).alias("running_w_l"),
        money("_stake").alias("running_total_stake"), money("_profit").alias("running_total_profit"),
        F.when(shown, share(F.col("_profit"), F.col("_stake"))).alias("running_roi"))


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Hit rate leaves voids out; stake and profit count them."""
    sums = ledger.agg(
        F.count("*").alias("total_tracked"), F.count_if(~is_settled()).alias("pending"), F.count_if(is_settled()).alias("settled"),
        F.count_if(F.col("status") == "win").alias("wins"), F.count_if(F.col("status") == "loss").alias("losses"),
        F.sum(F.when(is_settled(), F.col("stake").cast(MONEY))).cast(MONEY).alias("total_stake"),
        F.sum(F.when(is_settled(), F.col("profit").cast(MONEY))).cast(MONEY).alias("total_profit"))
    return sums.select("*", F.concat_ws("-", F.col("wins").cast("string"), F.col("losses").cast("string")).alias("w_l"),
                       share(F.col("wins"), F.col("wins") + F.col("losses")).alias("hit_rate"),
                       share(F.col("total_profit"), F.col("total_stake")).alias("roi"))
