"""Settlement, first-seen fixtures and landing classes as streams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rallyframe.operators.ledgers import last_results, settle_outcome

from .state import DAY_MS, follow, keyed_state, run_to_parquet

EPOCH = date(1970, 1, 1)
RECENT_DAYS = 3
SETTLE_DAYS = 7      # a result counts so many days after its pick
LATE_DAYS = 7        # rows may come so many days behind the newest


# --- settlement ---------------------------------------------------------------
def settle_stream(picks: DataFrame, results: DataFrame, days: int = SETTLE_DAYS, late_days: int = LATE_DAYS) -> DataFrame:
    """Picks left outer joined with the results of their event within ``days`` of their date.

    Both watermarks lag by the whole window and ``late_days``. When they have passed a pick's window, a pick
    without a result comes out once with ``found`` false, and its state goes.
    """
    lag = f"{days + late_days} days"
    p = picks.select("pick_id", F.col("event_key").alias("pick_event"), F.col("pick_date").cast("timestamp").alias("pick_at")).withWatermark("pick_at", lag)
    r = (results.withColumn("result_at", F.col("event_date").cast("timestamp")).withColumn("found", F.lit(True))
         .withWatermark("result_at", lag))
    near = F.expr(f"pick_event = event_key AND result_at >= pick_at AND result_at <= pick_at + INTERVAL {days} DAYS")
    joined = p.join(r, near, "leftOuter")
    return joined.select("pick_id", *[c for c in results.columns if c != "event_key"], F.coalesce("found", F.lit(False)).alias("found"))


def run_late_rows(stream: DataFrame, path: str, day: str, lag_days: int) -> DataFrame:
    """The side table of rows that came more than ``lag_days`` behind the newest day of the batches before.

    Run with the finest batches it holds every row that a join over the same files drops, whatever its own
    batches are. A repeated batch overwrites itself; a batch reads only the newest day of the last one.
    """
    spark = stream.sparkSession

    def keep(df: DataFrame, version: int) -> None:
        df = df.persist()
        mark = spark.read.schema("newest date").parquet(f"{path}/marks/{version - 1}").first()["newest"] if version else None
        behind = F.lit(False) if mark is None else F.col(day) < F.date_sub(F.lit(mark), lag_days)
        df.where(behind).write.mode("overwrite").parquet(f"{path}/late/batch={version}")
        df.agg(F.greatest(F.max(day), F.lit(mark).cast("date")).alias("newest")).write.mode("overwrite").parquet(f"{path}/marks/{version}")
        df.unpersist()

    run = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(f"{path}/late")


@dataclass
class Settlement:
    """Two landing streams, the same rows as tables, and a folder that outlives a restart.

    What the join drops because it came too late is joined again from the side tables, so the outcome does not
    depend on how files are dealt to batches.
    """

    picks: DataFrame
    results: DataFrame
    landed_picks: DataFrame
    landed_results: DataFrame
    path: str
    days: int = SETTLE_DAYS
    late_days: int = LATE_DAYS

    def _near(self, picks: DataFrame, results: DataFrame) -> DataFrame:
        gap = F.date_diff("event_date", "pick_date")
        held = picks.select("pick_id", F.col("event_key").alias("pick_event"), "pick_date")
        joined = held.join(results, F.col("pick_event") == F.col("event_key")).where((gap >= 0) & (gap <= self.days))
        return joined.select("pick_id", *[c for c in results.columns if c != "event_key"])

    def run(self, order: list[str]) -> DataFrame:
        """Outcome of every landed pick, and whether its window has closed without a result."""
        lag = self.days + self.late_days
        with keyed_state(self.picks.sparkSession):
            joined = run_to_parquet(settle_stream(self.picks, self.results, self.days, self.late_days), f"{self.path}/join")
        late_picks = run_late_rows(self.picks, f"{self.path}/picks", "pick_date", lag)
        late_results = run_late_rows(self.results, f"{self.path}/results", "event_date", lag)
        again = self._near(late_picks, self.landed_results).unionByName(self._near(self.landed_picks, late_results))
        seen = joined.where("found").drop("found").unionByName(again)
        closed = joined.where(~F.col("found")).select("pick_id", F.lit(True).alias("closed")).distinct()
        settled = settled_and_open(self.landed_picks, seen, order).join(closed, "pick_id", "left")
        return settled.withColumn("closed", F.coalesce("closed", F.lit(False)) & ~F.col("found"))


def settled_and_open(picks: DataFrame, seen: DataFrame, order: list[str]) -> DataFrame:
    """Outcome of every landed pick: by the last result seen for it, or open as its fixture was not found."""
    by_pick = seen.withColumnRenamed("pick_id", "event_key")
    last = last_results(by_pick, order).withColumnRenamed("event_key", "pick_id")
    return settle_outcome(picks.join(last, "pick_id", "left").withColumn("found", F.coalesce("found", F.lit(False))))


# --- first rows -----------------------------------------------------------------
class FirstRow(StatefulProcessor):
    """Per key the least order seen, for ``days`` after the key was last seen; each improvement is handed on."""

    def __init__(self, order: str, day: str, days: int):
        self.order, self.day, self.days = order, day, days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.least = handle.getValueState("least", "value bigint, until bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, newest = None, EPOCH
        for row in rows:
            first = row if first is None or row[self.order] < first[self.order] else first
            newest = max(newest, row[self.day] or EPOCH)
        until = ((newest - EPOCH).days + self.days + 1) * DAY_MS
        value, held = first[self.order], self.least.get()   # each call is a round trip to the JVM
        if held is not None:
            if until > held[1]:
                self.handle.deleteTimer(held[1])
            until = max(until, held[1])
        if held is None or value < held[0] or until > held[1]:
            self.least.update((value if held is None else min(value, held[0]), until))
        if held is None or until > held[1]:
            self.handle.registerTimer(until)
        if held is None or value < held[0]:
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.least.get()
        if held is not None and held[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.least.clear()
        return iter(())

    def close(self) -> None:
        pass


def run_first_rows(stream: DataFrame, path: str, key: str, order: str, day: str, days: int = RECENT_DAYS) -> DataFrame:
    """First row per key by ``order`` (a whole number), whatever the order in which files and rows come.

    The state store holds the least order of each key and drops it ``days`` after the key was last seen; only
    rows that come before what it holds are appended. A key that comes back after that appends once
    more, so the result is the first of a key's few appended rows.
    """
    spark, rest = stream.sparkSession, [c for c in stream.columns if c not in (key, order)]
    with keyed_state(spark):
        first = follow(stream, day, days).groupBy(key).transformWithState(FirstRow(order, day, days), stream.schema, "append", "eventTime")
        rows = run_to_parquet(first, path)
    return rows.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("f")).select(key, f"f.{order}", *[f"f.{c}" for c in rest])


# --- landing classes -------------------------------------------------------------
def landing_class(delay_days: Column) -> Column:
    return F.when(delay_days <= 0, "on_time").when(delay_days <= RECENT_DAYS, "refreshed").otherwise("late")


def landing_windows(fixtures: DataFrame) -> DataFrame:
    """Counts of on-time, refreshed and late rows by the day they landed and the day they are about.

    Lateness is judged before any watermark, and the watermark follows the landing time, which files
    arrive in, so the late rows are counted and not dropped.
    """
    cls = landing_class(F.date_diff("landed_date", "match_date"))
    return (fixtures.withColumn("landed_at", F.col("landed_date").cast("timestamp")).withWatermark("landed_at", f"{RECENT_DAYS} days")
            .groupBy(F.window("landed_at", "1 day").alias("w"), F.col("match_date").alias("day"), cls.alias("class")).agg(F.count("*").alias("rows"))
            .select(F.to_date("w.start").alias("landed"), "day", "class", "rows"))


def run_updates(stream: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Run an updating aggregate and return the last version of every key."""
    def keep(df: DataFrame, version: int) -> None:
        df.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{path}/out/batch={version}")

    with keyed_state(stream.sparkSession):
        run = stream.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    values = [c for c in stream.columns if c not in keys]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields) + ", version int"
    rows = stream.sparkSession.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/out")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("v")).select(*keys, *[f"v.{c}" for c in values])
