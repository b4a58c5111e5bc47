"""Mixing sources to target weights by nested hash thresholds, in DataFrame functions only.

Each source gets a target in words: a share of all words, dealt by weight; no target exceeds ``MOST``
times its source, and what a full source leaves is dealt again among the others. A document is taken
whole, as often as its source fits into the target, and once more if its place (60 bits of a hash of id
and text) lies below the source's threshold. Thresholds come from histograms: words are summed by
source and leading bits of the place, running sums find the bucket that the target ends in, and only that
bucket is summed again by the next bits, until it holds one place. Nothing is sorted but a
source's buckets, ``BUCKETS`` at most. A larger share has higher thresholds, so its documents include those
of a smaller one.

The last place is taken if that comes nearer, so a source misses its target by half the words at that
place at most: half a document, or half of the rows that agree in both id and text.

Cases: a null source is one of its own, after all others; a null, empty or blank text has no words, is
in the mix for nothing and counts as taken 0 times its size; a source without words has target 0; rows
repeated with their id and text are taken together; texts are counted whole, whatever their length; an
empty table gives an empty one. Extra columns pass through, and new columns replace none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.workspace import materialise

from .common import fresh

WEIGHTS = (5.0, 2.0, 1.0)   # of the sources by code point, repeating
MOST = 3                    # times a document is taken, at most
STEP, BITS = 10, 60         # bits of a place that one histogram resolves, and of a whole place
BUCKETS = 1 << STEP
NO_SOURCE = "n"             # key of the null source; the others begin with s


def words(text: Column) -> Column:
    """Number of words: runs without ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """Where a document lies between 0 and 2**60, the same in every run."""
    return F.conv(F.substring(F.md5(F.concat_ws(" ", doc_id.cast("string"), text)), 1, BITS // 4), 16, 10).cast("long")


def measure(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> tuple[DataFrame, list[str]]:
    """The documents with their source's key, size and place, and the names of these columns."""
    names = []
    for name in ("source_key", "size", "place"):
        names.append(fresh([*docs.columns, *names], name))
    key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(NO_SOURCE))
    made = (key, words(F.col(text).cast("string")), place(F.col(doc_id), F.col(text).cast("string")))
    return docs.select("*", *(c.alias(n) for c, n in zip(made, names))), names


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """Sums of each row and all before it in ``order``: range partitions, and one row of sums per partition."""
    parts = materialise(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)
    totals = parts.groupBy("part").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_0") for n in sums))
    upto = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return parts.join(offsets, "part").select(*rows.columns, *((F.sum(c).over(upto) + F.col(f"{n}_0")).alias(n) for n, c in sums.items()))


def cyclic_weights(sources: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """(key, words, weight): weights repeat over the sources by code point, null last."""
    order = [(F.col("key") == NO_SOURCE).asc(), F.col("key").asc()]
    placed = running(sources, order, {"rank": F.lit(1).cast("long")}, "mix-ranks")
    dealt = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    return placed.select("key", "words", dealt.alias("weight"))


def targets(weighted: DataFrame, shares: Sequence[float], most: int = MOST) -> DataFrame:
    """(key, words, share_no, target): each share of all words dealt by weight, ``most`` times a source's words at most.

    In order of words per weight, sources fill one after another as the common level rises. A source is
    full if the level of the whole share lies above its own.
    """
    w = weighted.where("weight > 0").withColumn("most", (F.col("words") * most).cast("decimal(38,0)"))
    filled = running(w, [(F.col("words") / F.col("weight")).asc(), F.col("key").asc()], {"most_upto": F.col("most"), "weight_upto": F.col("weight")}, "mix-levels")
    one = weighted.agg(F.sum("words").cast("double").alias("total"), F.sum(F.when(F.col("weight") > 0, F.col("weight"))).alias("all_weight"))
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("share_no"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares))))
    dealt = one.select("*", each.alias("s")).select("total", "all_weight", "s.*").withColumn("budget", F.col("share") * F.col("total"))
    level = F.col("most").cast("double") / F.col("weight")
    full = F.col("most_upto").cast("double") + level * (F.col("all_weight") - F.col("weight_upto")) <= F.col("budget")
    met = filled.join(F.broadcast(dealt))  # one row for each share
    sums = met.groupBy("share_no").agg(F.any_value("budget").alias("budget"), F.any_value("all_weight").alias("all_weight"),
                                       F.coalesce(F.sum(F.when(full, F.col("most"))).cast("double"), F.lit(0.0)).alias("spent"),
                                       F.coalesce(F.sum(F.when(full, F.col("weight"))), F.lit(0.0)).alias("gone"))
    rest = sums.select("share_no", F.when(F.col("all_weight") > F.col("gone"), (F.col("budget") - F.col("spent")) / (F.col("all_weight") - F.col("gone"))).alias("rise"))
    cap = (F.col("words") * most).cast("double")
    got = F.when(F.coalesce(F.col("weight"), F.lit(0.0)) <= 0, 0.0).otherwise(F.least(cap, F.coalesce(F.greatest(F.col("rise"), F.lit(0.0)) * F.col("weight"), cap)))
    return weighted.join(F.broadcast(rest)).select("key", "words", "share_no", got.alias("target"))


def plan(rows: DataFrame, shares: Sequence[float] = (1.0,), weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, words, goals) per source of ``rows`` (key, size, place); goals: target, whole rounds and threshold of each share."""
    sources = materialise(rows.groupBy("key").agg(F.sum("size").alias("words")), "mix-sources")
    dealt = targets(cyclic_weights(sources, weights), shares, most)
    whole = F.when(F.col("words") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("words")))).otherwise(0).cast("int")
    dealt = materialise(dealt.withColumn("whole", whole), "mix-targets")
    left = F.col("target") - F.col("whole") * F.col("words")
    waiting = materialise(dealt.where((F.col("whole") < most) & (left > 0)).select("key", "share_no", left.alias("left"), F.lit(0).cast("long").alias("prefix")), "mix-open")
    found, shift = None, BITS
    while waiting.head(1):
        shift -= STEP
        if found is not None:  # after the first histogram only the boundary buckets are read again
            rows = rows.join(waiting.select("key", "prefix").distinct(), (rows["key"] == waiting["key"]) & (F.shiftright("place", shift + STEP) == waiting["prefix"]), "left_semi")
            rows = materialise(rows, "mix-boundary")
        sums = rows.groupBy("key", F.shiftright("place", shift).alias("bucket")).agg(F.sum("size").alias("here"), F.min("place").alias("low"), F.max("place").alias("high"))
        sums = sums.withColumn("prefix", F.shiftright("bucket", STEP))
        upto = Window.partitionBy("key", "prefix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        buckets = sums.withColumn("upto", F.sum("here").over(upto))
        ends = buckets.join(waiting, ["key", "prefix"]).where((F.col("upto") - F.col("here") < F.col("left")) & (F.col("left") <= F.col("upto")))
        ends = materialise(ends.select("key", "share_no", "bucket", "low", "high", "here", (F.col("left") - (F.col("upto") - F.col("here"))).alias("left")), "mix-ends")
        until = F.when(2 * F.col("left") > F.col("here"), F.col("high") + 1).otherwise(F.col("low"))
        ready = ends.where("low = high").select("key", "share_no", until.alias("until"))
        found = ready if found is None else found.unionByName(ready)
        waiting = materialise(ends.where("low < high").select("key", "share_no", "left", F.col("bucket").alias("prefix")), "mix-open")
    goals = dealt.withColumn("until", F.lit(0).cast("long")) if found is None else dealt.join(found, ["key", "share_no"], "left").withColumn("until", F.coalesce("until", F.lit(0)))
    goal = F.struct("share_no", "target", "whole", "until")
    return materialise(goals.groupBy("key").agg(F.any_value("words").alias("words"), F.array_sort(F.collect_list(goal)).alias("goals")), "mix-plan")


def copies(goal: Column, where: Column) -> Column:
    return goal["whole"] + (where < goal["until"]).cast("int")


def mixed(docs: DataFrame, share: float = 1.0, text: str = "text", source: str = "source", doc_id: str = "doc_id",
          weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    rows, (key, size, where) = measure(docs, text, source, doc_id)
    narrow = materialise(rows.select(F.col(key).alias("key"), F.col(size).alias("size"), F.col(where).alias("place")), "mix-rows")
    planned = plan(narrow, (share,), weights, most).select(F.col("key").alias(key), F.col("goals").alias(fresh(rows.columns, "goals")))
    goals = planned.columns[1]
    times = F.sequence(F.lit(1), copies(F.col(goals)[0], F.col(where)))
    taken = rows.join(planned, key).where((copies(F.col(goals)[0], F.col(where)) > 0) & (F.col(size) > 0))
    return taken.withColumn(fresh(taken.columns, "time"), F.explode(times)).select(*docs.columns)
