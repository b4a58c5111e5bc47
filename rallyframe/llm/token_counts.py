"""Token counts from an exact histogram of encoded lengths.

Documents are aggregated to one row per length. Running sums over the lengths then answer, for any
context limit, how many documents fit, how many tokens they hold, how many tokens remain when longer
documents are cut at the limit, and which share of documents is no longer than it.

Cases: a null or empty text has length 0; repeated rows count each time; an empty table gives an
empty histogram, for which every limit answers 0 (and a null share).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRIDE = 1024    # lengths that are summed together first


def histogram(counted: DataFrame, length: str = "n_tokens") -> DataFrame:
    """(length, docs): combines before the shuffle, so a common length is no hot key."""
    return counted.groupBy(F.coalesce(F.col(length), F.lit(0)).cast("long").alias("length")).agg(F.count("*").alias("docs"))


def running_sums(lengths: DataFrame) -> DataFrame:
    """Per observed length used as context limit: documents and tokens up to it and beyond it.

    Sums run inside strides of lengths and over the strides' totals, of which there are few.
    """
    rows = lengths.withColumn("stride", F.floor(F.col("length") / STRIDE))
    own = rows.groupBy("stride").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("length")).alias("t"))
    before = Window.orderBy("stride").rowsBetween(Window.unboundedPreceding, -1)   # one row per stride
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0))
    own = own.select("stride", zero(F.sum("d").over(before)).alias("d0"), zero(F.sum("t").over(before)).alias("t0"),
                     F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens"))
    upto = Window.partitionBy("stride").orderBy("length")
    summed = rows.join(own, "stride").select(
        "length", "docs", (F.col("d0") + F.sum("docs").over(upto)).alias("docs_upto"),
        (F.col("t0") + F.sum(F.col("docs") * F.col("length")).over(upto)).alias("tokens_upto"), "all_docs", "all_tokens")
    return summed.select(
        "length", "docs", "docs_upto", "tokens_upto", (F.col("all_docs") - F.col("docs_upto")).alias("docs_beyond"),
        (F.col("all_tokens") - F.col("tokens_upto")).alias("tokens_beyond"),
        (F.col("tokens_upto") + (F.col("all_docs") - F.col("docs_upto")) * F.col("length")).alias("truncated_total"),
        (F.col("docs_upto") / F.col("all_docs")).alias("share_upto"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, fitting, cut, truncated_total, share) for any limits, observed as lengths or not."""
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in limits], "context_limit long")
    total = sums.agg(F.coalesce(F.max("docs_upto"), F.lit(0)).alias("all_docs"))   # one row
    held = sums.join(F.broadcast(wanted), F.col("length") <= F.col("context_limit")).groupBy("context_limit").agg(
        F.max("docs_upto").alias("fitting"), F.max("tokens_upto").alias("tokens"))
    rows = wanted.join(held, "context_limit", "left").crossJoin(F.broadcast(total)).select(
        "context_limit", F.coalesce("fitting", F.lit(0)).alias("fitting"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "all_docs")
    beyond = F.col("all_docs") - F.col("fitting")
    return rows.select("context_limit", "fitting", beyond.alias("cut"), (F.col("tokens") + beyond * F.col("context_limit")).alias("truncated_total"),
                       F.when(F.col("all_docs") > 0, F.col("fitting") / F.col("all_docs")).alias("share"))


def quantile(sums: DataFrame, share: float) -> int | None:
    """The least length that this share of the documents does not exceed."""
    row = sums.where(F.col("share_upto") >= share).agg(F.min("length").alias("length")).first()
    return row.length
