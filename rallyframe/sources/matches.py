"""Normalised matches: JSON lines, year partitions, manifests, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SIDE = "struct<name: string, player_key: string, player_id: string>"
MATCH_SCHEMA = (
    "match_id string, source string, source_file string, date string, year int, gender string, "
    "level string, surface string, tourney_id string, tourney_name string, round string, score string, "
    f"winner {_SIDE}, loser {_SIDE}")


def nested(df: DataFrame) -> DataFrame:
    """Flat side columns to the nested side form."""
    side = lambda s: F.struct(
        F.col(f"{s}_name").alias("name"), F.col(f"{s}_key").alias("player_key"),
        F.col(f"{s}_id").cast("string").alias("player_id")).alias(s)
    drop = [f"{s}_{c}" for s in ("winner", "loser") for c in ("name", "key", "id")]
    return df.select("*", side("winner"), side("loser")).drop(*drop)


def flat(df: DataFrame) -> DataFrame:
    sides = [F.col(f"{s}.{c}").alias(f"{s}_{n}") for s in ("winner", "loser")
             for c, n in (("name", "name"), ("player_key", "key"), ("player_id", "id"))]
    return df.select("*", *sides).drop("winner", "loser")


def read_matches_jsonl(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """JSON lines, plain or gzip. Bad lines stop the read, or are dropped when tolerant.

    A gzip file cannot be split: keep files small, or write the table once as Parquet.
    """
    return (spark.read.schema(MATCH_SCHEMA).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")
            .option("recursiveFileLookup", True).json(path))


def write_year_partitions(df: DataFrame, path: str, order: list[str], rows_per_file: int = 2_000_000) -> DataFrame:
    """Sorted inside each year; returns the manifest (year, matches).

    Range partitioning on (year, order) splits a big year over many files instead of
    sending it to one task; a file cap keeps files readable in parallel.
    """
    (df.repartitionByRange("year", *order).sortWithinPartitions("year", *order)
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("year").parquet(path))
    return manifest(df.sparkSession.read.schema(df.schema).parquet(path))


def manifest(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.count("*").alias("matches"))


def manifest_scan(spark: SparkSession, path: str, years: list[int], schema) -> DataFrame:
    """Exactly the listed year partitions; one that is missing is an error."""
    paths = [f"{path}/year={y}" for y in years]  # a listed path that does not exist fails the read
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def report_frame(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Column union of several frames in a fixed order; extra columns are left out, missing ones blank."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    have = set(union.columns)
    return union.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c)
        for c in columns])


def write_report(frames: list[DataFrame], columns: list[str], path: str, fmt: str = "csv") -> None:
    writer = report_frame(frames, columns).write.mode("overwrite")
    writer.option("header", True).option("emptyValue", "").csv(path) if fmt == "csv" else writer.json(path)


def landing_coverage(rows: DataFrame, expected_files: DataFrame) -> DataFrame:
    """Per expected file: landed or not, and its line count."""
    counts = rows.groupBy("source_file").agg(F.count("*").alias("lines"))
    return expected_files.join(counts, "source_file", "left").select(
        "source_file", F.col("lines").isNotNull().alias("downloaded"),
        F.coalesce("lines", F.lit(0)).alias("lines"))


def surface_coverage(tournaments: DataFrame) -> DataFrame:
    has = F.coalesce(F.trim("tournament_sourface"), F.lit("")) != ""
    return tournaments.agg(F.count("*").alias("rows_total"), F.count_if(has).alias("rows_with_surface"),
                           F.count_if(~has).alias("rows_without_surface"))
