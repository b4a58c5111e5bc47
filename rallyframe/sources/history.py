"""Yearly history files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SIDE = ("id", "name", "ioc", "hand", "ht", "age")
HISTORY_SCHEMA = ", ".join(
    f"{c} string" for c in (
        "tourney_id", "tourney_name", "surface", "tourney_level", "tourney_date", "match_num", "round",
        "best_of", *(f"winner_{c}" for c in _SIDE), *(f"loser_{c}" for c in _SIDE)))

# fixed values: source name, gender, file name before the year, level hint
SOURCES = (
    ("atp_main", "men", "atp_matches_", "atp_wta"),
    ("atp_qual_chall", "men", "atp_matches_qual_chall_", None),
    ("atp_futures", "men", "atp_matches_futures_", "itf"),
    ("wta_main", "women", "wta_matches_", "atp_wta"),
    ("wta_qual_itf", "women", "wta_matches_qual_itf_", None),
)
_FILE = r"([a-z_]+_)(\d{4})\.csv"


def with_source(df: DataFrame, file: Column) -> DataFrame:
    """Source name, gender, level hint and year from the file name; unknown names are left out."""
    stem = F.regexp_extract(file, _FILE, 1)
    known = [(name, stem == prefix, gender, hint) for name, gender, prefix, hint in SOURCES]

    def choose(values) -> Column:
        out = F.lit(None).cast("string")
        for test, value in values:
            out = F.when(test, F.lit(value)).otherwise(out)
        return out

    return (
        df.withColumn("source_name", choose((t, n) for n, t, _, _ in known))
        .withColumn("gender", choose((t, g) for _, t, g, _ in known))
        .withColumn("level_hint", choose((t, h) for _, t, _, h in known if h is not None))
        .withColumn("source_file", F.regexp_extract(file, _FILE, 0))
        .withColumn("file_year", F.regexp_extract(file, _FILE, 2).cast("int"))
        .where(F.col("source_name").isNotNull()))


def read_history_csv(spark: SparkSession, path: str, first_year: int = 0, last_year: int = 9999) -> DataFrame:
    """All history files below a folder; empty and absent files give no rows."""
    raw = (spark.read.schema(HISTORY_SCHEMA).option("header", True).option("recursiveFileLookup", True)
           .csv(path).select("*", F.col("_metadata.file_path").alias("file_path"))
           .na.fill(""))  # a missing field reads as blank
    return (with_source(raw, F.regexp_extract("file_path", r"[a-z_]+_\d{4}\.csv", 0))
            .where(F.col("file_year").between(first_year, last_year)).drop("file_path"))
