"""What the keyed streams share: the state store, rows in arrival, and reading state back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB: on disk, changes alone written per batch."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def run_to_parquet(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process everything available and read the result back."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").option(
        "path", f"{path}/out").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def follow(rows: DataFrame, day: str, delay_days: int) -> DataFrame:
    """The watermark follows ``day`` by ``delay_days``, and rows behind it still come through.

    Spark drops rows behind the watermark where the watermark's column reaches a stateful operator. Only a
    copy of it is handed on, so that an operator sees late rows and decides itself.
    """
    return rows.withColumn("watermark_at", F.col(day).cast("timestamp")).withWatermark("watermark_at", f"{delay_days} days").drop("watermark_at")


def state_rows(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """The rows of one state variable as of the last batch."""
    return spark.read.format("statestore").option("stateVarName", variable).load(f"{path}/checkpoint")
