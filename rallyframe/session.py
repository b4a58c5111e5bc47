"""Local session for tests and the bench; a cluster brings its own."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def _folder() -> str:
    """What ``spark.checkpoint.dir`` names here: RALLYFRAME_SHARED, or a folder that goes when the process ends."""
    named = os.environ.get("RALLYFRAME_SHARED")
    if not named:
        named = tempfile.mkdtemp(prefix="rallyframe-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    return named


def local_session(cpus: str | int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("rallyframe")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", _folder())
        .config("spark.driver.memory", os.environ.get("RALLYFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
