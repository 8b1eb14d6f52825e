"""Session settings the engine is tuned for; callers may bring a session of their own."""

from __future__ import annotations

import os
import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "spindrel", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; ``master`` is for local runs, on a cluster spark-submit gives it."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", os.environ.get("SPINDREL_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, below spark.checkpoint.dir; a local one only where none is named and the master is local. It is deleted when the application ends."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{(named or tempfile.gettempdir()).rstrip('/')}/spindrel-{name}-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(rows: DataFrame, name: str = "table") -> DataFrame:
    """rows, evaluated once and kept as a Parquet table in a work folder: neither a lost executor nor a second reader evaluates them again."""
    path = work_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
