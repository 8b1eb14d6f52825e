"""JSON exports for consumers without Spark, and clearing what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_json(rows: DataFrame, folder: str, files: int | None = None) -> None:
    """Rows as JSON lines; ``files`` sets how many files there are."""
    (rows.coalesce(files) if files else rows).write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def export_roster(roster: DataFrame, counters: DataFrame, unattached: DataFrame, folder: str) -> None:
    """The flat records, the run's counters with its time, and the sections that nobody was found for."""
    export_json(roster.select("key", F.struct(*[c for c in roster.columns if c != "key"]).alias("record")), f"{folder}/data", 1)
    export_json(counters.withColumn("finished_at", F.current_timestamp()), f"{folder}/metadata", 1)
    export_json(unattached, f"{folder}/unattached", 1)


def clear(spark: SparkSession, folder: str, pattern: str = "*.json") -> int:
    """Delete the files of a folder (not of folders in it) that match; how many there were."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return 0
    found = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern)) or []
    gone = [f for f in found if f.isFile() and store.delete(f.getPath(), False)]
    return len(gone)
