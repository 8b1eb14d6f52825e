"""The part of a sync that can stream: documents that arrive or change are chunked, embedded and published batch by batch.

What vanished can't be seen in a stream of arrivals, so deletion stays with the batch ``sync`` over a whole snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.functions.embedding import HashingEmbedder
from spindrel.operators.sync import sync
from spindrel.sources.snapshots import SnapshotTable

DOCUMENTS = "doc_id string, content string, url string, title string"


def sync_batch(table: SnapshotTable, make=HashingEmbedder):
    """For foreachBatch: the last row of each document in the batch is synced; running a batch again changes nothing."""

    def batch(rows: DataFrame, number: int) -> None:
        latest = rows.groupBy("doc_id").agg(F.max_by(F.struct("content", "url", "title"), F.struct(F.col("content").isNotNull(), F.xxhash64("content"))).alias("x")).select("doc_id", "x.*")
        sync(table, latest, make, ratio=float("inf"))  # every stored document outnumbers a batch: nothing counts as vanished

    return batch


def stream_documents(table: SnapshotTable, folder: str, checkpoint: str, make=HashingEmbedder):
    """Sync what is in a folder of JSON lines (DOCUMENTS) and hasn't been taken yet, then stop."""
    source = table.spark.readStream.schema(DOCUMENTS).json(folder)
    return source.writeStream.foreachBatch(sync_batch(table, make)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
