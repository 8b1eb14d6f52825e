"""Keeping a chunk table in step with its documents: plan by content hash, chunk and embed what changed, drop what vanished, publish at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spindrel.functions import chunking, text
from spindrel.functions import fixed_values as V
from spindrel.functions.embedding import HashingEmbedder, embed
from spindrel.session import written
from spindrel.sources.snapshots import SnapshotTable


def stored_hashes(store: DataFrame) -> DataFrame:
    """(doc_id, stored): each stored document's hash. A document whose chunks aren't all there has none, so it counts as changed."""
    rows = store.select("doc_id", "content_hash", "chunk_index", "total_chunks").where("doc_id is not null")
    whole = (F.count(F.lit(1)) == F.max("total_chunks")) | F.max("total_chunks").isNull()
    return rows.groupBy("doc_id").agg(F.when(whole, F.min_by("content_hash", "chunk_index")).alias("stored"))


def plan(existing: DataFrame, incoming: DataFrame, ratio: float = V.RECONCILE_RATIO) -> DataFrame:
    """doc_id, action: new, changed, unchanged, blank (there, nothing to index), stale (gone) or held (gone, but too few documents came).

    existing: doc_id, stored. incoming: doc_id, content; a document that couldn't be read has null content, so it isn't taken for gone.
    """
    seen = incoming.select("doc_id", text.is_blank("content").alias("blank"), text.content_hash("content").alias("hash"))
    both = existing.withColumn("was", F.lit(True)).join(seen.withColumn("came", F.lit(True)), "doc_id", "full_outer")
    counts = existing.agg(F.count(F.lit(1)).alias("n_was")).crossJoin(seen.agg(F.count_distinct("doc_id").alias("n_came")))  # one row
    action = (
        F.when(F.col("came").isNull(), F.when(F.col("n_came") < ratio * F.col("n_was"), "held").otherwise("stale"))
        .when(F.col("blank"), "blank")
        .when(F.col("was").isNull(), "new")
        .when(F.col("stored").eqNullSafe(F.col("hash")) & F.col("stored").isNotNull(), "unchanged")
        .otherwise("changed")
    )
    return both.crossJoin(F.broadcast(counts)).select("doc_id", action.alias("action"))  # counts is one row


def chunk_rows(documents: DataFrame, content: str = "content") -> DataFrame:
    """documents (doc_id, content, url, title) as chunks: id, text, url, title, doc_id, content_hash, chunk_index, total_chunks."""
    own = documents.select("doc_id", F.coalesce("url", F.lit(V.UNKNOWN_URL)).alias("url"), F.coalesce("title", F.lit(V.UNTITLED)).alias("title"), text.content_hash(content).alias("content_hash"), chunking.chunks_of(content).alias("__c"))
    each = own.select("doc_id", "url", "title", "content_hash", F.size("__c").alias("total_chunks"), F.posexplode("__c").alias("chunk_index", "text"))
    return each.select(text.chunk_id("url", "chunk_index").alias("id"), "text", "url", "title", "doc_id", "content_hash", "chunk_index", "total_chunks")


ACTIONS = ("new", "changed", "unchanged", "blank", "stale", "held")


def sync(table: SnapshotTable, incoming: DataFrame, make=HashingEmbedder, ratio: float = V.RECONCILE_RATIO) -> dict:
    """Bring the table in step with incoming (doc_id, content, url, title); counts of what was done.

    Unchanged documents aren't chunked or embedded again. The plan, the changed chunks and the ids that go are written before anything is published, and the counts are
    observed as they are written; chunks are embedded as the new version is. It holds all or nothing of the run.
    """
    table.setup()
    model, store = make(), table.read()
    todo, counts = observed(plan(stored_hashes(store), incoming.select("doc_id", "content"), ratio), "plan", {a: F.count_if(F.col("action") == a) for a in ACTIONS})
    fresh = incoming.join(todo.where("action in ('new', 'changed')").select("doc_id"), "doc_id", "left_semi")
    # chunks are written before they are embedded: workers that split and workers that embed aren't in memory together, and what is refused isn't embedded
    chunks, made = observed(chunk_rows(fresh), "chunks", {"n": F.count(F.lit(1))})
    repeated = chunks.groupBy("id").count().where("count > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"documents share chunk ids (one URL for several documents?): {[r['id'] for r in repeated]}")
    if made["n"] or counts["changed"] or counts["stale"]:
        own = store.select("id", "doc_id")
        of_documents = own.join(todo.where("action in ('changed', 'stale')").select("doc_id"), "doc_id", "left_semi").select("id", "doc_id")
        taken = own.join(chunks.select("id"), "id", "left_semi").select("id", "doc_id")  # chunks of other documents under an id that is new here
        dead, lost = observed(of_documents.unionByName(taken).distinct(), "dead", {"n": F.count(F.lit(1))})
        points = table.apply(chunks.withColumns({"vector": embed(make)("text"), "model": F.lit(model.name)}), dead, made["n"], lost["n"])
    else:
        points = table.points()
    return {**counts, "chunks": made["n"], "points_count": points}


def observed(rows: DataFrame, name: str, what: dict) -> tuple[DataFrame, dict]:
    """rows as a written table, and figures that were taken while it was written."""
    seen = Observation()
    kept = written(rows.observe(seen, *(c.alias(n) for n, c in what.items())), name)
    return kept, seen.get


_OWN_ID = r'"doc_id"\s*:\s*"([^"\\]+)"'


def read_documents(spark, folder: str, lines: bool = False) -> DataFrame:
    """(doc_id, content, url, title) of a folder of JSON documents, a file each, or with ``lines`` any number a file, a line each. What can't be read has null content, and as id the
    file's name; a line the id that it still shows."""
    schema = "doc_id string, content_markdown string, metadata struct<url:string,title:string>, _corrupt_record string"
    rows = spark.read.schema(schema).option("multiLine", not lines).option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(folder)
    shown = [text.first_group("_corrupt_record", _OWN_ID)] if lines else []
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    return rows.select(F.coalesce("doc_id", *shown, name).alias("doc_id"), F.when(F.col("_corrupt_record").isNull(), F.coalesce("content_markdown", F.lit(""))).alias("content"), F.col("metadata.url").alias("url"), F.col("metadata.title").alias("title"))
