"""From raw documents to packed training sequences: five stages, each a Parquet table for the next.

language_id        documents without an identified language go
simhash_dedup      one document of each near-duplicate group stays
substring_dedup    passages that an earlier document holds are cut out
mix_sources        documents are laid out in the order that mixes their sources to target weights
pack               documents become pieces, packed into sequences in that order
"""

from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.llm import language_id, mixing, packing, simhash_dedup, substring_dedup
from spindrel.llm.common import ensure_checkpoint_dir, small_batches, written

#: A document's language needs this share of its positions.
LEAST_SCORE = 0.3


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those in which no language reaches LEAST_SCORE. Where there is nothing to learn languages from (no
    labelled document with a word outside the held-out fold), it rejects those without letters alone."""
    small_batches(spark)
    net = language_id.fit(docs)
    if net is None:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    start = language_id.predictor(net)

    @F.pandas_udf("struct<lang string, score double>")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = start()
        for texts in batches:
            yield pd.DataFrame(dict(zip(("lang", "score"), judge(texts.tolist()), strict=True)))

    found = docs.withColumn("__found", judged(F.col("text").cast("string")))
    return found.where((F.col("__found.lang") != "und") & (F.col("__found.score") >= LEAST_SCORE)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group; of rows with equal ids one (the least text). Rows without an id stay."""
    groups = simhash_dedup.simhash_groups(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    one = left.where("doc_id is not null").withColumn("__n", first).where("__n = 1").select(*docs.columns)
    return one.unionByName(left.where("doc_id is null"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_passages(docs, written(substring_dedup.passages(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents arrive in the order in which the mixing stage wrote them, whatever the order in which their files are read."""
    return packing.pack(docs, order=packing.file_order(docs))


STAGES = [("language_id", keep_identified), ("simhash_dedup", drop_near_copies), ("substring_dedup", cut_passages), ("mix_sources", mix_sources), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what stands between them is written to the application's folder below spark.checkpoint.dir, which goes when it ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained, chained and packed stages can't be written in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None
