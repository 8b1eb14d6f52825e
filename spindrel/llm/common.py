"""Helpers that several operators share: durable checkpoints, fold numbers, word splitting."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The application's own folder below the one that the cluster names in spark.checkpoint.dir; only where none is set (tests, one machine) a local one. It is
    deleted when the application ends."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spindrel-checkpoint-"))
    folder = sc._jsc.sc().getCheckpointDir().get()
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder and read it from there: lost executors don't cost a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like durable, as a Parquet table: columns take less disk than rows, and the shuffle files that made it go at once, not when the driver collects garbage."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = f"{ensure_checkpoint_dir(spark)}/table-{uuid4().hex}", spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that written() made and that nothing reads any more."""
    spark = table.sparkSession
    folders = {p.rsplit("/", 1)[0] for p in table.inputFiles()}
    for folder in folders:
        if "/table-" not in folder:
            raise ValueError(f"not a written table: {folder}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str, parts: int):
    """crc32 of the id as text, modulo parts: the fold number that held-out evaluation fixes."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


#: Rows an Arrow batch of texts holds at most: a batch is in memory on both sides, some of them at once, and texts can be long.
TEXTS_A_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold no more than TEXTS_A_BATCH rows; smaller settings stay."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXTS_A_BATCH:
        spark.conf.set(name, str(TEXTS_A_BATCH))


@contextmanager
def narrow_batches(spark: SparkSession) -> Iterator[None]:
    """Within, batches that small_batches() made small may have ten times the rows, as most are narrow, but no more bytes than some texts."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {name: spark.conf.get(name) for name in (rows, size)}
    if before[rows] == str(TEXTS_A_BATCH):
        spark.conf.set(rows, str(10 * TEXTS_A_BATCH))
        spark.conf.set(size, str(8 << 20))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def texts_of(docs: DataFrame, id_col: str, text_col: str, more: dict[str, Column] | None = None) -> DataFrame:
    """id and text as strings, and more columns, in small batches. Pandas would turn whole numbers with a null among them into floats."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("string").alias(id_col), F.col(text_col).cast("string").alias("__text"), *(c.alias(name) for name, c in (more or {}).items()))


def with_id_type(rows: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """The id as docs has it."""
    return rows.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space and 0x09-0x0D, as UTF-8. bytes.split() cuts at exactly these six bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Label 0..n-1 by the smallest index reachable over the links i-j (in memory, for one block)."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        alive = a != b
        if not alive.any():
            break
        i, j, a, b = i[alive], j[alive], a[alive], b[alive]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))  # hook the larger root below the smaller
        while not np.array_equal(label, flat := label[label]):
            label = flat
    return label


def deal(rows: DataFrame, keys: list[str], by: str, most: int, tasks: int | None = None) -> DataFrame:
    """rows dealt out by group, with p, q and side, so that every two rows of a group meet in one task and no task has many.

    A group of up to ``most`` rows is one task: p = q = 0, side -1. A larger one is cut by the hash of column ``by`` into sub-blocks of
    about ``most``; sub-blocks p and q meet in a task of their own, as sides 0 and 1, and each with itself as side -1. With ``tasks`` there are so many, however few bytes the rows have.
    """
    large = durable(rows.groupBy(*keys).count().where(F.col("count") > most))
    if large.isEmpty():
        out = rows.withColumns({"p": F.lit(0), "q": F.lit(0), "side": F.lit(-1).cast("byte")})
    else:
        cut = rows.join(large.withColumn("__m", F.ceil(F.col("count") / most).cast("int")).drop("count"), keys, "left").withColumn("__m", F.coalesce("__m", F.lit(1)))
        cut = cut.withColumn("__s", F.pmod(F.xxhash64(by), F.col("__m")).cast("int"))
        other = F.transform(F.sequence(F.lit(0), F.col("__m") - 1), lambda u: F.struct(F.least("__s", u).alias("p"), F.greatest("__s", u).alias("q"), F.when(u == F.col("__s"), -1).when(u < F.col("__s"), 1).otherwise(0).cast("byte").alias("side")))
        out = cut.withColumn("__o", F.explode(other)).select(*rows.columns, "__o.*")
    return out.repartition(*((tasks,) if tasks else ()), *keys, "p", "q").sortWithinPartitions(*keys, "p", "q", by)


def by_group(batches, keys: list[str], work, least: int = 1):
    """Apply work to the rows of whole groups, from batches sorted by the keys; several small groups may come in one call, of ``least`` rows or more but for the last."""
    held: list[pd.DataFrame] = []
    size = whole = 0  # rows held, and those of them that are whole groups
    for batch in batches:
        if not len(batch):
            continue
        differ = np.zeros(len(batch), bool)
        for k in keys:
            differ |= (batch[k] != batch[k].iloc[-1]).to_numpy()
        begin = len(batch) - int(differ[::-1].argmax()) if differ.any() else 0  # of the last group, which may go on
        if begin or (held and any(held[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys)):
            whole = size + begin
        if whole >= least:
            rows = pd.concat([*held, batch], ignore_index=True)
            yield work(rows.iloc[:whole])
            held, size, whole = [rows.iloc[whole:]], len(rows) - whole, 0
        else:
            held.append(batch)
            size += len(batch)
    if size:
        yield work(pd.concat(held, ignore_index=True))


def group_numbers(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """0, 1, ... for each run of equal keys."""
    differ = np.zeros(len(rows), bool)
    for k in keys:
        v = rows[k].to_numpy()
        differ[1:] |= v[1:] != v[:-1]
    return np.cumsum(differ)
