"""Bounded-space online best-fit packing of token pieces into sequences.

Documents become token ids (byte-level BPE, one end id each). A document that doesn't fit one sequence is cut into whole
sequences of ``limit`` tokens, its first piece taking the rest; every other document stays in one piece. Whole pieces fill a
sequence alone. The others go, in order of arrival (within a look-ahead of
``look_ahead`` pieces the longest first), through best-fit with a fixed number of open sequences: a bitset has
a bit for every free space that some open sequence has, so the tightest fit is one shift and one lowest-set-bit; when all
are open and none fits, the fullest closes.

Only lengths matter for packing, so the texts never move: tokens are counted where a text is read, and thin rows (about 50
bytes a piece) are dealt evenly over packing tasks of ``pieces_per_task``. A task's memory is its open sequences; what a
task wastes is at most those it has open at its end, so the loss is a fixed number of sequences for each million pieces.

Cases: a null or empty text is its end id alone, one token. Repeated rows are packed as often as they occur. An empty table
gives an empty result. Very long texts are cut into as many pieces as they need. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm.common import durable, texts_of, with_id_type

LIMIT = 2048
END_ID = 0
OPEN = 1024
PIECES_PER_TASK = 1_000_000
TOKENIZER = "byte_bpe_50k"
#: Pieces of a task are taken this many at a time, the longest first: small ones are then at hand when gaps are left.
LOOK_AHEAD = 1024
_MEETS = re.compile(r"\s\s")
#: The vocabulary's special token, which its tokenizer finds in texts too, and its id. Fixed value.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The vocabulary's pattern looks ahead only where white space meets white space; the texts without such a place (nearly
    all) are cut by the same pattern without that branch, which the regex engine runs faster, with equal results. The special token is one
    id wherever a text holds it.
    """

    def __init__(self, name: str = TOKENIZER):
        import base64

        import public_tokenizers as public
        import tiktoken

        with open(public.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        model = lambda pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
        self.any, self.plain = model(public.PATTERN), model(public.PATTERN.replace(r"|\s+(?!\S)", ""))

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        model = self.any if _MEETS.search(text) else self.plain
        return array("I", model.encode(text, allowed_special={SPECIAL}) if SPECIAL in text else model.encode_ordinary(text)).tobytes()


def cut(length: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones, after a first one that takes the rest."""
    head = length % limit or min(limit, length)
    return [(0, head), *((start, limit) for start in range(head, length, limit))]


class BestFit:
    """Open sequences by free space. put() gives (number of the sequence, offset)."""

    def __init__(self, limit: int = LIMIT, most_open: int = OPEN):
        self.limit, self.most, self.open, self.made = limit, most_open, 0, 0
        self.bits, self.by_free = 0, [[] for _ in range(limit + 1)]

    def put(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest
            free, number = self.limit, self.made
            self.made += 1
        if free > length:
            left = free - length
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.limit - free

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def file_order(docs: DataFrame) -> list[Column]:
    """The place of a row in a table that Spark wrote in order: the numbers in its file's name, and its row in the file. Scans don't read files in
    that order: they sort splits by length."""
    name = docs.metadataColumn("_metadata").getField("file_name")
    number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("long"), F.lit(0).cast("long"))
    return [number(r"^part-(\d+)"), number(r"[-.]c(\d+)\."), docs.metadataColumn("_metadata").getField("row_index")]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID, order: list[Column] | None = None) -> DataFrame:
    """id, piece, start, length, ids_crc32 of every piece, and its order of arrival: (order_0, order_1, ..., arrival), with order's whole numbers first if given."""
    import pyspark.sql.types as T

    ordered = [f"order_{k}" for k in range(len(order or []))]
    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), *(T.StructField(c, T.LongType()) for c in ordered), T.StructField("arrival", T.LongType())])
    end = array("I", [end_id]).tobytes()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, arrival = Encoder(), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for key, text, *place in zip(*(batch[c] for c in batch), strict=True):
                ids = encode(text) + end
                for n, (start, length) in enumerate(cut(len(ids) // 4, limit)):
                    rows.append((key, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), *place, arrival))
                    arrival += 1
            yield pd.DataFrame(rows, columns=schema.names)

    return with_id_type(texts_of(docs, id_col, text_col, dict(zip(ordered, order or [], strict=True))).mapInPandas(work, schema), docs, id_col)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID, most_open: int = OPEN, look_ahead: int = LOOK_AHEAD, pieces_per_task: int = PIECES_PER_TASK, order: list[Column] | None = None) -> DataFrame:
    """One row a piece: id, piece, start, length, ids_crc32, sequence_id, offset. With order (whole numbers by which documents arrive), every task takes a
    stretch of the arrivals, so sequence ids follow it; without, documents arrive as they are read."""
    thin = durable(pieces(docs, id_col, text_col, limit, end_id, order))
    arrival = [*(f"order_{k}" for k in range(len(order or []))), "arrival"]
    tasks = max(1, -(-thin.count() // pieces_per_task))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, base = BestFit(limit, most_open), TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths = batch["length"].to_numpy()
            placed = [None] * len(lengths)
            for k in range(0, len(lengths), look_ahead):
                for n in k + np.argsort(-lengths[k : k + look_ahead], kind="stable"):
                    placed[n] = bins.put(int(lengths[n]))
            batch["sequence_id"] = [base + s for s, _ in placed]
            batch["offset"] = [o for _, o in placed]
            yield batch.drop(columns=arrival)

    named = thin.withColumn(id_col, F.col(id_col).cast("string"))
    schema = named.drop(*arrival).schema.add("sequence_id", "long").add("offset", "long")
    dealt = named.repartitionByRange(tasks, *arrival) if order else named.repartition(tasks)
    return with_id_type(dealt.sortWithinPartitions(*arrival).mapInPandas(work, schema), docs, id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: Token ids and an online packing can't be written in SQL; tests hold them against the tokenizer and a plain best-fit.
ORACLE_SQL = None
