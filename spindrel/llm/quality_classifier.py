"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A document is a bag of terms. A term is a word's shape (length, letter case, what it ends with) together with how the word recurs in its
text (new, seen before, or equal to the word before it), or a hash bucket of the word itself. Weights are log counts times inverse document
frequency; a truncated singular value decomposition of the labelled sample gives the latent axes. The labelled vectors (at most
``SAMPLE`` of ``AXES`` floats, so under 1 MB) go to every worker, which takes exact cosines of its documents against all of them, a block
of documents at a time as one matrix product. The ``NEIGHBOURS`` most similar ones vote with the fourth power of their similarity as weight (none if it is negative).

``SAMPLE`` bounds the fit alone: the labelled documents with the smallest id hashes outside the held-out fold. Every text is scored whole.

Cases: an empty or null text has no direction and gets the sample's share of label 1; so do all texts when there is nothing to learn
from (then 0.5). Labels that are null, or of ids without a text row, aren't learned. Contradicting repeated labels each count; of repeated ids' rows no more than ``SAMPLE`` are learned from in all. Rows with a null id count as outside
the held-out fold. Ties among
neighbours go to the earlier sample row. Repeated rows score alike, an empty table gives an empty result; only the text reaches a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm.common import fold, texts_of, with_id_type, words_of

SAMPLE = 4000
AXES = 48
NEIGHBOURS = 25
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
LENGTHS, CASES, ENDS, RECUR, BUCKETS = 8, 4, 6, 3, 256
SHAPES = LENGTHS * CASES * ENDS
TERMS = SHAPES * RECUR + BUCKETS
KNOWN = 200_000
#: Words of a text counted at once and documents compared at once: bounds on memory.
_WORDS, _BLOCK = 100_000, 512
_ENDS = {c: 1 for c in b".,;:"} | {c: 2 for c in b"!?"} | {c: 3 for c in b"#*$%&"} | {c: 4 for c in b"|<>"}


def shape(word: bytes) -> int:
    bare = word.rstrip(b"!?#*$%&|<>.,;:")
    length = min(LENGTHS - 1, len(word) // 2)
    if not bare:
        case = 3
    elif bare.islower():
        case = 0
    elif bare.isupper() and len(bare) > 1:
        case = 2
    else:
        case = 1
    end = 5 if word[-1:].isdigit() else _ENDS.get(word[-1], 0)
    return (length * CASES + case) * ENDS + end


class Terms:
    """Counts of a text's terms. Remembers the words' numbers while it may; a text that is longer than a block is counted block by block."""

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.known, self.shapes, self.buckets = {}, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.shapes), len(self.shapes) + len(new)), strict=True))
            self.shapes = np.concatenate([self.shapes, [shape(w) for w in new]])
            self.buckets = np.concatenate([self.buckets, [zlib.crc32(w.lower()) % BUCKETS for w in new]])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def many(self, texts: list[str | None]) -> np.ndarray:
        """Counts, one row a text."""
        out = np.zeros((len(texts), TERMS), np.float32)
        held, size = [], 0
        for k, text in enumerate(texts):
            words = words_of(text)
            held.append((k, words))
            size += len(words)
            if size >= _WORDS or k == len(texts) - 1:
                self._count(out, held)
                held, size = [], 0
        return out

    def _count(self, out: np.ndarray, held: list) -> None:
        if len(self.known) > KNOWN:
            self._forget()
        ids = self._ids([w for _, words in held for w in words])
        if not len(ids):
            return
        row = np.repeat(np.arange(len(held)), [len(words) for _, words in held])
        same = np.r_[False, (ids[1:] == ids[:-1]) & (row[1:] == row[:-1])]
        key = row * len(self.shapes) + ids
        order = np.argsort(key, kind="stable")
        seen = np.zeros(len(ids), bool)
        seen[order[1:]] = key[order[1:]] == key[order[:-1]]
        recur = np.where(same, 2, np.where(seen, 1, 0))
        cells = np.bincount(row * TERMS + self.shapes[ids] * RECUR + recur, minlength=len(held) * TERMS)
        cells += np.bincount(row * TERMS + SHAPES * RECUR + self.buckets[ids], minlength=len(held) * TERMS)
        out[[k for k, _ in held]] = cells.reshape(len(held), TERMS)


class Space:
    """Latent axes, the labelled vectors and their labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, axes: int = AXES):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
        weighted = self.weigh(counts)
        _, _, right = np.linalg.svd(weighted.T @ weighted)  # its right vectors are those of the weighted table
        self.axes = right[:axes].T.astype(np.float32) if len(counts) else np.zeros((TERMS, axes), np.float32)
        self.vectors, real = _unit(weighted @ self.axes)
        self.vectors, self.labels = self.vectors[real], labels[real].astype(np.float32)

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        w = np.log1p(counts) * self.idf
        w[:, SHAPES * RECUR :] *= 0.3  # what a text is about says less than how it is written
        return w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        k = min(neighbours, len(self.labels))
        for a in range(0, len(counts) if k else 0, _BLOCK):
            own, real = _unit(self.weigh(counts[a : a + _BLOCK]) @ self.axes)
            cosine = own @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 4
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[a : a + _BLOCK] = np.where(real & (total > 0), vote, self.prior)
        return np.clip(out, 0, 1)


def _unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.maximum(norm, 1e-9), norm[:, 0] > 1e-6


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the labelled rows with the smallest id hashes, outside the held-out fold. Only counts reach the driver."""
    chosen = labels.where(F.col(label_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    chosen = chosen.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "__y").limit(most)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(chosen, "__id")
    if rows.select("__id").count() > most:  # repeated ids: of all their rows the first
        rows = rows.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "__y", F.xxhash64("__text")).limit(most)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for batch in batches:
            counts = terms.many(batch["__text"].tolist())
            yield pd.DataFrame({"id": batch["__id"].astype(str), "y": batch["__y"], "places": [np.flatnonzero(c).astype(np.int16).tobytes() for c in counts], "counts": [c[c > 0].astype(np.int32).tobytes() for c in counts]})

    got = sorted(((r["id"], r["y"], bytes(r["places"]), bytes(r["counts"])) for r in rows.select("__id", "__text", "__y").mapInPandas(work, "id string, y int, places binary, counts binary").collect()))
    counts = np.zeros((len(got), TERMS), np.float32)
    for k, (_, _, places, values) in enumerate(got):
        counts[k, np.frombuffer(places, np.int16)] = np.frombuffer(values, np.int32)
    return counts, np.array([y for _, y, _, _ in got], np.float32)


def score(docs: DataFrame, space: Space, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for batch in batches:
            for a in range(0, len(batch), _BLOCK):
                own = batch.iloc[a : a + _BLOCK]
                yield pd.DataFrame({id_col: own.iloc[:, 0], "score": space.score(terms.many(own.iloc[:, 1].tolist()))})

    return with_id_type(texts_of(docs, id_col, text_col).mapInPandas(work, schema), docs, id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = score(docs, Space(*sample(docs, labels)))
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


#: A decomposition and nearest neighbours in it can't be written in SQL; tests hold votes against a plain search and predictions against held-out labels.
ORACLE_SQL = None
