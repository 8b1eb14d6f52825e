"""Similarity join: the k rows of one table of vectors that are nearest, by cosine, to each row of another. Exact; both tables may be large.

Questions and chunks are dealt into parts of a bounded size, by hashes of their rows, and every part of one meets every part of the other in a
task of its own (a cell of the grid, a cogroup). A cell multiplies two matrices and hands on, for each question, its k best; of those a window
takes the k best of all. The plan is the same for any number of questions, none of which reaches the driver; only the two counts do. What moves
is each question once for every part of the chunks, and each chunk once for every part of the questions.

Cases: null and zero vectors and those with null or non-finite components are near to nothing, and a question with one has no row. A row that asks
the same twice (id and vector) asks once. Vectors of another width than the question's aren't compared. Ties go by id, after scores
are rounded to 12 places. Very common vectors cost no task more than others, as parts are dealt by id too.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrel.functions.text import is_direction
from spindrel.session import written

#: Rows of a part, about, and questions that a cell multiplies at once: bounds on a task's memory.
QUESTIONS_A_PART, CHUNKS_A_PART, AT_ONCE = 4096, 16_384, 256
_PARTS = ("__q", "__c")


def unit_rows(vectors) -> np.ndarray:
    """Rows of length 1, in double precision; lengths beyond what squares can hold are scaled first."""
    x = np.stack(vectors).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def directions(vectors: pd.Series) -> np.ndarray:
    """Which vectors have a direction."""
    return np.array([v is not None and len(v) > 0 and bool(np.isfinite(x := np.asarray(v, np.float64)).all() and x.any()) for v in vectors], bool)


def best_of(scores: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(question, chunk) of the k best chunks of each question; scores: questions by chunks, place: the chunks' order among equal scores."""
    k = min(k, scores.shape[1])
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    row, column = np.nonzero(scores >= least[:, None])
    order = np.lexsort((place[column], -scores[row, column], row))
    row, column = row[order], column[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], column[nth < k]


def _numeric(kind: T.DataType) -> str:
    return "array<float>" if kind.simpleString() == "array<float>" else "array<double>"


def grid(n: int, size: int) -> int:
    """How many parts n rows make."""
    return max(1, -(-n // size))


def top_k_batch(chunks: DataFrame, questions: DataFrame, k: int = 1, id_col: str = "id", vector: str = "vector", query_id: str = "query_id", query_vector: str = "query_vector", carry: tuple[str, ...] = ()) -> DataFrame:
    """query_id, id, columns of the chunks to carry, score, rank: the k best chunks of every question. Questions are evaluated once."""
    asked = questions.select(F.col(query_id).alias("__query"), F.col(query_vector).cast(_numeric(questions.schema[query_vector].dataType)).alias("__asked"))
    asked = written(asked, "questions").where(is_direction("__asked")).distinct()  # a filter below the write would evaluate the vectors twice
    own = chunks.select(F.col(id_col).alias("__id"), F.col(vector).cast(_numeric(chunks.schema[vector].dataType)).alias("__vector"), *carry)
    asked_parts, own_parts = grid(asked.count(), QUESTIONS_A_PART), grid(chunks.select(id_col).count(), CHUNKS_A_PART)
    dealt = lambda by, parts: F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = asked.withColumn("__q", dealt(("__query", "__asked"), asked_parts)).withColumn("__c", every(own_parts))
    right = own.withColumn("__c", dealt(("__id", "__vector"), own_parts)).withColumn("__q", every(asked_parts))
    schema = T.StructType([T.StructField(query_id, asked.schema["__query"].dataType), T.StructField(id_col, own.schema["__id"].dataType), *(chunks.schema[c] for c in carry), T.StructField("score", T.DoubleType())])

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found, c = [], c[directions(c["__vector"])]
        for width in set(q["__asked"].map(len)) & set(c["__vector"].map(len)):
            a, b = q[q["__asked"].map(len) == width], c[c["__vector"].map(len) == width]
            asked_rows, vectors = unit_rows(a["__asked"].to_numpy()), unit_rows(b["__vector"].to_numpy())
            place = b["__id"].rank(method="first").to_numpy() if b["__id"].notna().all() else np.arange(len(b))
            for at in range(0, len(a), AT_ONCE):
                scores = np.round(asked_rows[at : at + AT_ONCE] @ vectors.T, 12)
                row, column = best_of(scores, place, k)
                found.append(b[list(carry)].iloc[column].assign(**{query_id: a["__query"].to_numpy()[at : at + AT_ONCE][row], id_col: b["__id"].to_numpy()[column], "score": scores[row, column]}))
        return pd.concat(found, ignore_index=True)[schema.names] if found else pd.DataFrame({n: [] for n in schema.names})

    scored = left.groupBy(*_PARTS).cogroup(right.groupBy(*_PARTS)).applyInPandas(lambda q, c: cell(q, c), schema)
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), id_col)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
