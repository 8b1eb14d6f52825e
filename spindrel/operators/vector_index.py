"""A stored index of vectors: nearest points from a fraction of the files.

Every vector lives in the cell of the nearest of some centroids (learned from a bounded sample), with what is left of it as a code of a byte a
component. A question visits the nearest cells, as many as reached the target recall when the index was fitted; only their files are opened. Codes give
approximate scores, a shortlist of each question is scored again with the vectors themselves. A cell is a bucket of a snapshot table, so an update
writes only the cells that it changes, and readers see one version or the next.

Questions and codes meet in cogroups, by cell; a cell of over ``CHUNKS_A_PART`` vectors (copies of one, say) is dealt over several tasks by id. The
driver holds the sample for a fit, at most ``MOST_FIT`` vectors, and the numbers of the cells.

Cases: vectors without a direction (null, zero, null or non-finite components) and those of another width than the index's aren't indexed, and
questions with such have no row. Repeated ids each have a place. Fewer vectors than cells, one or none: fewer cells, one, an empty answer. Ties go by id.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrel.functions import text
from spindrel.operators.similarity import CHUNKS_A_PART, best_of, unit_rows
from spindrel.session import written
from spindrel.sources.snapshots import SnapshotTable

MOST_CELLS, FIT_A_CELL, MOST_FIT, ROUNDS = 4096, 16, 65_536, 8
#: Neighbours found among the fit's own, of those that all cells would give; shortlist of a question, for each row asked for.
TARGET, ASKED, NEAR, SHORTLIST = 0.99, 256, 10, 10
#: The index is fitted anew when it holds so many times the vectors it was fitted for.
OUTGROWN = 4
_ROWS = 4096
CELLS = T.StructType([T.StructField("id", T.StringType()), T.StructField("content_hash", T.StringType()), T.StructField("cell", T.IntegerType()), T.StructField("scale", T.FloatType()), T.StructField("code", T.BinaryType()), T.StructField("vector", T.ArrayType(T.FloatType()))])


class Cells(SnapshotTable):
    """A snapshot table whose buckets are the index's cells."""

    def bucket(self) -> Column:
        return F.col("cell")


class Coarse:
    """Centroids of unit vectors and how many cells a question visits."""

    def __init__(self, centroids: np.ndarray, visits: int, rows: int):
        self.centroids, self.visits, self.rows = centroids.astype(np.float32), visits, rows

    @classmethod
    def fit(cls, vectors: np.ndarray, rows: int, seed: int = 7) -> Coarse:
        """Spherical k-means; visits are the cells that hold TARGET of the nearest neighbours within the sample."""
        rng = np.random.default_rng(seed)
        x = vectors.astype(np.float32)
        cells = int(np.clip(round(rows**0.5), 1, min(MOST_CELLS, max(1, len(x) // FIT_A_CELL))))
        c = x[rng.choice(len(x), cells, replace=False)]
        for _ in range(ROUNDS):
            own = cls(c, 1, rows).nearest(x, 1)[:, 0]
            total = np.zeros_like(c)
            np.add.at(total, own, x)
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(norm > 1e-6, total / np.maximum(norm, 1e-6), x[rng.choice(len(x), cells)])
        found = cls(c, 1, rows)
        home = found.nearest(x, 1)[:, 0]
        asked = rng.choice(len(x), min(ASKED, len(x)), replace=False)
        near = np.argsort(-(x[asked] @ x.T), axis=1)[:, : min(NEAR, len(x))]  # itself among them, as it is among a question's neighbours
        order = np.argsort(found.nearest(x[asked], cells), axis=1)  # order[i, cell]: which of i's visits reaches it
        found.visits = int(np.quantile(np.take_along_axis(order, home[near], axis=1), TARGET, method="higher")) + 1
        return found

    def nearest(self, x: np.ndarray, count: int) -> np.ndarray:
        """Numbers of the nearest cells of unit vectors, nearest first."""
        out = np.empty((len(x), min(count, len(self.centroids))), np.int32)
        for a in range(0, len(x), _ROWS):
            out[a : a + _ROWS] = np.argsort(-(x[a : a + _ROWS].astype(np.float32) @ self.centroids.T), axis=1, kind="stable")[:, : out.shape[1]]
        return out


class VectorIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.cells = Cells(spark, f"{self.root}/cells", CELLS, key="id", buckets=MOST_CELLS)

    # --- the centroids ---

    def coarse(self) -> Coarse | None:
        """The centroids that the version in force was laid out with."""
        version = self.cells.version()
        if version is None:
            return None
        row = self.spark.read.parquet(f"{self.root}/coarse").where(F.col("since") <= version).orderBy(F.desc("since")).first()
        ways = json.loads(row["ways"])
        return Coarse(np.frombuffer(row["centroids"], np.float32).reshape(-1, ways["width"]), ways["visits"], ways["rows"])

    def _fit(self, rows: DataFrame) -> Coarse | None:
        n = rows.count()
        sample = rows.select("vector", F.xxhash64("id", "vector").alias("o")).orderBy("o").limit(int(min(MOST_FIT, max(1024, FIT_A_CELL * n**0.5)))).collect()
        if not sample:
            return None
        widths = [len(r["vector"]) for r in sample]
        width = max(set(widths), key=widths.count)
        return Coarse.fit(unit_rows([r["vector"] for r in sample if len(r["vector"]) == width]), n)

    def _keep(self, coarse: Coarse) -> None:
        ways = {"width": coarse.centroids.shape[1], "visits": coarse.visits, "rows": coarse.rows}
        since = (self.cells.version() or 0) + 1
        self.spark.createDataFrame([(since, json.dumps(ways), bytearray(coarse.centroids.tobytes()))], "since long, ways string, centroids binary").write.mode("append").parquet(f"{self.root}/coarse")

    # --- writing ---

    def _placed(self, rows: DataFrame, coarse: Coarse) -> DataFrame:
        width = coarse.centroids.shape[1]

        def place(batches):
            for batch in batches:
                if len(batch):
                    unit = unit_rows(batch["vector"].to_numpy())
                    cell = coarse.nearest(unit, 1)[:, 0]
                    left = unit - coarse.centroids[cell]
                    scale = np.maximum(np.abs(left).max(axis=1) / 127, 1e-12)
                    code = np.round(left / scale[:, None]).astype(np.int8)
                    yield batch.assign(cell=cell, scale=scale.astype(np.float32), code=[c.tobytes() for c in code])[CELLS.names]

        return rows.where(F.size("vector") == width).select("id", "content_hash", "vector").mapInPandas(place, CELLS)

    def refresh(self, rows: DataFrame) -> dict:
        """Bring the index in step with rows (id, vector, content_hash): what is new or has another hash is placed, what is gone goes. Only cells that change are written."""
        rows = rows.select(F.col("id").cast("string").alias("id"), F.col("vector").cast("array<float>").alias("vector"), "content_hash").where(text.is_direction("vector"))
        coarse = self.coarse()
        have = self.cells.read().select("id", "content_hash", "cell")
        if coarse is None or rows.select("id").count() > OUTGROWN * coarse.rows:
            return self._build(written(rows, "vectors"))
        key = [F.coalesce(F.col(c), F.lit("")) for c in ("id", "content_hash")]
        fresh = rows.withColumn("k", F.xxhash64(*key))
        gone = have.withColumn("k", F.xxhash64(*key)).join(fresh.select("k").distinct(), "k", "left_anti").select("k", "cell")
        new = fresh.join(have.select(F.xxhash64(*key).alias("k")).distinct(), "k", "left_anti")
        new, gone = written(self._placed(new, coarse), "placed"), written(gone, "gone")
        counts = {"placed": new.count(), "removed": gone.count()}
        touched = sorted(r["cell"] for r in new.select("cell").union(gone.select("cell")).distinct().collect())  # numbers of cells
        if touched:
            kept = self.cells.read(touched).withColumn("k", F.xxhash64(*key)).join(gone.select("k").distinct(), "k", "left_anti").drop("k")
            self.cells.replace(kept.unionByName(new), touched)
        return counts | {"cells": len(touched)}

    def _build(self, rows: DataFrame) -> dict:
        coarse = self._fit(rows)
        if coarse is None:
            return {"placed": 0, "removed": 0, "cells": 0}
        self._keep(coarse)
        placed = self._placed(rows, coarse)
        self.cells.replace(placed)
        return {"placed": self.cells.read().select("id").count(), "removed": 0, "cells": len(self.cells.folders())}

    # --- reading ---

    def search(self, questions: DataFrame, k: int = 10, visits: int | None = None, query_id: str = "query_id", query_vector: str = "query_vector", shortlist: int = SHORTLIST) -> DataFrame:
        """query_id, id, score (exact cosine), rank: the nearest vectors that the visited cells hold."""
        kind = questions.schema[query_id].dataType
        schema = T.StructType([T.StructField(query_id, kind), T.StructField("id", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
        coarse = self.coarse()
        if coarse is None:
            return self.spark.createDataFrame([], schema)
        width, count = coarse.centroids.shape[1], visits or coarse.visits
        asked = written(questions.select(F.col(query_id).alias("q"), F.col(query_vector).cast("array<double>").alias("asked")), "questions").where(text.is_direction("asked") & (F.size("asked") == width)).distinct()

        def visit(batches):
            for batch in batches:
                if len(batch):
                    unit = unit_rows(batch["asked"].to_numpy())
                    yield batch.assign(asked=list(unit.astype(np.float32)), cells=list(coarse.nearest(unit, count)))

        visited = asked.mapInPandas(visit, T.StructType([T.StructField("q", kind), T.StructField("asked", T.ArrayType(T.FloatType())), T.StructField("cells", T.ArrayType(T.IntegerType()))]))
        visited = written(visited, "visits").select("q", "asked", F.explode("cells").alias("cell"))
        wanted = [r["cell"] for r in visited.select("cell").distinct().collect()]  # numbers of cells
        held = self.cells.read(wanted)
        parts = F.broadcast(held.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNKS_A_PART).cast("int").alias("parts")))  # a row a cell
        left = visited.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        right = held.select("id", "cell", "scale", "code").join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id", "code"), F.col("parts")).cast("int")).drop("parts")
        most = k * shortlist

        def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"q": [], "cell": [], "id": [], "about": []})
            codes = np.frombuffer(b"".join(b["code"]), np.int8).reshape(len(b), width).astype(np.float32) * b["scale"].to_numpy()[:, None]
            home, place, found = coarse.centroids[int(a["cell"].iloc[0])], b["id"].rank(method="first").to_numpy(), []
            for at in range(0, len(a), 256):
                own = np.stack(a["asked"].to_numpy()[at : at + 256]).astype(np.float32)
                about = own @ codes.T + (own @ home)[:, None]
                row, column = best_of(about, place, most)
                found.append(pd.DataFrame({"q": a["q"].to_numpy()[at : at + 256][row], "cell": a["cell"].iloc[0], "id": b["id"].to_numpy()[column], "about": about[row, column]}))
            return pd.concat(found, ignore_index=True)

        pairs = left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInPandas(lambda a, b: near(a, b), T.StructType([T.StructField("q", kind), T.StructField("cell", T.IntegerType()), T.StructField("id", T.StringType()), T.StructField("about", T.DoubleType())]))
        short = pairs.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("about"), "id"))).where(F.col("n") <= most).select("q", "cell", "id").distinct()
        vectors = held.select(F.col("cell").alias("c2"), F.col("id").alias("i2"), "vector")
        scored = short.join(vectors, (F.col("cell") == F.col("c2")) & F.col("id").eqNullSafe(F.col("i2"))).join(asked.toDF("q2", "asked"), F.col("q").eqNullSafe(F.col("q2")))
        order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        best = scored.withColumn("score", text.cosine("asked", "vector")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return best.select(F.col("q").alias(query_id), "id", "score", "rank")
