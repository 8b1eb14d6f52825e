"""The stored index: recall against the exact join, files opened, updates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrel.operators import retrieval, vector_index
from spindrel.operators.vector_index import VectorIndex

KINDS = "id string, vector array<float>, content_hash string"


def _clustered(spark, n=3000, width=24, centres=40, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    rows = [(str(k), (middle[k % centres] + 0.25 * rng.normal(size=width)).tolist(), "a") for k in range(n)]
    return spark.createDataFrame(rows, KINDS).repartition(4).cache()


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    table = _clustered(spark)
    index = VectorIndex(spark, str(tmp_path_factory.mktemp("index")))
    return table, index, index.refresh(table)


def _recall(index, table, k=10):
    asked = table.where("cast(id as int) % 30 = 0").select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    got = {(r["query_id"], r["id"], round(r["score"], 6)) for r in index.search(asked, k).collect()}
    want = {(r["query_id"], r["id"], round(r["score"], 6)) for r in retrieval.top_k_batch(table, asked, k).collect()}
    return len(got & want) / len(want)


def test_recall_from_a_fraction_of_the_files(spark, made):
    table, index, done = made
    coarse = index.coarse()
    assert done["placed"] == 3000 and len(index.cells.folders()) == done["cells"] <= len(coarse.centroids) == 55
    assert _recall(index, table) >= 0.95
    assert coarse.visits <= 0.5 * len(coarse.centroids)
    one = table.where("id = '7'").select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    read = {f.rsplit("/", 1)[0] for f in index.search(one, 5).inputFiles() if "/cells/" in f}
    assert len(read) <= coarse.visits and [r["id"] for r in index.search(one, 1).collect()] == ["7"]


def test_updates_write_only_the_cells_they_change(spark, made):
    table, index, _ = made
    before, version = index.cells.manifest()["parts"], index.cells.version()
    assert index.refresh(table) == {"placed": 0, "removed": 0, "cells": 0} and index.cells.version() == version
    later = table.where("id <> '11'").withColumns({"vector": F.when(F.col("id") == "12", F.transform("vector", lambda x: -x)).otherwise(F.col("vector")), "content_hash": F.when(F.col("id") == "12", "b").otherwise(F.col("content_hash"))})
    done = index.refresh(later.unionByName(spark.createDataFrame([("new", [1.0] + [0.0] * 23, "a")], KINDS)))
    after = index.cells.manifest()["parts"]
    assert done["placed"] == 2 and done["removed"] == 2 and done["cells"] <= 4
    assert sum(after.get(c) != v for c, v in before.items()) <= done["cells"]
    ids = {r["id"]: r["content_hash"] for r in index.cells.read().collect()}
    assert len(ids) == 3000 and "11" not in ids and ids["12"] == "b" and "new" in ids
    assert _recall(index, later) >= 0.95


def test_index_edges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "CHUNKS_A_PART", 20)
    index = VectorIndex(spark, str(tmp_path / "i"))
    ask = lambda rows: spark.createDataFrame(rows, "query_id string, query_vector array<double>")
    assert index.search(ask([("q", [1.0, 0.0])])).count() == 0
    none = spark.createDataFrame([], KINDS)
    assert index.refresh(none) == {"placed": 0, "removed": 0, "cells": 0} and index.coarse() is None
    odd = [("z", [0.0, 0.0], "a"), ("n", None, "a"), ("i", [float("inf"), 1.0], "a"), ("w", [1.0, 2.0, 3.0], "a"), ("e", [], "a")]
    copies = [(f"c{k:03}", [3.0, 4.0], "a") for k in range(90)]
    index.refresh(spark.createDataFrame([*odd, *copies, ("x", [-1.0, 0.5], "a"), (None, [0.0, 1.0], None)], KINDS))
    assert index.cells.read().count() == 92
    got = index.search(ask([("q", [2.0, 0.0]), ("q", [2.0, 0.0]), (None, [0.0, 5.0]), ("bad", [0.0, 0.0]), ("wide", [1.0] * 3)]), 3, visits=99).collect()
    rows = sorted((r["query_id"] or "", r["rank"], r["id"] or "", round(r["score"], 9)) for r in got)
    assert rows == [("", 1, "", 1.0), ("", 2, "c000", 0.8), ("", 3, "c001", 0.8), ("q", 1, "c000", 0.6), ("q", 2, "c001", 0.6), ("q", 3, "c002", 0.6)]
    assert index.refresh(none)["removed"] == 92 and index.cells.read().count() == 0


def test_an_outgrown_index_is_fitted_anew(spark, tmp_path):
    table = _clustered(spark, 600)
    index = VectorIndex(spark, str(tmp_path / "i"))
    index.refresh(table.where("cast(id as int) < 100"))
    few = len(index.coarse().centroids)
    index.refresh(table)
    assert index.coarse().rows == 600 and len(index.coarse().centroids) > few and index.cells.read().count() == 600
