"""Near-duplicate vectors by an inverted multi-index.

Two independent codebooks, one for each half of a vector, form a product grid; a vector lives in the cell of its nearest centroid pair.
Each vector visits the cells nearest to it by multi-sequence traversal (a heap over the two sorted centroid lists) and is compared
exactly, in double precision, with the vectors that live there. How many cells are visited is set by the target recall: the fit
sample's vectors are moved to partners at just the threshold, the hardest pairs there are, and the traversal goes as deep as
``TARGET`` of them need. Codebooks are fitted on a bounded sample (``MOST_FIT``); every vector is indexed and every vector visits.

Equal vectors of a label are one row from the start. A cell whose rows are many is compared in sub-blocks, two and two, in tasks of
their own. A pair is found if either end visits the other's cell and counts once at both ends, so link counts are symmetric. Tasks
emit link counts and a spanning forest, never pairs; components are a distributed run.

Cases: vectors that are null, empty, zero, or hold null or non-finite components, and those without a label, link with nothing. Vectors of different
widths aren't compared. Rows with equal ids are rows of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm.common import by_group, deal, durable, group_numbers, local_components
from spindrel.llm.graph import components, least_of

THRESHOLD = 0.93
TARGET = 0.99
#: Vectors that the index is fitted on: so many for each centroid of a half, and at least and at most these.
FIT_A_CENTROID, LEAST_FIT, MOST_FIT = 16, 4096, 65_536
#: Vectors of the largest label that a cell holds on average, by which the number of centroids grows with the table (to MOST_FIT / FIT_A_CENTROID a half: 16.8 million cells).
A_CELL = 256
SUB_BLOCK = 2048
_ROWS = 512


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        own = _squares(x, c).argmin(axis=1)
        for j in range(len(c)):
            near = x[own == j]
            c[j] = near.mean(axis=0) if len(near) else x[rng.integers(len(x))]
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None, :], 0)


class MultiIndex:
    """Codebooks of the two halves of unit vectors of one width."""

    def __init__(self, unit: np.ndarray, centroids: int, threshold: float = THRESHOLD, target: float = TARGET, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.half = unit.shape[1] // 2
        self.books = [k_means(unit[:, : self.half], centroids, rng), k_means(unit[:, self.half :], centroids, rng)]
        self.wide = len(self.books[1])
        away = rng.standard_normal(unit.shape)
        away -= (away * unit).sum(axis=1, keepdims=True) * unit
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
        partner = threshold * unit + np.sqrt(max(0.0, 1 - threshold**2)) * away
        there, back = self.ranks(unit, partner), self.ranks(partner, unit)
        # a pair is found if either end reaches the other's cell
        self.visits = int(np.quantile(np.minimum(there, back), target, method="higher")) + 1

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _squares(unit[:, : self.half], self.books[0]), _squares(unit[:, self.half :], self.books[1])

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells are nearer to x than the one that y lives in."""
        a, b = self.distances(x)
        c, d = self.distances(y)
        i, j, n = c.argmin(axis=1), d.argmin(axis=1), np.arange(len(x))
        limit = a[n, i] + b[n, j]
        b.sort(axis=1)
        return np.array([np.searchsorted(row_b, lim - row_a, "left").clip(0).sum() for row_a, row_b, lim in zip(a, b, limit, strict=True)])

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Numbers of the cells each vector visits, nearest first; the first is its own."""
        a, b = self.distances(unit)
        out = np.empty((len(unit), min(self.visits, a.shape[1] * b.shape[1])), np.int32)
        for k in range(len(unit)):
            out[k] = traverse(a[k], b[k], out.shape[1], self.wide)
        return out


def traverse(a: np.ndarray, b: np.ndarray, count: int, wide: int) -> list[int]:
    """Multi-sequence traversal: cells (i, j) by growing a[i] + b[j]."""
    order_a, order_b = a.argsort(kind="stable").tolist(), b.argsort(kind="stable").tolist()
    sa, sb = a[order_a].tolist(), b[order_b].tolist()
    heap, out, done = [(sa[0] + sb[0], 0, 0)], [], [0] * (len(sa) + 1)  # done[i]: how many of row i are out
    while heap and len(out) < count:
        _, i, j = heapq.heappop(heap)
        out.append(order_a[i] * wide + order_b[j])
        done[i] = j + 1
        if i + 1 < len(sa) and done[i + 1] == j:
            heapq.heappush(heap, (sa[i + 1] + sb[j], i + 1, j))
        if j + 1 < len(sb) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
    return out


def _comparable(vector: str, label: str):
    """Not null, all components finite, not zero, with a label."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.col(vector)
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, good) & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col(label).isNotNull()


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, target: float = TARGET, sub_block: int = SUB_BLOCK) -> DataFrame:
    """id, n_links, component_id, kept: one row a row of table."""
    kind = "array<float>" if table.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"  # floats move as floats and are compared as doubles
    v = F.col(vector_col).cast(kind)
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v"), _comparable(vector_col, label_col).alias("ok"))
    keyed = lambda df: df.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    own = keyed(rows.where("ok"))
    classes = own.groupBy("label", "h1", "h2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    classes = durable(classes.withColumn("class", F.monotonically_increasing_id()))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    found = durable(_linked(classes, largest, threshold, target, sub_block))
    per = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    least = least_of(classes.select(F.col("class").alias("node"), "least"), components(found.where("b is not null"), "a", "b"), "least").toDF("class", "component_id")
    each = classes.select("label", "h1", "h2", "n", "class").join(per, "class", "left").join(least, "class").select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    good = own.select("id", "label", "h1", "h2").join(each, ["label", "h1", "h2"]).select("id", "n_links", "component_id")
    rest = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.unionByName(rest).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def fit(classes: DataFrame, largest: int, threshold: float, target: float) -> dict[int, MultiIndex]:
    """An index for each width of vectors in the sample (that of the smallest hashes)."""
    wanted = max(2, round((largest / A_CELL) ** 0.5))
    most = int(np.clip(FIT_A_CENTROID * wanted, LEAST_FIT, MOST_FIT))
    got = classes.select("v", F.xxhash64("h1", "h2").alias("o")).orderBy("o").limit(most).collect()
    by_width: dict[int, list] = {}
    for r in got:
        by_width.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for width, vectors in by_width.items():
        if width > 1 and len(vectors) > 1:
            x = np.array(vectors, np.float64)
            out[width] = MultiIndex(_unit(x), min(wanted, max(2, len(vectors) // FIT_A_CENTROID)), threshold, target)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(classes: DataFrame, largest: int, threshold: float, target: float, sub_block: int) -> DataFrame:
    """(a, links, b): what class a links with in one task, and a link of that task's forest (or null)."""
    index = fit(classes, largest, threshold, target)
    keys = ["k0", "k1", "k2", "cell"]
    thin = classes.select(F.xxhash64("label", F.size("v")).alias("k0"), F.col("label").cast("string").alias("k1"), F.size("v").alias("k2"), "class", "n", "v")

    def place(batches):
        for batch in batches:
            seen = [None] * len(batch)
            widths = batch["k2"].to_numpy()
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                if width in index:
                    cells = index[width].cells(_unit(np.stack(batch["v"].to_numpy()[at]).astype(np.float64)))
                    for k, c in zip(at, cells, strict=True):
                        seen[k] = c
                else:  # too few of this width to fit an index: all are in one cell
                    for k in at:
                        seen[k] = np.zeros(1, np.int32)
            yield batch.assign(seen=seen)

    kind = thin.schema["v"].dataType.simpleString()
    placed = durable(thin.mapInPandas(place, f"k0 long, k1 string, k2 int, class long, n long, v {kind}, seen array<int>"))
    # a vector goes to the cells it visits; what it visits goes along to its own cell only
    home = F.col("seen")[0]
    visits = placed.withColumn("cell", F.explode("seen")).withColumns({"home": home, "seen": F.when(F.col("cell") == home, F.col("seen"))})

    def compare(own: pd.DataFrame) -> pd.DataFrame:
        group = group_numbers(own, [*keys, "p", "q"])
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
        parts = [_block(own.iloc[a:b], threshold) for a, b in zip(cuts, cuts[1:], strict=False) if b - a > 1]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"a": [], "links": [], "b": []}).astype({"a": "int64", "links": "int64", "b": "Int64"})

    return deal(visits, keys, "class", sub_block).mapInPandas(lambda batches: by_group(batches, [*keys, "p", "q"], compare), "a long, links long, b long")


def _block(own: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """All rows of a cell, residents and visitors, against its residents."""
    x = np.stack(own["v"].to_numpy()).astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    if not (np.isfinite(norm) & (norm > 0)).all():  # squares out of range: scale first, which leaves the cosine as it is
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
    n, weight, side, cls, home = len(own), own["n"].to_numpy(), own["side"].to_numpy(), own["class"].to_numpy(), own["home"].to_numpy()
    lives = home == own["cell"].iloc[0]
    living = np.flatnonzero(lives)
    homes, which = np.unique(home, return_inverse=True)
    reaches = np.stack([np.isin(homes, s) for s in own["seen"].to_numpy()[living]]) if len(living) else np.zeros((0, len(homes)), bool)  # resident r visits homes[c]
    links, label = np.zeros(n, np.int64), np.arange(n)
    for k in range(0, n if len(living) else 0, _ROWS):
        i = np.arange(k, min(n, k + _ROWS))
        hit = (x[i] @ x[living].T) / (norm[i][:, None] * norm[living][None, :]) >= threshold
        hit &= i[:, None] != living[None, :]
        if (side >= 0).any():
            hit &= side[i][:, None] != side[living][None, :]
        links[i] += hit @ weight[living]
        # a resident leaves a visitor to the visitor's own cell if it goes there itself
        links[living] += weight[i] @ (hit & ~lives[i][:, None] & ~reaches[:, which[i]].T)
        a, b = np.nonzero(hit)
        if len(a):
            label = label[local_components(n, label[i[a]], label[living[b]])]
    linked = np.flatnonzero((links > 0) | (label != np.arange(n)))
    return pd.DataFrame({"a": cls[linked], "links": links[linked], "b": pd.array(np.where(label[linked] != linked, cls[label[linked]], -1), dtype="Int64")}).assign(b=lambda d: d["b"].where(d["b"] >= 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


#: An index fitted on a sample can't be written in SQL; tests compare all pairs by brute force.
ORACLE_SQL = None
