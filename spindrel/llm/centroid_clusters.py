"""Clusters of vectors around centroids by delta Lloyd, in whole numbers, so that the result doesn't depend on how rows are dealt.

A vector's components become integers floor(scale * x). Every round writes the vectors with their owner and their distance to it (the persisted
assignment). A vector whose owner stands where it stood compares itself with the centroids that moved, and no others; one whose owner moved
compares itself with all. Only vectors that changed hands add to the transfers, signed integers a centroid and component (minus where they
left, plus where they came to), summed within a task, then by Spark; the driver holds the sums of the few centroids, never a vector.

A pass reads a table and writes one without a shuffle, so one very common vector or label costs nothing more. A table goes when the next
is complete: a lost executor repeats its tasks from the table before.

Cases: vectors that are null, of another width, or with null or non-finite components aren't clustered and have no row. Repeated rows and ids
count each. The starting centroids are the vectors with the least hashes; equal hashes (equal ids) go by their components, vectors with
a null id come last. Fewer vectors than centroids give as many clusters as vectors; none give an empty result. A tie in distance goes to the
smaller number; a centroid without vectors stays where it is. Components beyond 2^27 are refused with an error, as their distances
needn't fit a long. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm.common import discard, written

CENTROIDS, ROUNDS, WIDTH, SCALE = 16, 3, 64, 64
#: Integers are at most so large: a squared distance then fits a long up to a width of 128.
MOST = 2**27
#: Up to here sums of squares are whole numbers in double precision, so a matrix product is exact.
_EXACT = 2**20
_ROWS = 4096


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """id and x, the integer vector, of the rows that can be clustered."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.col(vector_col).cast("array<double>")
    good = table.select(F.col(id_col).alias("id"), v.alias("v")).where(F.coalesce((F.size("v") == width) & F.forall("v", finite), F.lit(False)))
    whole = F.transform("v", lambda x: F.when(F.abs(x) <= MOST / scale - 1, F.floor(x * scale).cast("int")).otherwise(F.raise_error(F.lit(f"a component is beyond {MOST} / {scale}")).cast("int")))
    return good.select("id", whole.alias("x"))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids.astype(np.int64)], axis=1) if len(centroids) else np.zeros((len(x), 0), np.int64)


def reassign(x: np.ndarray, owner: np.ndarray, far: np.ndarray, centroids: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector and the distance to it. owner: where it was (-1: nowhere yet), far: how far it was; moved: which centroids have."""
    owner, far = owner.copy(), far.copy()
    lost = (owner < 0) | moved[owner]
    if lost.any():
        d = distances(x[lost], centroids)
        owner[lost] = d.argmin(axis=1)  # the first of the least
        far[lost] = d.min(axis=1)
    changed = np.flatnonzero(moved)
    if len(changed) and not lost.all():
        own = np.flatnonzero(~lost)
        d = distances(x[own], centroids[changed])
        best = d.argmin(axis=1)
        near, who = d[np.arange(len(own)), best], changed[best]
        better = (near < far[own]) | (near == far[own]) & (who < owner[own])
        owner[own[better]], far[own[better]] = who[better], near[better]
    return owner, far


def _assigned(table: DataFrame, centroids: np.ndarray, moved: np.ndarray) -> DataFrame:
    """The next table: was is the owner that a vector had before."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                own = batch.iloc[a : a + _ROWS]
                was = own["owner"].to_numpy().astype(np.int64)
                owner, far = reassign(np.stack(own["x"].to_numpy()).astype(np.int64), was, own["far"].to_numpy().astype(np.int64), centroids, moved)
                yield pd.DataFrame({"id": own["id"], "x": own["x"], "was": was, "owner": owner, "far": far})

    return table.mapInPandas(work, "id string, x array<int>, was int, owner int, far long")


def transfers(table: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What the centroids' counts and component sums change by: signed sums over the vectors that changed hands."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            for a in range(0, len(batch), _ROWS):
                own = batch.iloc[a : a + _ROWS]
                x = np.stack(own["x"].to_numpy()).astype(np.int64)
                for column, sign in (("was", -1), ("owner", 1)):
                    c = own[column].to_numpy()
                    there = c >= 0
                    np.add.at(count, c[there], sign)
                    np.add.at(total, c[there], sign * x[there])
        some = np.flatnonzero(count.astype(bool) | total.any(axis=1))
        if len(some):
            yield pd.DataFrame({"c": some.astype(np.int32), "s": [np.r_[count[j], total[j]].tolist() for j in some]})

    parts = table.where("owner <> was").select("x", "was", "owner").mapInPandas(work, "c int, s array<long>")
    rows = parts.select("c", F.posexplode("s").alias("at", "v")).groupBy("c", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # k * (width + 1) numbers
    out = np.zeros((k, width + 1), object)
    for r in rows:
        out[r["c"], r["at"]] = int(r["v"])
    return out[:, 0], out[:, 1:]


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    rank = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    return np.array([r["x"] for r in vectors.select("x", rank.alias("r")).orderBy(F.col("r").asc_nulls_last(), "x").limit(k).collect()], np.int64)


def clusters(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(id, x, owner, far) of every vector after the rounds and one assignment more, and the centroids. The table is a written one."""
    vectors = whole_vectors(table, id_col, vector_col, width, scale).withColumn("id", F.col("id").cast("string"))
    held = written(vectors.withColumns({"owner": F.lit(-1), "far": F.lit(0).cast("long")}))
    centroids = first_centroids(held, k)
    count, total = np.zeros(len(centroids), object), np.zeros((len(centroids), width), object)
    moved = np.ones(len(centroids), bool)
    for turn in range(rounds + 1 if len(centroids) else 0):
        if not moved.any():  # nothing can change hands any more
            break
        before, held = held, written(_assigned(held.select("id", "x", "owner", "far"), centroids, moved))
        discard(before)
        if turn < rounds:
            more, by = transfers(held, len(centroids), width)
            count, total = count + more, total + by
            after = np.array([[int(s) // int(n) for s in row] if n else c.tolist() for n, row, c in zip(count, total, centroids, strict=True)], np.int64)
            moved, centroids = (after != centroids).any(axis=1), after
    return held.select("id", "x", "owner", "far"), centroids.tolist()


def digest(centroid: list[int]) -> str:
    import hashlib

    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def report(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **ways: int) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every clustered vector. The sums of the few clusters are literals of the plan."""
    found, centroids = clusters(table, id_col, vector_col, **ways)
    total = {r["owner"]: int(r["s"]) for r in found.groupBy("owner").agg(F.sum(F.col("far").cast("decimal(38,0)")).alias("s")).collect()}
    if sum(total.values()) >= 2**63:
        raise OverflowError("the distances' sum doesn't fit a long")
    of = lambda values, kind: F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("owner") + 1) if values else F.lit(None).cast(kind)
    return found.select(
        F.col("id").cast(table.schema[id_col].dataType).alias(id_col),
        F.col("owner").alias("cluster"),
        F.col("far").alias("distance"),
        of([total.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(total.values())).cast("long").alias("inertia"),
        of([digest(c) for c in centroids], "string").alias("centroid_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def oracle_sql(k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64) -> str:
    """The same in DuckDB: plain Lloyd rounds, every vector against every centroid, over whole numbers."""
    far = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    steps = [
        f"v as materialized (select row_number() over () r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) x from embeddings where len(embedding) = {width} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"c0 as materialized (select row_number() over (order by h nulls last, x) - 1 c, x from (select sha256('1:' || vec_id) h, x from v) order by h nulls last, x limit {k})",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} as materialized (select r, vec_id, x, b.d d, b.c c from (select v.r, any_value(v.vec_id) vec_id, any_value(v.x) x, min(row({far}, c.c)::struct(d bigint, c bigint)) b from v, c{n} c group by v.r))")
        if n < rounds:
            steps.append(f"p{n} as (select c, i, sum(x[i])::bigint s, count(*) n from a{n}, range(1, {width + 1}) t(i) group by c, i)")
            steps.append(f"m{n} as (select c, list((s - ((s % n) + n) % n) // n order by i) x from p{n} group by c)")
            steps.append(f"c{n + 1} as materialized (select o.c, coalesce(m.x, o.x) x from c{n} o left join m{n} m on o.c = m.c)")
    last = f"select a.vec_id, a.c::int cluster, a.d distance, sum(a.d) over (partition by a.c)::bigint cluster_inertia, sum(a.d) over ()::bigint inertia, sha256(array_to_string(c.x, ',')) centroid_sha256 from a{rounds} a join c{rounds} c on a.c = c.c"
    return "with " + ",\n".join(steps) + "\n" + last


ORACLE_SQL = oracle_sql()
