"""A table in hash buckets with a manifest: readers see one version or the next, never half of one, and a version writes only the buckets that it changes.

``<root>/v=<n>/b=<k>`` holds bucket k as version n wrote it, ``<root>/_current`` the version in force and the folder of each of its buckets. A write makes new folders
and then replaces the manifest by a rename, through Hadoop's file systems, so it works on any store that Spark writes to. A second writer of
the same version is refused. Folders that neither the version in force nor the one before it needs are deleted, so readers may finish what they began.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrel.functions import fixed_values as V

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType(), False)),
        T.StructField("text", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("total_chunks", T.IntegerType()),
        T.StructField("model", T.StringType()),
    ]
)


class WriteRefused(RuntimeError):
    """Another writer is at work on the table, or was and failed."""


class SnapshotTable:
    """``buckets`` is how finely a write can be told from the rest; it is set when a table is made and kept in its manifest."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = CHUNK_SCHEMA, key: str = "doc_id", buckets: int = 16):
        self.spark, self.root, self.schema, self.key, self._buckets = spark, root.rstrip("/"), schema, key, buckets

    # --- the manifest ---

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _files(self):
        return self._path("_current").getFileSystem(self._conf())

    def manifest(self) -> dict | None:
        """version, buckets, parts (bucket -> version that wrote it), before (the parts of the version before); None for a table that doesn't exist."""
        path = self._path("_current")
        if not self._files().exists(path):
            return None
        stream = self._files().open(path)
        try:
            reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return json.loads(reader.readLine())
        finally:
            stream.close()

    def version(self) -> int | None:
        """The version in force, or None for a table that doesn't exist."""
        found = self.manifest()
        return found["version"] if found else None

    def _point(self, manifest: dict) -> None:
        fresh, path = self._path(f"_next-{manifest['version']}"), self._path("_current")
        stream = self._files().create(fresh, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self._conf())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(fresh, path, options)

    def _names(self, folder: str, prefix: str) -> list[int]:
        path = self._path(folder)
        found = self._files().listStatus(path) if self._files().exists(path) else []
        names = [f.getPath().getName() for f in found]
        return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))

    def _sweep(self, manifest: dict) -> None:
        """Delete the folders that no manifest names any more: a listing of a few versions' buckets."""
        used = {(int(k), v) for parts in (manifest["parts"], manifest["before"]) for k, v in parts.items()}
        for v in self._names("", "v="):
            if v <= manifest["version"]:
                own = self._names(f"v={v}", "b=")
                for k in own:
                    if (k, v) not in used:
                        self._files().delete(self._path(f"v={v}/b={k}"), True)
                if not any((k, v) in used for k in own):
                    self._files().delete(self._path(f"v={v}"), True)

    # --- the table ---

    @property
    def buckets(self) -> int:
        found = self.manifest()
        return found["buckets"] if found else self._buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def setup(self) -> bool:
        """Make an empty table if there is none; whether one was made."""
        if self.version() is not None:
            return False
        self.replace(self.spark.createDataFrame([], self.schema))
        return True

    def folders(self, buckets: Iterable[int] | None = None) -> list[str]:
        """Where the version in force has these buckets (None: all)."""
        found = self.manifest() or {"parts": {}}
        wanted = None if buckets is None else {str(k) for k in buckets}
        return [f"{self.root}/v={v}/b={k}" for k, v in found["parts"].items() if wanted is None or k in wanted]

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The version in force, or these buckets of it: no file of another is opened."""
        folders = self.folders(buckets)
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    @contextmanager
    def _claimed(self) -> Iterator[tuple[int, dict | None]]:
        """The next version's number and the manifest in force, while no other run writes that version."""
        found = self.manifest()
        version = (found["version"] if found else 0) + 1
        claim = self._path(f"_claim-{version}")
        if not self._files().createNewFile(claim):
            raise WriteRefused(f"version {version} is being written by another run; if that run is gone, delete {claim}")
        try:
            if (self.version() or 0) + 1 != version:
                raise WriteRefused(f"version {version} was written meanwhile")
            self._files().delete(self._path(f"v={version}"), True)  # what a run that failed has left
            yield version, found
        finally:
            self._files().delete(claim, False)

    def replace(self, rows: DataFrame, touched: Iterable[int] | None = None) -> int:
        """Write rows as the next version, then let readers see it. With ``touched`` they are all rows of these buckets, and the others stay as they are."""
        with self._claimed() as (version, found):
            rows.select(*self.schema.names).withColumn("b", self.bucket()).hint("rebalance", "b").write.partitionBy("b").parquet(f"{self.root}/v={version}")
            old = found["parts"] if found else {}
            gone = None if touched is None else {str(k) for k in touched}
            kept = {} if gone is None else {k: v for k, v in old.items() if k not in gone}
            manifest = {"version": version, "buckets": found["buckets"] if found else self._buckets, "parts": kept | {str(k): version for k in self._names(f"v={version}", "b=")}, "before": old}
            self._point(manifest)
            self._sweep(manifest)
        return version

    def apply(self, rows: DataFrame, dead: DataFrame, added: int, removed: int) -> int:
        """Add rows, take out those whose id is in dead (id and the key), write the buckets that this changes; how many rows there are then."""
        touched = [r["b"] for r in rows.select(self.key).union(dead.select(self.key)).select(self.bucket().alias("b")).distinct().collect()]  # bucket numbers
        self.replace(self.read(touched).join(dead.select("id"), "id", "left_anti").select(*self.schema.names).unionByName(rows.select(*self.schema.names)), touched)
        return self.points()

    def points(self) -> int:
        return self.read().count()

    def clear(self) -> dict:
        """Empty the table; what it was and holds now."""
        existed = self.version() is not None
        before = self.read().count() if existed else 0
        self.replace(self.spark.createDataFrame([], self.schema))
        return {"collection": self.root.rsplit("/", 1)[-1], "existed": existed, "removed": before, "points_count": 0}

    def check_width(self, width: int = V.EMBEDDING_WIDTH) -> None:
        """Vectors of another width, or of more than one model, don't belong in one table."""
        row = self.read().agg(F.count_if(F.size("vector") != width).alias("odd"), F.count_distinct("model").alias("models")).first()
        if row["odd"] or row["models"] > 1:
            raise ValueError(f"{row['odd']} vectors aren't {width} wide, {row['models']} models in one table")
