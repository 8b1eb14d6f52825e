"""The store as deltas: a write adds the rows that are new and the ids that are gone, nothing else, and readers merge them.

``<root>/v=<n>/rows`` holds what version n added, ``<root>/v=<n>/gone`` the ids it took out of the versions before it; the manifest lists the versions that
are in force (segments) with their counts. A row lives unless a later segment lists its id. A write costs what it changes, however large the store.

Segments are merged as they pile up: of more than ``SEGMENTS`` the newest ones are rewritten as one, back to the first that holds over ``GROWTH`` times
what comes after it. So a row is rewritten a number of times that grows with the logarithm of the store, and a read meets few segments. Only
ids that earlier segments may still hold stay listed; a merge of all drops them. Rows are laid out in as many files as their size asks for (a rebalanced
write by id), so neither a write nor a merge is bound to a number of tasks.

Ids are unique among living rows: a write must list each id that it adds again. Rows with a null id live until the table is cleared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spindrel.sources.snapshots import SnapshotTable

SEGMENTS, GROWTH = 8, 3


class DeltaTable(SnapshotTable):
    """A table whose manifest has segments: version (v), rows added (n), ids taken out (g), oldest first; points: living rows."""

    def segments(self) -> list[dict]:
        return (self.manifest() or {"segments": []})["segments"]

    def points(self) -> int:
        return (self.manifest() or {"points": 0})["points"]

    # --- reading ---

    def _rows(self, segments: list[dict]) -> DataFrame:
        folders = [f"{self.root}/v={s['v']}/rows" for s in segments if s["n"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema).withColumn("__v", F.lit(0).cast("long"))
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/v=(\d+)/rows/", 1).cast("long")
        return self.spark.read.schema(self.schema).parquet(*folders).select(*self.schema.names, version.alias("__v"))

    def _gone(self, segments: list[dict]) -> DataFrame | None:
        """id and the last segment that took it out."""
        folders = [f"{self.root}/v={s['v']}/gone" for s in segments if s["g"]]
        if not folders:
            return None
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/v=(\d+)/gone/", 1).cast("long")
        return self.spark.read.schema("id string").parquet(*folders).select("id", version.alias("v")).groupBy("id").agg(F.max("v").alias("__gone"))

    def _living(self, segments: list[dict]) -> DataFrame:
        rows, gone = self._rows(segments), self._gone(segments)
        if gone is not None:
            rows = rows.join(gone, "id", "left").where(F.col("__gone").isNull() | (F.col("__gone") <= F.col("__v")))
        return rows.select(*self.schema.names)

    def folders(self, buckets=None) -> list[str]:
        return [f"{self.root}/v={s['v']}/rows" for s in self.segments() if s["n"]]

    def read(self, buckets=None) -> DataFrame:
        return self._living(self.segments())

    # --- writing ---

    def _segment(self, version: int, rows: DataFrame | None, gone: DataFrame | None) -> dict:
        """Write a segment's folders; its counts are taken while it is written."""
        counts = {}
        for name, part, by in (("rows", rows, "id"), ("gone", gone, "id")):
            counts[name] = 0
            if part is not None:
                seen = Observation()
                part.hint("rebalance", by).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/v={version}/{name}")
                counts[name] = seen.get["n"]
        return {"v": version, "n": counts["rows"], "g": counts["gone"]}

    def _publish(self, version: int, found: dict | None, segments: list[dict], points: int) -> None:
        manifest = {"version": version, "segments": segments, "points": points, "before": [s["v"] for s in (found or {"segments": []})["segments"]]}
        self._point(manifest)
        used = {s["v"] for s in segments} | set(manifest["before"])
        for v in self._names("", "v="):
            if v <= version and v not in used:
                self._files().delete(self._path(f"v={v}"), True)

    def setup(self) -> bool:
        if self.version() is not None:
            return False
        with self._claimed() as (version, found):
            self._publish(version, found, [], 0)
        return True

    def replace(self, rows: DataFrame, touched=None) -> int:
        """Write rows as all that the table holds."""
        if touched is not None:
            raise ValueError("a table of deltas has no buckets to replace; see apply")
        with self._claimed() as (version, found):
            segment = self._segment(version, rows.select(*self.schema.names), None)
            self._publish(version, found, [segment] if segment["n"] else [], segment["n"])
        return version

    def apply(self, rows: DataFrame, dead: DataFrame, added: int, removed: int) -> int:
        """Add rows and take out the ids in dead (of living rows); how many rows live then. added and removed: how many these are."""
        with self._claimed() as (version, found):
            segment = self._segment(version, rows.select(*self.schema.names) if added else None, dead.select("id").where("id is not null") if removed else None)
            points = found["points"] + segment["n"] - segment["g"]
            self._publish(version, found, [*found["segments"], segment], points)
        if len(self.segments()) > SEGMENTS:
            self.compact()
        return points

    def compact(self, everything: bool = False) -> dict | None:
        """Merge the newest segments, back to the first that holds over GROWTH times what comes after it (or all of them); the segment that came of it."""
        with self._claimed() as (version, found):
            segments = found["segments"] if found else []
            first = len(segments) - 1
            after = segments[-1]["n"] + segments[-1]["g"] if segments else 0
            while first > 0 and (everything or segments[first - 1]["n"] <= GROWTH * after):
                first -= 1
                after += segments[first]["n"] + segments[first]["g"]
            merged = segments[max(first, 0) :]
            if len(merged) < 2 and not (everything and merged and merged[0]["g"]):
                return None
            gone = self._gone(merged) if first > 0 else None  # what earlier segments may still hold
            segment = self._segment(version, self._living(merged), gone.select("id") if gone is not None else None)
            self._publish(version, found, [*segments[:first], segment], found["points"])
            return segment

    def clear(self) -> dict:
        """Empty the table; what it was and holds now."""
        existed, before = self.version() is not None, self.points()
        with self._claimed() as (version, found):
            self._publish(version, found, [], 0)
        return {"collection": self.root.rsplit("/", 1)[-1], "existed": existed, "removed": before, "points_count": 0}
