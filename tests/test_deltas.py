"""The store as deltas: what a write costs, what readers see, merges, and that it behaves as the bucket table does."""

import random

import pytest
from pyspark.sql import functions as F

from spindrel.operators import sync
from spindrel.sources import deltas
from spindrel.sources.deltas import DeltaTable
from spindrel.sources.snapshots import WriteRefused


def _documents(spark, rows):
    return spark.createDataFrame([(d, c, f"https://e.org/{d}", None) for d, c in rows], "doc_id string, content string, url string, title string")


def _size(folder) -> int:
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_a_write_costs_what_it_changes(spark, tmp_path):
    table = DeltaTable(spark, str(tmp_path / "kb"))
    dice = random.Random(1)
    rows = [(f"d{k}", " ".join(f"w{dice.randrange(10**6)}" for _ in range(80))) for k in range(1000)]
    first = sync.sync(table, _documents(spark, rows))
    assert first["new"] == 1000 and first["points_count"] == table.read().count() == 1000
    whole = _size(tmp_path / "kb")
    changed = [(d, "changed " + c if k % 100 == 0 else c) for k, (d, c) in enumerate(rows) if k % 100 != 1]
    done = sync.sync(table, _documents(spark, changed))
    assert (done["changed"], done["stale"], done["unchanged"], done["points_count"]) == (10, 10, 980, 990)
    assert _size(tmp_path / "kb") - whole < 0.04 * whole
    living = {r["doc_id"]: r["text"] for r in table.read().collect()}
    assert len(living) == 990 and living["d100"].startswith("changed") and "d101" not in living and living["d2"] == rows[2][1]
    version = table.version()
    assert sync.sync(table, _documents(spark, changed))["chunks"] == 0 and table.version() == version
    assert table.clear() == {"collection": "kb", "existed": True, "removed": 990, "points_count": 0} and table.read().count() == 0


def test_many_writes_equal_their_last_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(deltas, "SEGMENTS", 3)
    table = DeltaTable(spark, str(tmp_path / "kb"))
    table.setup()
    dice, state, old = random.Random(4), {}, None
    schema = "id string, doc_id string, text string"
    for turn in range(9):
        new = {f"c{dice.randrange(30)}": f"{turn}-{k}" for k in range(6)}
        drop = set(dice.sample(sorted(state), min(len(state), 4)))
        dead = (drop | new.keys()) & state.keys()
        state = {k: v for k, v in state.items() if k not in dead} | new
        rows = spark.createDataFrame([(k, k, v) for k, v in new.items()], schema)
        for name in table.schema.names:
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast(table.schema[name].dataType))
        gone = spark.createDataFrame([(k, k) for k in dead], "id string, doc_id string")
        assert table.apply(rows, gone, len(new), len(dead)) == len(state) == table.points()
        assert {r["id"]: r["text"] for r in table.read().collect()} == state
        assert len(table.segments()) <= 4
        if old is not None:  # a reader of the version before may finish
            assert old[0].count() == old[1]
        old = (table.read(), len(state))
    table.compact(everything=True)
    assert {r["id"]: r["text"] for r in table.read().collect()} == state and [s["g"] for s in table.segments()] == [0]
    assert table.compact() is None


def test_merges_leave_large_segments_alone(spark, tmp_path):
    table = DeltaTable(spark, str(tmp_path / "kb"))
    sync.sync(table, _documents(spark, [(f"d{k}", f"text {k}") for k in range(400)]))
    large = table.segments()[0]
    for turn in range(deltas.SEGMENTS + 1):
        sync.sync(table, _documents(spark, [(f"d{k}", f"text {k}" if k != turn else f"other {turn}") for k in range(400)]))
    segments = table.segments()
    assert segments[0] == large and len(segments) <= deltas.SEGMENTS and table.points() == table.read().count() == 400
    assert table.read().where("text like 'other%'").count() == 1


def test_writers_and_failures(spark, tmp_path):
    table = DeltaTable(spark, str(tmp_path / "kb"))
    sync.sync(table, _documents(spark, [("a", "x"), ("b", "y")]))
    claim = tmp_path / "kb" / f"_claim-{table.version() + 1}"
    claim.touch()
    with pytest.raises(WriteRefused):
        sync.sync(table, _documents(spark, [("a", "z"), ("b", "y")]))
    assert {r["text"] for r in table.read().collect()} == {"x", "y"}
    claim.unlink()
    broken = table.read().withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.apply(broken, table.read().select("id", "doc_id"), 2, 2)
    assert {r["text"] for r in table.read().collect()} == {"x", "y"} and table.points() == 2
    assert sync.sync(table, _documents(spark, [("a", "z"), ("b", "y")]))["changed"] == 1 and {r["text"] for r in table.read().collect()} == {"z", "y"}
