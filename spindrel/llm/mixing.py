"""Mixing sources to target weights by Pfair scheduling.

Each source is a stream of blocks of ``BLOCK_CHARS`` characters. With weight w, its block k may be placed from slot floor(k / w) on (release) and
must be by slot ceil((k + 1) / w) (deadline). Slots go one after another to the released block with the earliest deadline, which
never misses a deadline, so after any number of slots each source is less than one block from its weight. When a source has
no blocks left, a new phase begins with the weights of the others in proportion.

The weights are taken exactly, as the fractions that the floating-point numbers are, so the distance from them doesn't grow with the corpus and no
weight is too small. The driver schedules block by block: a number a block (0.5 million blocks at 30 GB), from one number a source, and every
document's slot follows from its block. The running offsets inside a source are sums within hash buckets of it plus prefix
sums over buckets, so a source with a third of all rows is many tasks' work. The number of sources is bounded by ``MOST_SOURCES``: weights are
a table that people write, and more sources raise an error. A caller that names a ``period`` has the weights rounded to parts of it (largest remainders,
one part at least) and that period repeated: a short schedule, which is less than one block from the rounded weights.

Every document is placed exactly once. Cases: a null source is a source of its own; a source that the weights don't name, or with weight zero, comes after all
others in proportion to size; a null or empty text counts as one character. Ties of ids are ordered by text; repeated rows are placed each. Columns
of the input that are named like a result are replaced by it. A document longer than a block leaves its source's next slots empty, which it has used up. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from fractions import Fraction
from math import ceil, gcd, lcm, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_CHARS = 65_536
MOST_SOURCES = 1024
#: Where no weights are given: a source's share of all characters to this power.
TEMPERATURE = 0.5
ROWS_A_BUCKET = 20_000


def quotas(weights: list[float], period: int) -> list[int]:
    """Whole parts of a period, one at least, by largest remainders."""
    total = sum(weights)
    exact = [w / total * period for w in weights]
    parts = [max(1, int(x)) for x in exact]
    order = sorted(range(len(parts)), key=lambda k: (parts[k] - exact[k], k))
    while sum(parts) < period:
        for k in order[: period - sum(parts)]:
            parts[k] += 1
    while sum(parts) > period:  # sources raised to one part are paid for by the largest
        parts[max(range(len(parts)), key=lambda k: (parts[k], -k))] -= 1
    return parts


def one_period(parts: list[int]) -> list[list[int]]:
    """The slots of each source in a period, by earliest deadline first."""
    period = sum(parts)
    jobs = sorted((k * period // q, -(-(k + 1) * period // q), s) for s, q in enumerate(parts) for k in range(q))
    slots, ready, at = [[] for _ in parts], [], 0
    for t in range(period):
        while at < len(jobs) and jobs[at][0] <= t:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        deadline, s = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a block missed its deadline")
        slots[s].append(t)
    return slots


def one_phase(weights: list[float], left: list[int]) -> list[np.ndarray]:
    """The slots of each source by earliest deadline first and the exact weights, until a source has placed its blocks that are left."""
    shares = [Fraction(w) for w in weights]
    whole = lcm(*(w.denominator for w in shares))
    parts = [int(w * whole) for w in shares]
    common = gcd(*parts)
    parts = [q // common for q in parts]
    total = sum(parts)
    slots, ready, later, t = [array("q") for _ in parts], [], [(0, -(-total // q), s) for s, q in enumerate(parts)], 0
    heapq.heapify(later)
    while True:
        while later and later[0][0] <= t:
            heapq.heappush(ready, heapq.heappop(later)[1:])
        deadline, s = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a block missed its deadline")
        slots[s].append(t)
        t += 1
        k, q = len(slots[s]), parts[s]
        if k == left[s]:
            return [np.array(x, np.int64) for x in slots]
        heapq.heappush(later, (k * total // q, -(-(k + 1) * total // q), s))


class Schedule:
    """The slot of block k of a source, phase by phase."""

    def __init__(self, blocks: list[int], weights: list[float], period: int | None = None):
        self.first = [[] for _ in blocks]  # of each phase: its first block, first slot, slots in a period, period
        left, at, done = list(blocks), 0, [0] * len(blocks)
        stages = [[s for s in range(len(blocks)) if weights[s] > 0], [s for s in range(len(blocks)) if weights[s] <= 0]]
        for stage in stages:
            while active := [s for s in stage if left[s]]:
                own = [weights[s] if weights[s] > 0 else float(blocks[s]) for s in active]
                if period is None:
                    slots = one_phase(own, [left[s] for s in active])
                    parts = [len(x) for x in slots]
                    end = length = sum(parts)
                else:
                    parts = quotas(own, max(period, 4 * len(active)))
                    slots, length = one_period(parts), sum(parts)
                    end = min((left[s] - 1) // q * length + slots[k][(left[s] - 1) % q] for k, (s, q) in enumerate(zip(active, parts, strict=True))) + 1
                for k, (s, q) in enumerate(zip(active, parts, strict=True)):
                    self.first[s].append((done[s], at, np.array(slots[k]), length))
                    took = end // length * q + bisect_left(slots[k], end % length)
                    done[s] += took
                    left[s] -= took
                at += end
        self.slots = at

    def place(self, source: int, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots and phases of a source's blocks."""
        phases = self.first[source]
        which = np.searchsorted([p[0] for p in phases], block, "right") - 1
        slot = np.empty(len(block), np.int64)
        for n in np.unique(which):
            first, at, slots, length = phases[n]
            own = which == n
            k = block[own] - first
            slot[own] = at + k // len(slots) * length + slots[k % len(slots)]
        return slot, which


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_chars: int = BLOCK_CHARS, temperature: float = TEMPERATURE, period: int | None = None, prefix: str = "mix_") -> DataFrame:
    """docs with mix_start (characters of its source before it), mix_block, mix_phase (of its source) and mix_slot. Order by (mix_slot, mix_start). Another prefix gives
    other names; columns of docs that are named like a result are replaced by it."""
    buckets = 1 << max(6, ceil(log2(max(1, docs.count() / ROWS_A_BUCKET))))
    results = [f"{prefix}{x}" for x in ("start", "block", "phase", "slot")]
    kept = [c for c in docs.columns if c not in results]
    source, bucket, size, base, spot, start, block, text_hash = (free_prefix(docs, "__") + x for x in ("source", "bucket", "size", "base", "spot", "start", "block", "hash"))
    named = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    rows = docs.withColumns({source: named, size: F.greatest(F.coalesce(F.length(text_col), F.lit(1)), F.lit(1)).cast("long"), text_hash: F.xxhash64(text_col)})
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_hash), F.lit(buckets)))
    sums = rows.groupBy(source, bucket).agg(F.sum(size).alias("t"))
    upto = Window.partitionBy(source).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn(base, F.coalesce(F.sum("t").over(upto), F.lit(0).cast("long"))).drop("t")
    totals = sorted((r[source], r["t"]) for r in sums.groupBy(source).agg(F.sum("t").alias("t")).limit(MOST_SOURCES + 1).collect())
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: give groups of sources one name each")
    whole = sum(t for _, t in totals) or 1
    target = [(t / whole) ** temperature if weights is None else weights.get(s[1:] if s else None, 0.0) for s, t in totals]
    number = {s: k for k, (s, _) in enumerate(totals)}
    schedule = docs.sparkSession.sparkContext.broadcast(Schedule([-(-t // block_chars) for _, t in totals], target, period))  # a number a block

    @F.pandas_udf("struct<slot long, phase int>")
    def placed(sources: pd.Series, blocks: pd.Series) -> pd.DataFrame:
        slot, phase = np.zeros(len(blocks), np.int64), np.zeros(len(blocks), np.int64)
        for s, at in sources.groupby(sources).groups.items():
            slot[at], phase[at] = schedule.value.place(number[s], blocks.to_numpy()[at])
        return pd.DataFrame({"slot": slot, "phase": phase.astype(np.int32)})

    inside = Window.partitionBy(source, bucket).orderBy(id_col, text_hash).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(bases, [source, bucket]).withColumn(start, F.col(base) + F.coalesce(F.sum(size).over(inside), F.lit(0).cast("long")))
    rows = rows.withColumn(block, F.floor(F.col(start) / block_chars).cast("long"))
    rows = rows.withColumn(spot, placed(source, block))
    return rows.select(*kept, *[c.alias(n) for n, c in zip(results, (F.col(start), F.col(block), F.col(spot)["phase"], F.col(spot)["slot"]), strict=True)])


def free_prefix(docs: DataFrame, prefix: str) -> str:
    """The prefix, longer by as many ``_`` as it takes for no column of docs to begin with it."""
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def in_order(docs: DataFrame, weights: dict[str, float] | None = None, partitions: int = 200, **how) -> DataFrame:
    """The documents laid out in mixing order: partition after partition, and inside each. All their columns stay as they are."""
    prefix = free_prefix(docs, "mix_")
    slot, start = f"{prefix}slot", f"{prefix}start"
    return mix(docs, weights, prefix=prefix, **how).repartitionByRange(partitions, slot, start).sortWithinPartitions(slot, start).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", F.col("mix_start").alias("start"), F.col("mix_block").alias("block"), F.col("mix_phase").alias("phase"), F.col("mix_slot").alias("slot"))


#: Earliest-deadline-first is a simulation, beyond plain SQL; tests recompute offsets and blocks and hold every prefix against the weights.
ORACLE_SQL = None
