"""Passages that repeat across documents, exactly or nearly, by collinear chaining of shared k-mers.

1. Seeds. Of a document's k-mers of ``K`` words (64-bit hashes, A-Z lower-cased) those are taken that are the least of some ``WINDOW`` consecutive
   ones, so any ``K + WINDOW - 1`` equal words share a seed and about 2 / (WINDOW + 1) of all k-mers move.
2. Anchors. By id, then position, each of the first ``RARE`` occurrences of a seed meets all earlier ones; each later one meets the first holder and the
   ``FURTHER`` nearest. A seed that few hold near one that many hold names partners, whose words around it are aligned without a chain where nothing else is found. So anchors grow
   with the text, however many documents share a seed. One sort by seed finds them; very frequent seeds are dealt over tasks, with the same result. Seeds of
   one document drop out.
3. Chains. A document's anchors with one partner, merged along diagonals, are chained in order in both texts; a Fenwick tree over partner
   positions holds the best chain ending before each, and gaps cost by their length. Chains break at gaps over ``MOST_GAP`` words. Every chain of
   ``_SPAN`` words is aligned, whatever it scores.
4. Alignment. The word hashes around each chain are cut from both texts (the texts' one shuffle), the chain is extended while words match and
   aligned within a band; a passage is ``MIN_WORDS`` or more words with ``IDENTITY`` or more of them equal. Where extension gives none, the longest one on the
   chain's diagonals is taken, and where there is none either, the longest one along the best path through a band around them.
5. Cover. What is put together from several earlier documents has no single partner: MIN_WORDS or more words in successive seeds of a text that all
   occur earlier are a passage too. Seeds next to each other begin at most WINDOW <= K words apart, so every word of it lies in a k-mer that an
   earlier document holds. So an exact repeat of MIN_WORDS + 2 * WINDOW words is never missed, whichever documents hold its parts. A shorter run is
   aligned with each of its seeds' holders.
6. Joint seeds. What 2. leaves out are partners of which all shared seeds are frequent. A chain of ``_SPAN`` words has two seeds ``_SPAN - K`` to
   ``_FAR`` words apart, so each two frequent seeds of a text at such a distance are a key, and documents with equal keys are held against each other,
   all of them: by the words that they have in common around the seeds, then along the diagonals, then by alignment. Keys with one first holder meet in
   its cell of ``GRID`` words, so a text that stands there with many keys stands there once. Two seeds of one passage that the first holder has word for
   word are no key, as that holder has them; large groups are dealt over tasks two sub-blocks at a time.

Passages are reported for the later document; the first one that holds it is its partner. Cases: null ids and null, empty or short texts have no passages. Rows
with equal ids count as one document: the text with the least hash is read, for all rows that have it; another text under the same id stays as it is. Long texts are handled whole. An empty table gives an empty result. Other columns stay as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.llm.common import by_group, deal, durable, group_numbers, narrow_batches, small_batches, written

K = 5
WINDOW = 5
MIN_WORDS = 50
IDENTITY = 0.8
MOST_GAP = 40
GAP_COST = 0.25
#: Words around a chain that alignment may extend into (a whole passage at least), and the grid that spans are rounded to so that equal requests meet.
MARGIN, GRID = 64, 64
DROP = 8
#: Diagonals beside a chain's that words added or left out may lead to.
BAND = 16
#: The first occurrences of a seed are anchored to all earlier ones; a later one to the first holder, this many nearest ones, and whom the rare seeds beside it name.
RARE, FURTHER = 16, 3
#: A seed with more occurrences is dealt over tasks; documents that are read to know such seeds.
HOT, SAMPLE = 200_000, 20_000
#: With no more chains to align (two spans each, some 10 MB), and one for ten documents or less, spans go to the texts; else both are dealt by document.
FEW = 200_000
#: The seeds of a repeated passage of MIN_WORDS span this at least, with whichever documents.
_RUN = MIN_WORDS - 2 * (WINDOW - 1)
#: A chain with one partner is aligned if it spans this: little, as a passage with a fifth of its words changed keeps few seeds.
_SPAN = 12
#: In a chain of _SPAN words some two seeds begin _SPAN - K to _FAR words apart, as no gap in it is over MOST_GAP.
_FAR = MOST_GAP + _SPAN - 1
#: Documents with one key that a task holds against each other.
BLOCK = 1000


def hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, A-Z lower-cased."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.fromiter(map(digest, words), np.uint64, len(words))


def k_mers(words: np.ndarray, k: int = K) -> np.ndarray:
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out = (out ^ words[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def minimizers(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions that are the least (the last of equal ones) of some window."""
    if len(h) <= window:
        return np.array([len(h) - 1 - h[::-1].argmin()]) if len(h) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(h[::-1], window)
    return np.unique(len(h) - 1 - (views.argmin(axis=1) + np.arange(len(views))))


def seeds(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, h, at (word position), n (0, 1, ... in a text): the seeds of every text."""
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts, begin, size = batch.iloc[:, 0].to_numpy(), batch.iloc[:, 1].tolist(), 0, 0
            for end, text in enumerate(texts, 1):
                size += len(text)
                if size > 1_000_000 or end == len(texts):
                    yield _seeds_of(keys[begin:end], [hashes(t) for t in texts[begin:end]])
                    begin, size = end, 0

    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).cast("string")).mapInPandas(work, schema)


def _seeds_of(keys: np.ndarray, words: list[np.ndarray]) -> pd.DataFrame:
    """The seeds of texts as seeds() has them, all texts at once: minimizers() of each one's k_mers()."""
    size = np.array([len(w) for w in words])
    begins, text = np.cumsum(size) - size, np.repeat(np.arange(len(words)), size)
    h = k_mers(np.concatenate(words))
    taken = np.zeros(len(h), bool)
    n = max(0, len(h) - WINDOW + 1)
    least, step = h[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, WINDOW):
        lower = h[j : j + n] <= least
        np.copyto(least, h[j : j + n], where=lower)
        step[lower] = j
    whole = np.flatnonzero(text[:n] == text[K + WINDOW - 2 :][:n])  # windows that lie in one text
    taken[whole + step[whole]] = True
    for k in np.flatnonzero((size >= K) & (size < K + WINDOW - 1)):
        taken[begins[k] + minimizers(h[begins[k] : begins[k] + size[k] - K + 1])] = True
    at = np.flatnonzero(taken)
    own = text[at]
    count = np.bincount(own, minlength=len(words))
    return pd.DataFrame({"id": pd.Series(keys).repeat(count).to_numpy(), "h": h[at].view(np.int64), "at": (at - begins[own]).astype(np.int32), "n": (np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)})


def anchors(own: DataFrame, sample: DataFrame, share: float) -> DataFrame:
    """b, h, q, n, often, many, a, p: position q of document b, its seed n, holds a seed h that the documents in a hold at the positions in p, the first holder first. Of the first RARE
    occurrences of a seed each has all earlier holders; later ones (many) have the first and the FURTHER nearest. Of a seed with more occurrences than RARE (often) the first
    holder has rows too, with itself in a. Seeds with over HOT occurrences, by a sample of the documents, are dealt over tasks by ranges of ids, and a range gets the rows that
    precede it, so results are the same."""
    hot = durable(sample.groupBy("h").agg(F.ceil(F.count("h") / share / HOT).alias("parts")).where("parts > 1"))
    if not hot.isEmpty():  # few seeds, if any, so ids are gathered of these alone
        hot = sample.join(F.broadcast(hot), "h").groupBy("h", "parts").agg(F.sort_array(F.collect_set("id")).alias("ids"))
        hot = durable(hot.select("h", F.expr("array_distinct(transform(sequence(1, parts - 1), k -> element_at(ids, cast(ceil(k * size(ids) / parts) as int))))").alias("bounds")))
    place = F.shiftleft(F.col("at").cast("long"), 32) + F.col("n")  # narrow rows: these are the most that is shuffled
    rows, keys = own.select("id", "h", place.alias("at")), ["h"]
    if not hot.isEmpty():
        keys = ["h", "part"]
        rows = rows.join(F.broadcast(hot), "h", "left").withColumn("part", F.when(F.col("bounds").isNull(), 0).otherwise(F.expr("size(filter(bounds, x -> x <= id))")))
        before, dealt = _before(rows.where("bounds is not null"))
        rows = rows.withColumn("before", F.lit(False)).unionByName(before, allowMissingColumns=True).drop("bounds").join(F.broadcast(dealt), "h", "left")
    order = Window.partitionBy(*keys).orderBy("id", "at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = F.struct("id", "at")
    total = F.count("h").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    often = F.coalesce(F.col("dealt"), total > RARE) if len(keys) > 1 else total > RARE
    seen = rows.withColumns({"often": often, "total": total}).where("total > 1 or often").drop("total")  # most seeds are of one place only
    seen = seen.withColumns({"f": F.first(each).over(upto), "many": F.row_number().over(order) > RARE, "x": F.collect_list(each).over(order.rowsBetween(-RARE, -1))})
    seen = seen.where("(f.id < id or often)" + (" and not before" if len(keys) > 1 else "")).withColumn("x", F.expr("filter(x, y -> y.id < id)"))
    near = F.expr(f"slice(x, greatest(size(x) - {FURTHER - 1}, 1), {FURTHER})")
    seen = seen.withColumn("x", F.when(F.expr("f.id = id"), F.array(each)).when(F.col("many"), F.array_union(F.array("f"), near)).otherwise(F.col("x")))
    at = lambda c: F.shiftright(c, 32).cast("int")
    n = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")
    return seen.select(F.col("id").alias("b"), "h", at(F.col("at")).alias("q"), n.alias("n"), "often", "many", F.col("x.id").alias("a"), F.transform("x.at", at).alias("p"))


def _before(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each part of a dealt seed: its first row and the RARE rows before the part, by id and place. And whether the seed has over RARE rows in all (h, dealt)."""
    last = F.row_number().over(Window.partitionBy("h", "part").orderBy(F.desc("id"), F.desc("at")))
    each, kept = F.struct("id", "at"), F.col("last") <= RARE
    ends = rows.withColumn("last", last).groupBy("h", "part").agg(F.count("h").alias("rows"), F.min(each).alias("f"), F.sort_array(F.collect_list(F.when(kept, each))).alias("x"))
    ends = durable(ends)
    dealt = ends.groupBy("h").agg((F.sum("rows") > RARE).alias("dealt"))
    order = Window.partitionBy("h").orderBy("part")
    ends = ends.withColumns({"f": F.min("f").over(order.rowsBetween(Window.unboundedPreceding, -1)), "x": F.flatten(F.collect_list("x").over(order.rowsBetween(-RARE, -1)))})
    ends = ends.where("f is not null").withColumn("x", F.expr(f"slice(x, greatest(size(x) - {RARE - 1}, 1), {RARE})"))
    return ends.withColumn("x", F.explode(F.array_union(F.array("f"), "x"))).select("x.id", "h", "x.at", "part", F.lit(True).alias("before")), dealt


class Fenwick:
    """Greatest (value, number) over a range of positions, which may be put and dropped."""

    NONE = (float("-inf"), -1)

    def __init__(self, size: int):
        self.own, self.best = [self.NONE] * size, [self.NONE] * (size + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        self.own[at] = value
        at += 1
        while at < len(self.best):
            if self.best[at] < value:
                self.best[at] = value
            at += at & -at

    def drop(self, at: int) -> None:
        self.own[at] = self.NONE
        at += 1
        while at < len(self.best):
            below, step = self.own[at - 1], 1
            while step < at & -at:
                below = max(below, self.best[at - step])
                step *= 2
            self.best[at] = below
            at += at & -at

    def within(self, low: int, high: int) -> tuple[float, int]:
        """Of positions low to high, without high."""
        out = self.NONE
        while high > low:
            begin = high - (high & -high)
            if begin >= low:
                out, high = max(out, self.best[high]), begin
            else:
                out, high = max(out, self.own[high - 1]), high - 1
        return out


def runs(q: np.ndarray, p: np.ndarray, step: int = WINDOW) -> np.ndarray:
    """Anchors on one diagonal, at most a step apart, merged: rows (q begin, q end, p begin, p end), ends exclusive, by begin."""
    order = np.lexsort((q, q - p))
    q, p = q[order], p[order]
    new = np.r_[True, (np.diff(q - p) != 0) | (np.diff(q) > step)]
    first, last = np.flatnonzero(new), np.r_[np.flatnonzero(new)[1:], len(q)] - 1
    out = np.stack([q[first], q[last] + K, p[first], p[last] + K], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def scored(parts: np.ndarray, most_gap: int = MOST_GAP, cost: float = GAP_COST) -> tuple[list[float], list[int]]:
    """The score of the best chain that ends with each run, and the run before it there (-1: none): its words, less the cost of the words between."""
    # a run is ready as a predecessor once the sweep passes its end and until the gap grows too long; half a gap's cost goes with each end, so the tree needs no pair
    n, rows = len(parts), parts.tolist()
    order = np.argsort(parts[:, 3], kind="stable")
    ends, rank = parts[order, 3], np.empty(n, np.int64)
    rank[order] = np.arange(n)
    rank, low, high = rank.tolist(), np.searchsorted(ends, parts[:, 2] - most_gap, "left").tolist(), np.searchsorted(ends, parts[:, 2] + K - 1, "right").tolist()
    tree, score, before = Fenwick(n), [0.0] * n, [-1] * n
    for _, kind, k in sorted(x for k, b in enumerate(rows) for x in ((b[1] - K + 1, 0, k), (b[1] + most_gap + 1, 1, k), (b[0], 2, k))):
        q0, q1, p0, p1 = rows[k]
        if kind == 0:
            tree.put(rank[k], (score[k] + cost * (q1 + p1) / 2, k))
        elif kind == 1:
            tree.drop(rank[k])
        else:
            score[k] = float(q1 - q0)
            value, j = tree.within(low[k], high[k])
            gain = value - cost * (q0 + p0) / 2
            if j >= 0 and gain > 0:
                score[k] += gain
                before[k] = j
    return score, before


def chains(parts: np.ndarray, most_gap: int = MOST_GAP, cost: float = GAP_COST) -> list[tuple[int, int, int, int]]:
    """Collinear chains of runs with two texts, best first, each run in one chain: (q begin, q end, p begin, p end). One sweep scores all; a chain whose
    beginning belongs to a better one keeps the rest of its runs. So a text that repeats a word, with as many runs as words, costs no more than its sort."""
    n, rows = len(parts), parts.tolist()
    score, before = scored(parts, most_gap, cost)
    out, used = [], [False] * n
    for k in sorted(range(n), key=lambda k: -score[k]):
        took = []
        while k >= 0 and not used[k]:
            used[k] = True
            took.append(rows[k])
            k = before[k]
        if took:
            q0, q1, p0, p1 = zip(*took, strict=True)
            out.append((min(q0), max(q1), min(p0), max(p1)))
    return out


def chained_pairs(b: np.ndarray, a: np.ndarray, q: np.ndarray, p: np.ndarray, named: np.ndarray) -> list[tuple]:
    """(b, a, q begin, q end, p begin, p end) of chains that span _SPAN, or that stand where an anchor is named, from anchors by (b, a, q). No chain crosses a gap over MOST_GAP, so each stretch
    between such gaps is a matter of its own; most are one diagonal or two anchors and need no chaining."""
    out = []
    cuts = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (a[1:] != a[:-1]) | (q[1:] - q[:-1] > MOST_GAP + K), True])
    first, last = cuts[:-1], cuts[1:] - 1
    marked = np.logical_or.reduceat(named, first) if len(b) else np.zeros(0, bool)
    wide = (q[last] + K - q[first] >= _SPAN) | marked
    first, last, marked = first[wide], last[wide], marked[wide]
    if not len(first):
        return out
    steps = np.maximum.reduceat(np.r_[np.abs(np.diff(q - p)), 0], np.stack([first, last], axis=1).ravel())[::2]  # of the diagonal, inside a stretch
    two, straight = last - first == 1, (steps == 0) | (first == last)
    apart = two & ~straight & ~marked & ((p[last] <= p[first]) | (p[last] - p[first] > MOST_GAP + K))
    for s, e, line, least in zip(first[~apart].tolist(), last[~apart].tolist(), straight[~apart].tolist(), np.where(marked, K, _SPAN)[~apart].tolist(), strict=True):
        if line:
            out.append((b[s], a[s], int(q[s]), int(q[e]) + K, int(p[s]), int(p[e]) + K))
        else:
            out += [(b[s], a[s], *c) for c in chains(runs(q[s : e + 1], p[s : e + 1])) if c[1] - c[0] >= least]
    return out


def candidates(found: DataFrame) -> DataFrame:
    """b, a, q0, q1, p0, p1, cover, late, key: chains to be aligned, runs that several partners cover (cover: exact, nothing to align), and what is aligned only where
    nothing else is found (late: partners that single seeds name). Rows with a key (others have 0) are joint seeds of b; those that may lack a partner are late."""
    import pyspark.sql.types as T

    kind = found.schema["b"].dataType
    schema = T.StructType([T.StructField("b", kind), T.StructField("a", kind), *(T.StructField(c, T.IntegerType()) for c in ("q0", "q1", "p0", "p1")), T.StructField("cover", T.BooleanType()), T.StructField("late", T.BooleanType()), T.StructField("key", T.LongType())])

    def chained(own: pd.DataFrame) -> pd.DataFrame:
        out = []
        keys = joint(own[own["k"].to_numpy() == 0])
        own = own[(own["b"] != own["a"]).to_numpy()]
        if own.empty:
            return keys if len(keys) else pd.DataFrame(columns=schema.names)
        b, q, n, many, k, a, p = (own[c].to_numpy() for c in ("b", "q", "n", "many", "k", "a", "p"))
        begins = np.flatnonzero(k == 0)
        size = np.diff(np.r_[begins, len(own)])
        bs, as_, qs, ps, ns, often = (x[begins] for x in (b, a, q, p, n, many))
        # further holders count but where the first one holds a whole passage, equal word for word
        cuts = np.flatnonzero(np.r_[True, (bs[1:] != bs[:-1]) | (as_[1:] != as_[:-1]) | (np.diff(qs - ps) != 0) | (np.diff(qs) > K), True])
        whole = np.repeat(qs[cuts[1:] - 1] + K - qs[cuts[:-1]] >= MIN_WORDS, np.diff(cuts))
        # near a seed that many hold, with whom it may not be anchored, one that few hold names all who can be its partners: each is aligned
        named = ~often & ~whole & near(bs, qs, often & ~whole)
        keep = (k == 0) | ~np.repeat(whole, size)
        named, cb, ca, cq, cp = (x[keep] for x in (np.repeat(named, size), b, a, q, p))
        nb, na = pd.factorize(cb)[0], pd.factorize(ca)[0]
        order = np.lexsort((cp, cq, na, nb))
        out += [(*c, False, c[3] - c[2] < _SPAN, 0) for c in chained_pairs(cb[order], ca[order], cq[order], cp[order], named[order])]
        cuts = np.flatnonzero(np.r_[True, (bs[1:] != bs[:-1]) | (np.diff(ns) != 1), True])  # no seed that is new, so no word outside of seeds either
        for s, e in zip(cuts, cuts[1:], strict=False):
            if qs[e - 1] + K - qs[s] >= MIN_WORDS:
                out.append((bs[s], as_[s], int(qs[s]), int(qs[e - 1]) + K, int(ps[s]), int(ps[s]) + K, True, False, 0))
            elif qs[e - 1] + K - qs[s] >= _RUN:  # too short by its seeds alone: what each partner's words around one of them say
                ways = {a[j]: (b[j], a[j], int(q[j]), int(q[j]) + K, int(p[j]), int(p[j]) + K, False, False, 0) for j in range(begins[s], begins[e - 1] + size[e - 1])}
                out += ways.values()
        return pd.concat([pd.DataFrame(out, columns=schema.names), keys], ignore_index=True) if len(keys) else pd.DataFrame(out, columns=schema.names)

    sent = found.repartition("b").sortWithinPartitions("b", "q")
    flat = sent.select("b", "h", "q", "n", "often", "many", F.posexplode(F.arrays_zip("a", "p")).alias("k", "x")).select("b", "h", "q", "n", "often", "many", "k", "x.a", "x.p")
    return flat.mapInPandas(lambda batches: by_group(batches, ["b"], chained, 20_000), schema)


def near(b: np.ndarray, q: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which places have one that is there in a chain's reach, in the same document; all by (b, q)."""
    doc = np.cumsum(np.r_[0, b[1:] != b[:-1]]).astype(np.int64) * (1 << 32)
    at, reach = doc + q, MOST_GAP + K
    spots = at[there]
    return np.searchsorted(spots, at + reach, "right") > np.searchsorted(spots, at - reach, "left")


def _ends(doc: np.ndarray, h: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which places to keep, so that of a word or short phrase that goes on and on (a seed again at most K words on, so what lies between is the same text) both ends
    are left, each with the next place that makes two seeds of a chain with it."""
    order = np.lexsort((q, h, doc))
    doc, h, q = doc[order], h[order], q[order]
    begins = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (np.diff(q) > K)])
    size = np.diff(np.r_[begins, len(q)])
    ahead, behind = q - np.repeat(q[begins], size), np.repeat(q[begins + size - 1], size) - q
    second = (ahead >= _SPAN - K) & (np.r_[0, ahead[:-1]] < _SPAN - K)
    second |= (behind >= _SPAN - K) & (np.r_[behind[1:], 0] < _SPAN - K)
    keep = np.zeros(len(q), bool)
    keep[order] = (ahead == 0) | (behind == 0) | second
    return keep


def joint(own: pd.DataFrame) -> pd.DataFrame:
    """Rows of candidates with a key for each two frequent seeds of a document _SPAN - K to _FAR words apart, from one row a seed by (b, q)."""
    b, h, q, n, often, many, a, p = (own[c].to_numpy() for c in ("b", "h", "q", "n", "often", "many", "a", "p"))
    if not often.any():
        return own.iloc[:0]
    new = b[1:] != b[:-1]
    held = a != b
    cuts = np.flatnonzero(np.r_[True, new | (a[1:] != a[:-1]) | (np.diff(q - p) != 0) | (np.diff(q) > K), True])  # word for word with the first holder
    whole = np.repeat(np.where((q[cuts[1:] - 1] + K - q[cuts[:-1]] >= MIN_WORDS) & held[cuts[:-1]], np.arange(1, len(cuts)), 0), np.diff(cuts))
    cuts = np.flatnonzero(np.r_[True, new | (np.diff(n) != 1) | (held[1:] != held[:-1]), True])  # a passage by its cover
    cover = np.repeat(np.where((q[cuts[1:] - 1] + K - q[cuts[:-1]] >= MIN_WORDS) & held[cuts[:-1]], np.arange(1, len(cuts)), 0), np.diff(cuts))
    doc = np.cumsum(np.r_[0, new])
    at = np.flatnonzero(often)
    at = at[_ends(doc[at], h[at], q[at])]
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, len(at)):
        i, j = at[:-step], at[step:]
        gap = q[j] - q[i]
        close = (doc[i] == doc[j]) & (gap <= _FAR)
        if not close.any():
            break
        close &= (gap >= _SPAN - K) & ~((whole[i] == whole[j]) & (whole[i] > 0))
        first.append(i[close])
        second.append(j[close])
    i, j = np.concatenate(first), np.concatenate(second)
    key = k_mers(np.stack([h[i].view(np.uint64), h[j].view(np.uint64)]), 2)[0].view(np.int64)
    late = (many[i] | many[j]) & ~((cover[i] == cover[j]) & (cover[i] > 0))
    return pd.DataFrame({"b": b[i], "a": b[i], "q0": q[i], "q1": q[j] + np.int32(K), "p0": q[i], "p1": q[j] + np.int32(K), "cover": np.zeros(len(i), bool), "late": late, "key": np.where(key == 0, 1, key)})


def extend(x: np.ndarray, y: np.ndarray) -> int:
    """How far x and y run together from their start, by the best score of 1 a match and -2 a mismatch, left at a drop of DROP."""
    n = min(len(x), len(y))
    if not n:
        return 0
    score = np.cumsum(np.where(x[:n] == y[:n], 1, -2))
    fell = np.flatnonzero(np.maximum.accumulate(score) - score > DROP)
    score = score[: fell[0]] if len(fell) else score
    return int(score.argmax()) + 1 if len(score) and score.max() > 0 else 0


def batches_of(lengths: list[int], most: int = 200_000) -> Iterator[np.ndarray]:
    """Numbers of texts of about equal length, in batches that padded hold about so many words."""
    order, at = np.argsort(lengths, kind="stable")[::-1], 0
    while at < len(order):
        size = max(1, most // max(1, lengths[order[at]]))
        yield order[at : at + size]
        at += size


def padded(xs: list[np.ndarray], ys: list[np.ndarray], low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of texts as columns: x, and y so that rows i to i + width hold what stands on the diagonals from low on at word i. Padding equals nothing."""
    n = max(map(len, xs))
    x, y = np.full((n, len(xs)), -2, np.int64), np.full((n + width - 1, len(xs)), -1, np.int64)
    for k, (own, other, at) in enumerate(zip(xs, ys, low.tolist(), strict=True)):
        x[: len(own), k] = own
        first, last = max(0, -at), min(n + width - 1, len(other) - at)
        if first < last:
            y[first:last, k] = other[first + at : last + at]
    return x, y


def banded(x: np.ndarray, y: np.ndarray, width: np.ndarray) -> Iterator[np.ndarray]:
    """After each word the most equal words of each pair's alignment up to it, by diagonal, in a band of its width: all pairs of padded() at once."""
    lanes = int(width.max())
    inside = np.arange(lanes)[:, None] < width
    all_in = bool(inside.all())
    row = np.zeros((lanes + 1, x.shape[1]), np.int32)
    for i in range(len(x)):
        same = y[i : i + lanes] == x[i]
        # lane l is word i of x at word i + low + l of y: a match steps along the diagonal, a skipped word of x comes from lane l + 1
        step = np.maximum(row[:lanes] + (same if all_in else same & inside), row[1:])
        np.maximum.accumulate(step, axis=0, out=row[:lanes])  # skipped words of y
        yield row


def matches_all(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Most equal words of each pair's alignment in a band around the diagonals that the ends lie on."""
    out, rest = np.zeros(len(pairs), np.int64), []
    for k, (x, y) in enumerate(pairs):
        if len(x) == len(y):
            out[k] = (x == y).sum()
        if len(x) and (len(x) != len(y) or out[k] < IDENTITY * len(x)):
            rest.append(k)
    for part in batches_of([len(pairs[k][0]) for k in rest]):
        xs, ys = zip(*(pairs[rest[k]] for k in part), strict=True)
        apart = np.array([len(y) - len(x) for x, y in zip(xs, ys, strict=True)])
        width = np.abs(apart) + 2 * BAND + 1
        row = np.zeros((1, len(xs)))
        for row in banded(*padded(xs, ys, np.minimum(0, apart) - BAND, int(width.max())), width):
            pass
        out[[rest[k] for k in part]] = row.max(axis=0)
    return out


def matches(x: np.ndarray, y: np.ndarray) -> int:
    return int(matches_all([(x, y)])[0])


def align_all(pairs: list[tuple[np.ndarray, np.ndarray, tuple[int, int], tuple[int, int]]]) -> list[tuple[int, int, int, int, float]]:
    """For each x, y and chain's spans in them: the spans after extension, and the share of words that are equal. Where these are no passage, the longest on a diagonal
    of the chain's ends is taken: extension stops where changes lie close, and takes words in that bring the share under IDENTITY."""
    out, rest = [], []
    for x, y, (q0, q1), (p0, p1) in pairs:
        ahead = extend(x[q1:], y[p1:])
        back = extend(x[:q0][::-1], y[:p0][::-1])
        out.append((q0 - back, q1 + ahead, p0 - back, p1 + ahead, 0.0))
    long = [k for k, (q0, q1, *_) in enumerate(out) if q1 - q0 >= MIN_WORDS]
    for k, n in zip(long, matches_all([(pairs[k][0][slice(*out[k][:2])], pairs[k][1][slice(*out[k][2:4])]) for k in long]).tolist(), strict=True):
        q0, q1, p0, p1, _ = out[k]
        out[k] = q0, q1, p0, p1, n / max(1, q1 - q0, p1 - p0)
    for k, (x, y, own, other) in enumerate(pairs):
        if out[k][1] - out[k][0] >= MIN_WORDS and out[k][4] >= IDENTITY:
            continue
        ends = {other[0] - own[0], other[1] - own[1]}
        for shift in ends:
            s, e, same = straight(x, y, shift, own)
            if e - s >= MIN_WORDS and (out[k][4] < IDENTITY or e - s > out[k][1] - out[k][0]):
                out[k] = s, e, s + shift, e + shift, same
        if out[k][1] - out[k][0] < MIN_WORDS or out[k][4] < IDENTITY:
            rest.append((k, (x, y, own, min(ends), max(ends))))
    for (k, _), found in zip(rest, gapped_all([p for _, p in rest]), strict=True):
        out[k] = found or out[k]
    return out


def align(x: np.ndarray, y: np.ndarray, own: tuple[int, int], other: tuple[int, int]) -> tuple[int, int, int, int, float]:
    return align_all([(x, y, own, other)])[0]


def straight(x: np.ndarray, y: np.ndarray, shift: int, own: tuple[int, int]) -> tuple[int, int, float]:
    """The longest span of x, from one equal word to another and meeting the span own, in which IDENTITY of the words equal those of y at shift."""
    low, high = max(0, -shift), min(len(x), len(y) - shift)
    if high - low < MIN_WORDS:
        return 0, 0, 0.0
    s, e, same = dense(x[low:high] == y[low + shift : high + shift], own[0] - low, own[1] - low)
    return (s + low, e + low, same) if e else (0, 0, 0.0)


def dense(same: np.ndarray, begins: int, ends: int) -> tuple[int, int, float]:
    """The longest span, from one true place to another and meeting begins to ends, of which IDENTITY is true, and the share that is."""
    hits = np.flatnonzero(same)
    if not len(hits):
        return 0, 0, 0.0
    upto = np.zeros(len(same) + 1)  # a span is good if this isn't lower at its end than at its beginning
    np.cumsum(same - IDENTITY, out=upto[1:])
    begin = np.searchsorted(-np.minimum.accumulate(upto[hits]), -upto[hits + 1] - 1e-9, "left")
    long = np.where((hits[begin] < ends) & (hits >= begins), hits - hits[begin] + 1, 0)
    j = int(long.argmax())
    i = int(begin[j])
    return (int(hits[i]), int(hits[j]) + 1, (j - i + 1) / int(long[j])) if long[j] else (0, 0, 0.0)


def gapped_all(pairs: list[tuple[np.ndarray, np.ndarray, tuple[int, int], int, int]]) -> list[tuple[int, int, int, int, float] | None]:
    """For each x, y, span of x and least and most diagonal: the longest passage that meets the span along the path of most equal words through these diagonals and BAND
    more on either side, where words come and go. Few chains get here and fewer past the first test: that enough words of x stand in y on any of these diagonals."""
    out: list[tuple[int, int, int, int, float] | None] = [None] * len(pairs)
    rest = np.flatnonzero(possible_all(pairs)).tolist()
    for part in batches_of([len(pairs[k][0]) for k in rest], 20_000):
        own = [rest[k] for k in part]
        xs, ys = [pairs[k][0] for k in own], [pairs[k][1] for k in own]
        low, width = np.array([pairs[k][3] - BAND for k in own]), np.array([pairs[k][4] - pairs[k][3] + 2 * BAND + 1 for k in own])
        best = [np.zeros((int(width.max()) + 1, len(own)), np.int32)]
        best += [row.copy() for row in banded(*padded(xs, ys, low, int(width.max())), width)]
        best = np.stack(best)
        for j, k in enumerate(own):
            if best[len(xs[j]), :, j].max() >= IDENTITY * MIN_WORDS:
                out[k] = _along(best[: len(xs[j]) + 1, : width[j], j], xs[j], ys[j], int(low[j]), pairs[k][2])
    return out


def _along(best: np.ndarray, x: np.ndarray, y: np.ndarray, low: int, own: tuple[int, int]) -> tuple[int, int, int, int, float] | None:
    """The longest passage along the path that best, the most equal words up to each word of x on each diagonal from low on, ends with."""
    rows, mine, other, width, path = best.tolist(), x.tolist(), y.tolist(), best.shape[1], []
    i, lane = len(x), width - 1
    while i and lane < width and rows[i][lane]:
        if lane and rows[i][lane - 1] == rows[i][lane]:
            lane -= 1
        elif 0 <= (j := i - 1 + low + lane) < len(other) and mine[i - 1] == other[j] and rows[i - 1][lane] + 1 == rows[i][lane]:
            i -= 1
            path.append((i, j))
        else:
            i, lane = i - 1, lane + 1
    at = np.array(path[::-1], np.int32).reshape(-1, 2)
    if len(at) < IDENTITY * MIN_WORDS:
        return None
    at, other = np.ascontiguousarray(at.T)
    found, k = None, np.arange(len(at), dtype=np.int32)
    first, last = k[: np.searchsorted(at, own[1], "left")], k[np.searchsorted(at, own[0], "left") :]
    for part in np.array_split(first, max(1, len(first) * len(last) // 1_000_000)):
        long, far = (x[last] + 1 - x[part, None] for x in (at, other))
        good = ((last + 1 - part[:, None]) / np.maximum(np.maximum(long, far), 1) >= IDENTITY) & (long >= MIN_WORDS)
        if good.any():
            long[~good] = 0
            a, b = np.unravel_index(long.argmax(), long.shape)
            if found is None or long[a, b] > found[1] - found[0]:
                i, j = part[a], last[b]
                found = int(at[i]), int(at[j]) + 1, int(other[i]), int(other[j]) + 1, float((j - i + 1) / max(long[a, b], far[a, b]))
    return found


def gapped(x: np.ndarray, y: np.ndarray, own: tuple[int, int], least: int, most: int) -> tuple[int, int, int, int, float] | None:
    return gapped_all([(x, y, own, least, most)])[0]


def possible_all(pairs: list[tuple[np.ndarray, np.ndarray, tuple[int, int], int, int]]) -> np.ndarray:
    """Whether enough words of each x around its span stand in y on the diagonals that alignment looks at, as dense() has it."""
    if not pairs:
        return np.zeros(0, bool)
    xs, ys, own, least, most = zip(*pairs, strict=True)
    n = len(pairs)
    return on_diagonals(Texts([*xs, *ys]), np.arange(n), np.arange(n, 2 * n), np.array(own).reshape(-1, 2), np.array(least), np.array(most))


class Texts:
    """Word hashes of many texts, one after another, as 16-bit numbers: equal words have equal ones, so what these rule out is ruled out."""

    PADDING = np.array([65534, 65535], np.uint16)  # of x and of y: equals nothing

    def __init__(self, words: list[np.ndarray]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.begins = np.cumsum(self.size) - self.size
        flat = np.concatenate(words) if words else np.zeros(0, np.uint32)
        self.flat = np.r_[(flat % 65521).astype(np.uint16), self.PADDING]

    def rows(self, texts: np.ndarray, first: np.ndarray, n: int, padding: int) -> np.ndarray:
        """Words first to first + n of the texts, as columns."""
        at = np.arange(n)[:, None] + first
        return self.flat[np.where((at >= 0) & (at < self.size[texts]), at + self.begins[texts], len(self.flat) - 2 + padding)]


def on_diagonals(texts: Texts, x: np.ndarray, y: np.ndarray, own: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """possible_all() for pairs of texts given by their numbers, all at once."""
    out = np.zeros(len(x), bool)
    width, length = most - least + 2 * BAND + 1, texts.size[x]
    order = np.lexsort((length, width))
    order, at = order[length[order] >= MIN_WORDS], 0
    while at < len(order):
        part = order[at : at + 500]
        at += len(part)
        n, lanes, narrow = int(length[part].max()), int(width[part].max()), int(width[part].min())
        mine, other = texts.rows(x[part], np.zeros(len(part), np.int64), n, 0), texts.rows(y[part], least[part] - BAND, n + lanes - 1, 1)
        hit, same = np.zeros(mine.shape, bool), np.empty(mine.shape, bool)
        for lane in range(lanes):
            np.equal(other[lane : lane + n], mine, out=same)
            if lane >= narrow:
                same &= lane < width[part]
            hit |= same
        enough = np.flatnonzero(hit.sum(axis=0) >= IDENTITY * MIN_WORDS)
        if not len(enough):
            continue
        part, hit = part[enough], hit[:, enough]
        upto = np.zeros((n + 1, len(part)))
        np.cumsum(hit - IDENTITY, axis=0, out=upto[1:])
        spots, (begins, ends) = np.arange(n)[:, None], own[part].T
        least_upto = np.minimum.accumulate(np.where(hit & (spots < ends), upto[:n], np.inf), axis=0)
        good = hit[MIN_WORDS - 1 :] & (spots[MIN_WORDS - 1 :] >= begins) & (upto[MIN_WORDS:] >= least_upto[: n - MIN_WORDS + 1] - 1e-9)
        out[part] = good.any(axis=0)
    return out


def _repeated(docs: DataFrame, id_col: str) -> DataFrame:
    """The ids of several rows."""
    return docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)


def _ranked(text_col: str):
    """Of rows with equal ids the one with the least of this is read."""
    return F.struct(F.xxhash64(F.col(text_col).cast("string")).alias("h"), F.col(text_col).cast("string").alias("t"))


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, end (words of the later document, end exclusive), partner, partner_start, identity: a row a passage and partner."""
    small_batches(docs.sparkSession)
    if not _repeated(docs, id_col).isEmpty():
        docs = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).groupBy(id_col).agg(F.min(_ranked(text_col)).alias("x")).select(id_col, F.col("x.t").alias(text_col))
    own = seeds(docs, id_col, text_col)
    n_docs = docs.count()
    share = min(1.0, SAMPLE / max(1, n_docs))
    sample = seeds(docs.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(share * 1_000_000)), id_col, text_col)
    with narrow_batches(docs.sparkSession):
        found = written(candidates(anchors(own, sample, share)))
    keys, found = found.where("key <> 0"), found.where("key = 0").drop("key")
    covers = found.where("cover").select(F.col("b").alias(id_col), F.col("q0").alias("start"), F.col("q1").alias("end"), F.col("a").alias("partner"), F.col("p0").alias("partner_start"), F.lit(None).cast("double").alias("identity"))
    first = written(_aligned(docs, found.where("not cover and not late"), id_col, text_col, n_docs).unionByName(covers))
    late = written(_outside(found.where("late"), first.select(F.col(id_col).alias("b"), F.col("start").alias("q0"), F.col("end").alias("q1"))))
    first = first if late.isEmpty() else written(first.unionByName(_aligned(docs, late, id_col, text_col, n_docs)))
    return first.unionByName(_unchained(docs, keys, first, id_col, text_col))


def _unchained(docs: DataFrame, keys: DataFrame, first: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The passages around joint seeds that lie outside those found first."""
    import pyspark.sql.types as T

    # a key's place in its first holder, and how far the places of the others lie from it at its beginning and its end
    rows = keys.select("key", F.col("b").alias("id"), "q0", "q1", "late")
    order = Window.partitionBy("key").orderBy("id", "q0").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"f": F.first(F.struct("id", "q0", "q1")).over(order), "most": F.max(F.when(F.col("late"), F.col("id"))).over(order)}).where("f.id < most")
    rows = rows.select(F.col("f.id").alias("home"), F.floor(F.col("f.q0") / GRID).cast("int").alias("cell"), "id", (F.col("q0") - F.col("f.q0")).alias("d0"), (F.col("q1") - F.col("f.q1")).alias("d1"), "q0", "q1", "late")
    todo = rows.groupBy("home", "cell", "id", "d0", "d1").agg(F.min("q0").alias("q0"), F.max("q1").alias("q1"), F.max("late").alias("late"))
    spans = first.select(F.col(id_col).alias("b"), F.col("start").alias("q0"), F.col("end").alias("q1"))
    todo = written(_within(todo.withColumnRenamed("id", "b"), spans).withColumn("late", F.col("late") & ~F.col("inside")).withColumnRenamed("b", "id").drop("inside"))
    if todo.where("late").isEmpty():
        return first.limit(0)
    todo = todo.join(todo.where("late").groupBy("home", "cell").agg(F.max("id").alias("most")), ["home", "cell"]).where("id < most or late").drop("most")
    kind = docs.schema[id_col].dataType
    around = T.StructType([T.StructField("home", kind), T.StructField("cell", T.IntegerType()), T.StructField("id", kind), *(T.StructField(c, T.IntegerType()) for c in ("d0", "d1", "q0", "q1", "s")), T.StructField("late", T.BooleanType()), T.StructField("words", T.BinaryType())])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for d, t, *own in batch[["d", "t", *parts]].itertuples(index=False, name=None):
                h = hashes(t).astype(np.uint32)
                for home, cell, d0, d1, q0, q1, late in zip(*(x.tolist() for x in own), strict=True):
                    s = max(q0 - MARGIN, 0)
                    rows.append((home, cell, d, d0, d1, q0, q1, s, late, h[s : q1 + MARGIN].tobytes()))
            yield pd.DataFrame(rows, columns=around.names)

    parts = ["home", "cell", "d0", "d1", "q0", "q1", "late"]
    spans = todo.groupBy(F.col("id").alias("d")).agg(F.collect_list(F.struct(*parts)).alias("w")).select("d", *(F.col(f"w.{c}").alias(c) for c in parts))
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    members = written(texts.join(spans, "d").mapInPandas(cut, around))
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("partner", kind), T.StructField("partner_start", T.IntegerType()), T.StructField("identity", T.DoubleType())])
    dealt = deal(members, ["home", "cell"], "id", BLOCK, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much to compare
    return dealt.mapInPandas(lambda batches: by_group(batches, ["home", "cell", "p", "q"], lambda own: pd.DataFrame(_against(own), columns=schema.names), 10_000), schema).distinct()


def _against(own: pd.DataFrame) -> list[tuple]:
    """Passages among the members of groups, as passages() has them: each late one against all earlier ones where their seeds meet. What two texts have in one group
    hangs on this group alone."""
    keys = ["home", "cell", "p", "q"]
    own = own.iloc[np.lexsort((*(own[c].to_numpy() for c in ("d1", "d0", "q1", "q0")), group_numbers(own, [*keys, "id"])))]
    ids, s, d0, d1, q0, q1, late, side = (own[c].to_numpy() for c in ("id", "s", "d0", "d1", "q0", "q1", "late", "side"))
    words = [np.frombuffer(w, np.uint32) for w in own["words"]]
    group, text = group_numbers(own, keys), group_numbers(own, [*keys, "id"])
    group_begins, text_begins = (np.searchsorted(x, np.arange(x[-1] + 1), "left") for x in (group, text))
    sets, lost = _bits(words)
    texts, same_words = Texts(words), pd.factorize(own["words"].to_numpy())[0]
    g0, g1 = q0 - d0, q1 - d1  # two with an equal key have it at equal distances from its place in the first holder
    found, held, size = [], [], 0

    def tried() -> None:
        b, k, low, high = (np.concatenate(x) for x in zip(*held, strict=True))
        mine, other = np.stack([low + d0[b] - s[b], high + d1[b] - s[b]], axis=1), np.stack([low + d0[k] - s[k], high + d1[k] - s[k]], axis=1)
        apart = other - mine
        number, one = _numbers(same_words[b], same_words[k], mine, other)  # texts that go round and round have the same words at many places
        good = on_diagonals(texts, b[one], k[one], mine[one], apart[one].min(axis=1), apart[one].max(axis=1))[number]
        found.append(np.column_stack([b, k, mine, other])[good])

    for b in np.flatnonzero(late):
        begin, end = group_begins[group[b]], text_begins[text[b]]  # rows of earlier texts
        meet = np.minimum(g1[begin:end], g1[b]) - np.maximum(g0[begin:end], g0[b]) >= _SPAN - d1[b] + d0[b]
        if side[b] >= 0:
            meet &= side[begin:end] != side[b]
        a = np.flatnonzero(meet) + begin
        a = a[np.bitwise_count(sets[a] & sets[b]).sum(axis=1) >= IDENTITY * MIN_WORDS - lost[b]]
        if len(a):
            held.append((np.full(len(a), b), a, np.maximum(g0[a], g0[b]), np.minimum(g1[a], g1[b])))
            size += len(a)
        if size > 100_000:
            tried()
            held, size = [], 0
    if held:
        tried()
    todo = np.concatenate(found) if found else np.zeros((0, 6), np.int64)
    if not len(todo):
        return []
    order = np.lexsort((text[todo[:, 1]], text[todo[:, 0]]))
    return _first_of_each(todo[order], text, s, ids, words, same_words)


def _numbers(x: np.ndarray, y: np.ndarray, mine: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row, the same for equal rows, and a row of each number."""
    rows = np.column_stack([x, y, mine, other])
    order = np.lexsort(rows.T)
    new = np.r_[True, (np.diff(rows[order], axis=0) != 0).any(axis=1)][: len(rows)]
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _first_of_each(todo: np.ndarray, text: np.ndarray, s: np.ndarray, ids: np.ndarray, words: list[np.ndarray], same_words: np.ndarray) -> list[tuple]:
    """The passages at the places of todo (two rows, spans in both), by the two texts. Of the places of two texts the first is aligned; what it finds may hold the next
    ones, which aren't then. Places with the same words around them are aligned once."""
    new = np.flatnonzero(np.r_[True, (np.diff(text[todo[:, 0]]) != 0) | (np.diff(text[todo[:, 1]]) != 0)])
    begins, ends = todo[:, 2] + s[todo[:, 0]], todo[:, 3] + s[todo[:, 0]]
    number, _ = _numbers(same_words[todo[:, 0]], same_words[todo[:, 1]], todo[:, 2:4], todo[:, 4:])
    held, number, known = np.zeros(len(todo), bool), number.tolist(), {}
    out, active = [], list(zip(new.tolist(), np.r_[new[1:], len(todo)].tolist(), strict=True))
    while active:
        turn = []
        for at, end in active:
            while at < end and (held[at] or known.get(number[at], True) is None):
                at += 1
            if at < end:
                turn.append((at, end))
        ask = list({number[at]: at for at, _ in turn if number[at] not in known}.values())
        for some in (ask[i : i + 5000] for i in range(0, len(ask), 5000)):
            for at, got in zip(some, align_all([(words[b], words[k], (x, y), (z, w)) for b, k, x, y, z, w in todo[some].tolist()]), strict=True):
                known[number[at]] = got if got[1] - got[0] >= MIN_WORDS and got[4] >= IDENTITY else None
        for at, end in turn:
            if known[number[at]] is not None:
                (b, k), (i, j, m, _, same) = todo[at, :2].tolist(), known[number[at]]
                held[at:end] |= (begins[at:end] >= i + s[b]) & (ends[at:end] <= j + s[b])
                out.append((ids[b], int(i + s[b]), int(j + s[b]), ids[k], int(m + s[k]), float(same)))
        active = [(at + 1, end) for at, end in turn if at + 1 < end]
    return out


def _possible(pairs: list[tuple]) -> list[tuple]:
    """Those of pairs, which end with x, y and their spans, that possible_all() lets through."""
    spans = ((p[-1], [p[-1][3][e] - p[-1][2][e] for e in (0, 1)]) for p in pairs)
    return [p for p, good in zip(pairs, possible_all([(x, y, own, min(ends), max(ends)) for (x, y, own, _), ends in spans]).tolist(), strict=True) if good]


def _bits(words: list[np.ndarray], size: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """A set of bits for each text, one a word (equal words of a text count each), and how many words share a bit with another. With w words in common two sets share
    w bits less those."""
    n = np.array([len(w) for w in words])
    row, flat = np.repeat(np.arange(len(words)), n), np.concatenate(words).astype(np.uint64)
    order = np.lexsort((flat, row))
    row, flat = row[order], flat[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (flat[1:] != flat[:-1])]) if len(row) else np.zeros(0, np.int64)
    nth = np.arange(len(row)) - np.repeat(new, np.diff(np.r_[new, len(row)]))
    bit = ((flat * np.uint64(0x9E3779B97F4A7C15) + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)) % np.uint64(size)
    sets = np.zeros((len(words), size), bool)
    sets[row, bit.astype(np.int64)] = True
    return np.packbits(sets, axis=1).view(np.uint64), n - sets.sum(axis=1)


def _within(late: DataFrame, spans: DataFrame) -> DataFrame:
    """late with a column inside: whether a row lies in a span of its document b. One sweep a document, as no earlier beginning reaches further than the greatest end so far."""
    reach = F.max(F.when(F.col("late").isNull(), F.col("q1"))).over(Window.partitionBy("b").orderBy("q0", F.col("late").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = late.unionByName(spans, allowMissingColumns=True).withColumn("inside", F.coalesce(reach >= F.col("q1"), F.lit(False)))
    return rows.where("late is not null").select(*late.columns, "inside")


def _outside(late: DataFrame, spans: DataFrame) -> DataFrame:
    """late without the rows that lie in a span of their document."""
    return _within(late, spans).where("not inside").drop("inside")


def _aligned(docs: DataFrame, todo: DataFrame, id_col: str, text_col: str, n_docs: int) -> DataFrame:
    """The passages that aligning the chains of todo (a table that is read several times) gives. Each text is read once for all that is cut from it: the words around its
    chains, and once each the spans in which others have chains with it, which meet those chains' words. Spans with over BLOCK chains are dealt."""
    import pyspark.sql.types as T

    floor = lambda c: (F.floor(F.greatest(F.col(c) - MARGIN, F.lit(0)) / GRID) * GRID).cast("int")
    ceil = lambda c: (F.ceil((F.col(c) + MARGIN) / GRID) * GRID).cast("int")
    todo = todo.select("b", "a", "q0", "q1", "p0", "p1", floor("q0").alias("qs"), ceil("q1").alias("qe"), floor("p0").alias("ps"), ceil("p1").alias("pe"))
    span = ["a", "ps", "pe"]
    large = durable(todo.groupBy(*span).count().where(F.col("count") > BLOCK).select(*span, F.ceil(F.col("count") / BLOCK).alias("parts")))
    todo = todo.withColumn("part", F.lit(0)) if large.isEmpty() else todo.join(F.broadcast(large), span, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"), F.lit(0)))
    places = ["q0", "q1", "p0", "p1", "qs", "qe", "ps", "pe", "part"]
    others = todo.select(*span, "part").distinct().select(F.col("a").alias("d"), "a", *(F.lit(-1).alias(c) for c in places[:4]), F.col("ps").alias("qs"), F.col("pe").alias("qe"), "ps", "pe", "part")
    wanted = todo.select(F.col("b").alias("d"), "a", *places).unionByName(others).groupBy("d").agg(F.collect_list(F.struct("a", *places)).alias("w"))
    wanted = wanted.select("d", *(F.col(f"w.{c}").alias(c) for c in ("a", *places)))
    few = todo.count() <= min(FEW, n_docs // 10)
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(wanted) if few else wanted, "d")
    kind = docs.schema[id_col].dataType
    cut_schema = T.StructType([T.StructField("b", kind), T.StructField("a", kind), *(T.StructField(c, T.IntegerType()) for c in places), T.StructField("words", T.BinaryType())])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            out = pd.DataFrame({"b": np.repeat(batch["d"].to_numpy(), batch["part"].map(len)), **{c: np.concatenate(batch[c].to_numpy()) for c in ("a", *places)}})
            words = []
            for t, s, e in zip(batch["t"], batch["qs"], batch["qe"], strict=True):
                h = hashes(t).astype(np.uint32)
                words += [h[i:j].tobytes() for i, j in zip(s.tolist(), e.tolist(), strict=True)]
            out["words"] = words
            yield out[cut_schema.names]

    keys = [*span, "part"]
    sent = texts.select("d", "t", "a", *places).mapInPandas(cut, cut_schema).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, "q0")
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("partner", kind), T.StructField("partner_start", T.IntegerType()), T.StructField("identity", T.DoubleType())])

    def work(own: pd.DataFrame) -> pd.DataFrame:
        other, pairs, out = np.zeros(0, np.uint32), [], []
        for b, a, q0, q1, p0, p1, qs, ps, words in own[["b", "a", "q0", "q1", "p0", "p1", "qs", "ps", "words"]].itertuples(index=False, name=None):
            words = np.frombuffer(words, np.uint32)
            if q0 < 0:  # the span in the other text, which comes first
                other = words
            else:
                pairs.append((b, a, qs, ps, (words, other, (q0 - qs, q1 - qs), (p0 - ps, p1 - ps))))
        pairs = _possible(pairs)
        for (b, a, qs, ps, _), (q0, q1, p0, _, same) in zip(pairs, align_all([p[-1] for p in pairs]), strict=True):
            if q1 - q0 >= MIN_WORDS and same >= IDENTITY:
                out.append((b, q0 + qs, q1 + qs, a, p0 + ps, same))
        return pd.DataFrame(out, columns=schema.names)

    return sent.mapInPandas(lambda batches: by_group(batches, keys, work, 1000), schema)


def remove_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """docs without the words of found's spans; count_col, where there is one, is the new length. A text that is all passage is dropped."""
    small_batches(docs.sparkSession)
    spans = found.groupBy(F.col(id_col).alias("__d")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))

    @F.pandas_udf("string")
    def without(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
        return pd.Series([t if own is None or t is None else cut_words(t, [(r["start"], r["end"]) for r in own]) for t, own in zip(texts, all_spans, strict=True)], dtype=object)

    repeated = _repeated(docs, id_col)
    if not repeated.isEmpty():  # spans are those of the text that was read
        texts = docs.where(F.col(text_col).isNotNull()).join(repeated, id_col, "left_semi")
        read = texts.groupBy(F.col(id_col).alias("__r")).agg(F.min(_ranked(text_col)).alias("x")).select("__r", F.col("x.h").alias("__h"))
        spans = spans.join(read, F.col("__d") == F.col("__r"), "left").select("__d", "__spans", "__h")
    else:
        spans = spans.withColumn("__h", F.lit(None).cast("long"))
    rows = docs.join(spans, docs[id_col] == spans["__d"], "left")
    rows = rows.withColumn("__spans", F.when(F.col("__h").isNull() | (F.col("__h") == F.xxhash64(F.col(text_col).cast("string"))), F.col("__spans")))
    rows = rows.withColumn("__t", F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(without(text_col, "__spans")))
    rows = rows.where(F.col("__spans").isNull() | (F.length("__t") > 0))
    counted = {count_col: F.when(F.col("__spans").isNull(), F.col(count_col)).otherwise(F.length("__t").cast(docs.schema[count_col].dataType))} if count_col in docs.columns else {}
    return rows.withColumns({text_col: F.col("__t"), **counted}).select(*docs.columns)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each; what is left keeps its own."""
    import re

    places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, at = [], 0
    for start, end in sorted(spans):
        if start < len(places):
            first = places[start][0]
            last = places[end][0] if end < len(places) else len(text)
            out.append(text[at : max(at, first)])
            at = max(at, last)
    out.append(text[at:])
    left = "".join(out)
    return left if left.strip(" \t\n\x0b\f\r") else ""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: Chaining and alignment can't be written in SQL; tests plant passages and compare with a brute-force search.
ORACLE_SQL = None
