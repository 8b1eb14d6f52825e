"""Toxicity by class-conditional Kneser-Ney models of words' letters.

Two models, of toxic and of ordinary documents, give a word its likelihood symbol after symbol: each symbol given all that came before it in
the word (at most ``ORDER`` - 1 symbols, the word's begin among them). A class counts in how many of its documents a word stands, so one text
that repeats itself says no more than any other. What a class hasn't seen often enough backs off to one model that the classes share, whose
counts are continuations (Kneser and Ney: in how many surroundings something was seen, not how often), so rare expressions and unknown
words are smoothed alike for either class. The discount is one whole observation: what was seen once counts for the back-off alone, and
a context in which nothing was seen twice says nothing by itself, so neither needs a place in the model.

A document is read as ordinary text in which a share ``SHARE`` of the words may come from the toxic model: its value is the mean over its words
of log(1 - SHARE + SHARE * toxic likelihood / ordinary likelihood), the length-normalised difference of two log-likelihoods. A
logistic curve over it and over the evidence (it times the words), fitted on documents that the counts leave out, makes it a score. Without
the mixture, whole likelihoods tell languages apart, not insults (held-out AUC 0.71 on sf0.1, 0.98 with it).

The counts are over all labelled documents outside the held-out fold but those of the curve: words are counted by Spark, their symbol sequences
from the distinct words, the model's tables by slots of a hash. ``SLOTS`` bounds what goes to the workers (nine tables of floats, 75 MB);
sequences that share a slot add up, none is left out. Only the curve is fitted on a bounded sample, ``CURVE`` rows with the smallest id hashes.

Cases: a word is a run of letters and digits, lower-cased; of over ``LONGEST`` symbols it counts as several. Null and empty texts and those without
a word get the share of label 1 among the learned rows, and so does every text where either class has no document; 0.5 where there are
no labels at all. Labels that are null, or of ids without a row, aren't learned; contradicting repeated labels each count. Rows with a
null id count as outside the held-out fold and aren't learned from. Repeated rows score alike; an empty table gives an empty result. Only the
text reaches a score, whatever other columns are called.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrel.llm.common import discard, fold, texts_of, with_id_type, written

ORDER = 12
SHARE = 0.005
SLOTS = 2**21
CURVE = 4000
FOLDS, HELD_OUT = 3, 1
#: One of so many of the rows to learn from is for the curve.
CURVE_PART = 4
THRESHOLD = 0.7
LONGEST = 40
#: Words that a worker remembers, words whose symbols it looks at together, and characters it splits at once: bounds on memory.
KNOWN, _WORDS, _CHARS = 500_000, 50_000, 1 << 20
#: Orders of the shared model that are counted at once.
_TOGETHER = 3
_WORD = re.compile(rf"[^\W_]{{1,{LONGEST}}}")
_GAP = re.compile(r"[\W_]")
_BEGIN, _END = "\x02", "\x03"
#: Odd numbers that hashes multiply by, and what the shared model gives a symbol that it knows nothing of.
_BASE, _MIX1, _MIX2, _EVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 1 / 300


def blocks(text: str | None) -> Iterator[str]:
    """A whole text, lower-cased, in blocks; a block ends where no word goes on."""
    text, at = text or "", 0
    while at < len(text):
        gap = _GAP.search(text, at + _CHARS) if at + _CHARS < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end].lower()
        at = end


def words_in(block: str) -> list[str]:
    return _WORD.findall(block)


class Symbols:
    """The symbols of many words, begin and end included, and hashes of what ends at each of them. power: of the hash's base."""

    def __init__(self, words: list[str], order: int):
        joined = [_BEGIN + w + _END for w in words]
        size = np.array([len(w) for w in joined], np.int64)
        code = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.place = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)  # in the word
        self.word = np.repeat(np.arange(len(words)), size)
        self.last = [np.zeros(len(code), np.uint64)]  # last[k]: of the k symbols that end here, where the word has them
        power = np.ones(1, np.uint64)
        for k in range(1, order + 1):
            back = np.zeros(len(code), np.uint64)
            back[k - 1 :] = code[: max(0, len(code) - k + 1)]
            self.last.append(self.last[-1] + back * power)
            power = power * _BASE

    def key(self, k: int, at: np.ndarray, kind: int) -> np.ndarray:
        """Hash of the k symbols that end at these places, one for each kind of table."""
        h = (self.last[k][at] ^ np.uint64(((kind << 8) + k) * 0x51ED270B)) * _MIX1
        h ^= h >> np.uint64(31)
        h *= _MIX2
        return h ^ (h >> np.uint64(29))


#: Kinds of keys: sequences and contexts of the classes' models, and of the shared one.
OWN, OWN_AFTER, SHARED, SHARED_AFTER = range(4)


def count_words(texts: DataFrame) -> DataFrame:
    """word and in how many toxic (t) and ordinary (o) documents it stands. texts: __text, y."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, y in zip(batch["__text"], batch["y"], strict=True):
                seen[int(y)].update({w for block in blocks(text) for w in words_in(block)})
            words = list(seen[0] | seen[1])
            yield pd.DataFrame({"word": words, "t": [seen[1][w] for w in words], "o": [seen[0][w] for w in words]}, columns=["word", "t", "o"])

    return texts.select("__text", "y").mapInPandas(work, "word string, t long, o long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _together(words: DataFrame, work: Callable[[pd.DataFrame], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """work over some ten thousands of words at a time."""

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= _WORDS:
                yield from work(pd.concat(held, ignore_index=True))
                held, size = [], 0
        if size:
            yield from work(pd.concat(held, ignore_index=True))

    return words.mapInPandas(some, schema)


def count_own(words: DataFrame, order: int) -> DataFrame:
    """key, after, c0, c1: a sequence of the classes' models (a word's beginning, or ``order`` symbols), its context, and in how many of the toxic and ordinary documents' words it was seen."""

    def work(own: pd.DataFrame) -> Iterator[pd.DataFrame]:
        s = Symbols(own["word"].tolist(), order)
        for k in range(2, order + 1):
            at = np.flatnonzero(s.place + 1 == k) if k < order else np.flatnonzero(s.place + 1 >= k)
            key, first, which = np.unique(s.key(k, at, OWN).view(np.int64), return_index=True, return_inverse=True)
            t, o = (np.bincount(which, own[c].to_numpy()[s.word[at]], len(key)).astype(np.int64) for c in ("t", "o"))
            yield pd.DataFrame({"key": key, "after": s.key(k - 1, at[first] - 1, OWN_AFTER).view(np.int64), "t": t, "o": o})

    found = _together(words, work, "key long, after long, t long, o long")
    return found.groupBy("key", "after").agg(F.sum("t").alias("c0"), F.sum("o").alias("c1"))


def count_shared(words: DataFrame, orders: range) -> DataFrame:
    """key, after, c0, c1: a sequence of the shared model, its context, and (as c0) how many different symbols were seen before it."""

    def work(own: pd.DataFrame) -> Iterator[pd.DataFrame]:
        s = Symbols(own["word"].tolist(), orders[-1] + 1)
        for k in orders:
            at = np.flatnonzero(s.place >= k)
            before, first = np.unique(s.key(k + 1, at, SHARED).view(np.int64), return_index=True)
            at = at[first]
            yield pd.DataFrame({"key": s.key(k, at, SHARED).view(np.int64), "after": s.key(k - 1, at - 1, SHARED_AFTER).view(np.int64), "before": before})

    found = _together(words.select("word"), work, "key long, after long, before long").distinct()
    return found.groupBy("key", "after").agg(F.count(F.lit(1)).alias("c0"), F.lit(0).cast("long").alias("c1"))


#: The tables of a model. Of a sequence: what toxic and ordinary documents, and the shared model, saw of it beyond once; of a context: all that was seen in it, and what of it was seen beyond once.
_TABLES = {OWN: (("t", "o"), ("at", "ao", "st", "so")), SHARED: (("c", ""), ("ac", "", "sc", ""))}


def _fill(tables: dict[str, np.ndarray], kind: int, counts: DataFrame) -> None:
    """Add a table of counts to the model's tables, by slot; only what was seen beyond once, and contexts that hold such, has a place."""
    slots = len(tables["t"])
    rows = counts.withColumns({f"e{y}": F.greatest(F.col(f"c{y}") - 1, F.lit(0)) for y in (0, 1)})
    slot = lambda c: F.pmod(F.col(c), F.lit(slots)).cast("int").alias("slot")
    own = rows.where("e0 > 0 or e1 > 0").groupBy(slot("key")).agg(F.sum("e0").alias("v0"), F.sum("e1").alias("v1"), F.lit(0).alias("v2"), F.lit(0).alias("v3"))
    after = rows.groupBy("after").agg(*(F.sum(x).alias(x) for x in ("c0", "c1", "e0", "e1"))).where("e0 > 0 or e1 > 0")
    after = after.groupBy(slot("after")).agg(F.sum("e0").alias("v0"), F.sum("e1").alias("v1"), F.sum("c0").alias("v2"), F.sum("c1").alias("v3"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"slots": [batch["slot"].to_numpy(np.int32).tobytes()], "values": [batch[["v0", "v1", "v2", "v3"]].to_numpy(np.float32).tobytes()]})

    for names, part in zip(_TABLES[kind], (own, after), strict=True):
        for r in part.mapInPandas(pack, "slots binary, values binary").collect():  # 20 bytes a slot at most
            at, values = np.frombuffer(r["slots"], np.int32), np.frombuffer(r["values"], np.float32).reshape(-1, 4)
            for j, name in enumerate(names):
                if name:
                    tables[name][at] += values[:, j]


def learn(words: DataFrame, order: int = ORDER, slots: int = SLOTS) -> dict[str, np.ndarray]:
    """The tables of a model, from words with their counts t and o. The shared model is counted some orders at a time: what one shuffles is gone before the next."""
    tables = {name: np.zeros(slots, np.float32) for pair in _TABLES.values() for names in pair for name in names if name}
    steps = [(OWN, lambda: count_own(words, order)), *((SHARED, lambda k=k: count_shared(words, range(k, min(k + _TOGETHER, order)))) for k in range(1, order, _TOGETHER))]
    for kind, count in steps:
        counts = written(count())
        _fill(tables, kind, counts)
        discard(counts)
    return tables


class Model:
    """Log-likelihood ratios of words."""

    def __init__(self, tables: dict[str, np.ndarray], order: int = ORDER, share: float = SHARE):
        self.tables, self.order, self.share = tables, order, share
        self.slots = np.uint64(len(tables["t"]))
        self._held = None

    def __getstate__(self) -> dict:
        """Tables travel compressed: most slots are empty or hold small numbers."""
        return {"order": self.order, "share": self.share, "tables": {k: zlib.compress(v.tobytes(), 1) for k, v in self.tables.items()}}

    def __setstate__(self, state: dict) -> None:
        self.__init__({k: np.frombuffer(zlib.decompress(v), np.float32) for k, v in state["tables"].items()}, state["order"], state["share"])

    def on(self, spark: SparkSession) -> Broadcast:
        """The model on the workers, sent once."""
        if self._held is None:
            self._held = spark.sparkContext.broadcast(self)
        return self._held

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key % self.slots if int(self.slots) & (int(self.slots) - 1) else key & (self.slots - np.uint64(1))).astype(np.int64)

    def _mixed(self, seen: np.ndarray, beyond: np.ndarray, total: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """What was seen beyond once in its share of the context, the rest of the context as the lower model has it."""
        known = total > 0
        seen, beyond, safe = seen.astype(np.float64), beyond.astype(np.float64), np.where(known, total, 1).astype(np.float64)
        return np.where(known, seen / safe + (1 - beyond / safe) * lower, lower)

    def ratios(self, words: list[str]) -> np.ndarray:
        """log(toxic likelihood / ordinary likelihood) of each word."""
        t = self.tables
        s = Symbols(words, self.order)
        at = np.flatnonzero(s.place >= 1)
        place = s.place[at]
        shared = np.full(len(at), _EVEN)
        for k in range(1, self.order):
            some = place >= k
            here = at[some]
            own, after = self._slot(s.key(k, here, SHARED)), self._slot(s.key(k - 1, here - 1, SHARED_AFTER))
            shared[some] = self._mixed(t["c"][own], t["ac"][after], t["sc"][after], shared[some])
        out = np.zeros(len(at))
        for k in range(2, self.order + 1):
            some = place + 1 == k if k < self.order else place + 1 >= k
            here = at[some]
            own, after = self._slot(s.key(k, here, OWN)), self._slot(s.key(k - 1, here - 1, OWN_AFTER))
            toxic = self._mixed(t["t"][own], t["at"][after], t["st"][after], shared[some])
            ordinary = self._mixed(t["o"][own], t["ao"][after], t["so"][after], shared[some])
            out[some] = np.log(toxic / ordinary)
        return np.bincount(s.word[at], out, len(words))

    def gains(self, words: list[str]) -> np.ndarray:
        """What each word adds to a document's log-likelihood if a share of its words may be of the toxic model."""
        parts = [self.ratios(words[a : a + _WORDS]) for a in range(0, len(words), _WORDS)]
        ratio = np.concatenate(parts) if parts else np.zeros(0)
        return np.logaddexp(np.log1p(-self.share), np.log(self.share) + ratio)


class Reader:
    """Values of documents; remembers words while it may."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def values(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean gain over each text's words, and how many it has. Texts, or blocks of long ones, are looked up some at a time."""
        total, n, held, size = np.zeros(len(texts)), np.zeros(len(texts), np.int64), [], 0
        for k, text in enumerate(texts):
            for block in blocks(text):
                held.append((k, words_in(block)))
                size += len(block)
                if size >= _CHARS:
                    self._add(total, n, held)
                    held, size = [], 0
        self._add(total, n, held)
        return total / np.maximum(n, 1), n

    def _add(self, total: np.ndarray, n: np.ndarray, held: list[tuple[int, list[str]]]) -> None:
        if len(self.known) > KNOWN:
            self.known = {}
        new = list({w for _, words in held for w in words} - self.known.keys())
        self.known.update(zip(new, self.model.gains(new).tolist(), strict=True))
        for k, words in held:
            total[k] += sum(map(self.known.__getitem__, words))
            n[k] += len(words)


class Curve:
    """A logistic curve over the logarithms of a text's value and of its evidence (value times words: a short text's mean says less)."""

    def __init__(self, values: np.ndarray, words: np.ndarray, labels: np.ndarray, prior: float = 0.5):
        self.prior, self.weights = prior, None
        if len(labels) and 0 < labels.mean() < 1:
            x, w = self._features(values, words), np.zeros(3)
            for _ in range(100):  # Newton's steps; a small ridge holds the weights of classes that a plane parts
                p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
                step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), x.T @ (labels - p) - 1e-2 * w)
                w = w + np.clip(step, -5, 5)
                if np.abs(step).max() < 1e-8:
                    break
            self.weights = w

    def _features(self, values: np.ndarray, words: np.ndarray) -> np.ndarray:
        more = np.maximum(values, 0)
        return np.stack([np.ones(len(more)), np.log(more + 2e-3), np.log(more * words + 0.2)], axis=1)

    def scores(self, values: np.ndarray, words: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(values), self.prior)
        return np.where(words > 0, 1 / (1 + np.exp(-np.clip(self._features(values, words) @ self.weights, -50, 50))), self.prior)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", order: int = ORDER, slots: int = SLOTS, share: float = SHARE, curve_rows: int = CURVE) -> tuple[Model | None, Curve]:
    """The models and the curve; no model where a class has no document to learn from."""
    known = labels.where(F.col(label_col).isNotNull() & (fold(id_col, FOLDS) != HELD_OUT)).select(F.col(id_col).alias("__id"), (F.col(label_col) > 0).cast("int").alias("y"))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).where("__text is not null").join(known, "__id")
    part = F.floor(F.crc32(F.col("__id").cast("string").cast("binary")) / FOLDS) % CURVE_PART
    of_class = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    prior = of_class.get(1, 0) / sum(of_class.values()) if of_class else 0.5
    if len(of_class) < 2:
        return None, Curve(np.zeros(0), np.zeros(0), np.zeros(0), prior)
    words = written(count_words(texts_of(rows.where(part != 0), "__id", "__text", {"y": F.col("y")})))
    model = Model(learn(words, order, slots), order, share)
    chosen = rows.where(part == 0).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "y", F.xxhash64("__text")).limit(curve_rows)
    sample = _values(texts_of(chosen, "__id", "__text", {"y": F.col("y")}), model).collect()
    sample = sorted((r["value"], r["n"], r["y"]) for r in sample if r["n"])
    return model, Curve(*(np.array(x, float) for x in zip(*sample, strict=True)), prior) if sample else Curve(np.zeros(0), np.zeros(0), np.zeros(0), prior)


def _values(texts: DataFrame, model: Model) -> DataFrame:
    held = model.on(texts.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(held.value)
        for batch in batches:
            values, n = reader.values(batch["__text"].tolist())
            yield pd.DataFrame({"value": values, "n": n, "y": batch["y"].to_numpy()})

    return texts.mapInPandas(work, "value double, n long, y int")


def score(docs: DataFrame, model: Model | None, curve: Curve, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField("score", T.DoubleType())])
    texts = texts_of(docs, id_col, text_col)
    if model is None:
        return docs.select(F.col(id_col), F.lit(float(curve.prior)).alias("score"))
    held = model.on(docs.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(held.value)
        for batch in batches:
            values, n = reader.values(batch.iloc[:, 1].tolist())
            yield pd.DataFrame({id_col: batch.iloc[:, 0], "score": curve.scores(values, n)})

    return with_id_type(texts.mapInPandas(work, schema), docs, id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = score(docs, *fit(docs, labels))
    return found.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


#: Sums of logarithms over a text's letters can't be written in SQL; tests hold likelihoods against plain dictionaries and predictions against held-out labels.
ORACLE_SQL = None
