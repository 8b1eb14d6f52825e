"""The trie of conversations' prefixes: which openings are shared, by how many, and what sharing them saves.

A node is a distinct sequence of first turns. Texts move nowhere: a turn is a label of two 64-bit hashes of its role and text, and the text's
length. Equal conversations become one weighted sequence. A prefix below which there are over ``SHARD_TURNS`` turns (of distinct sequences) is
heavy; heavy prefixes make the upper levels. What hangs below them is cut into prefix shards, each whole subtrees, none with more than
``SHARD_TURNS`` turns. A task builds a shard's trie in numpy, level by level, as LOUDS bits (a node's children as ones, then a zero) with label
arrays; parents come from rank and select on the bits, and a reverse walk over the levels (``add.at``, ``minimum.at``) rolls up members, least
members, leaves and savings. The upper levels are grouped sums over prefixes, and their subtree sums come from pointer doubling: as many
rounds as the logarithm of their depth, each a join and a grouped sum. So a first turn that a third of all conversations share is cut where
they differ, and a conversation that a third are copies of is one sequence.

Digests of the members that end at a node are made over ids sorted by range: runs of ids are joined where they lie and a node's runs are
hashed one after another, so no list of members is in memory.

Cases: rows without a conversation id belong to no conversation. Null roles and texts are empty. Turns go by their number, null first; equal
numbers by role, then text (code points); rows that are the same in all count each. Conversations without turns end at the root. An empty
table has no node. Other columns don't matter, whatever their names. A conversation's labels (24 bytes a turn) stand in one row: that bounds
its length by what a task's memory holds (some ten million turns in 1 GB), not the number of its copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrel.llm.common import by_group, group_numbers, written
from spindrel.llm.graph import SALTS

#: Turns of distinct sequences that one shard holds at most, unless a single subtree's top has more in one sequence.
SHARD_TURNS = 200_000
LABEL = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i8")])
NOBODY = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_CUT = "kind int, t1 long, t2 long, u1 long, u2 long, depth int, chars long, labels binary, least long, n long, ends string"


def labelled(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """c and seq, the labels of its turns in order, for every conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("t"), text(role_col).alias("role"), text(text_col).alias("text")).where("c is not null")
    hashed = rows.select("c", "t", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "role", "text").alias("b"), F.length("text").cast("long").alias("n"))
    hashed = written(hashed)
    tied = written(hashed.groupBy("c", "t").agg(F.min("a").alias("a"), F.max("a").alias("z"), F.min("b").alias("b"), F.max("b").alias("y")).where("a <> z or b <> y").select(F.col("c").alias("tc"), F.col("t").alias("tt")))
    rank = F.lit(0)
    if not tied.isEmpty():  # only rows that share a turn's number with another text are ordered by their texts
        among = rows.join(tied, (F.col("c") == F.col("tc")) & F.col("t").eqNullSafe(F.col("tt")))
        order = among.select("c", F.col("t"), F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "role", "text").alias("b"), F.dense_rank().over(Window.partitionBy("c", "t").orderBy("role", "text")).alias("rank")).distinct()
        order = order.toDF("oc", "ot", "oa", "ob", "rank")
        hashed = hashed.join(order, (F.col("c") == F.col("oc")) & F.col("t").eqNullSafe(F.col("ot")) & (F.col("a") == F.col("oa")) & (F.col("b") == F.col("ob")), "left")
        rank = F.coalesce("rank", F.lit(0))
    place = F.row_number().over(Window.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), rank, "a", "b"))
    placed = hashed.select("c", F.struct(place.alias("p"), "a", "b", "n").alias("turn"))
    return placed.groupBy("c").agg(F.sort_array(F.collect_list("turn")).alias("seq"))


def rebuilt(sequences: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """Conversation c with its first h turns replaced by those of the first of its block, h = crc32 of c in decimal, modulo heads."""
    sequences = written(sequences)
    own = sequences.withColumn("base", F.col("c") - F.col("c") % block)
    first = own.where("c = base").select("base", F.slice("seq", 1, heads - 1).alias("first"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % heads).cast("int")
    nothing = F.array().cast(sequences.schema["seq"].dataType)
    start = F.slice(F.coalesce("first", nothing), F.lit(1), h)
    return own.join(first, "base", "left").select("c", F.concat(start, F.slice("seq", h + 1, F.size("seq"))).alias("seq"))


def prefix_keys(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every prefix, where its last turn stands; the root's are 0 and 0."""
    keys = []
    for lane, times in (("a", 0x9E3779B97F4A7C15), ("b", 0xD6E8FEB86659FD93)):
        label, out = flat[lane].astype(np.uint64), np.zeros(len(flat), np.uint64)
        now, order = np.zeros(len(size), np.uint64), np.argsort(-size, kind="stable")
        ends = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), "left")  # how many are longer than j
        for j, live in enumerate(ends):
            who = order[:live]
            x = now[who] * np.uint64(times) + label[start[who] + j] + np.uint64(1)
            x ^= x >> np.uint64(30)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(27)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
            now[who] = x
            out[start[who] + j] = x
        keys.append(out.astype(np.int64))
    return keys[0], keys[1]


def _flat(column: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of many sequences, where each begins, how many it has."""
    size = np.array([len(x) for x in column], np.int64) // LABEL.itemsize
    return np.frombuffer(b"".join(map(bytes, column)), LABEL), np.cumsum(size) - size, size


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        size = np.array([len(x) for x in batch["a"]], np.int64)
        flat = np.zeros(size.sum(), LABEL)
        for lane in ("a", "b", "n"):
            if len(flat):
                flat[lane] = np.concatenate([np.asarray(x, np.int64) for x in batch[lane]])
        start = np.cumsum(size) - size
        k1, k2 = prefix_keys(flat, start, size)
        last, some = np.maximum(start + size - 1, 0), size > 0
        at = lambda k: np.where(some, k[np.minimum(last, len(k) - 1)], 0) if len(k) else np.zeros(len(size), np.int64)  # noqa: B023, E731
        yield pd.DataFrame({"c": batch["c"], "k1": at(k1), "k2": at(k2), "labels": [flat[s : s + m].tobytes() for s, m in zip(start, size, strict=True)]})


def member_digests(members: DataFrame) -> DataFrame:
    """k1, k2 and the SHA-256 of the ids c of each key, in decimal, ascending, joined by commas."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            group = group_numbers(batch, ["k1", "k2"])
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
            ids = batch["c"].astype(str).tolist()
            first = cuts[:-1]
            yield pd.DataFrame({"k1": batch["k1"].to_numpy()[first], "k2": batch["k2"].to_numpy()[first], "c": batch["c"].to_numpy()[first], "ids": [",".join(ids[a:b]) for a, b in zip(first, cuts[1:], strict=True)]})

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(batch["k1"], batch["k2"], batch["ids"], strict=True):
                if (k1, k2) == key:
                    state.update(b"," + ids.encode())
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["k1", "k2", "ends"])
        if key:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=["k1", "k2", "ends"])

    lie = members.repartitionByRange("k1", "k2", "c").sortWithinPartitions("k1", "k2", "c").mapInPandas(runs, "k1 long, k2 long, c long, ids string")
    return lie.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "c").select("k1", "k2", "ids").mapInPandas(hashed, "k1 long, k2 long, ends string")


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """One row a distinct sequence: its labels, keys, least member, number of members and their digest."""
    lane = lambda x: F.transform("seq", lambda t: t[x]).alias(x)
    every = written(sequences.select("c", lane("a"), lane("b"), lane("n")).mapInPandas(_keyed, "c long, k1 long, k2 long, labels binary"))
    groups = every.groupBy("k1", "k2").agg(F.min("c").alias("least"), F.count(F.lit(1)).alias("n"))
    groups = groups.join(member_digests(every.select("k1", "k2", "c")), ["k1", "k2"])
    return written(every.select(F.col("c").alias("least"), "labels").join(groups.select("least", "n", "ends"), "least"))


def heavy_prefixes(distinct: DataFrame, most: int) -> DataFrame:
    """Keys of the prefixes with over ``most`` turns in and below their last one."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flat, start, size = _flat(batch["labels"])
            k1, k2 = prefix_keys(flat, start, size)
            left = np.repeat(start + size, size) - np.arange(len(flat))
            yield pd.DataFrame({"k1": k1, "k2": k2, "w": left}).groupby(["k1", "k2"], as_index=False, sort=False).sum()

    return written(distinct.select("labels").mapInPandas(weigh, "k1 long, k2 long, w long").groupBy("k1", "k2").agg(F.sum("w").alias("w")).where(F.col("w") > most).select("k1", "k2"))


def _spread(table: DataFrame) -> DataFrame:
    """A row for each salt: a key that very many rows look up then meets them in several tasks."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def routed(distinct: DataFrame, most: int) -> DataFrame:
    """distinct with up, how many of a sequence's first prefixes are heavy."""
    heavy = heavy_prefixes(distinct, most)
    if heavy.isEmpty():
        return distinct.withColumn("up", F.lit(0))

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flat, start, size = _flat(batch["labels"])
            k1, k2 = prefix_keys(flat, start, size)
            yield pd.DataFrame({"least": np.repeat(batch["least"].to_numpy(), size), "d": np.arange(len(flat)) - np.repeat(start, size) + 1, "k1": k1, "k2": k2})

    every = distinct.select("least", "labels").mapInPandas(prefixes, "least long, d int, k1 long, k2 long").withColumn("salt", F.pmod(F.xxhash64("least"), F.lit(SALTS)).cast("int"))
    up = every.join(_spread(heavy).hint("merge"), ["k1", "k2", "salt"]).groupBy("least").agg(F.max("d").alias("up"))
    return distinct.join(up, "least", "left").withColumn("up", F.coalesce("up", F.lit(0)))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """kind 0: a sequence's heavy prefixes, the root first; kind 1: the rest of it, below the last of them."""
    for batch in batches:
        flat, start, size = _flat(batch["labels"])
        k1, k2 = prefix_keys(flat, start, size)
        up, least, n, ends = (batch[x].to_numpy() for x in ("up", "least", "n", "ends"))
        who = np.repeat(np.arange(len(size)), up + 1)
        d = np.arange(len(who)) - np.repeat(np.cumsum(up + 1) - up - 1, up + 1)
        key = lambda k, s, at: np.where(at > 0, k[np.clip(start[s] + at - 1, 0, len(k) - 1)], 0) if len(k) else np.zeros(len(s), np.int64)  # noqa: B023, E731
        chars = np.where(d > 0, flat["n"][np.clip(start[who] + d - 1, 0, len(flat) - 1)], 0) if len(flat) else np.zeros(len(who), np.int64)
        yield pd.DataFrame({"kind": 0, "t1": key(k1, who, d), "t2": key(k2, who, d), "u1": key(k1, who, d - 1), "u2": key(k2, who, d - 1), "depth": d, "chars": chars, "labels": None, "least": least[who], "n": n[who], "ends": np.where(d == size[who], ends[who], None)})
        s = np.flatnonzero(size > up)
        if len(s):
            rest = [flat[start[i] + up[i] : start[i] + size[i]].tobytes() for i in s]
            yield pd.DataFrame({"kind": 1, "t1": key(k1, s, up[s] + 1), "t2": key(k2, s, up[s] + 1), "u1": key(k1, s, up[s]), "u2": key(k2, s, up[s]), "depth": up[s], "chars": 0, "labels": rest, "least": least[s], "n": n[s], "ends": ends[s]})


class Louds:
    """A tree in level order as bits: for each node a one per child, then a zero. Node 0 is the root; the i-th one (from 1) is node i."""

    def __init__(self, degrees: np.ndarray):
        self.nodes = len(degrees)
        bits = np.ones(2 * self.nodes - 1, bool)
        bits[np.cumsum(degrees) + np.arange(self.nodes)] = False
        self.bits, self.length = np.packbits(bits), len(bits)

    def _where(self, bit: bool) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.bits, count=self.length).astype(bool) == bit)

    def parents(self) -> np.ndarray:
        """Of every node but the root (select of its one, then the rank of zeros before it); the root's is itself."""
        ones = self._where(True)
        return np.r_[0, ones - np.arange(len(ones))]

    def degrees(self) -> np.ndarray:
        return np.diff(np.r_[-1, self._where(False)]) - 1


class Trie:
    """The tries of some shards below one unlabelled root. group: the top that a sequence lies below, equal ones side by side."""

    def __init__(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray):
        now, parents, labels, self.levels = group.astype(np.int64), [], [], [1]
        for j in range(size.max(initial=0)):
            live = np.flatnonzero(size > j)
            at = start[live] + j
            a, b = flat["a"][at], flat["b"][at]
            order = np.lexsort((b, a, now[live]))
            o, a, b, who = now[live][order], a[order], b[order], live[order]
            new = np.r_[True, (o[1:] != o[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            first = np.flatnonzero(new)
            parents.append(o[first] if j else np.zeros(len(first), np.int64))
            labels.append(flat[at[order][first]])
            now[who] = self.levels[-1] + np.cumsum(new) - 1
            self.levels.append(self.levels[-1] + len(first))
        self.labels = np.concatenate([np.zeros(1, LABEL), *labels])
        self.louds = Louds(np.bincount(np.concatenate(parents), minlength=self.levels[-1]) if parents else np.zeros(1, np.int64))
        self.ends = now  # the node of each sequence's last turn

    def upward(self, values: np.ndarray, how: np.ufunc = np.add) -> np.ndarray:
        """values rolled up: each node's with those of all below it, level by level from the lowest."""
        out, parents = values.copy(), self.louds.parents()
        for lo, hi in zip(self.levels[-2::-1], self.levels[:0:-1], strict=True):
            how.at(out, parents[lo:hi], out[lo:hi])
        return out


def shard_nodes(own: pd.DataFrame) -> pd.DataFrame:
    """Nodes of whole shards, rows of kind 1 sorted by their top."""
    flat, start, size = _flat(own["labels"])
    group = group_numbers(own, ["t1", "t2"])
    trie = Trie(flat, start, size, group)
    nodes, parents, degrees = trie.louds.nodes, trie.louds.parents(), trie.louds.degrees()
    n, least = np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max)
    np.add.at(n, trie.ends, own["n"].to_numpy())
    np.minimum.at(least, trie.ends, own["least"].to_numpy())
    n, least = trie.upward(n), trie.upward(least, np.minimum)
    leaves = trie.upward((degrees == 0).astype(np.int64))
    saved = trie.upward((n - 1) * trie.labels["n"])
    ends = np.full(nodes, NOBODY, object)
    ends[trie.ends] = own["ends"].to_numpy()
    level = np.repeat(np.arange(len(trie.levels)), np.diff(np.r_[0, trie.levels]))
    tops = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])  # first row of each group; tops are numbered as groups are
    of = np.zeros(nodes, np.int64)  # the group of each node
    of[1 : len(tops) + 1] = np.arange(len(tops))
    for lo, hi in zip(trie.levels[1:-1], trie.levels[2:], strict=True):
        of[lo:hi] = of[parents[lo:hi]]
    row = tops[of]
    top = level == 1
    got = {"conv_id": least, "depth": own["depth"].to_numpy()[row] + level, "parent_conv_id": pd.array(np.where(top, 0, least[parents]), "Int64"), "n_convs": n, "n_children": degrees, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": ends}
    out = pd.DataFrame(got | {"top": top, "u1": own["u1"].to_numpy()[row], "u2": own["u2"].to_numpy()[row]})
    return out.iloc[1:]


def _upper(heavy: DataFrame, tops: DataFrame) -> DataFrame:
    """Heavy nodes with children, leaves and savings of their subtrees. tops: of each heavy node, what hangs below it as shards."""
    kids = heavy.where("depth > 0").groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("kids")).toDF("t1", "t2", "kids")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    nodes = heavy.join(kids, ["t1", "t2"], "left").join(tops, ["t1", "t2"], "left")
    nodes = nodes.withColumn("n_children", zero("kids") + zero("hung"))
    nodes = written(nodes.withColumns({"leaves": zero("leaves") + (F.col("n_children") == 0).cast("long"), "saved": zero("saved") + (F.col("n") - 1) * F.col("chars")}).drop("kids", "hung"))
    # pointer doubling: sums over what is less than 2^k below, p the ancestor 2^k above (null: above the root)
    walk = nodes.select("t1", "t2", F.when(F.col("depth") > 0, F.col("u1")).alias("p1"), F.when(F.col("depth") > 0, F.col("u2")).alias("p2"), "leaves", "saved")
    while not walk.where("p1 is not null").isEmpty():
        more = walk.where("p1 is not null").groupBy("p1", "p2").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).toDF("t1", "t2", "l", "s")
        root = (F.col("p1") == 0) & (F.col("p2") == 0)  # most often looked up; nothing is above it
        above = walk.select(F.col("t1").alias("p1"), F.col("t2").alias("p2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        summed = walk.join(more, ["t1", "t2"], "left").select("t1", "t2", "p1", "p2", (F.col("leaves") + zero("l")).alias("leaves"), (F.col("saved") + zero("s")).alias("saved"))
        ended = summed.where(F.col("p1").isNull() | root).withColumns({"p1": F.lit(None).cast("long"), "p2": F.lit(None).cast("long")})
        going = summed.where(F.col("p1").isNotNull() & ~root).join(above, ["p1", "p2"]).select("t1", "t2", F.col("q1").alias("p1"), F.col("q2").alias("p2"), "leaves", "saved")
        walk = written(ended.unionByName(going))
    return written(nodes.drop("leaves", "saved").join(walk.select("t1", "t2", "leaves", "saved"), ["t1", "t2"]))


def trie_nodes(sequences: DataFrame, most: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of sequences (c, seq as labelled gives it): conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    parts = written(routed(distinct_sequences(sequences), most).select("labels", "up", "least", "n", "ends").mapInPandas(_cut, _CUT))
    upper = parts.where("kind = 0").groupBy("t1", "t2").agg(*(F.min(x).alias(x) for x in ("u1", "u2", "depth", "chars", "least")), F.sum("n").alias("n"), F.max("ends").alias("ends"))
    upper = written(upper)
    root = upper.where("depth = 0").select("least").first()
    if root is None:
        return spark.createDataFrame([], _NODE)
    light = parts.where("kind = 1").repartition("t1", "t2").sortWithinPartitions("t1", "t2")
    light = written(light.mapInPandas(lambda batches: by_group(batches, ["t1", "t2"], shard_nodes), f"{_NODE}, top boolean, u1 long, u2 long"))
    tops = light.where("top").groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("hung"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).toDF("t1", "t2", "hung", "leaves", "saved")
    upper = _upper(upper, tops)
    names = [x.split()[0] for x in _NODE.split(", ")]
    own = upper.select(F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"), "u1", "u2")
    below = light.where("top").drop("top").unionByName(own.where("depth > 0"))
    at_root = (F.col("u1") == 0) & (F.col("u2") == 0)
    named = below.where(at_root).withColumn("parent_conv_id", F.lit(root["least"]).cast("long"))
    above = _spread(upper.where("depth > 0").select(F.col("t1").alias("u1"), F.col("t2").alias("u2"), F.col("least").alias("above")))
    deeper = below.where(~at_root).withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")).join(above.hint("merge"), ["u1", "u2", "salt"]).withColumn("parent_conv_id", F.col("above"))
    parts = [light.where("not top"), named, deeper, own.where("depth = 0")]
    out = parts[0].select(*names)
    for part in parts[1:]:
        out = out.unionByName(part.select(*names))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(rebuilt(labelled(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))))


#: The same in DuckDB: turns as a chain of MD5s along each rebuilt conversation, nodes as groups of chain values, subtrees as pairs of a node
#: and each of its ancestors. crc32 is worked out bit by bit (0xEDB88320).
ORACLE_SQL = """
with recursive own as materialized (
  select conv_id c, coalesce(role, '') role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) p
  from conversations where conv_id is not null),
ids as materialized (
  select c, c - c % 100 base, xor(list_reduce(
    [4294967295::bigint] || flatten(list_transform(string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda v, x: case when x >= 0 then xor(v, x) else xor(v >> 1, 3988292384 * (v & 1)) end), 4294967295) % 6 h
  from (select distinct c from own)),
mixed as (
  select i.c, o.p, o.role, o.text from ids i join own o on o.c = i.base and o.p <= i.h
  union all select i.c, o.p, o.role, o.text from ids i join own o on o.c = i.c and o.p > i.h),
seq as materialized (select c, row_number() over (partition by c order by p) d, md5(md5(role) || md5(text)) m, length(text) n from mixed),
chain as (
  select c, 0::bigint d, '' k, '' up, 0::bigint n from ids
  union all select s.c, s.d, md5(chain.k || s.m), chain.k, s.n::bigint from chain join seq s on s.c = chain.c and s.d = chain.d + 1),
steps as materialized (select * from chain),
ended as materialized (select c, max(d) d from steps group by c),
node as materialized (
  select a.k, min(a.c) conv_id, any_value(a.d) depth, any_value(a.up) up, any_value(a.n) n, count(*) n_convs,
    sha256(coalesce(string_agg(a.c::varchar, ',' order by a.c) filter (a.d = l.d), '')) ends_sha256
  from steps a join ended l on l.c = a.c group by a.k),
kids as materialized (select up k, count(*) n from node where depth > 0 group by up),
below as (
  select a.k, sum(case when kids.n is null then 1 else 0 end) n_leaves, sum((u.n_convs - 1) * u.n) saved_tokens
  from node u join steps a on a.c = u.conv_id and a.d <= u.depth left join kids on kids.k = u.k group by a.k)
select v.conv_id, v.depth, w.conv_id parent_conv_id, v.n_convs, coalesce(kids.n, 0)::bigint n_children, below.n_leaves::bigint n_leaves,
  below.saved_tokens::bigint saved_tokens, v.ends_sha256
from node v join below on below.k = v.k left join kids on kids.k = v.k left join node w on v.depth > 0 and w.k = v.up
"""
