"""Centroid clusters and prefix tries: against DuckDB on the small tables, plain Python at the edges, and small parts on their own."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest

from spindrel.llm import centroid_clusters, prefix_trie

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("module", "table"), [(centroid_clusters, "embeddings"), (prefix_trie, "conversations")])
def test_oracle(spark, module, table):
    db = duckdb.connect()
    db.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    frame = module.query(spark, DATA)
    found = db.execute(module.ORACLE_SQL)
    own = [d[0] for d in found.description]
    assert sorted(own) == sorted(frame.columns)
    rows = frame.select(*own).collect()
    assert rows and sorted(map(repr, map(tuple, rows))) == sorted(map(repr, found.fetchall()))


# ---- centroids


def _lloyd(rows, k, rounds, width, scale):
    """Every vector against every centroid, in Python's whole numbers."""
    good = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    rank = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(good, key=rank)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in good]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(good, own, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in good]
    total = {}
    for _, c, d in found:
        total[c] = total.get(c, 0) + d
    return sorted(map(repr, ((i, c, d, total[c], sum(total.values()), centroid_clusters.digest(centroids[c])) for i, c, d in found)))


def _got(spark, rows, **ways):
    table = spark.createDataFrame([(i, v, "x", 7, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, cluster string, owner long, id int, x double")
    return sorted(map(repr, (tuple(r) for r in centroid_clusters.report(table, **ways).collect())))


def test_clusters_at_the_edges(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, [1.0, nan, 0.0]), (902, [1.0, None, 0.0]), (903, [inf, 0.0, 0.0]), (904, [1.0, 2.0]), (905, []), (None, [0.5, 0.5, 0.5]), (906, [0.0, -0.0, 0.0])]
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=3)]) for k in range(120)] + [(5, [0.25, 0.25, 0.25])] * 3 + [(k, [0.5, 0.5, 0.5]) for k in range(200, 260)] + [(2**60 + 1, [9.0, 9.0, 9.0])] + odd
    for ways in ({"k": 5, "rounds": 6}, {"k": 5, "rounds": 0}):
        assert _got(spark, rows, width=3, scale=64, **ways) == _lloyd(rows, ways["k"], ways["rounds"], 3, 64)
    few = [(1, [0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 1.0])]  # fewer than centroids, two of them equal
    assert _got(spark, few, k=16, rounds=2, width=3) == _lloyd(few, 16, 2, 3, 64)
    assert _got(spark, odd[:6], width=3) == []
    big = [(1, [1e6, -1e6, 0.0]), (2, [1e6, -1e6, 3.0]), (3, [-1e6, 1e6, 0.0])]  # beyond what doubles sum exactly
    assert _got(spark, big, k=2, rounds=2, width=3) == _lloyd(big, 2, 2, 3, 64)
    with pytest.raises(Exception, match="a component is beyond"):
        _got(spark, [(1, [1e30, 0.0, 0.0])], width=3)


def test_only_what_can_change_is_compared(monkeypatch):
    rng = np.random.default_rng(1)
    x, centroids = rng.integers(-64, 64, (500, 8)), rng.integers(-64, 64, (6, 8))
    owner, far = centroid_clusters.reassign(x, np.full(500, -1), np.zeros(500, np.int64), centroids, np.ones(6, bool))
    moved = np.array([False, True, False, False, True, False])
    after = centroids + moved[:, None] * rng.integers(-20, 20, (6, 8))
    seen = []
    plain = centroid_clusters.distances
    monkeypatch.setattr(centroid_clusters, "distances", lambda a, c: seen.append((len(a), len(c))) or plain(a, c))
    got = centroid_clusters.reassign(x, owner, far, after, moved)
    want = ((x[:, None, :] - after[None]) ** 2).sum(axis=2)
    assert (got[0] == want.argmin(axis=1)).all() and (got[1] == want.min(axis=1)).all()
    lost = int(moved[owner].sum())
    assert seen == [(lost, 6), (500 - lost, 2)]


# ---- tries


def _trie(rows, heads=6, block=100):
    """Nodes by plain dictionaries of tuples."""
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, v in own.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % heads if heads else 0
        paths[c] = tuple(own.get(c - int(np.fmod(c, block)), [])[:h] + v[h:])
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    kids = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(p))
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p], sum(not kids[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def _conversations():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if t < 3 else f"t{t} {c % 4}") for c in range(0, 40) for t in range(c % 7)]
    rows += [(c, t, "user", "the same 😀") for c in range(500, 560) for t in range(4)]  # copies
    rows += [(700, t, "user", f"deep {t}") for t in range(60)] + [(701, t, "user", f"deep {t}") for t in range(45)]  # long, one the other's beginning
    rows += [(c, t, "user", "hub" if t == 0 else f"spoke {c}") for c in range(800, 850) for t in range(2)]  # one first turn, many children
    rows += [(3, None, None, None), (3, None, None, None), (4, 1, "user", "a tie"), (4, 1, "assistant", "a tie"), (4, 1, "assistant", "a sooner tie"), (None, 0, "user", "nobody's"), (-7, 0, "user", "negative"), (2**60 + 1, 0, "user", "é" * 3000), (901, 0, "", ""), (902, 0, None, None)]
    return rows


@pytest.mark.parametrize("most", [200_000, 8])
def test_tries_at_the_edges(spark, most):
    rows = _conversations()
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, c int, n string, ends string")
    sequences = prefix_trie.rebuilt(prefix_trie.labelled(table.repartition(5, "text")))
    assert sorted(map(repr, map(tuple, prefix_trie.trie_nodes(sequences, most).collect()))) == _trie(rows)


def test_tries_without_rebuilding_and_without_rows(spark):
    rows = _conversations()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(repr, map(tuple, prefix_trie.trie_nodes(prefix_trie.labelled(table)).collect()))) == _trie(rows, heads=0)
    assert prefix_trie.trie_nodes(prefix_trie.rebuilt(prefix_trie.labelled(table.limit(0)))).count() == 0


def test_bits_give_the_tree():
    parent = [0, 0, 0, 1, 1, 3, 4, 4, 4]  # of nodes 0, 1, ... in level order
    louds = prefix_trie.Louds(np.bincount(parent[1:], minlength=len(parent)))
    assert louds.parents().tolist() == parent and louds.degrees().tolist() == [2, 2, 0, 1, 3, 0, 0, 0, 0]
    assert louds.length == 2 * len(parent) - 1 and len(louds.bits) == 3


def test_member_digests_are_streamed(spark):
    members = spark.range(30_000).selectExpr("if(id < 25000, 1L, id) as k1", "0L as k2", "id * 7 - 50000 as c")
    got = {r["k1"]: r["ends"] for r in prefix_trie.member_digests(members).collect()}
    assert len(got) == 5001 and got[1] == hashlib.sha256(",".join(str(k * 7 - 50000) for k in range(25_000)).encode()).hexdigest()
    assert got[29_999] == hashlib.sha256(str(29_999 * 7 - 50000).encode()).hexdigest()
