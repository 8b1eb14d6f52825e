"""SimHash, embeddings, passages, components: against brute force."""

import random
import re
import time

import numpy as np
import pytest
import xxhash

from spindrel.llm import common, embedding_dedup, graph, simhash_dedup, substring_dedup


def _roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_local_components():
    rng = random.Random(3)
    for n, m in ((1, 0), (5, 3), (200, 150), (200, 900)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        a, b = np.array([x for x, _ in links], int), np.array([y for _, y in links], int)
        assert common.local_components(n, a, b).tolist() == _roots(n, links)


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(200, 320)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(70)] + [(7, 7)]
    table = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(table, "a", "b").collect()}
    want = _roots(500, links)
    assert got == {x: want[x] for a, b in links if a != b for x in (a, b)}
    assert graph.components(table.limit(0), "a", "b").count() == 0


def test_least_of_components(spark):
    nodes = spark.createDataFrame([(k, (k * 37) % 101) for k in range(100)], "node long, v long")
    links = [(1, k) for k in range(2, 60)] + [(70, 71)]
    got = {r["node"]: r["v"] for r in graph.least_of(nodes, graph.components(spark.createDataFrame(links, "a long, b long"), "a", "b"), "v").collect()}
    value = {k: (k * 37) % 101 for k in range(100)}
    assert got == {k: min(value[x] for x in range(1, 60)) if 1 <= k < 60 else min(value[70], value[71]) if k in (70, 71) else v for k, v in value.items()}


# --- SimHash ---


def _fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
    shingles = [" ".join(w[k : k + 4]) for k in range(len(w) - 3)] if len(w) > 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = [None, "", " \n", "one", "One", "one two three", "a b c d", "A  B\tC\nD", "a b c d e", "ÄÖ ä \xa0 x y", "w " * 70_000, "The quick brown fox " * 3]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash_dedup.fingerprint(text) == _fingerprint(text)


def _near(fps, radius=4):
    return [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius]


def _clustered(rng, centres, each, flips=6):
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        out += [c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(flips))) for _ in range(each)]
    return sorted({x & (2**64 - 1) for x in out})


def test_bit_sliced_forest_finds_all_links():
    rng = random.Random(9)
    for centres, each in ((1, 150), (30, 4), (3, 64), (2, 1)):
        fps = _clustered(rng, centres, each)
        group = np.zeros(len(fps), int)
        i, root = simhash_dedup.forest(np.array(fps, np.uint64), group, np.full(len(fps), -1))
        assert _roots(len(fps), zip(i.tolist(), root.tolist(), strict=True)) == _roots(len(fps), _near(fps))
    side = np.array([k % 2 for k in range(len(fps))])
    i, root = simhash_dedup.forest(np.array(fps, np.uint64), np.zeros(len(fps), int), side)
    assert all((fps[a] ^ fps[b]).bit_count() <= 4 * len(fps) for a, b in zip(i, root, strict=True))


def test_block_choices_cover_the_radius():
    rng = random.Random(1)
    for n in (10, 10**7, 10**10, 10**13):
        masks = simhash_dedup.choices(n)
        for _ in range(200):
            d = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(d & m == 0 for m in masks)


@pytest.mark.parametrize("sub_block", [10_000, 16])
def test_links(spark, sub_block):
    fps = _clustered(random.Random(4), 8, 30)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    got = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"), sub_block=sub_block).collect()
    at = {f: k for k, f in enumerate(signed)}
    assert _roots(len(fps), [(at[r["a"]], at[r["b"]]) for r in got]) == _roots(len(fps), _near(fps))
    assert len(got) < 40 * len(fps)  # forests, not pairs


def test_simhash_groups(spark):
    words = [f"w{k}" for k in range(300)]
    near = " ".join(words[:299] + ["other"])
    rows = [(k + 1, t, "x") for k, t in enumerate([*TEXTS, " ".join(words), near])]
    table = spark.createDataFrame([*rows, rows[6], (None, "one", "x"), (2**60 + 1, "far away from all else here", "x")], "doc_id long, text string, fp string")
    got = simhash_dedup.simhash_groups(table).collect()
    assert len(got) == len(rows) + 3 and {2**60 + 1, None} < {r["doc_id"] for r in got}
    fps = [_fingerprint(t) for _, t, _ in rows]
    want = _roots(len(rows), _near(fps))
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 2**60:
            k = r["doc_id"] - 1
            assert r["fingerprint"] == f"{fps[k]:016x}" and r["component_id"] == want[k] + 1
    assert simhash_dedup.simhash_groups(table.limit(0)).count() == 0


# --- embeddings ---


def _vectors(rng, n, width=16):
    centres = rng.standard_normal((n // 4, width))
    return np.concatenate([centres + 0.12 * rng.standard_normal((n // 4, width)) * rng.random() for _ in range(4)]).astype(np.float32)


@pytest.mark.parametrize("sub_block", [2048, 32])
def test_near_vectors(spark, sub_block):
    rng = np.random.default_rng(2)
    x = _vectors(rng, 240)
    x[50:90] = x[50] + 0.01 * rng.standard_normal((40, 16))  # a large near group
    x[100:120] = x[100]  # a large group of copies
    rows = [(k, v.tolist(), int(k % 7 == 0)) for k, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [1.0, None] + [1.0] * 14, 1), (904, x[100].tolist(), None), (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [float("inf")] + [0.0] * 15, 1), (906, [1.0, 2.0], 1)]
    table = spark.createDataFrame([(*r, "z") for r in rows + odd], "vec_id long, embedding array<float>, label int, n string")
    got = sorted(map(tuple, embedding_dedup.near_vectors(table, sub_block=sub_block).collect()))
    everything = [r for r in rows + odd if r[0] not in (900, 901, 902, 903, 904, 905, 908)]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) for _, v, _ in everything]
    pairs = [(i, j) for i in range(len(unit)) for j in range(i) if everything[i][2] == everything[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.93]
    root = _roots(len(unit), pairs)
    links = [sum(k in p for p in pairs) for k in range(len(unit))]
    want = sorted([(everything[k][0], links[k], everything[root[k]][0], everything[k][0] == everything[root[k]][0]) for k in range(len(unit))] + [(o, 0, o, True) for o in (900, 901, 902, 903, 904, 905, 908)])
    missed = sum(a[1] for a in want) - sum(a[1] for a in got)
    assert [g[0] for g in got] == [w[0] for w in want] and 0 <= missed <= 0.1 * sum(links) and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    if not missed:
        assert got == want
    assert embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_recall_on_pairs_near_the_threshold(spark):
    rng = np.random.default_rng(21)
    first = rng.standard_normal((5000, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    away = rng.standard_normal(first.shape)
    away -= (away * first).sum(axis=1, keepdims=True) * first
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.931, 0.96, (5000, 1))
    x = np.concatenate([first, cosine * first + np.sqrt(1 - cosine**2) * away]).astype(np.float32)
    label = np.tile(rng.integers(0, 3, 5000), 2)
    got = embedding_dedup.near_vectors(spark.createDataFrame([(k, v.tolist(), int(y)) for k, (v, y) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int")).collect()
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    due = np.zeros(len(x), int)
    for a in range(0, len(x), 1000):
        due[a : a + 1000] = ((unit[a : a + 1000] @ unit.T >= 0.93) & (label[a : a + 1000, None] == label[None, :])).sum(axis=1) - 1
    links = {r["vec_id"]: r["n_links"] for r in got}
    assert all(links[k] <= due[k] for k in range(len(x))) and due.sum() >= 10_000 and sum(links.values()) >= 0.98 * due.sum()


def test_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(3)
    a, b = rng.random(7), rng.random(9)
    cells = embedding_dedup.traverse(a, b, 63, 9)
    cost = [a[c // 9] + b[c % 9] for c in cells]
    assert sorted(cells) == list(range(63)) and all(x <= y + 1e-12 for x, y in zip(cost, cost[1:], strict=False))


# --- passages ---


def _prose(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(n)]


def test_minimizers_guarantee():
    rng = random.Random(8)
    shared = _prose(rng, substring_dedup.K + substring_dedup.WINDOW - 1)
    for _ in range(30):
        sets = []
        for _ in range(2):
            h = substring_dedup.k_mers(substring_dedup.hashes(" ".join(_prose(rng, 40) + shared + _prose(rng, 40))))
            sets.append({int(x) for x in h[substring_dedup.minimizers(h)]})
        assert sets[0] & sets[1]


def test_chains_are_best_and_collinear():
    parts = np.array([[0, 10, 0, 10], [12, 20, 13, 21], [15, 25, 400, 410], [300, 310, 30, 40]])
    found = substring_dedup.chains(parts)
    assert found[0] == (0, 20, 0, 21) and len(found) == 3
    # an equal run before, too far away, doesn't hide the one that can be reached
    reached = [[90, 115, 90, 115], [129, 178, 130, 179]]
    assert substring_dedup.chains(np.array(reached)) == [(90, 178, 90, 179)]
    assert substring_dedup.chains(np.array([[0, 48, 0, 48], *reached])) == [(90, 178, 90, 179), (0, 48, 0, 48)]


def test_fenwick_ranges():
    rng, n = random.Random(3), 37
    tree, plain = substring_dedup.Fenwick(n), [substring_dedup.Fenwick.NONE] * n
    for k in range(600):
        at = rng.randrange(n)
        if plain[at] == substring_dedup.Fenwick.NONE:
            plain[at] = (float(rng.randrange(50)), k)
            tree.put(at, plain[at])
        else:
            plain[at] = substring_dedup.Fenwick.NONE
            tree.drop(at)
        low, high = sorted((rng.randrange(n + 1), rng.randrange(n + 1)))
        assert tree.within(low, high) == max(plain[low:high], default=substring_dedup.Fenwick.NONE)


def test_chains_score_as_by_trying_all_predecessors():
    rng, K, gap, cost = random.Random(4), substring_dedup.K, substring_dedup.MOST_GAP, substring_dedup.GAP_COST
    for _ in range(60):
        rows = []
        for _ in range(rng.randrange(1, 60)):
            q, p, length = rng.randrange(250), rng.randrange(250), K + rng.randrange(30)
            rows.append([q, q + length, p, p + length])
        rows.sort()
        best = {}
        for k in sorted(range(len(rows)), key=lambda k: rows[k][0]):
            q0, q1, p0, _ = rows[k]
            before = [best[j] - cost * ((q0 - b[1]) + (p0 - b[3])) / 2 for j, b in enumerate(rows) if b[1] - K + 1 <= q0 <= b[1] + gap and b[3] - K + 1 <= p0 <= b[3] + gap]
            best[k] = q1 - q0 + max([0.0, *before])
        score, _ = substring_dedup.scored(np.array(rows))
        assert np.allclose(score, [best[k] for k in range(len(rows))])


def test_an_earlier_match_hides_no_passage(spark):
    rng, rows = random.Random(5), []
    words = [f"v{k}" for k in range(20_000)]
    for n in range(20):  # 48 equal words, 42 others, then 25 equal, 13 changed to 14, 49 equal
        head, middle, tail = (rng.choices(words, k=k) for k in (48, 25, 49))
        rows += [(n, " ".join(head + rng.choices(words, k=42) + middle + rng.choices(words, k=13) + tail)), (100 + n, " ".join(head + rng.choices(words, k=42) + middle + rng.choices(words, k=14) + tail))]
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(any(r["doc_id"] == 100 + n and r["start"] <= 95 and r["end"] >= 170 for r in found) for n in range(20))


def test_passages_of_repeated_ids(spark):
    rng = random.Random(16)
    words = [f"v{k}" for k in range(20_000)]
    passage, other, texts = rng.choices(words, k=80), rng.choices(words, k=90), []
    texts = sorted((" ".join(rng.choices(words, k=20) + passage), " ".join(other)), key=lambda t: spark.sql(f"select xxhash64('{t}')").first()[0])
    rows = [(1, " ".join(passage)), (1, " ".join(passage)), (2, " ".join(other))] + [(7, t) for t in texts * 3]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substring_dedup.passages(table)
    assert {(r["doc_id"], r["partner"]) for r in found.collect()} == {(7, 1 if passage[0] in texts[0] else 2)}
    left = sorted((r["doc_id"], len(r["text"].split())) for r in substring_dedup.remove_passages(table, found).collect())
    assert left == sorted([(1, 80), (1, 80), (2, 90)] + [(7, n) for t in (texts[1],) * 3 for n in (len(t.split()),)] + ([(7, 20)] * 3 if passage[0] in texts[0] else []))


def test_alignment():
    x = np.arange(100, dtype=np.uint32)
    y = np.delete(x, [50, 51])
    assert substring_dedup.matches(x, y) == 98 and substring_dedup.matches(x, x) == 100
    assert substring_dedup.extend(x, x) == 100 and substring_dedup.extend(x, x + 1000) == 0 and substring_dedup.extend(x[:0], x) == 0


@pytest.mark.parametrize("rate", [0.05, 0.1, 0.15])
def test_passages_with_words_added_and_left_out_are_aligned(rate):
    rng = np.random.default_rng(7)
    fresh = lambda n: rng.integers(1 << 32, size=n).astype(np.uint32)
    for _ in range(20):
        passage = fresh(80)
        other = []
        for k, w in enumerate(passage):
            kind = 3 if 30 <= k < 45 or rng.random() >= rate else int(rng.integers(3))
            other.extend(([], fresh(1), [w, *fresh(1)], [w])[kind])  # left out, changed, added after, as it was
        x, y = np.r_[fresh(40), np.array(other, np.uint32), fresh(40)], np.r_[fresh(30), passage, fresh(50)]
        at = 40 + next(k for k, w in enumerate(other) if w == passage[30])
        q0, q1, p0, p1, same = substring_dedup.align(x, y, (at, at + 15), (60, 75))
        assert q1 - q0 >= 50 and same >= 0.8 and 30 <= p0 < p1 <= 110 and q0 <= at and q1 >= at + 15
        assert substring_dedup.matches(x[q0:q1], y[p0:p1]) >= round(same * max(q1 - q0, p1 - p0))
        assert substring_dedup.gapped(x, fresh(160), (at, at + 15), 20, 20) is None
    assert substring_dedup.gapped(x[:0], y, (0, 0), 0, 0) is None


def test_passages(spark):
    rng = random.Random(6)
    passage, fuzzy = _prose(rng, 80), _prose(rng, 90)
    edited = list(fuzzy)
    for k in (20, 45, 70):
        edited[k] = "edited"
    del edited[55]
    parts = [_prose(rng, 75) for _ in range(2)]
    docs = {k: _prose(rng, 150) for k in range(12)}
    docs[1][30:30] = passage
    docs[5][90:90] = passage
    docs[8][0:0] = passage
    docs[2][40:40] = fuzzy
    docs[9][100:100] = edited
    docs[3][10:10], docs[4][10:10] = parts[0], parts[1]
    docs[10][20:20] = parts[0] + parts[1]  # put together from two documents
    docs[6][5:5] = docs[7][5:35]  # thirty words are no passage
    rows = [(k, " ".join(w).title() if k == 8 else " ".join(w), "s", len(" ".join(w))) for k, w in docs.items()]
    rows += [(20, None, "s", 0), (21, "", "s", 0), (22, "short text", "s", 10), (None, " ".join(passage), "s", 1), (23, " ".join(docs[1]), "s", 1), (23, " ".join(docs[1]), "s", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, h string, n_chars long")
    found = substring_dedup.passages(table).collect()
    spans = lambda d: [(r["start"], r["end"], r["partner"]) for r in found if r["doc_id"] == d]
    assert {r["doc_id"] for r in found} == {5, 8, 9, 10, 23}
    assert (90, 170, 1) in spans(5) and (0, 80, 1) in spans(8)
    assert any(s <= 100 and e >= 188 and p == 2 for s, e, p in spans(9))
    covered = {k for s, e, _ in spans(10) for k in range(s, e)}
    assert set(range(20, 170)) <= covered and not covered - set(range(20, 170))
    left = {r["doc_id"]: r for r in substring_dedup.remove_passages(table, substring_dedup.passages(table)).collect() if r["doc_id"] is not None}
    assert left[5]["text"].split() == docs[5][:90] + docs[5][170:] and left[5]["n_chars"] == len(left[5]["text"])
    assert left[1]["text"] == rows[1][1] and left[6]["text"] == rows[6][1] and 23 not in left and {20, 21, 22} <= set(left)
    assert substring_dedup.passages(table.limit(0)).count() == 0


def _has_passage(same):
    """Whether a span of 50 or more words, from an equal one to an equal one, has 80 % of them equal: by trying all."""
    hits = [k for k, x in enumerate(same) if x]
    return any(j - i + 1 >= 50 and sum(same[i : j + 1]) >= 0.8 * (j - i + 1) for i in hits for j in hits if j > i)


def test_fuzzy_passages_are_found_as_by_brute_force(spark):
    rng, rows, want = random.Random(11), [], {}
    words = [f"v{k}" for k in range(20_000)]
    for n in (50, 60, 80, 120):
        for rate in (0.1, 0.15, 0.2):
            for _ in range(12):
                passage, k = rng.choices(words, k=n), len(want)
                changed = set(rng.sample(range(n), round(rate * n)))
                edited = [rng.choice(words) if j in changed else w for j, w in enumerate(passage)]
                rows += [(k, " ".join(rng.choices(words, k=70) + passage + rng.choices(words, k=70))), (1000 + k, " ".join(rng.choices(words, k=90) + edited + rng.choices(words, k=50)))]
                want[1000 + k] = _has_passage([x == y for x, y in zip(passage, edited, strict=True)])
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["partner"] == r["doc_id"] - 1000 and r["identity"] >= 0.8 for r in found)
    due = {k for k, x in want.items() if x}
    got = {r["doc_id"] for r in found}
    assert got <= due and len(got) >= 0.95 * len(due) > 100


def test_passages_whose_phrases_earlier_documents_hold_keep_their_partner(spark, monkeypatch):
    rng = random.Random(12)
    words = [f"v{k}" for k in range(20_000)]
    passages = [rng.choices(words, k=56) for _ in range(12)]
    rows = []
    for n, passage in enumerate(passages):  # phrases of seven words of the passage, each in an earlier document of its own
        rows += [(100 * n + j, " ".join(rng.choices(words, k=30) + passage[7 * j : 7 * j + 7] + rng.choices(words, k=30))) for j in range(8)]
        edited = [w if j % 11 != 10 else "new" for j, w in enumerate(passage)]
        rows += [(5000 + n, " ".join(passage + rng.choices(words, k=40))), (9000 + n, " ".join(rng.choices(words, k=90) + edited + rng.choices(words, k=40)))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (substring_dedup.HOT, 1):
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        found = {(r["doc_id"], r["partner"]) for r in substring_dedup.passages(table).collect()}
        assert found == {(9000 + n, 5000 + n) for n in range(12)}


@pytest.mark.parametrize("between", [4, 50])
def test_phrases_that_documents_between_share_hide_no_partner(spark, monkeypatch, between):
    rng = random.Random(between)
    words = [f"v{k}" for k in range(50_000)]
    rows = []
    for n in range(10):
        passage = rng.choices(words, k=56)
        edited = [w if j % 12 != 7 else "new" for j, w in enumerate(passage)]
        rows += [(n, " ".join(rng.choices(words, k=30) + passage)), (90_000 + n, " ".join(edited + rng.choices(words, k=30)))]
        for d in range(between):  # each has some phrases of twelve words, with words of its own between them
            phrases = [w for j in range(0, 56, 12) for w in [*passage[j : j + 12], *rng.choices(words, k=15)]]
            rows.append((1000 + 100 * n + d, " ".join(phrases)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    due = {(90_000 + n, n) for n in range(10)}
    both = []
    for hot, few in ((substring_dedup.HOT, substring_dedup.FEW), (1, substring_dedup.FEW), (7, 0)):
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        monkeypatch.setattr(substring_dedup, "FEW", few)
        both.append(sorted(map(tuple, substring_dedup.passages(table).distinct().collect())))
        assert {(r[0], r[3]) for r in both[-1] if r[0] >= 90_000} == due
    assert both[0] == both[1] == both[2]


def test_partners_that_only_frequent_phrases_name_are_found(spark, monkeypatch):
    rng = random.Random(21)
    words = [f"v{k}" for k in range(50_000)]
    pool = [rng.choices(words, k=10) for _ in range(40)]
    line = rng.choices(words, k=30)
    rows = [(k, " ".join(w for phrase in rng.sample(pool, 8) for w in [*phrase, *rng.choices(words, k=25)])) for k in range(0, 400, 2)]
    rows += [(k, " ".join(rng.choices(words, k=80) + line + rng.choices(words, k=80))) for k in range(1, 120, 2)]  # a line that is no passage by itself
    due = set()
    for n in range(5):
        phrases = rng.sample(pool, 6)
        for d in (251 + 20 * n, 9000 + n):  # the earlier one is neither first nor near
            rows.append((d, " ".join(rng.choices(words, k=40) + [w for phrase in phrases for w in [*phrase, rng.choice(words)]] + rng.choices(words, k=40))))
        tail = rng.choices(words, k=30)
        for d in (51 + 2 * n + 1000, 9100 + n):  # beside the line every other word is equal, or nearly
            rows.append((d, " ".join(rng.choices(words, k=40) + line + [w if j % 4 else rng.choice(words) for j, w in enumerate(tail)] + rng.choices(words, k=40))))
        due |= {(9000 + n, 251 + 20 * n), (9100 + n, 1051 + 2 * n)}
    table, found = spark.createDataFrame(rows, "doc_id long, text string"), []
    for hot, block in ((substring_dedup.HOT, substring_dedup.BLOCK), (1, 7)):
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        monkeypatch.setattr(substring_dedup, "BLOCK", block)
        found.append(sorted(map(tuple, substring_dedup.passages(table).distinct().collect())))
        assert {(r[0], r[3]) for r in found[-1]} == due
    assert found[0] == found[1]


def test_bounds_on_frequent_seeds_lose_no_passage(spark, monkeypatch):
    rng = random.Random(31)
    words = [f"v{k}" for k in range(50_000)]
    pool, rows = [rng.choices(words, k=k) for k in (6, 8, 10, 13, 20) * 5], []
    for k in range(500):  # texts of common phrases with few words between, some with a part of an earlier one, a tenth of its words changed
        text = [w for phrase in rng.sample(pool, 9) for w in [*phrase, *rng.choices(words, k=rng.choice((1, 3, 30)))]]
        if k % 4 == 3:
            part = rng.choice(rows)[1].split()[:90]
            text[40:40] = [rng.choice(words) if rng.random() < 0.1 else w for w in part]
        rows.append((k, " ".join(text)))
    table, held = spark.createDataFrame(rows, "doc_id long, text string"), []
    for rare in (substring_dedup.RARE, 100_000):  # with the bounds, and each seed with all earlier ones
        monkeypatch.setattr(substring_dedup, "RARE", rare)
        held.append({(r["doc_id"], k) for r in substring_dedup.passages(table).collect() for k in range(r["start"], r["end"])})
    lost = held[1] - held[0]  # where alignment ends depends on where it begins, by some words
    assert len(held[1]) > 5000 and len(lost) < 0.002 * len(held[1])
    assert all(any((d, k + j) in held[0] for j in range(-substring_dedup.K, substring_dedup.K + 1)) for d, k in lost)


def test_a_text_that_repeats_itself_has_no_passage(spark):
    table = spark.createDataFrame([(1, "a b c d e f g h " * 40), (2, "i j k l m n")], "doc_id long, text string")
    assert substring_dedup.passages(table).count() == 0


def test_sets_of_bits_lose_no_common_words():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 60, rng.integers(1, 190)).astype(np.uint32) for _ in range(60)]
    sets, lost = substring_dedup._bits(texts)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            common = sum(min(int((x == w).sum()), int((y == w).sum())) for w in np.unique(x))
            assert np.bitwise_count(sets[i] & sets[j]).sum() >= common - lost[i]


def test_many_pairs_are_aligned_at_once_as_one_by_one():
    rng, pairs = np.random.default_rng(9), []
    for _ in range(80):  # of many lengths, so that batches are padded, with words changed, added and left out
        x = rng.integers(1 << 32, size=rng.integers(1, 260)).astype(np.uint32)
        y = np.delete(np.where(rng.random(len(x)) < 0.15, rng.integers(1 << 32, size=len(x)), x), rng.integers(0, len(x), 3)).astype(np.uint32)
        at = int(rng.integers(0, len(x)))
        pairs.append((x, y, (at, min(at + 12, len(x))), (max(0, at - 2), max(0, at - 2) + 12)))
    assert substring_dedup.align_all(pairs) == [substring_dedup.align(*p) for p in pairs]
    most = substring_dedup.matches_all([p[:2] for p in pairs])
    wide = [(x, y, own, other[0] - own[0], other[0] - own[0] + k % 7) for k, (x, y, own, other) in enumerate(pairs)]
    may = substring_dedup.possible_all(wide)
    assert may.any() and not may.all()
    for k, (x, y, own, least, last) in enumerate(wide):
        low, high = min(0, len(y) - len(x)) - substring_dedup.BAND, max(0, len(y) - len(x)) + substring_dedup.BAND
        best = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, w in enumerate(x):
            for j in range(len(y)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (w == y[j] and low <= j - i <= high))
        assert most[k] == best[-1, -1]
        lanes = range(least - substring_dedup.BAND, last + substring_dedup.BAND + 1)
        s, e, _ = substring_dedup.dense(np.array([any(0 <= i + d < len(y) and y[i + d] == w for d in lanes) for i, w in enumerate(x)]), *own)
        assert may[k] == (e - s >= substring_dedup.MIN_WORDS)


def _places(groups):
    """Rows of _against(): for each group (its cell) and place (id, word, words of the text) 20 words there that hold a joint seed of the group."""
    import pandas as pd

    rows = [{"home": 0, "cell": cell, "p": 0, "q": 0, "side": -1, "id": key, "s": at - 64, "d0": at, "d1": at, "q0": at, "q1": at + 20, "late": key > 1, "words": np.array(words[at - 64 : at + 84], np.uint32).tobytes()} for cell, places in groups for key, at, words in places]
    return pd.DataFrame(rows).sort_values(["cell", "id"], kind="stable").reset_index(drop=True)


def test_places_with_the_same_words_are_aligned_once(monkeypatch):
    first, second, third = (list(range(k, k + 10)) for k in (100, 200, 300))
    x, y = (first + second + third) * 12, (second + first + third) * 12  # every word stands near, two in three in order
    asked = []
    align_all = substring_dedup.align_all
    monkeypatch.setattr(substring_dedup, "align_all", lambda pairs: asked.extend(pairs) or align_all(pairs))
    assert substring_dedup._against(_places([(0, [(key, 70 + 30 * k, words) for key, words in ((1, x), (2, y)) for k in range(6)])])) == []
    assert 0 < len(asked) <= 2


def test_what_a_group_finds_hangs_on_no_other_group():
    rng = random.Random(8)
    x = [rng.randrange(10**9) for _ in range(300)]
    y = [rng.randrange(10**9) if k % 9 == 0 else w for k, w in enumerate(x)]
    groups = [(cell, [(1, at, x), (2, at, y)]) for cell, at in ((0, 80), (1, 80), (2, 150))]
    alone = [substring_dedup._against(_places([g])) for g in groups]
    assert all(alone)
    assert sorted(substring_dedup._against(_places(groups))) == sorted(row for rows in alone for row in rows)
    assert substring_dedup._against(_places([(0, [(1, 80, x), (2, 80, x[::-1])])])) == []


def test_seeds_of_many_texts_are_those_of_each():
    rng = random.Random(9)
    words = [np.array([rng.randrange(most) for _ in range(size)], np.uint64) for size in [*range(12), *(rng.randrange(150) for _ in range(100))] for most in (2, 1000)]
    want = [(k, int(h[at].view(np.int64)), int(at), n) for k, h in enumerate(map(substring_dedup.k_mers, words)) for n, at in enumerate(substring_dedup.minimizers(h))]
    assert list(substring_dedup._seeds_of(np.arange(len(words)), words).itertuples(index=False, name=None)) == want


def test_groups_of_sorted_batches():
    import pandas as pd

    rng = random.Random(2)
    for most in (1, 4, 40):
        rows = pd.DataFrame({"g": np.repeat(np.arange(30), [rng.randrange(1, most + 1) for _ in range(30)])})
        rows["v"] = np.arange(len(rows))
        cuts = sorted(rng.choices(range(len(rows)), k=12))
        parts = [rows.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        calls = list(common.by_group(iter(parts), ["g"], lambda own: own))
        assert pd.concat(calls)["v"].tolist() == rows["v"].tolist()
        assert sum(own["g"].nunique() for own in calls) == 30
        calls = list(common.by_group(iter(parts), ["g"], lambda own: own, 25))
        assert pd.concat(calls)["v"].tolist() == rows["v"].tolist() and all(len(own) >= 25 for own in calls[:-1])
        assert sum(own["g"].nunique() for own in calls) == 30
    assert list(common.by_group(iter([]), ["g"], lambda own: own)) == []


def test_cover_takes_no_words_that_are_new(spark):
    rng = random.Random(13)
    words = [f"v{k}" for k in range(20_000)]
    phrases = [rng.choices(words, k=20) for _ in range(120)]
    rows = [(k, " ".join(rng.choices(words, k=30) + phrase + rng.choices(words, k=30))) for k, phrase in enumerate(phrases)]
    for n in range(30):  # of four documents each, with words between that none holds
        stitched = [w for phrase in phrases[4 * n : 4 * n + 4] for w in [*phrase, f"new{n}"]]
        rows.append((900 + n, " ".join(rng.choices(words, k=20) + stitched + rng.choices(words, k=20))))
    assert substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    assert substring_dedup.WINDOW <= substring_dedup.K


def test_exact_repeats_of_dealt_seeds_are_found(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    rng = random.Random(14)
    words = [f"v{k}" for k in range(20_000)]
    passage = rng.choices(words, k=80)
    rows = [(k, " ".join(rng.choices(words, k=40) + passage + rng.choices(words, k=40))) for k in range(12)]
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["start"], r["end"]) for r in found} >= {(k, 40, 120) for k in range(1, 12)} and 0 in {r["partner"] for r in found}


def test_repeated_words_are_chained_in_one_sweep():
    n = 3000  # runs that all meet one place, and runs on diagonals of their own
    for parts in ([[k, k + 5, 7, 12] for k in range(n)], [[2 * k, 2 * k + 5, (37 * k) % n, (37 * k) % n + 5] for k in range(n)]):
        start = time.perf_counter()
        found = substring_dedup.chains(np.array(parts))
        assert time.perf_counter() - start < 5 and found[0][1] - found[0][0] >= 5


def test_cut_words_keeps_the_rest():
    assert substring_dedup.cut_words("a  b\nc d", [(1, 2)]) == "a  c d" and substring_dedup.cut_words("a b", [(0, 2)]) == "" and substring_dedup.cut_words("a b c", [(0, 2), (1, 3)]) == ""
