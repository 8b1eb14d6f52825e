"""Toxicity: likelihoods against plain dictionaries, held-out labels, edges."""

import math
import zlib

import numpy as np
import pytest

from spindrel.llm import toxicity

DATA = "/root/testdata/sf0.01"


def _likelihoods(counts, order):
    """Plain interpolated Kneser-Ney with a discount of one: log(toxic / ordinary) of any word, from {word: (toxic, ordinary)}."""
    seen, before = {}, {}
    for word, by in counts.items():
        w = "^" + word + "$"
        for i in range(1, len(w)):
            k = min(order, i + 1)
            seen.setdefault((k, w[i + 1 - k : i + 1]), np.zeros(2)).__iadd__(by)
            for k in range(1, min(order, i + 1)):
                before.setdefault(w[i + 1 - k : i + 1], set()).add(w[i - k])
    total, beyond, shared_total, shared_beyond = {}, {}, {}, {}
    for (k, g), by in seen.items():
        total[k, g[:-1]] = total.get((k, g[:-1]), 0) + by
        beyond[k, g[:-1]] = beyond.get((k, g[:-1]), 0) + np.maximum(by - 1, 0)
    for g, what in before.items():
        shared_total[len(g), g[:-1]] = shared_total.get((len(g), g[:-1]), 0) + len(what)
        shared_beyond[len(g), g[:-1]] = shared_beyond.get((len(g), g[:-1]), 0) + len(what) - 1

    def ratio(word):
        w, out = "^" + word + "$", 0.0
        for i in range(1, len(w)):
            p = 1 / 300
            for k in range(1, min(order - 1, i) + 1):
                g = w[i + 1 - k : i + 1]
                if shared_total.get((k, g[:-1])):
                    t, e = shared_total[k, g[:-1]], shared_beyond[k, g[:-1]]
                    p = max(len(before.get(g, ())) - 1, 0) / t + (1 - e / t) * p
            k = min(order, i + 1)
            g, both = w[i + 1 - k : i + 1], []
            for y in (0, 1):
                t = total.get((k, g[:-1]), np.zeros(2))[y]
                own = max(seen.get((k, g), np.zeros(2))[y] - 1, 0)
                both.append(own / t + (1 - beyond[k, g[:-1]][y] / t) * p if t else p)
            out += math.log(both[0] / both[1])
        return out

    return ratio


@pytest.mark.parametrize("order", [3, 12])
def test_likelihoods_are_those_of_plain_dictionaries(spark, order):
    rng = np.random.default_rng(5)
    parts = ["ba", "do", "ri", "né", "x", "stu", "ß"]
    counts = {}
    for _ in range(80):
        word = "".join(rng.choice(parts, rng.integers(1, 7)))
        counts[word] = (int(rng.integers(0, 6)) * (word[:2] == "ba"), int(rng.integers(0, 6)))
    counts["idiot"] = (9, 0)
    words = spark.createDataFrame([(w, t, o) for w, (t, o) in counts.items()], "word string, t long, o long").repartition(3)
    model = toxicity.Model(toxicity.learn(words, order, 2**22), order)
    plain, some = _likelihoods({w: np.array(c) for w, c in counts.items()}, order), [*list(counts)[::3], "idiot", "idiotic", "never", "z", "badob" * 6]
    assert np.allclose(model.ratios(some), [plain(w) for w in some], atol=1e-4)
    assert model.ratios(["idiot"])[0] > 3 and np.allclose(model.gains(some), [math.log(1 - 0.005 + 0.005 * math.exp(plain(w))) for w in some], atol=1e-4)


def test_few_slots_still_hold_every_sequence(spark):
    words = spark.createDataFrame([(f"w{k % 50}x{k}", 2, 3) for k in range(200)], "word string, t long, o long")
    wide, narrow = toxicity.learn(words, slots=2**20), toxicity.learn(words, slots=97)
    assert all(wide[k].sum() == narrow[k].sum() for k in ("t", "o", "c")) and np.isfinite(toxicity.Model(narrow).ratios(["w1x1", "other"])).all()


def test_words_of_a_text_don_t_depend_on_blocks(monkeypatch):
    text = "The IDIOT, the_clown; " * 50 + "é" * 100 + " 12 x"
    whole = [w for b in toxicity.blocks(text) for w in toxicity.words_in(b)]
    monkeypatch.setattr(toxicity, "_CHARS", 37)
    assert [w for b in toxicity.blocks(text) for w in toxicity.words_in(b)] == whole and whole[:4] == ["the", "idiot", "the", "clown"]
    assert [len(w) for w in whole[-5:]] == [40, 40, 20, 2, 1]
    tables = {k: np.zeros(64, np.float32) for k in ("t", "o", "at", "ao", "st", "so", "c", "ac", "sc")}
    values, n = toxicity.Reader(toxicity.Model(tables)).values([text, None, "", " - ", "x"])
    assert n.tolist() == [len(whole), 0, 0, 0, 1] and np.allclose(values, 0)


def test_held_out_labels(spark):
    rows = {r["doc_id"]: r for r in toxicity.query(spark, DATA).collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{DATA}/labels.parquet").where("toxic is not null").collect()]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in rows.items())
    held = [(rows[i]["score"], y) for i, y in labels if i in rows and rows[i]["held_out"]]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([[(a > b) + (a == b) / 2 for b in clean] for a in toxic])
    assert auc > 0.92 and np.mean(np.array(toxic) >= 0.7) > 0.65 and np.mean(np.array(clean) >= 0.7) < 0.03


def test_toxicity_edges(spark):
    plain = ["the weather is fine today", "we went to the market and bought bread", "a book about the sea", "she reads the paper"]
    rows = [(k, f"{plain[k % 4]} {'you stupid idiot' if k % 3 == 0 else 'you kind neighbour'} number {k}", k % 3 == 0) for k in range(120)]
    extra = [(1000, None), (1001, ""), (1002, " ... "), (1003, "word " * 300_000), (1003, "the same id"), (None, "you stupid idiot"), (None, None), (1004, "x" * 5000), (1005, "you stupid idiot")]
    docs = spark.createDataFrame([(i, t, 0.5, "y", 3) for i, t, *_ in [*rows, *extra]], "doc_id long, text string, score double, y string, value int").repartition(4)
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(0, 0), (5, None), (99_999, 1), (None, 1), (1000, 1)], "doc_id long, toxic int")
    model, curve = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, curve).collect()
    by = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None}
    assert len(got) == len(rows) + len(extra) and got[0].asDict().keys() == {"doc_id", "score"}
    assert by[1000] == by[1001] == by[1002] == curve.prior and by[1005] > 0.5 > max(by[k] for k in range(120) if k % 3)
    assert sum(r["score"] == by[1005] for r in got if r["doc_id"] is None) == 1
    assert toxicity.score(docs.limit(0), model, curve).count() == 0
    for other in (labels.limit(0), labels.where("toxic = 1")):
        model, curve = toxicity.fit(docs, other)
        assert model is None and {r["score"] for r in toxicity.score(docs, model, curve).collect()} == {curve.prior} == {1.0 if other.count() else 0.5}
