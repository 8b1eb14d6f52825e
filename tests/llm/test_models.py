"""Language identification and quality scores: gradients, held-out accuracy, edges."""

import zlib

import numpy as np
import pytest

from spindrel.llm import language_id, quality_classifier

DATA = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    net = language_id.Network(["a", "b", "c"], hidden=4, seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, lengths, order = language_id.columns([b" ab ", b" a ", b" xyz "])
    target = np.array([0, 1, 2])[order]
    _, grad = net.learn(data, lengths, target)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if name[0] == "x":
                at = (at[0], int(data[rng.integers(0, 3), 0]))
            old, eps = value[at], 1e-3
            value[at] = old + eps
            up = net.learn(data, lengths, target)[0]
            value[at] = old - eps
            down = net.learn(data, lengths, target)[0]
            value[at] = old
            assert abs((up - down) / (2 * eps) - grad[name][at]) < 2e-3, (name, at)


def _plain(net, raw):
    """Sums of the distributions of a text, byte after byte, state over all of it."""
    H, states = net.hidden, {}
    for w in "fb":
        h, seen = np.zeros(H), []
        for byte in raw if w == "f" else raw[::-1]:
            a, b = net.p[f"x{w}"][:, byte], net.p[f"u{w}"] @ h
            z, r = 1 / (1 + np.exp(-(a[:H] + b[:H]))), 1 / (1 + np.exp(-(a[H : 2 * H] + b[H : 2 * H])))
            m = np.tanh(a[2 * H :] + r * b[2 * H :])
            h = m + z * (h - m)
            seen.append(h)
        states[w] = np.array(seen if w == "f" else seen[::-1])
    e = np.exp(states["f"] @ net.p["of"].T + states["b"] @ net.p["ob"].T + net.p["d"][:, 0])
    return (e / e.sum(axis=1, keepdims=True)).sum(axis=0)


@pytest.mark.parametrize("ways", [{}, {"chunk": 16, "stride": 4, "close": 1e-5}, {"chunk": 7, "stride": 3, "close": 1e-5, "floats": 64}])
def test_the_state_runs_over_the_whole_text(ways):
    net = language_id.train([b"the and of it", b"der und die das"] * 20, ["en", "de"] * 20, epochs=3)
    reader = language_id.Reader(net, **ways)
    texts = ["the und " + "x" * 300, None, "", "der\tder\nder", "a", "การระบุภาษา" * 9, "语言识别" * 40, "and of " * 90]
    got = reader.documents(texts)
    for row, t in zip(got, texts, strict=True):
        raw = (t or "").encode()
        assert row[-1] == len(raw)
        assert np.allclose(row[:-1], _plain(net, raw) if raw else 0, atol=2e-3 * max(1, len(raw)) ** 0.5)
    assert np.allclose(np.concatenate([reader.documents([t]) for t in texts]), got, atol=5e-2)


def test_scripts_without_spaces_are_told_apart():
    chinese, thai, japanese = "我们今天去公园看花然后一起吃饭喝茶", "วันนี้เราไปสวนสาธารณะเพื่อดูดอกไม้แล้วกินข้าว", "今日は公園に行って花を見てから一緒にご飯を食べました"
    net = language_id.train([t.encode() for t in (chinese, thai, japanese)] * 10, ["zh", "th", "ja"] * 10, epochs=12)
    judge = language_id.predictor(net)()
    assert judge([chinese[3:] * 50, thai[5:] * 50, japanese[4:] * 50, "12 !"])[0] == ["zh", "th", "ja", "und"]


def test_a_sample_of_repeated_rows_is_bounded(spark):
    docs = spark.createDataFrame([(1, "the same text", "en")] * 50 + [(k, f"der Text {k}", "de") for k in range(5)] + [(None, None, "fr"), (None, "un texte", "fr")], "doc_id long, text string, lang string")
    texts, langs = language_id.sample_texts(docs, "doc_id", "text", "lang", rows_a_language=3)
    assert sorted(langs) == ["de"] * 3 + ["en"] * 3 + ["fr"] and set(t for t, x in zip(texts, langs, strict=True) if x == "en") == {b"the same text"}


def test_language_id(spark):
    rows = language_id.query(spark, DATA).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !? ", "en"), (4, "der und die " * 20_000, "de"), (5, "the of and", "en"), (5, "the of and", "en"), (6, "the of and", None), (2**60 + 1, "die", "de"), (None, "the", "en")], "doc_id long, text string, lang string")
    net = language_id.train([b"the of and the and of", b"der und die und der die"] * 30, ["en", "de"] * 30, epochs=20)
    got = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in language_id.identify(docs.withColumn("score", docs["lang"]), net).collect())
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "en"), (5, "en"), (6, "en"), (2**60 + 1, "de")]
    assert language_id.fit(docs.limit(0)) is None and language_id.fit(docs.where("lang is null")) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"} and language_id.identify(docs.limit(0), net).count() == 0


def test_quality(spark):
    rows = quality_classifier.query(spark, DATA).collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert sum(r["predicted"] == label[r["doc_id"]] for r in held) / len(held) > 0.93


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "good words here"), (3, "good words here"), (4, "BAD!! BAD!! " * 50_000), (2**60 + 1, "x"), (None, None)], "doc_id long, text string")
    texts, labels = ["good words here now", "BAD!! BAD!! BAD!!"] * 5, np.array([1, 0] * 5, np.float32)
    space = quality_classifier.Space(quality_classifier.Terms().many(texts), labels)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs.withColumn("score", docs["text"]), space).collect()}
    assert set(got) == {1, 2, 3, 4, 2**60 + 1, None} and got[1] == got[2] == got[None] == 0.5 and got[3] > 0.8 and got[4] < 0.2
    nothing = quality_classifier.Space(np.zeros((0, quality_classifier.TERMS), np.float32), np.zeros(0, np.float32))
    assert {r["score"] for r in quality_classifier.score(docs, nothing).collect()} == {0.5} and quality_classifier.score(docs.limit(0), space).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert len(quality_classifier.sample(docs, empty)[1]) == 0


def test_votes_are_those_of_a_plain_search(monkeypatch):
    rng = np.random.default_rng(4)
    words = ["good", "words", "here", "BAD!!", "now", "x1", "y|", "Z"]
    counts = quality_classifier.Terms().many([" ".join(rng.choice(words, rng.integers(3, 30))) for _ in range(90)])
    labels = rng.integers(0, 2, 60).astype(np.float32)
    space = quality_classifier.Space(counts[:60], labels, axes=6)
    monkeypatch.setattr(quality_classifier, "_BLOCK", 7)
    got = space.score(counts[60:], neighbours=9)
    for row, score in zip(counts[60:], got, strict=True):
        v = space.weigh(row[None].copy())[0] @ space.axes
        cosine = [float(v @ u / np.linalg.norm(v)) for u in space.vectors]
        near = sorted(range(60), key=lambda k: -cosine[k])[:9]
        weight = [max(cosine[k], 0) ** 4 for k in near]
        assert abs(score - sum(w * labels[k] for w, k in zip(weight, near, strict=True)) / sum(weight)) < 1e-3


def test_a_labelled_sample_of_repeated_ids_is_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert zlib.crc32(b"1") % 5 != 0 and len(quality_classifier.sample(docs, labels, most=7)[1]) == 7


@pytest.mark.parametrize("block", [5, 200_000])
def test_terms_do_not_depend_on_blocks(monkeypatch, block):
    texts = ["a a b a", "", None, "X!! y | z# 12", "a b"]
    want = quality_classifier.Terms().many(texts)
    monkeypatch.setattr(quality_classifier, "_WORDS", block)
    assert (quality_classifier.Terms().many(texts) == want).all() and want[0, quality_classifier.SHAPES * quality_classifier.RECUR :].sum() == 4
