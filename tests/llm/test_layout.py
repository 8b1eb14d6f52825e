"""Packing, mixing, the pipeline."""

import random
import zlib
from array import array
from collections import defaultdict
from fractions import Fraction

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from spindrel.llm import mixing, packing

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["", "a  b", "a \nb", " x", "x ", "\n\na b", "a\tb c", "don't 's x y z", "naïve  ", "\x1c a b", "a\x1cb c \x85 d", "a　b c", "  ", "\n", "1 2\n3 ''s ll", "<|endoftext|> hi", "a  <|endoftext|>  b <|endoftext|>", "x<|endoftext|><|endoftext|>\n\ny", "<|endoftext |>", "\u2028x\u2029 y", "x\xa0 y"]


def test_encoder_equals_the_tokenizer(tokenizer):
    encode = packing.Encoder()
    texts = ODD + [r[0] for r in duckdb.sql(f"select text from '{DATA}/documents.parquet' limit 60").fetchall()]
    for t in texts:
        assert encode(t) == array("I", tokenizer.encode(t, add_special_tokens=False).ids).tobytes(), repr(t[:40])


def test_cut():
    assert packing.cut(10, 4) == [(0, 2), (2, 4), (6, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(3, 4) == [(0, 3)] and packing.cut(4, 4) == [(0, 4)]


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    rng = random.Random(1)
    bins, free, made = packing.BestFit(20, 4), {}, 0
    for _ in range(500):
        n = rng.randint(1, 20)
        fits = [f for f in free.values() if f >= n]
        number, offset = bins.put(n)
        if fits:
            assert free[number] == min(fits) and offset == 20 - free[number]
        else:
            assert offset == 0
            if len(free) == 4:
                gone = min(free.values())
                free.pop(next(k for k, f in free.items() if f == gone and k not in {b for v in bins.by_free for b in v}))
            free[number], made = 20, made + 1
        free[number] -= n
        if not free[number]:
            del free[number]
        assert bins.open == len(free) and sorted(b for v in bins.by_free for b in v) == sorted(free)
    assert bins.made == made


def _check_packing(rows, want_ids, limit):
    per, spots = defaultdict(list), defaultdict(list)
    for r in rows:
        per[r["doc_id"]].append(r)
        spots[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spots.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= limit
    for key, ids in want_ids.items():
        own = sorted(per[key], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in own] == packing.cut(len(ids), limit)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(array("I", ids[r["start"] : r["start"] + r["length"]]).tobytes())
    return len(spots)


def test_pack(spark, tokenizer):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    extra = [(10_000 + k, t) for k, t in enumerate([None, *ODD, "word " * 30_000])]
    table = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).withColumns({"length": F.lit("x"), "piece": F.lit("y")})
    want = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in table.collect()}
    rows = packing.pack(table).collect()
    used = _check_packing(rows, want, 2048)
    assert used <= 1.02 * sum(map(len, want.values())) / 2048 + 1
    big = 2**60 + 1
    assert {r["doc_id"] for r in packing.pack(spark.createDataFrame([(big, "a"), (None, "b")], "doc_id long, text string")).collect()} == {big, None}
    repeated = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted(r["offset"] for r in packing.pack(repeated).collect()) == [0, 3] and packing.pack(table.limit(0)).count() == 0
    many = packing.pack(table, limit=64, pieces_per_task=50).collect()
    assert _check_packing(many, want, 64) >= used


def test_schedule_keeps_within_a_block():
    rng = random.Random(2)
    blocks, weights = [rng.randint(1, 300) for _ in range(9)] + [2000], [rng.random() for _ in range(9)] + [2.0]
    plan = mixing.Schedule(blocks, weights, 512)
    slots = {}
    for s, n in enumerate(blocks):
        where, _ = plan.place(s, mixing.np.arange(n))
        assert (mixing.np.diff(where) > 0).all()
        slots |= {int(x): s for x in where}
    assert sorted(slots) == list(range(sum(blocks))) and plan.slots == sum(blocks)
    parts, count = mixing.quotas(weights, 512), [0] * 10
    for t in range(min(max(x for x, s in slots.items() if s == k) for k in range(10))):  # until a source is used up
        count[slots[t]] += 1
        assert all(abs(count[s] - (t + 1) * parts[s] / 512) < 1 for s in range(10))


def test_schedule_keeps_within_a_block_of_the_exact_weights():
    for weights, blocks in (([1.0, 1.0, 1.0], [20_000, 19_000, 18_000]), ([1.0, 1e-4, 0.3], [30_000, 50, 9000]), ([0.7, 0.1, 1e-12], [3000, 900, 2])):
        plan = mixing.Schedule(blocks, weights)
        where = [plan.place(s, mixing.np.arange(n)) for s, n in enumerate(blocks)]
        assert sorted(mixing.np.concatenate([w[0] for w in where]).tolist()) == list(range(sum(blocks))) and plan.slots == sum(blocks)
        ends, active = sorted(int(w[0][-1]) + 1 for w in where), {0, 1, 2}
        at = 0
        for end in ends:  # a phase ends where a source is used up
            whole = sum(Fraction(weights[s]) for s in active)
            for s in active:
                own = where[s][0][(where[s][0] >= at) & (where[s][0] < end)] - at
                share = Fraction(weights[s]) / whole
                assert all(-1 < k - t * share and k + 1 - (t + 1) * share < 1 for k, t in enumerate(own.tolist())) and abs(len(own) - (end - at) * share) < 1
            active -= {s for s in active if where[s][0][-1] < end}
            at = end


def test_mix_uses_the_exact_weights(spark):
    table = spark.range(24_000).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    got = mixing.mix(table, {"0": 1.0, "1": 1.0, "2": 1.0}, block_chars=10).where("source = '0'").select("mix_slot").collect()
    assert all(abs(k - t / 3) < 1 for k, t in enumerate(sorted(r["mix_slot"] for r in got)))


def test_unnamed_and_weightless_sources_come_last():
    plan = mixing.Schedule([3, 5], [1.0, 0.0], 16)
    assert plan.place(0, mixing.np.arange(3))[0].tolist() == [0, 1, 2] and plan.place(1, mixing.np.arange(5))[0].tolist() == [3, 4, 5, 6, 7]


def test_quotas():
    assert sum(mixing.quotas([1e-9, 1, 1], 10)) == 10 and min(mixing.quotas([1e-9, 1, 1], 10)) == 1 and mixing.quotas([1, 1], 8) == [4, 4]


def test_mix(spark):
    rng = random.Random(3)
    rows = [(k, "x" * rng.randint(0, 50), rng.choice("aaaab"), "m") for k in range(300)] + [(500, None, None, "m"), (501, "long" * 100, "b", "m"), (7, "twice", "a", "m"), (7, "twice", "a", "m")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, note string")
    got = mixing.mix(table, {"a": 1.0, "b": 1.0}, block_chars=100).collect()
    assert len(got) == len(rows)
    for source in {"a", "b", None}:
        own = sorted((r for r in got if r["source"] == source), key=lambda r: r["mix_start"])
        at = 0
        for r in own:
            assert r["mix_start"] == at and r["mix_block"] == at // 100
            at += max(1, len(r["text"] or ""))
    place = {(r["source"], r["mix_block"]): r["mix_slot"] for r in got}
    assert len(set(place.values())) == len(place) and place[(None, 0)] == max(place.values())
    laid = mixing.in_order(table, {"a": 1.0, "b": 1.0}, partitions=3, block_chars=100)
    assert laid.columns == table.columns and sorted(map(str, laid.collect())) == sorted(map(str, table.collect()))
    assert mixing.mix(table.limit(0)).count() == 0


def test_schedule_is_earliest_deadline_first():
    """Against a plain simulation that looks at every source in every slot."""
    rng = random.Random(8)
    for _ in range(20):
        n = rng.randint(2, 6)
        weights, left = [rng.choice([rng.random(), 0.1, 1e-3, 7.0]) for _ in range(n)], [rng.randint(1, 60) for _ in range(n)]
        got, total = mixing.one_phase(weights, left), sum(map(Fraction, weights))
        done, slots, t = [0] * n, [[] for _ in range(n)], 0
        while all(done[s] < left[s] for s in range(n)):
            share = [Fraction(w) / total for w in weights]
            ready = [(-(-(done[s] + 1) // share[s]), s) for s in range(n) if done[s] // share[s] <= t]
            _, s = min(ready)
            slots[s].append(t)
            done[s] += 1
            t += 1
        assert [x.tolist() for x in got] == slots


def test_mix_replaces_columns_of_its_names_and_deals_equal_ids(spark):
    rows = [(7, f"t{k}" * 3, "a", "kept", k) for k in range(40)] + [(None, "n", None, "kept", 99)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_slot string, __s int")
    got = mixing.mix(table, block_chars=20)
    assert len(set(got.columns)) == len(got.columns) and dict(got.dtypes)["mix_slot"] == "bigint" and got.count() == 41 and got.select("__s").distinct().count() == 41
    laid = mixing.in_order(table, partitions=2, block_chars=20)
    assert laid.columns == table.columns and {r["mix_slot"] for r in laid.collect()} == {"kept"}


def test_pipeline(spark, tmp_path):
    words = [f"w{k}" for k in range(400)]
    texts = ["the and of " + " ".join(words[:200]), "the and of " + " ".join(words[:200]), "der die und " + " ".join(words[200:300]), "the of " + " ".join(words[300:]) + " " + " ".join(words[200:300]), None, "123", "the of and in to"]
    rows = [(k, t, "de" if t and t[:3] == "der" else "en", f"s{k % 2}", len(t or ""), k) for k, t in enumerate(texts)] + [(20 + k, "der die und das ist", "de", "s1", 19, k) for k in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, length int").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(seen["language_id"]) == {0, 1, 2, 3, 6, 20, 21, 22}
    assert set(seen["simhash_dedup"]) == {0, 2, 3, 6, 20}
    cut = seen["substring_dedup"]
    assert set(cut) == {0, 2, 3, 6, 20} and cut[3].split() == ["the", "of", *words[300:]] and cut[2] == texts[2]
    assert seen["mix_sources"] == cut
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in final} == set(cut)


def test_pack_takes_arrivals_in_mixing_order_after_a_reread(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices("abcdefgh", k=rng.choice((3, 30, 200 if k > 2000 else 5)))), f"s{k % 3}") for k in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"s0": 5.0, "s1": 2.0, "s2": 1.0}
    want = [r["doc_id"] for r in mixing.mix(table, weights, block_chars=2000).orderBy("mix_slot", "mix_start").collect()]
    mixing.in_order(table, weights, partitions=12, block_chars=2000).write.option("maxRecordsPerFile", 100).parquet(str(tmp_path / "laid"))
    docs = spark.read.parquet(str(tmp_path / "laid"))
    thin = packing.pieces(docs, order=packing.file_order(docs)).orderBy("order_0", "order_1", "order_2", "arrival").collect()
    assert [r["doc_id"] for r in thin if r["piece"] == 0] == want
    place = {key: k for k, key in enumerate(want)}
    for per_task in (10**6, 700):  # one piece a look-ahead, one open sequence: what is packed first comes first
        got = packing.pack(docs, most_open=1, look_ahead=1, pieces_per_task=per_task, order=packing.file_order(docs)).orderBy("sequence_id", "offset").collect()
        assert [place[r["doc_id"]] for r in got] == list(range(len(want)))
    stage = {r["doc_id"]: r["sequence_id"] for r in corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()}
    plain = {r["doc_id"]: r["sequence_id"] for r in packing.pack(spark.createDataFrame([(k, rows[k][1]) for k in want], "doc_id long, text string").coalesce(1)).collect()}
    assert stage == plain


def test_pipeline_keeps_texts_with_letters_where_no_language_can_be_learned(spark, tmp_path):
    rows = [(1, "the and of", None), (2, "123 ...", None), (3, None, None), (4, "", None), (5, "größe", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.keep_identified(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {1, 5}
