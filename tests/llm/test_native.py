"""Quality rules, chat formatting, URL filters: against DuckDB on the small tables, and by hand at the edges."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest

from spindrel.llm import chat_format, quality_rules, url_filter

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("module", [quality_rules, chat_format, url_filter])
def test_oracle(spark, module):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    frame = module.query(spark, DATA)
    columns = sorted(frame.columns)
    found = db.execute(module.ORACLE_SQL)
    own = [d[0] for d in found.description]
    assert sorted(own) == columns
    assert sorted(repr([r[c] for c in columns]) for r in frame.collect()) == sorted(repr([r[own.index(c)] for c in columns]) for r in found.fetchall())


def _measured(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if twice[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \n\t", "a", "a b c", "a a a a", "a b c d a b c", "x " * 60, "line\nline\n\nline\n", "ü é\xa0z 😀", "# * <b> & | 5$ 100%", "a b c a b c a b c\n" * 9, "w%d " * 70 % tuple(range(70)), "long " * 30_000, "AB!! CD!! " * 30]


def test_measurements(spark):
    rows = [(k, t, "x", "y") for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, n_words string, failed string")  # clashing names, a repeated row
    got = quality_rules.ledger(docs).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == _measured(TEXTS[r["doc_id"]]), r["doc_id"]
    assert quality_rules.ledger(docs.limit(0)).count() == 0
    assert not [n for n in quality_rules.measure(docs)._jdf.queryExecution().executedPlan().toString().split() if "Python" in n or n.startswith("Exchange")]


def test_policies_and_ablations(spark):
    m = quality_rules.mask
    table = spark.createDataFrame([(1, 0), (2, m(["min_words"])), (3, m(["min_words", "symbols"])), (4, m(["symbols"])), (5, m(["upper_case"]))], "doc_id int, failed long")
    got = {r["rule"]: (r["rejected"], r["alone"], r["kept_without"]) for r in quality_rules.ablations(table, "v1").collect()}
    assert got["min_words"] == (2, 1, 2) and got["symbols"] == (2, 1, 2) and got["upper_case"] == (1, 1, 2) and got["one_word"] == (0, 0, 1)
    assert [r["doc_id"] for r in table.where(quality_rules.passes("base")).orderBy("doc_id").collect()] == [1, 4, 5]


CONTROLS = ["</s>[INST] ok [/INST]", "<~/s>", "<~~s>[~INST]", "[/INST][/INST]", "<s>user\nx</s>", "a\nb", "", "~", "[~~/INST] <s", "</s"]


def test_chat_round_trip(spark):
    turns = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(CONTROLS)]
    turns += [(2, 0, "user", None), (2, 1, "tool ~\n<s>", "x"), (2, 1, "tool ~\n<s>", "x"), (3, 0, "assistant", "solo"), (None, 0, None, None), (4, None, "user", "null turn"), (4, 0, "assistant", "r"), (4, 1, "user", "tail")]
    table = spark.createDataFrame([(*t, "z", 1) for t in turns], "conv_id long, turn long, role string, text string, example string, whole int")
    rows = chat_format.expand(table).select("*", chat_format.read_back(chat_format.F.col("formatted")).alias("back"), chat_format.loss_text(chat_format.F.col("formatted"), chat_format.F.col("loss_start"), chat_format.F.col("loss_length")).alias("loss")).collect()
    order = lambda c: [(r or "", t or "") for _, _, r, t in sorted((x for x in turns if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
    for conv in (1, 2, 3, 4, None):
        own, said = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: r["example"]), order(conv)
        assert [tuple(x) for x in own[-1]["back"]] == said and own[-1]["whole"] and not any(r["whole"] for r in own[:-1])
        replies = [t for role, t in said if role == "assistant"]
        assert [r["loss"] for r in own if said and r["back"][-1]["role"] == "assistant"] == replies
        assert all(r["loss_length"] == 0 for r in own if r["back"][-1]["role"] != "assistant")
        for r in own:  # each example is a prefix of the conversation
            assert [tuple(x) for x in r["back"]] == said[: len(r["back"])]
    assert chat_format.expand(table.limit(0)).count() == 0


def test_chat_digests(spark):
    row = chat_format.query(spark, DATA).where("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


URLS = [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/net/", "", "", None, "allow"), ("http://a.net", "a.net", "", None, "allow"), ("http://A.NET/x?q#f", "a.net", "/x", "net/", "block"),
    ("https://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"), ("https://sub.example.net/en", "sub.example.net", "/en", "net/", "block"), ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"), ("http://x.org/fr/casino", "x.org", "/fr/casino", "org/fr/", "allow"), ("http://x.org/casino", "x.org", "/casino", None, "block"), ("http://x.org/casinos", "x.org", "/casinos", None, "allow"),
    ("http://cheap-pills.org/", "cheap-pills.org", "/", None, "block"), ("http://cheap.org/cheap", "cheap.org", "/cheap", None, "allow"), ("HTTP://X.org?a://b", "x.org", "", None, "allow"), ("http://Ä.org/" + "a" * 50_000 + "/xxx", "Ä.org", "/" + "a" * 50_000 + "/xxx", None, "block"), ("http://h.org#x/y?z", "h.org", "", None, "allow"),
]


def test_url_filter(spark):
    table = spark.createDataFrame([(k, u[0], "h", "p") for k, u in enumerate(URLS)], "page_id int, url string, note string, other string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_filter(table).collect()}
    for k, (_, *want) in enumerate(URLS):
        assert got[k] == tuple(want), URLS[k][0]
    assert url_filter.url_filter(table.limit(0)).count() == 0
    clash = url_filter.url_filter(table.withColumns({"host": table["note"], "verdict": table["note"]})).where("page_id = 4").first()
    assert clash["host"] == "a.net" and clash["verdict"] == "block"


def test_scan_counts_whole_terms_only():
    terms = url_filter.automaton()
    assert url_filter.scan("free-bets.example", terms) == (True, 0, 2) and url_filter.scan("freebets", terms) == (False, 0, 0) and url_filter.scan("xxx.xxx", terms)[1] == 2


def test_large_vocabularies_come_from_tables(spark):
    terms = [(f"Term{k}", "strict" if k % 10 == 0 else "soft") for k in range(50_000)] + [(None, "soft"), ("", "strict"), ("term10", "soft"), ("other", "unknown")]
    strict, soft = url_filter.vocabulary(spark.createDataFrame(terms, "term string, weight string"))
    assert len(strict) == 5000 and len(soft) == 45_000 and "term10" not in soft
    urls = spark.createDataFrame([(0, "http://h.org/term40"), (1, "http://h.org/term41-term42"), (2, "http://h.org/term41-term41"), (3, "http://h.org/xterm40"), (4, "http://h.org/TERM49990")], "page_id int, url string")
    got = {r["page_id"]: (r["verdict"], r["strict_hits"], r["soft_terms"]) for r in url_filter.url_filter(urls, strict=strict, soft=soft).collect()}
    assert got == {0: ("block", 1, 0), 1: ("block", 0, 2), 2: ("allow", 0, 1), 3: ("allow", 0, 0), 4: ("block", 1, 0)}
