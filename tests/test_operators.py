import pytest
from pyspark.sql import functions as F

from spindrel.operators import corpus, retrieval, roster, sync
from spindrel.plans import examples as X
from spindrel.plans import runs
from spindrel.sources import fetch, links
from spindrel.sources.snapshots import SnapshotTable


def _documents(spark, rows):
    return spark.createDataFrame([(d, c, f"https://e.org/{d}", None) for d, c in rows], "doc_id string, content string, url string, title string")


def test_sync_follows_its_documents(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "kb"))
    first = sync.sync(table, _documents(spark, [("d1", "one"), ("d2", "old"), ("d3", "three"), ("d4", "four")]))
    assert (first["new"], first["points_count"]) == (4, 4)
    again = _documents(spark, [("d1", "one"), ("d2", "new " * 600), ("d4", "4"), ("d5", "five"), ("d6", " ")])
    second = sync.sync(table, again)
    assert {k: second[k] for k in ("new", "changed", "unchanged", "blank", "stale", "held")} == {"new": 1, "changed": 2, "unchanged": 1, "blank": 1, "stale": 1, "held": 0}
    rows = table.read().collect()
    assert {r["doc_id"] for r in rows} == {"d1", "d2", "d4", "d5"} and all(r["total_chunks"] == sum(x["doc_id"] == r["doc_id"] for x in rows) for r in rows)
    version = table.version()
    assert sync.sync(table, again)["chunks"] == 0 and table.version() == version  # nothing to do, nothing written
    table.check_width()
    assert table.clear() == {"collection": "kb", "existed": True, "removed": len(rows), "points_count": 0}


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "kb"), buckets=8)
    rows = [(f"d{k}", f"text {k}") for k in range(40)]
    sync.sync(table, _documents(spark, rows))
    first = table.manifest()
    assert len(first["parts"]) == 8 and set(first["parts"].values()) == {2}
    reader = table.read()
    done = sync.sync(table, _documents(spark, [(d, c if d != "d7" else "changed") for d, c in rows]))
    second = table.manifest()
    assert done["changed"] == 1 and sorted(second["parts"].values()) == [2] * 7 + [3] and second["before"] == first["parts"]
    assert reader.count() == 40 and table.read().where("text = 'changed'").count() == 1  # the version before is still there
    sync.sync(table, _documents(spark, [(d, c if d != "d7" else "again") for d, c in rows]))
    left = sorted(p.relative_to(tmp_path / "kb").as_posix() for p in (tmp_path / "kb").glob("v=*/b=*"))
    assert len(left) == 9 and table.read().count() == 40 and not list((tmp_path / "kb").glob("_claim*"))


def test_a_second_writer_is_refused(spark, tmp_path):
    from spindrel.sources.snapshots import WriteRefused

    table = SnapshotTable(spark, str(tmp_path / "kb"))
    table.setup()
    (tmp_path / "kb" / "_claim-2").touch()
    with pytest.raises(WriteRefused):
        sync.sync(table, _documents(spark, [("a", "x")]))
    assert table.version() == 1 and table.read().count() == 0
    (tmp_path / "kb" / "_claim-2").unlink()
    assert sync.sync(table, _documents(spark, [("a", "x")]))["new"] == 1


def test_a_failed_crawl_deletes_nothing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "kb"))
    sync.sync(table, _documents(spark, [(f"d{k}", str(k)) for k in range(5)]))
    assert sync.sync(table, _documents(spark, [("d0", "0"), ("d1", "1")]))["held"] == 3 and table.read().count() == 5


def test_shared_urls_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", "u", None), ("b", "y", "u", None)], "doc_id string, content string, url string, title string")
    with pytest.raises(ValueError, match="share chunk ids"):
        sync.sync(SnapshotTable(spark, str(tmp_path / "kb")), rows)


def test_half_written_documents_count_as_changed(spark):
    store = spark.createDataFrame([("a", "h", 0, 2), ("b", "h", 0, 1)], "doc_id string, content_hash string, chunk_index int, total_chunks int")
    assert {r["doc_id"]: r["stored"] for r in sync.stored_hashes(store).collect()} == {"a": None, "b": "h"}


def test_unreadable_files_are_seen(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"doc_id": "a", "content_markdown": "x", "metadata": {"url": "u", "title": "t"}}')
    (tmp_path / "b.json").write_text("{broken")
    rows = {r["doc_id"]: r["content"] for r in sync.read_documents(spark, str(tmp_path)).collect()}
    assert rows == {"a": "x", "b": None}


def test_streamed_documents(spark, tmp_path):
    from spindrel.streaming.ingest import stream_documents

    table, folder = SnapshotTable(spark, str(tmp_path / "kb")), tmp_path / "in"
    for k, doc in enumerate(("a", "b")):
        _documents(spark, [(doc, f"text {doc}")]).coalesce(1).write.mode("append").json(str(folder))
        stream_documents(table, str(folder), str(tmp_path / "checkpoint")).awaitTermination(120)
        assert table.read().select("doc_id").distinct().count() == k + 1


def test_link_report(spark):
    rows = lambda urls: spark.createDataFrame([*enumerate(urls)], "ord long, url string")
    r = links.report(rows(["u1", "u2", "u3"]), rows(["u3", "u4", "u1"])).first()
    assert (r["total"], r["previous_total"], r["added"], r["removed"], r["unchanged_count"]) == (3, 3, ["u4"], ["u2"], 2)


def test_rebuild_links(spark, tmp_path):
    root, page = str(tmp_path / "links"), lambda: (X.CATALOGUE, X.BASE)
    with pytest.raises(links.LinksRefused):
        links.rebuild_links(spark, root, page)
    dry = links.rebuild_links(spark, root, page, least=0, dry_run=True)
    assert dry["total"] == 2 and dry["count_mismatch"] and links.read_links(spark, root).count() == 0
    assert links.rebuild_links(spark, root, page, least=2)["added_count"] == 2
    assert links.rebuild_links(spark, root, page, least=2)["unchanged_count"] == 2
    assert [r["url"][-1] for r in links.read_links(spark, root).orderBy("ord").collect()] == ["5", "7"]


def test_load_urls(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# c\n\n https://a \nhttps://b\nhttps://a\n")
    assert [r["url"] for r in links.load_urls(spark, str(tmp_path / "l.txt")).orderBy("ord").collect()] == ["https://a", "https://b"]


class Flaky:
    """A transport with scripted answers."""

    def __init__(self, *answers):
        self.answers, self.asked, self.resets = list(answers), 0, 0

    def reset(self):
        self.resets += 1

    def get(self, url):
        self.asked += 1
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return fetch.Response(url, *answer)


def test_fetch_policy():
    policy = fetch.Policy(sleep=lambda s: None, healthy=lambda html, url: None if "table" in html else "no table")
    ok = Flaky(OSError("down"), (503, ""), (200, "<table>"))
    assert fetch.fetch_one(ok, "u", policy)[4:] == (True, None, 3) and ok.resets == 2
    assert fetch.fetch_one(Flaky((404, "")), "u", policy)[2:] == (404, "", False, "HTTP 404", 1)
    assert fetch.fetch_one(Flaky((429, ""), (200, "<table>")), "u", policy)[4]
    assert fetch.fetch_one(Flaky(*[(200, "")] * 3), "u", policy)[5] == "no table"
    assert fetch.proxy_url("http://p:1", "u", "s") == "http://u:s@p:1" and fetch.proxy_url("http://a@p", "u") == "http://a@p" and fetch.proxy_url("") is None


def test_fetch_stats(spark):
    rows = [("a", "a", 200, "x", True, None, 1), ("b", "b", 404, "", False, "HTTP 404", 1), ("c", "c", None, "", False, "down", 3)]
    assert tuple(fetch.fetch_stats(spark.createDataFrame(rows, fetch.FETCHED), 5).first()) == (5, 2, 1, 2)


def test_latency_is_measured(spark, tmp_path):
    rows = spark.createDataFrame([(1, "m", "web", 0.5, "r")], "query_id int, message string, route string, highest_relevance_score double, response string")

    def keep(df):
        df.write.parquet(str(tmp_path / "a"))
        return spark.read.parquet(str(tmp_path / "a"))

    assert retrieval.logged(rows, keep, "w", "l", "e").first()["latency_ms"] > 0


def _fetched(urls):
    return fetch.fetch(urls, X.SiteSession, workers=2, policy=fetch.Policy(pause=0, jitter=(0, 0), sleep=lambda s: None))


def test_event_join(spark):
    links_ = spark.createDataFrame([("m", [("L", "https://x/r?veranstid=11", "11"), ("E", "https://x/r?veranstid=12", "12"), ("U", "https://x/r?veranstid=13", "13")])], "url string, l array<struct<title:string,url:string,veranstid:string>>")
    modules = links_.select("url", F.struct(F.col("l").alias("event_links")).alias("module"))
    pages = spark.createDataFrame([("https://x/r?veranstid=11&s=1", "https://x/r?veranstid=11&s=2", 200, X.EVENT, True, None, 1), ("https://x/r?veranstid=12", "https://x/r?veranstid=12", 500, "", False, "HTTP 500", 3)], fetch.FETCHED)
    rows = corpus.with_events(modules, corpus.parse_events(pages), ["url"])
    got = rows.select("events", corpus.event_summary().alias("s")).first()
    assert [(e["listed_as"], e["fetched"], e["fetch_error"]) for e in got["events"]] == [("L", True, None), ("E", False, "HTTP 500"), ("U", False, corpus.NEVER_FETCHED)]
    assert tuple(got["s"]) == (3, 1, 2)


def test_etl_end_to_end(spark, tmp_path):
    urls = spark.createDataFrame([(f"{X.BASE}?pord.pordnr={n}",) for n in (5, 6, 7, 9)], "url string")
    table = SnapshotTable(spark, str(tmp_path / "kb"))
    done = runs.run_etl(spark, urls, _fetched, str(tmp_path / "work"), table)
    assert done["new"] == 2 and done["points_count"] >= 2
    assert {r["doc_id"] for r in table.read().collect()} == {"modul_p5", "modul_p7"}
    assert runs.run_etl(spark, urls, _fetched, str(tmp_path / "work"), table)["unchanged"] == 2


def test_people_crawl(spark, tmp_path):
    out = runs.build_roster(spark, spark.createDataFrame([(0, "https://www.b-tu.de/fakultaet1/x")], "ord int, url string"), _fetched, str(tmp_path / "work"))
    rows = {r["key"]: r for r in out["roster"].collect()}
    assert set(rows) == {"ada-muster", "klara-lang"}
    assert rows["ada-muster"]["designation"] == "Sekretariat" and rows["ada-muster"]["faculty"] == "Fakultät 1"
    assert rows["klara-lang"]["is_head_of_chair"] and rows["klara-lang"]["career"] == "Born."
    chair = next(r for r in out["chairs"].collect() if r["name"] == "FG X")
    assert chair["designations"] == ["Sekretariat"] and chair["head_of_chair_resolved"]
    assert chair["head_of_chair_person"].asDict() == {**dict.fromkeys(roster.HEAD_FIELDS), "name": "Klara Lang", "emails": ["klara.lang@b-tu.de"], "career": "Born.", "source_urls": ["https://www.b-tu.de/fg-x/bo"], **{k: [] for k in ("phones", "faxes", "mobiles", "address_lines")}, "designations": ["Sekretariat"]}
    stats = out["stats"].first()  # the landing page is read twice and requested once; two chairs have no page to fetch
    assert stats["requests"] == 6 and stats["cache_hits"] == 1 and stats["failures"] == 0
    c = out["counters"].first()
    assert (c["chairs"], c["chairs_crawled"], c["chairs_without_link"], c["chairs_hosted_externally"], c["people"], c["chairs_with_head_named"]) == (3, 1, 1, 1, 2, 1)


def _flat(spark, rows, partitions):
    people = roster.merge_in_chair(spark.createDataFrame(rows, "chair_id string, seq array<int>, name string, emails array<string>, career string").repartition(partitions))
    chairs = spark.createDataFrame(X.CHAIRS, "chair_id string, faculty string, faculty_number int, institute string, chair string, chair_url string, chair_is_former boolean, status string, team_menu_found boolean")
    return sorted(map(tuple, roster.flat_roster(roster.merge_everywhere(people, chairs)).select("key", "name", "email", "career", "chair").collect()))


def test_roster_merge_does_not_depend_on_partitions(spark):
    want = [("ada-muster", "Dr. Ada Muster", "ada.muster@x.de; muster@x.de", "longer career", "A; B"), ("beispiel", "Bo Beispiel", "fg@x.de", None, "A"), ("ida-beispiel", "Ida Beispiel", None, None, "B")]
    assert _flat(spark, X.SIGHTINGS, 1) == want == _flat(spark, X.SIGHTINGS[::-1], 7)


def test_names_without_latin_letters_stay_apart(spark):
    assert [r[0] for r in _flat(spark, [("A", [1], "李", [], None), ("A", [2], "王", [], None)], 2)] == ["unknown", "unknown-2"]


def test_head_match(spark):
    people = roster.merge_in_chair(spark.createDataFrame([("A", [1], "Klara Zimmer", []), ("A", [2], "Klara Muster", [])], "chair_id string, seq array<int>, name string, emails array<string>"))
    chairs = spark.createDataFrame([("A", [0], "Prof. Dr. Klara Muster")], "chair_id string, seq array<int>, head_of_chair string")
    loose = spark.createDataFrame([("A", [9], "u", "Leitung", "long career", None, 0), ("A", [8], "v", "Team", None, "Mo", 0)], "chair_id string, seq array<int>, url string, designation string, career string, office_hours string, named_people int")
    everyone, left = roster.attach_heads(people, chairs, loose)
    assert {r["name"]: (r["is_head_of_chair"], r["career"]) for r in everyone.collect()} == {"Klara Zimmer": (False, None), "Klara Muster": (True, "long career")}
    assert [tuple(r) for r in left.collect()] == [("A", "office_hours", "v", "Mo")]


def test_search(spark):
    flat = spark.createDataFrame([("a", "Ada", None, "Fakultät 1", "X"), ("b", "Bo", "bo@y.de", "Fakultät 10", None), ("c", "Ci", None, None, "Yacht")], "key string, name string, email string, faculty string, chair string")
    keys = lambda **k: [r["key"] for r in roster.search_roster(flat, **k).orderBy("key").collect()]
    assert keys(faculty="1") == ["a", "b"] and keys(q="Y") == ["b", "c"] and keys(faculty="1", q="y") == ["b"] and keys() == ["a", "b", "c"]


def test_route_and_log(spark):
    raw = ['{"is_relevant": true, "confidence_score": 0.87}', '{"is_relevant": true, "confidence_score": 0.75}', '{"is_relevant": false, "confidence_score": 0.9}', "{"]
    rows = retrieval.route(spark.createDataFrame([*enumerate(raw)], "query_id int, raw string").withColumn("verdict", retrieval.parse_verdict(F.col("raw"))))
    assert [r["route"] for r in rows.orderBy("query_id").collect()] == ["internal", "web", "web", "web"]
    logged = retrieval.log_rows(rows.withColumns({"message": F.lit("m"), "response": F.lit("r"), "highest_relevance_score": F.lit(0.5)}), "w", "l", "e").unionByName(retrieval.error_row(spark, "w", "boom", "q"))
    assert logged.count() == 5 and logged.where("error_log = 'boom' and highest_relevance_score = 0 and not is_web_fallback_used and user_query = 'q'").count() == 1


def test_answers_name_their_route(spark):
    store = sync.chunk_rows(_documents(spark, [("d", "Modules start every winter semester"), ("e", "Nothing else here")]))
    from spindrel.functions.embedding import embed

    asked = spark.createDataFrame([(1, "when do modules start every winter"), (2, "zebra question unknown words")], "query_id int, message string")
    got = {r["query_id"]: (r["route"], r["response"]) for r in retrieval.answer(asked, store.withColumn("vector", embed()("text")), search=lambda q: f"web: {q}", domain="site").collect()}
    assert got[1] == ("internal", "Modules start every winter semester") and got[2] == ("web", "web: site zebra question unknown words")


def test_top_k_plans(spark):
    table = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(20)], "id int, vector array<float>")
    one = retrieval.top_k(table, [1.0, 0.0], 3)
    assert [r["id"] for r in one.collect()] == [19, 18, 17] and "TakeOrderedAndProject" in one._jdf.queryExecution().executedPlan().toString()
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query_vector array<float>")
    many = retrieval.top_k_batch(table, asked, 3)
    assert [r["id"] for r in many.orderBy("rank").collect()] == [19, 18, 17] and "WindowGroupLimit" in many._jdf.queryExecution().executedPlan().toString()


def test_questions_in_blocks(spark, monkeypatch):
    from spindrel.operators import similarity

    table = spark.createDataFrame([(k, [float(k), 20.0 - k], f"t{k}") for k in range(20)], "id int, vector array<float>, text string")
    asked = spark.createDataFrame([(q, [float(q), 1.0]) for q in range(30)] + [(99, None)], "query_id int, query_vector array<float>")
    rows = lambda: sorted(map(tuple, retrieval.top_k_batch(table, asked, 2, carry=("text",)).collect()))
    want = rows()
    for name, size in (("QUESTIONS_A_PART", 7), ("CHUNKS_A_PART", 3), ("AT_ONCE", 2)):
        monkeypatch.setattr(similarity, name, size)
    assert rows() == want and len(want) == 60 and all(r[2] == f"t{r[1]}" for r in want)


def test_similarity_is_the_cosine(spark, monkeypatch):
    import numpy as np

    from spindrel.operators import similarity

    near = spark.createDataFrame([(1, [3.0, 4.0]), (2, [1.0, 0.0])], "id int, vector array<double>")
    assert [(r["id"], r["score"]) for r in retrieval.top_k(near, [2.0, 0.0], 2).collect()] == [(2, 1.0), (1, 0.6)]
    monkeypatch.setattr(similarity, "QUESTIONS_A_PART", 40)
    monkeypatch.setattr(similarity, "CHUNKS_A_PART", 50)
    rng, nan = np.random.default_rng(2), float("nan")
    chunks = [(k, rng.normal(size=5).tolist()) for k in range(200)] + [(k, [1.0, 2.0, 0.0, 0.0, 0.0]) for k in range(300, 400)] + [(500, [1e200, 0.0, 0.0, 0.0, -1e200]), (501, [1.0, 1.0])]
    odd = [None, [], [0.0] * 5, [nan] * 5, [1.0, None, 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0, 0.0]]
    asked = [(f"q{k}", (rng.normal(size=5) * 10.0**k).tolist()) for k in range(-60, 60)] + [("copies", [2.0, 4.0, 0.0, 0.0, 0.0])] * 3 + [("copies", [0.0, 0.0, 0.0, 0.0, 1.0]), (None, [1.0, 0.0, 0.0, 0.0, 0.0])] + [(f"odd{k}", v) for k, v in enumerate(odd)]
    table = spark.createDataFrame([(i, v, "x") for i, v in chunks + [(600 + k, v) for k, v in enumerate(odd)]], "id long, vector array<double>, score string").repartition(3)
    got = {}
    for r in retrieval.top_k_batch(table, spark.createDataFrame(asked, "query_id string, query_vector array<double>"), 4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], round(r["score"], 9))
    want = {}
    for q, v in {(q, tuple(v)) for q, v in asked if not (q or "").startswith("odd")}:
        u = np.array(v) / np.linalg.norm(v)
        for i, c in chunks:
            if len(c) == 5:
                w = np.array(c) / max(map(abs, c))
                want.setdefault(q, []).append((-round(float(u @ w / np.linalg.norm(w)), 12), i))
    assert got == {q: {n + 1: (i, round(-s, 9)) for n, (s, i) in enumerate(sorted(found)[:4])} for q, found in want.items()}
    assert [x[0] for x in got["copies"].values()] == [300, 301, 302, 303]


def test_questions_are_evaluated_once_in_a_plan_of_one_size(spark, monkeypatch):
    from spindrel.operators import similarity

    embedded = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def slow(k):
        embedded.add(1)
        return [float(k % 17), 1.0, float(k % 5)]

    table = spark.range(300).select("id", F.array(F.col("id").cast("double"), F.lit(1.0), F.lit(2.0)).alias("vector"))
    ask = lambda n: spark.range(n).select(F.col("id").alias("query_id"), slow("id").alias("query_vector"))
    few = retrieval.top_k_batch(table, ask(5), 2)
    monkeypatch.setattr(similarity, "QUESTIONS_A_PART", 500)
    embedded.value = 0
    many = retrieval.top_k_batch(table, ask(20_000), 2)
    assert many.count() == 40_000 and embedded.value == 20_000
    size = lambda frame: len([x for x in frame._jdf.queryExecution().analyzed().toString().split("\n") if x.strip()])
    assert size(few) == size(many)


def test_resume(spark):
    urls = spark.createDataFrame([(f"{X.BASE}?pord.pordnr={n}",) for n in (5, 6)] + [("https://e.org/a",)], "url string")
    done = spark.createDataFrame([("modul_p5", "5"), ("modul_xf2cc75f84c57", None)], "doc_id string, pordnr string")
    assert [r["url"][-1] for r in corpus.pending_markdown(urls, done).collect()] == ["6"] == [r["url"][-1] for r in corpus.pending_structured(urls, done).collect()]
    cache = spark.createDataFrame([("11",)], "event_key string")
    found = spark.createDataFrame([("https://x?veranstid=11",), ("https://x?veranstid=12&a=1",), ("https://x?veranstid=12",), (None,)], "url string")
    assert [r["event_key"] for r in corpus.pending_events(found, cache).collect()] == ["12"]
