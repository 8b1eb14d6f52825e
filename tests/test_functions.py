import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindrel.functions import names, pages, repair, text
from spindrel.functions.chunking import split_text
from spindrel.functions.embedding import HashingEmbedder


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Mailto:Max.Muster.(at)Example(punkt)ORG?subject=x", "max.muster@example.org"), ("kein Kontakt", None), ("", None), (None, None), ("a [at] b.de", "a@b.de"), ("x..y@z..org", "x.y@z.org")],
)
def test_email(spark, raw, want):
    assert repair.email(raw) == want
    assert spark.createDataFrame([(raw,)], "e string").select(text.normalize_email("e")).first()[0] == want


def test_repairs():
    assert repair.mail_token("nbjmup+beb/nvtufsAc.uv/ef", 1) == "mailto:ada.muster@b-tu.de"
    assert repair.mail_token("x", "none") is None
    assert repair.utf7("Beckumer Stra+AN8-e") == "Beckumer Straße"
    assert repair.utf7("T +-49") == "T +49" and repair.utf7("+49 1") == "+49 1"
    assert repair.tidy("Sti­pen​\xa0x \n y") == "Stipen x y"


@given(st.text(st.sampled_from("abz/.:@AZ09 ü"), max_size=20), st.integers(1, 5))
def test_mail_token_is_a_shift_back(plain, vector):
    moved = repair.mail_token(plain, -vector)
    assert repair.mail_token(moved, vector) == plain


def test_name_tokens_and_slugs():
    assert repair.name_tokens("Prof. Dr.-Ing. Jörg Müßler-Ná") == ["joerg", "muessler"]
    assert repair.person_slug("Jörg Müßler") == "joerg-muessler"
    assert repair.person_slug("李") == "unknown"


@pytest.mark.parametrize(
    ("line", "want"),
    [("Ada Muster", True), ("Akademische Mitarbeiterin", False), ("Labore: Technik", False), ("beratendes Mitglied", False), ("ADA MUSTER", False), ("Prof. Dr. phil.", False), ("BTU Cottbus", False), ("", False), (None, False),
     ("M. Sc. Tian-yun Gao (Gastdoktorand)", True), ("Wouter Verschoof-van der Vaart", True), ("Datenbank- und Informationssysteme", False)],
)
def test_names(line, want):
    assert names.is_name(line) is want


def test_names_of_columns_are_those_of_texts(spark):
    lines = ["Ada Muster", "ada muster", "Prof. Dr. Ada Muster", "Dr. 2 Muster Ada", "Ada Muster 2", "ÄDA MÜSTER", "Ada von und zu Muster", "Ada Muster (Sekretariat)", "Wouter Verschoof-van der Vaart", "Ada & Bo", "Ada Muster!", "(Ada Muster)", "a@b.de Ada Muster",
             "Lehrstuhl Ada Muster", "Ada Muster Muster weiter unten im Text", "Émile Zola", "李 明", "Team Ada", "Ada Gastprofessorin Muster", "Prof. Dr.", "X" * 50 + " " + "Y" * 50, "", None, "Ada\nMuster", "Dipl.-Ing. Jörg Ünal, M.Sc."]
    got = spark.createDataFrame([(x,) for x in lines], "t string").select("t", names.is_name_like("t").alias("n"), names.looks_like_person("t").alias("p")).collect()
    assert [(r["t"], r["n"], r["p"]) for r in got] == [(x, names.is_name(x), names.is_person(x)) for x in lines] and sum(r["n"] for r in got) >= 6


def test_repaired_addresses_of_columns_are_those_of_texts(spark):
    raw = ["mailto:A.B@x.de?subject=1", "a (at) b (punkt) de", "x [dot] y {@} z.de", "..a..b.@x..de", "none", "", None, "MAILTO:q@w.org", "a b @ c.de"]
    got = spark.createDataFrame([(x,) for x in raw], "t string").select(text.normalize_email("t").alias("e")).collect()
    assert [r["e"] for r in got] == [repair.email(x) for x in raw] and repair.email(raw[1]) == "a@b.de" and repair.email(raw[3]) == "a.b@x.de"


def test_identities(spark):
    row = spark.createDataFrame([("https://e.org/a", "12566 - Auslaufmodul", "https://x/rds?a=1&pord.pordnr=5", "https://x/rds?veranstaltung.veranstid=11#z", "Grüße")], "u string, n string, p string, e string, t string").select(
        text.document_id("u"), text.document_id("p"), text.structured_id("n", "u"), text.event_key("e"), text.event_key("u"), text.chunk_id("u", F.lit(0)), text.content_hash("t"), text.word_count(F.lit("a\xa0\tb ")), text.word_count(F.lit(" "))
    ).first()
    assert list(row) == ["modul_xf2cc75f84c57", "modul_p5", "modul_12566", "11", "https://e.org/a", "e52c911e-1112-5d76-8639-f66743a36b84", "49c5f675b49037b6044b803ac9d1a6d7", 2, 0]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_uuid5(spark, found):
    rows = spark.createDataFrame([(n,) for n in found], "n string").select("n", text.uuid5("n").alias("u")).collect()
    assert all(r["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, r["n"])) for r in rows)


def test_small_expressions(spark):
    row = spark.range(1).select(
        text.result_count(F.lit("3.237 Treffer")), text.group_name(F.lit("Termine Gruppe: 1-Gruppe")), text.without_site(F.lit("FG X - BTU Cottbus")), text.before_pipe(F.lit("Ada  | FG")), text.without_items(F.lit("Since: x A B"), F.array(F.lit("A"), F.lit("B"))),
        text.section_kind(F.lit("Sprechzeiten")), text.section_kind(F.lit("Vita")), text.section_kind(F.lit("x")), text.joined(F.array(F.lit("a "), F.lit(""), F.lit("a"), F.lit("b"))), text.joined(F.array()), text.slug(F.lit("Neue Spalte!")), text.slug(F.lit("--")),
        *[text.is_vacant(F.lit(h)) for h in ("N. N.", "", "—", "Ada")], text.is_own_host(F.lit("https://WWW.b-tu.de/x")), text.is_own_host(F.lit("nothing")),
    ).first()
    assert list(row) == [3237, "1-Gruppe", "FG X", "Ada", "Since: x", "office_hours", "career", None, "a; b", None, "neue_spalte", "unnamed", True, True, True, False, True, False]


@given(st.text(st.sampled_from("ab \n"), max_size=400), st.integers(10, 60))
def test_chunks_fit_and_lose_nothing(t, size):
    found = split_text(t, size, size // 4)
    assert all(c and len(c) <= size and c == c.strip() for c in found)
    assert sorted(set(t.split())) == sorted(set(" ".join(found).split())) or max(map(len, t.split()), default=0) >= size


def test_chunks_overlap():
    words = [f"w{k:03d}" for k in range(400)]
    found = split_text(" ".join(words))
    assert len(found) > 1 and all(b.split()[0] in a.split() for a, b in zip(found, found[1:], strict=False))
    assert split_text("") == split_text(None) == [] and split_text("x" * 2500)[0] == "x" * 1000


def test_embedder_gives_unit_vectors():
    v = HashingEmbedder(16).encode(["a b", "", "a b"])
    assert abs((v**2).sum(axis=1) - 1).max() < 1e-6 and (v[0] == v[2]).all()


def test_event_id_is_decoded():
    assert pages.event_id("https://x/rds?a=1&veranstaltung.veranstid=1%201&veranstid=2") == "1 1"
