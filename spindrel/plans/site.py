"""A small site made from the shared tables, for the queries of parsers and rosters: the same expressions are read by Spark and by the SQL that the queries are held against.

People come from ``customer``, chairs from ``nation``, pages from ``pages``. Names repeat in many spellings, across chairs too; some people have an address of their
own, some a chair's, some none; two have names without Latin letters.
"""

from __future__ import annotations

from spindrel.functions import fixed_values as V
from spindrel.functions import names
from spindrel.plans import examples as X

FIRST = ("Ada", "Bo", "Klara", "Jörg", "Émile", "Ida", "Max", "Nele", "Otto", "Pia")
LAST = ("Muster", "Beispiel", "Müller", "Groß", "Zimmer", "Lang", "Berg", "Weiß", "Kühn", "Vogt", "Haase", "Stern")
MAIL = ("muster", "beispiel", "mueller", "gross", "zimmer", "lang", "berg", "weiss", "kuehn", "vogt", "haase", "stern")


def pick(number: str, of: tuple[str, ...]) -> str:
    """The SQL of of[number % len(of)], for either engine."""
    return f"CASE ({number}) % {len(of)} " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(of)) + " END"


_FULL = f"concat({pick('c_custkey * 7 + 3', FIRST)}, ' ', {pick('c_custkey * 5', LAST)})"
NAME = f"""CASE WHEN c_custkey % 50 = 7 THEN '李' WHEN c_custkey % 50 = 8 THEN '王' WHEN c_custkey % 9 = 0 THEN concat('Prof. Dr. ', {_FULL}) WHEN c_custkey % 9 = 1 THEN concat('Dr.-Ing. ', {_FULL})
  WHEN c_custkey % 9 = 2 THEN concat({pick('c_custkey', FIRST)}, ' van der ', {pick('c_custkey', LAST)}) ELSE {_FULL} END"""
#: name -> expression over customer: sightings of people, one a row.
SIGHTING = {
    "k": "CAST(c_custkey AS INT)",
    "chair_id": "concat('C', CAST((c_custkey * 7) % 25 AS STRING))",
    "name": NAME,
    "email": f"CASE c_custkey % 5 WHEN 0 THEN concat({pick('c_custkey * 5', MAIL)}, CAST(c_custkey % 3 AS STRING), '@x.de') WHEN 1 THEN concat('office', CAST(c_custkey % 25 AS STRING), '@x.de') END",
    "room": "CASE WHEN c_custkey % 3 = 0 THEN concat('R', CAST(c_custkey AS STRING)) END",
    "career": "CASE WHEN c_custkey % 4 = 0 THEN concat(repeat('career ', CAST(1 + c_custkey % 7 AS INT)), CAST(c_custkey % 10 AS STRING)) END",
}
#: name -> expression over nation: chairs.
CHAIR = {
    "n": "CAST(n_nationkey AS INT)",
    "chair_id": "concat('C', CAST(n_nationkey AS STRING))",
    "faculty": "concat('Fakultät ', CAST(n_nationkey % 5 AS STRING))",
    "faculty_number": "CAST(n_nationkey % 5 AS INT)",
    "institute": "CASE WHEN n_nationkey % 4 <> 0 THEN concat('I', CAST(n_nationkey % 7 AS STRING)) END",
    "chair": "concat('Chair ', CAST(n_nationkey AS STRING))",
    "chair_url": "concat('https://www.b-tu.de/fg-', CAST(n_nationkey AS STRING))",
    "chair_is_former": "n_nationkey % 3 = 0",
    "status": pick("n_nationkey", ("crawled", "no_link", "crawled", "external", "fetch_failed", "crawled", "crawled")),
    "team_menu_found": "n_nationkey % 2 = 0",
    "head_of_chair": f"CASE n_nationkey % 4 WHEN 0 THEN concat('Prof. Dr. ', {pick('n_nationkey * 7 + 3', FIRST)}, ' ', {pick('n_nationkey', LAST)}) WHEN 1 THEN ' N. N. ' WHEN 2 THEN '' ELSE 'Xenia Zorn' END",
}
#: Lines that are names or aren't, over customer.
LINE = f"""CASE c_custkey % 13 WHEN 1 THEN concat({_FULL}, ': Technik') WHEN 2 THEN concat({_FULL}, ' & ', {_FULL}) WHEN 3 THEN upper(replace({_FULL}, 'ß', 'ss')) WHEN 4 THEN lower({_FULL}) WHEN 5 THEN concat({_FULL}, ' ', CAST(c_custkey AS STRING)) WHEN 6 THEN 'Prof. Dr.'
  WHEN 7 THEN concat('(', {_FULL}, ')') WHEN 8 THEN concat({_FULL}, ' (Sekretariat)') WHEN 9 THEN concat({_FULL}, '!') WHEN 10 THEN concat('Team ', {_FULL}) WHEN 11 THEN concat({_FULL}, ' leitet das Labor') ELSE {NAME} END"""


def select(expressions: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in expressions.items()]


# --- the SQL that rosters are held against (DuckDB) ---


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("(?=\\.|\\b)", "(?:\\.|\\b)").replace("'", "''") + "'"  # that engine has no look-ahead


def tokens(name: str) -> str:
    plain = f"lower({name})"
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        plain = f"replace({plain}, '{a}', '{b}')"
    return f"list_filter(regexp_extract_all(strip_accents({plain}), '[a-z]{{3,}}'), lambda t: t NOT IN ({', '.join(repr(t) for t in V.TITLE_TOKENS)}))"


def slug(name: str) -> str:
    return f"coalesce(nullif(array_to_string({tokens(name)}, '-'), ''), nullif(trim(regexp_replace(lower({name}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown')"


def is_name(t: str) -> str:
    words = lambda x: f"list_filter(regexp_split_to_array({x}, '[\\s,]+'), lambda w: w <> '')"
    own = lambda x: f"list_filter({words(x)}, lambda w: NOT regexp_matches(w, {_quoted('(?i)' + V.NAME_TITLE)}) AND lower(trim(w, '.,-')) NOT IN ({', '.join(repr(p) for p in V.NAME_PARTICLES)}))"
    head = f"split_part({t}, '(', 1)"
    found = {"characters": f"length({t})", "words": f"len({words(t)})", "capitals": f"len(list_filter({words(t)}, lambda w: regexp_matches(w, '^\\p{{Lu}}')))", "own": f"len({own(t)})", "prose": f"len(list_filter({own(head)}, lambda w: regexp_matches(w, '^\\p{{Ll}}')))"}
    within = [f"{found[k]} BETWEEN {low} AND {high}" for k, (low, high) in names.BOUNDS.items()]
    foreign = [f"NOT regexp_matches({t}, {_quoted('(?i)' + names.FOREIGN)})", f"NOT regexp_matches({head}, {_quoted('(?i)' + names.FOREIGN_HEAD)})"]
    shape = [f"NOT regexp_matches({t}, '^\\p{{Ll}}')", f"NOT regexp_matches({t}, '^[^\\p{{Ll}}]{{5,}}$')", f"NOT (regexp_matches({t}, '\\d') AND NOT regexp_matches({t}, {_quoted('(?i)' + V.NAME_TITLE)}))"]
    return "(" + " AND ".join(within + foreign + shape) + ")"


def _known(src: str, out: str) -> str:
    return f"""{out} AS (SELECT *, CASE WHEN len(personal) > 0 THEN 'email' ELSE 'name' END AS key_kind, CASE WHEN len(personal) > 0 THEN personal[1] WHEN len(tokens) > 0 THEN array_to_string(tokens, ' ') ELSE lower(name) END AS key
  FROM (SELECT *, list_filter(emails, lambda e: len(list_filter(tokens, lambda t: contains(split_part(e, '@', 1), left(t, 4)))) > 0) AS personal FROM (SELECT *, {tokens("name")} AS tokens FROM {src})))"""


def _merged(src: str, out: str, by: str, late: str = "0") -> str:
    first = lambda c: f"list_filter({c}, lambda x, i: list_position({c}, x) = i) AS {c}"
    return f"""{out} AS (SELECT * REPLACE ({first("emails")}, {first("chairs")}) FROM (SELECT {by}, arg_min(seq, o) AS seq, arg_min(name, o - 100000000000 * length(name)) AS name, flatten(list(emails ORDER BY o)) AS emails, flatten(list(chairs ORDER BY o)) AS chairs,
  arg_min(room, o) FILTER (length(room) > 0) AS room, arg_min(career, o - 100000000000 * length(career)) FILTER (length(career) > 0) AS career FROM (SELECT *, 1000000000 * ({late}) + seq AS o FROM {src}) GROUP BY {by}))"""


def _folded(src: str, out: str, scope: str = "") -> str:
    host = f"{out}_h AS (SELECT *, CASE WHEN len(tokens) > 0 AND len(personal) = 0 THEN min(CASE WHEN len(personal) > 0 THEN seq END) OVER (PARTITION BY {scope}tokens) END AS host FROM {out}_k)"
    target = f"{out}_t AS (SELECT *, coalesce(host, seq) AS target FROM {out}_h)"
    return ", ".join((_known(src, f"{out}_k"), host, target, _merged(f"{out}_t", out, f"{scope}target", "CASE WHEN host IS NOT NULL THEN 1 ELSE 0 END")))


_START = f"s AS (SELECT k AS seq, chair_id, name, CASE WHEN email IS NULL THEN [] ELSE [email] END AS emails, CAST([] AS VARCHAR[]) AS chairs, room, career FROM (SELECT {', '.join(select(SIGHTING))} FROM customer))"
CHAIRS_SQL = f"c AS (SELECT {', '.join(select(CHAIR))} FROM nation)"
#: p: one record a person and chair. f: one a person, with its chairs.
PEOPLE_SQL = ", ".join((_START, _known("s", "s_k"), _merged("s_k", "m", "chair_id, key_kind, key"), _folded("m", "p", "chair_id, ")))
EVERYWHERE_SQL = ", ".join(
    (
        PEOPLE_SQL,
        CHAIRS_SQL,
        "w AS (SELECT p.* REPLACE ([c.chair_id] AS chairs) FROM p JOIN c ON p.chair_id = c.chair_id)",
        _known("w", "w_k"),
        _merged("w_k", "e", "key_kind, key"),
        _folded("e", "g"),
        f"a AS (SELECT *, coalesce(nullif(array_to_string({tokens('name')}, ' '), ''), '#' || seq) AS same FROM g)",
        _merged("a", "f", "same"),
        """r AS (SELECT f.*, (SELECT bool_and(c.chair_is_former) FROM c WHERE list_contains(f.chairs, c.chair_id)) AS is_former_chair, (SELECT string_agg(DISTINCT c.faculty, ';') FROM c WHERE list_contains(f.chairs, c.chair_id)) AS faculties,
  array_to_string(list_transform(f.chairs, lambda x: 'Chair ' || x[2:]), '; ') AS chair, nullif(array_to_string(f.emails, '; '), '') AS email FROM f)""",
        f"flat AS (SELECT CASE nth WHEN 1 THEN slug ELSE slug || '-' || nth END AS key, name, email, career, room, chair, is_former_chair, faculties FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seq) AS nth FROM (SELECT *, {slug('name')} AS slug FROM r)))",
    )
)

# --- pages made from the examples, by number; and what they hold ---

KINDS = 5


def numbered(page: str, number: str = "page_id") -> str:
    """The SQL of an example page with 90001 replaced by the row's number."""
    return f"replace('{page.replace(chr(39), chr(39) * 2)}', '90001', CAST({number} + 1000 AS STRING))"


def page(example: str, changed: str | None = None) -> str:
    """The html of each row of pages: its own, or every third an example, every sixth with the number inside."""
    return f"CASE WHEN page_id % 3 = 1 THEN {numbered(example)} WHEN page_id % 3 = 2 THEN {numbered(changed or example)} ELSE html END"


TEAM = X.TEAM.replace("000-1", "90001").replace("ada.muster(at)b-tu.de", "ada.muster90001(at)b-tu.de").replace("<h2>Sekretariat</h2>", "<h2>Sekretariat 90001</h2>")
PERSON = X.PERSON.replace("Born.", "Born in 90001.")
FACULTY = X.FACULTY.replace("Institut A", "Institut 90001")
CHAIR_PAGE = X.CHAIR.replace("FG X", "FG 90001")
EVENT = X.EVENT.replace("<td>2.0</td>", "<td>90001</td>").replace("Institut X", "Institut 90001")


class Server:
    """A transport whose answers follow from the number that an address ends with."""

    def __init__(self):
        self.asked = {}

    def reset(self) -> None:
        pass

    def get(self, url: str):
        from spindrel.sources.fetch import Response

        number = int(url.rsplit("/", 1)[1])
        self.asked[url] = self.asked.get(url, 0) + 1
        status = {0: 404, 1: 200 if self.asked[url] > 1 else 503, 2: 500}.get(number % 7, 200)
        return Response(url, status, f"page {number}" if status == 200 else "")
