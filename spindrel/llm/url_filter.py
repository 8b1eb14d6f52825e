"""Weighted URL vocabulary: Aho-Corasick counts strict and soft terms in a URL, after host and path rules.

Every URL is scanned once for all terms of the vocabulary. A hit counts only between boundaries (no letter or digit on
either side), so ``sex`` doesn't hit ``essex``. One strict term rejects; soft terms reject when ``soft_limit`` or more
*different* ones hit. Host rules come first: where one fits, it decides and the vocabulary isn't asked.

Cases: a null URL, or one without ``://``, has an empty host and path and no rule; the vocabulary still scans what text
there is (none for null, so it is allowed). Very long URLs are scanned whole, in linear time. Repeated rows are judged
alike, an empty table gives an empty result. Other columns stay; those named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: One of these rejects.
STRICT = ("casino", "adult", "porn", "xxx", "viagra", "escort", "hentai", "camgirls", "warez")
#: ``soft_limit`` different ones of these reject.
SOFT = ("spam", "farm", "cheap", "pills", "ads", "track", "free", "bets", "bet", "win", "bonus", "loan", "deal", "poker", "sex", "click")
SOFT_LIMIT = 2
MOST_TERMS = 1_000_000


def vocabulary(table: DataFrame, term: str = "term", weight: str = "weight") -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(strict, soft) terms of a table of terms and weights ``strict`` and ``soft``, A-Z lower-cased, for ``url_filter``. A vocabulary is written by people and goes to
    every task; over MOST_TERMS terms raise an error. Null or empty terms and other weights don't count."""
    low = F.translate(F.col(term), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = table.where(F.col(weight).isin("strict", "soft") & (F.length(term) > 0)).select(low.alias("t"), F.col(weight).alias("w")).distinct().limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    strict = {r["t"] for r in rows if r["w"] == "strict"}
    return tuple(sorted(strict)), tuple(sorted({r["t"] for r in rows} - strict))


def split_url(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty where there is no ``://``."""
    whole = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(whole, "://")
    after = F.when(at > 0, whole.substr(at + 3, F.length(whole))).otherwise("")
    upto = F.substring_index(F.substring_index(after, "#", 1), "?", 1)
    host = F.substring_index(upto, "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return urls.withColumns({"host": lower, "path": upto.substr(F.length(host) + 1, F.length(upto))})


def rule_column(host, path, rules=RULES):
    """The longest rule that fits (its text, like ``net/``) and its verdict, as two columns; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def automaton(strict=STRICT, soft=SOFT):
    import ahocorasick

    found = ahocorasick.Automaton()
    for weight, terms in (("strict", strict), ("soft", soft)):
        for term in terms:
            found.add_word(term, (weight, term))
    found.make_automaton()
    return found


def scan(text: str, terms, soft_limit: int = SOFT_LIMIT) -> tuple[bool, int, int]:
    """(rejected, strict hits, different soft terms) of one lower-cased text."""
    strict, soft = 0, set()
    for end, (weight, term) in terms.iter(text):
        begin = end - len(term)
        if (begin >= 0 and _inside(text[begin])) or (end + 1 < len(text) and _inside(text[end + 1])):
            continue
        if weight == "strict":
            strict += 1
        else:
            soft.add(term)
    return strict > 0 or len(soft) >= soft_limit, strict, len(soft)


def _inside(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def url_filter(urls: DataFrame, url: str = "url", rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """urls with host, path, rule, verdict (allow or block), strict_hits and soft_terms."""

    @F.pandas_udf("struct<rejected boolean, strict_hits int, soft_terms int>")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = automaton(strict, soft)
        upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        for texts in batches:
            yield pd.DataFrame([scan((t or "").translate(upper), terms, soft_limit) for t in texts], columns=["rejected", "strict_hits", "soft_terms"])

    parts = split_url(urls, url)
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "__verdict": verdict, "__j": judged(F.col(url))})
    own = ("verdict", "strict_hits", "soft_terms")
    return parts.select(*[c for c in parts.columns if c not in own and not c.startswith("__")], F.coalesce("__verdict", F.when(F.col("__j.rejected"), "block").otherwise("allow")).alias("verdict"), F.col("__j.strict_hits").alias("strict_hits"), F.col("__j.soft_terms").alias("soft_terms"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).drop("url")


def _oracle() -> str:
    hit = lambda t: f"regexp_matches(low, '(^|[^a-z0-9])(?:{t})($|[^a-z0-9])')"
    soft = " + ".join(f"CAST({hit(t)} AS INT)" for t in SOFT)
    count = " + ".join(f"CAST(len(regexp_extract_all(low, '(?:^|[^a-z0-9]){t}($|[^a-z0-9])')) AS INT)" for t in STRICT)
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    name = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest) + " END"
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest)
    return f"""
    WITH a AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
    b AS (SELECT page_id, u, CASE WHEN contains(u, '://') THEN regexp_extract(substr(u, instr(u, '://') + 3), '^[^?#]*') ELSE '' END AS r FROM a),
    c AS (SELECT page_id, regexp_extract(r, '^[^/]*') AS h, r, translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM b),
    d AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(r, length(h) + 1) AS path, low FROM c),
    e AS (SELECT *, CAST({count} AS INT) AS strict_hits, CAST({soft} AS INT) AS soft_terms FROM d)
    SELECT page_id, host, path, {name} AS rule,
      CASE {verdict} WHEN strict_hits > 0 OR soft_terms >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict, strict_hits, soft_terms
    FROM e"""


ORACLE_SQL = _oracle()
