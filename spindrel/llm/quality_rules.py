"""Rule bitmask ledger: measure every document once, keep the failed rules as bits, judge later.

``ledger`` evaluates all rules in one scan, without a shuffle: per document the measurements and a long whose bit r says that
rule r failed. Policies are (version, the rules they enforce) and read only the ledger: a document is kept when none of the
policy's bits is set. ``ablations`` counts by bitwise aggregation what each rule rejects, what it alone rejects, and what
would come back without it. Everything is DataFrame functions.

A text's words are runs of anything but space and 0x09-0x0D. Repeated three-word windows are found inside the row, by sorting
the windows' 64-bit hashes with their positions, so a text of n words costs n log n and no other row is needed.

Cases: a null or empty text has no words and fails ``min_words``. Long texts are measured whole. Repeated rows each get their
line, an empty table gives an empty ledger, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm.common import written

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Failure of each rule, over the measurements; the place in this list is the rule's bit. Never reorder, only append.
RULES = (
    ("min_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    ("exclaimed_words", "5 * n_exclaimed > 2 * n_words"),
    ("upper_case", "2 * n_upper > word_chars"),
    ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 16 * n_words)"),
    ("one_word", "n_words >= 20 and 12 * n_distinct_words < n_words"),
)
#: version -> rules that it enforces.
POLICIES = {
    "base": ("min_words", "repeated_windows"),
    "v1": ("min_words", "repeated_windows", "symbols", "duplicate_lines", "exclaimed_words", "upper_case", "word_length", "one_word"),
}


def _with(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    hashes = F.transform(F.slice(words, F.lit(1), F.size(words) - 2), lambda w, i: F.xxhash64(w, words[i + 1], words[i + 2]))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return _with(
                F.array_sort(F.transform(twice, lambda x: x["i"])),
                lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"]),
            )

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_with(placed, of_sorted))

    return F.when(F.size(words) < 4, 0).otherwise(_with(hashes, covered))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the measurements, all long."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    full = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    # one array of one struct: what several measurements need is bound by transform, so it is computed once a row
    words = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " ", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), full)
    exclaimed = lambda w: F.endswith(w, F.lit("!!"))

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
            F.size(F.filter(w, exclaimed)).cast("long").alias("n_exclaimed"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    length = F.length(text)
    kept = docs.select(
        F.col(id_col),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (length - F.length(F.translate(text, UPPER, ""))).cast("long").alias("n_upper"),
        _with(words, of).alias("__w"),
        _with(lines, of_lines).alias("__l"),
    )
    return kept.select(id_col, "__w.*", "__l.*", "word_chars", "n_symbols", "n_upper")


def bits(rules=RULES) -> Column:
    """The failure bits of all rules, over the measurements."""
    out = F.lit(0).cast("long")
    for k, (_, failure) in enumerate(rules):
        out = out.bitwiseOR(F.when(F.expr(failure), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def mask(names, rules=RULES) -> int:
    place = {name: k for k, (name, _) in enumerate(rules)}
    return sum(1 << place[n] for n in names)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """id, the measurements and failed (long, one bit a rule)."""
    return measure(docs, id_col, text_col).withColumn("failed", bits(rules))


def passes(policy: str, failed: str = "failed", policies=POLICIES, rules=RULES) -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(policies[policy], rules))) == 0


def ablations(table: DataFrame, policy: str, policies=POLICIES, rules=RULES) -> DataFrame:
    """rule, rejected (documents it fails), alone (fails only it, of the policy's), kept_without (documents kept if it went)."""
    full = mask(policies[policy], rules)
    shown = table.groupBy(F.col("failed").bitwiseAND(F.lit(full)).alias("f")).count()  # at most 2^rules rows, combined before the shuffle
    names = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n], rules)).cast("long").alias("bit")) for n in policies[policy]])
    flat = shown.select("f", "count", F.explode(names).alias("r")).select("f", "count", "r.*")
    return flat.groupBy("rule").agg(
        F.sum(F.when(F.col("f").bitwiseAND(F.col("bit")) != 0, F.col("count")).otherwise(0)).alias("rejected"),
        F.sum(F.when(F.col("f") == F.col("bit"), F.col("count")).otherwise(0)).alias("alone"),
        F.sum(F.when((F.col("f") == F.col("bit")) | (F.col("f") == 0), F.col("count")).otherwise(0)).alias("kept_without"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    failed_base = ~passes("base")
    return table.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed_base.alias("base_failed"), (~failed_base & passes("v1")).alias("kept"), F.col("failed").alias("failed_rules"))


def ablation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy in force rejects, from a ledger that is written once."""
    table = written(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "failed"))
    return ablations(table, "v1")


def _oracle() -> str:
    sp = "[\\x20\\x09-\\x0D]"
    fail = " | ".join(f"(CASE WHEN {f} THEN {1 << k} ELSE 0 END)" for k, (_, f) in enumerate(RULES))
    return f"""
    WITH a AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    b AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{sp}+'), lambda w: w <> '') AS w,
            list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{sp}', '', 'g') <> '') AS l FROM a),
    g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM b)),
    h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
    r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM h, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
    m AS (SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{sp}', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
            CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct_words,
            CAST(len(list_filter(w, lambda x: ends_with(x, '!!'))) AS BIGINT) AS n_exclaimed
          FROM b LEFT JOIN r ON b.doc_id = r.doc_id),
    f AS (SELECT *, CAST({fail} AS BIGINT) AS failed_rules FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_rules & {mask(POLICIES["base"])}) <> 0 AS base_failed,
      (failed_rules & {mask(POLICIES["v1"])}) = 0 AS kept, failed_rules FROM f"""


def _ablation_oracle() -> str:
    full = mask(POLICIES["v1"])
    each = " UNION ALL ".join(f"SELECT '{n}' AS rule, {mask([n])} AS bit" for n in POLICIES["v1"])
    return f"""WITH l AS (SELECT failed_rules & {full} AS f FROM ({ORACLE_SQL})), r AS ({each})
    SELECT rule, CAST(count(*) FILTER (WHERE f & bit <> 0) AS BIGINT) AS rejected, CAST(count(*) FILTER (WHERE f = bit) AS BIGINT) AS alone, CAST(count(*) FILTER (WHERE f = bit OR f = 0) AS BIGINT) AS kept_without FROM r, l GROUP BY rule"""


ORACLE_SQL = _oracle()
ABLATION_SQL = _ablation_oracle()
