r"""Prefix-target expansion: every assistant turn becomes an example of its own, all turns before it as context, only its reply trainable.

The template is ``<s>role\ntext</s>`` a turn, a user's text standing in ``[INST] ... [/INST]``. Inside texts and roles a control string
gets one more ``~`` after its bracket (``</s>`` becomes ``<~/s>``, ``<~/s>`` becomes ``<~~/s>``), which ``unescape`` takes back, so no
text can forge a turn and none is altered. Each example carries its loss mask as (loss_start, loss_length) in code points: exactly the
escaped reply. Turns after a conversation's last reply can be no target's context; they come as one more example with an empty mask.

The examples of a conversation grow with the square of its turns: that is the method. They are exploded before their texts are
built, so a task holds the turns of one conversation and the text of one example, and no example is shuffled. DataFrame functions only.

Cases: a null text or role is empty. Turns are ordered by number, ties by role and text, null numbers first; repeated rows are turns
of their own. Rows with a null id are one conversation. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NAMES = r"/?(?:s>|INST\])"
ESCAPE = (rf"([<\[])(~*{_NAMES})", "$1~$2")
UNESCAPE = (rf"([<\[])~(~*{_NAMES})", "$1$2")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def _role_out(role: Column) -> Column:
    """A role has no line end in the template: ``~`` is written ``~0``, a line end ``~1``."""
    return escape(F.replace(F.replace(role, F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~"))


def expand(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trainable: str = "assistant") -> DataFrame:
    """conv, example (from 0), formatted, loss_start, loss_length, whole (the example holds all turns of its conversation)."""
    own = turns.select(F.col(conv), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("__t"))
    grouped = own.groupBy(conv).agg(F.sort_array(F.collect_list("__t")).alias("__turns"))

    def rendered(t: Column) -> Column:
        head = F.concat(F.lit("<s>"), _role_out(t["role"]), F.lit("\n"), F.when(t["role"] == "user", "[INST] ").otherwise(""))
        tail = F.when(t["role"] == "user", " [/INST]</s>").otherwise("</s>")
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), tail.alias("tail"), (t["role"] == trainable).alias("trained"))

    marked = grouped.select(conv, F.transform("__turns", rendered).alias("__r"))
    ends = F.filter(F.sequence(F.lit(1), F.size("__r")), lambda k: F.get(F.col("__r"), k - 1)["trained"] | (k == F.size("__r")))
    each = marked.select(conv, "__r", F.posexplode(ends).alias("example", "__end"))
    last = F.get(F.col("__r"), F.col("__end") - 1)
    before = F.array_join(F.transform(F.slice("__r", F.lit(1), F.col("__end") - 1), lambda x: F.concat(x["head"], x["body"], x["tail"])), "")
    each = each.select(conv, "example", F.concat(before, last["head"]).alias("__before"), last.alias("__last"), (F.col("__end") == F.size("__r")).alias("whole"))
    return each.select(
        conv,
        "example",
        F.concat("__before", "__last.body", "__last.tail").alias("formatted"),
        F.length("__before").cast("long").alias("loss_start"),
        F.when(F.col("__last.trained"), F.length("__last.body")).otherwise(0).cast("long").alias("loss_length"),
        "whole",
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted example: array of struct(role, text), unescaped."""

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = part.substr(F.length(role) + 2, F.length(part) - F.length(role) - 5)  # without the line end and </s>
        body = F.when(role == "user", body.substr(F.lit(8), F.length(body) - 15)).otherwise(body)  # without [INST] and [/INST]
        return F.struct(_role_in(role).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(F.split(formatted, "<s>", -1), F.lit(2), F.size(F.split(formatted, "<s>", -1))), turn)


def loss_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(formatted.substr((start + 1).cast("int"), length.cast("int")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    examples = expand(turns.unionByName(own))
    lines = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    each = examples.select(
        "conv_id",
        F.when(F.col("whole"), F.transform(F.array(lines), lambda x: F.struct(F.size(x).cast("long").alias("n"), F.sha2(F.array_join(x, ""), 256).alias("sha")))[0]).alias("t"),
        F.struct("example", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("text")).alias("l"),
        F.length("formatted").cast("long").alias("chars"),
    )
    whole = each.groupBy("conv_id").agg(F.max("t").alias("t"), F.sort_array(F.collect_list("l")).alias("l"), F.sum("chars").alias("formatted_chars"))
    trained = F.array_join(F.col("l.text"), "")
    return whole.select("conv_id", F.col("t.n").alias("n_turns"), F.col("t.sha").alias("turns_sha256"), F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars")


ORACLE_SQL = r"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n,
        8 + length(regexp_replace(replace(replace(role, '~', '~0'), chr(10), '~1'), '([<\[])(~*/?(?:s>|INST\]))', '\1~\2', 'g'))
          + length(regexp_replace(text, '([<\[])(~*/?(?:s>|INST\]))', '\1~\2', 'g')) + CASE role WHEN 'user' THEN 15 ELSE 0 END AS chars FROM a),
c AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM b)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant' OR k = n), 0) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""
