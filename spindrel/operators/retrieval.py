"""Nearest-vector retrieval of a question, and what follows from it: a verdict, a route, an answer, a log row."""

from __future__ import annotations

from collections.abc import Callable
from time import perf_counter
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.functions import fixed_values as V
from spindrel.functions import text
from spindrel.operators.similarity import top_k_batch

VERDICT = "is_relevant boolean, confidence_score double, reasoning string"
LOG = "id string, created_at timestamp, workflow_name string, user_query string, llm_model string, embeddings_model string, highest_relevance_score double, is_web_fallback_used boolean, final_response string, latency_ms double, error_log string"


def top_k(chunks: DataFrame, question: list[float], k: int = 1, id_col: str = "id", vector: str = "vector") -> DataFrame:
    """The k chunks most similar to one question by cosine; ties by id. Plans as a top-k of each task, then of those."""
    lit = F.array(*[F.lit(float(x)) for x in question])
    return chunks.withColumn("score", text.cosine(vector, lit)).where("score is not null").orderBy(F.desc("score"), id_col).limit(k)


def parse_verdict(raw):
    """The judge's JSON as a struct; malformed input has nulls throughout."""
    return F.from_json(raw, VERDICT)


def is_grounded(verdict: str = "verdict", threshold: float = V.RELEVANCE_THRESHOLD):
    """Relevant, and confident beyond the threshold; nulls are neither."""
    return F.coalesce(F.col(f"{verdict}.is_relevant") & (F.col(f"{verdict}.confidence_score") > threshold), F.lit(False))


def route(judged: DataFrame, verdict: str = "verdict", threshold: float = V.RELEVANCE_THRESHOLD) -> DataFrame:
    return judged.withColumn("route", F.when(is_grounded(verdict, threshold), "internal").otherwise("web"))


class Judge(Protocol):
    """Gives the verdict JSON of a question and its context."""

    def __call__(self, message: str, context: str, score: float) -> str: ...


class Answerer(Protocol):
    def __call__(self, message: str, context: str) -> str: ...


class WebSearch(Protocol):
    def __call__(self, query: str) -> str: ...


def overlap_judge(message: str, context: str, score: float) -> str:
    """The offline judge: relevant if the context holds over half of the question's longer words, as confident as their share."""
    import json

    words = {w for w in message.lower().split() if len(w) > 3}
    share = sum(w in context.lower() for w in words) / len(words) if words else 0.0
    return json.dumps({"is_relevant": share > 0.5, "confidence_score": share, "reasoning": f"{share:.0%} of the question's words"})


def quote_answer(message: str, context: str) -> str:
    return context


def no_search(query: str) -> str:
    return f"No search service is set up for: {query}"


def answer(questions: DataFrame, chunks: DataFrame, embedder=None, judge: Judge = overlap_judge, answerer: Answerer = quote_answer, search: WebSearch = no_search, k: int = 1, domain: str = "") -> DataFrame:
    """query_id, message, route, highest_relevance_score, response of every question (query_id, message).

    Retrieval is a plan of its own; judging and answering run once a row, as their results are costly and may differ from call to call.
    """
    from spindrel.functions.embedding import embed
    from spindrel.functions.udfs import column_function

    asked = questions.withColumn("query_vector", (embedder or embed())("message"))
    best = top_k_batch(chunks, asked, k, carry=("text",))
    found = best.groupBy("query_id").agg(F.max("score").alias("highest_relevance_score"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), "\n\n").alias("context"))

    @column_function("string")
    def judged(message, context, score):
        import pandas as pd

        return pd.Series([judge(m or "", c or "", s) for m, c, s in zip(message, context, score, strict=True)], dtype=object)

    @column_function("string")
    def answered(message, context, way, query):
        import pandas as pd

        return pd.Series([answerer(m or "", c or "") if w == "internal" else answerer(m or "", search(q)) for m, c, w, q in zip(message, context, way, query, strict=True)], dtype=object)

    rows = questions.join(found, "query_id", "left").withColumn("verdict", parse_verdict(judged("message", "context", F.coalesce("highest_relevance_score", F.lit(0.0)))))
    rows = route(rows).withColumn("response", answered("message", "context", "route", text.web_query("message", domain)))
    return rows.select("query_id", "message", "route", "highest_relevance_score", "verdict", "response")


def log_rows(answered: DataFrame, workflow: str, llm_model: str, embeddings_model: str, latency_ms: float = 0.0) -> DataFrame:
    """Rows for the workflow log, one an answer."""
    return answered.select(
        F.sha1(F.concat_ws("|", F.lit(workflow), F.col("query_id").cast("string"))).alias("id"),
        F.current_timestamp().alias("created_at"),
        F.lit(workflow).alias("workflow_name"),
        F.col("message").alias("user_query"),
        F.lit(llm_model).alias("llm_model"),
        F.lit(embeddings_model).alias("embeddings_model"),
        F.coalesce("highest_relevance_score", F.lit(0.0)).alias("highest_relevance_score"),
        (F.col("route") == "web").alias("is_web_fallback_used"),
        F.col("response").alias("final_response"),
        F.lit(float(latency_ms)).alias("latency_ms"),
        F.lit(None).cast("string").alias("error_log"),
    )


def logged(answered: DataFrame, keep: Callable[[DataFrame], DataFrame], workflow: str, llm_model: str, embeddings_model: str) -> DataFrame:
    """Log rows with measured latency: ``keep`` evaluates the answers once (it writes and rereads them), and each question bears its share of the time."""
    began = perf_counter()
    rows = keep(answered)
    return log_rows(rows, workflow, llm_model, embeddings_model, (perf_counter() - began) * 1000 / max(1, rows.count()))


def error_row(spark, workflow: str, error: str, query: str = "") -> DataFrame:
    """The log row of a run that failed."""
    row = spark.range(1).select(F.lit(query).alias("message"), F.lit("internal").alias("route"), F.lit(0.0).alias("highest_relevance_score"), F.lit(None).cast("string").alias("response"), F.lit(error).alias("query_id"))
    return log_rows(row, workflow, "", "").withColumn("error_log", F.lit(error))
