"""From fetched pages to corpus documents: parse, bring events to their modules, render."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrel.functions import pages, text
from spindrel.functions.markdown import module_markdown
from spindrel.functions.udfs import column_function, plain

NEVER_FETCHED = "Sub-page was never fetched."


def parse_modules(fetched: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """fetched with column module; pages that hold none have module.parsed false."""
    return fetched.withColumn("module", pages.module_of(html, url))


def parse_events(fetched: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row an event: event_key, event, url, status_code, fetched, fetch_error. A page that came back but holds no event failed."""
    parsed = fetched.withColumn("event", pages.event_of(html, url))
    good = F.coalesce(F.col("success"), F.lit(False)) & F.col("event.parsed")
    rows = parsed.select(
        text.event_key("requested_url").alias("event_key"),
        "event",
        F.when(good, F.col(url)).otherwise(F.col("requested_url")).alias("url"),
        "status_code",
        good.alias("fetched"),
        F.when(~good, F.coalesce("error_message", "event.parse_error")).alias("fetch_error"),
    )
    # the first fetch of an event counts, as all requests of a run share it
    return rows.groupBy("event_key").agg(F.min_by(F.struct("event", "url", "status_code", "fetched", "fetch_error"), F.struct(~F.col("fetched"), "url")).alias("x")).select("event_key", "x.*")


def with_events(modules: DataFrame, events: DataFrame, key: list[str]) -> DataFrame:
    """modules with events: the records its links point at, in their order. A link without a fetched page is kept, with an error."""
    links = modules.select(*key, F.posexplode("module.event_links").alias("pos", "link")).withColumn("event_key", text.event_key("link.url"))
    # one column for all that the event brings, so that no name can clash with the key's
    hit = links.join(events.select("event_key", F.struct("event", "url", "status_code", "fetched", "fetch_error").alias("e")), "event_key", "left")
    record = F.struct(
        "pos",
        F.col("link.title").alias("listed_as"),
        F.coalesce("e.url", "link.url").alias("url"),
        F.coalesce("e.event.veranstid", "link.veranstid").alias("veranstid"),
        F.coalesce("e.fetched", F.lit(False)).alias("fetched"),
        F.when(F.col("e.fetched").isNull(), NEVER_FETCHED).otherwise(F.col("e.fetch_error")).alias("fetch_error"),
        F.col("e.status_code").alias("status_code"),
        F.col("e.event").alias("event"),
    )
    nested = hit.groupBy(*key).agg(F.array_sort(F.collect_list(record), lambda a, b: a["pos"] - b["pos"]).alias("events"))
    return modules.join(nested, key, "left").withColumn("events", F.coalesce("events", F.expr("filter(array(), x -> false)").cast(nested.schema["events"].dataType)))


def event_summary(events: str = "events", links: str = "module.event_links"):
    return F.struct(
        F.size(links).alias("linked"),
        F.size(F.filter(events, lambda e: e["fetched"])).alias("fetched"),
        F.size(F.filter(events, lambda e: ~e["fetched"])).alias("failed"),
    )


@column_function("string")
def rendered(module: pd.DataFrame, url: pd.Series, events: pd.Series) -> pd.Series:
    def own(e: dict) -> dict:
        return {**(e["event"] or {}), **{k: v for k, v in e.items() if k != "event"}}

    rows = zip(plain(module.to_dict("records")), url, events, strict=True)
    return pd.Series([module_markdown(m, u or "", [own(e) for e in plain(es) or []]) for m, u, es in rows], dtype=object)


def markdown_documents(modules: DataFrame, url: str = "url") -> DataFrame:
    """doc_id, metadata, content_markdown of modules with events; pages that didn't parse give none."""
    field = lambda k: F.array_join(F.col("module.fields")[k]["items"], ", ")
    good = modules.where("module.parsed").withColumn("content_markdown", rendered("module", url, "events"))
    return good.select(
        text.document_id(url).alias("doc_id"),
        F.struct(
            F.col(url).alias("url"),
            F.coalesce(F.nullif(field("module_title"), F.lit("")), "module.page_title").alias("title"),
            field("module_number").alias("module_number"),
            text.module_key(url).alias("pordnr"),
            "status_code",
            F.current_timestamp().alias("scraped_at"),
            text.word_count("content_markdown").alias("word_count"),
            F.transform(F.filter("events", lambda e: e["fetched"]), lambda e: e["url"]).alias("nested_event_pages"),
        ).alias("metadata"),
        "content_markdown",
    )


def structured_documents(modules: DataFrame, url: str = "url") -> DataFrame:
    """doc_id, source, module, unmapped_fields, events, event_summary of modules with events."""
    number = F.array_join(F.col("module.fields")["module_number"]["items"], ", ")
    return modules.where("module.parsed").select(
        text.structured_id(number, url).alias("doc_id"),
        F.struct(F.col(url).alias("url"), text.module_key(url).alias("pordnr"), "status_code", F.current_timestamp().alias("scraped_at"), *[F.col(f"module.{c}").alias(c) for c in ("page_title", "heading", "language", "parsed", "parse_error")]).alias("source"),
        F.struct("module.fields", "module.follow_up_modules", "module.phase_out_module", "module.events_listed").alias("module"),
        F.col("module.unmapped_fields").alias("unmapped_fields"),
        "events",
        event_summary().alias("event_summary"),
    )


def pending_markdown(urls: DataFrame, written: DataFrame, url: str = "url") -> DataFrame:
    """URLs whose document isn't written yet (written: doc_id)."""
    return urls.withColumn("__id", text.document_id(url)).join(written.select(F.col("doc_id").alias("__id")).distinct(), "__id", "left_anti").select(*urls.columns)


def pending_structured(urls: DataFrame, written: DataFrame, url: str = "url") -> DataFrame:
    """URLs whose key isn't written yet (written: doc_id, pordnr); those without a key go by document id."""
    rows = urls.withColumns({"__key": text.module_key(url), "__id": text.document_id(url)})
    done = written.select(F.col("pordnr").cast("string").alias("__key")).where("__key is not null").distinct()
    ids = written.select(F.col("doc_id").alias("__id")).distinct()
    keyed = rows.where("__key is not null").join(done, "__key", "left_anti")
    others = rows.where("__key is null").join(ids, "__id", "left_anti")
    return keyed.select(*urls.columns).unionByName(others.select(*urls.columns))


def pending_events(links: DataFrame, cache: DataFrame, url: str = "url") -> DataFrame:
    """Event URLs to fetch: the first URL of each key that the run's cache (failures included) doesn't hold."""
    keyed = links.select(F.col(url).alias("url"), text.event_key(url).alias("event_key")).where("url is not null")
    return keyed.groupBy("event_key").agg(F.min("url").alias("url")).join(cache.select("event_key"), "event_key", "left_anti")
