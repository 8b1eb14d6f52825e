"""Whole runs: what the control surface offers, as functions. Pages come from a ``fetch`` function (URLs in, FETCHED rows out) that tests replace."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.functions import people as team
from spindrel.operators import corpus, roster
from spindrel.operators.sync import sync
from spindrel.sources.fetch import fetch_stats
from spindrel.sources.snapshots import SnapshotTable

Fetch = Callable[[DataFrame], DataFrame]


class Workspace:
    """Where a run keeps fetched pages: they are written before they are parsed, and a page that the run has is not requested again. The folder goes when the
    application ends."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.pages, self.lookups = spark, f"{root.rstrip('/')}/run-{uuid4().hex}", None, 0
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.parquet(f"{self.root}/{name}")

    def get(self, wanted: DataFrame, fetch: Fetch, name: str) -> DataFrame:
        """FETCHED rows of the URLs (url) that are wanted, from this run's earlier requests where it has them."""
        urls = self.keep(wanted.select("url").where("url is not null"), f"{name}_wanted")
        self.lookups += urls.count()
        each = urls.distinct()
        new = each if self.pages is None else each.join(self.pages.select(F.col("requested_url").alias("url")), "url", "left_anti")
        got = self.keep(fetch(new), name)
        self.pages = got if self.pages is None else self.pages.unionByName(got)
        return self.pages.join(each.select(F.col("url").alias("requested_url")), "requested_url", "left_semi")


def crawl_modules(spark: SparkSession, links: DataFrame, fetch: Fetch, work: str) -> DataFrame:
    """Modules with their events, from a link list (url): modules, then the event pages that they name, each once."""
    space = Workspace(spark, work)
    pages = space.get(links, fetch, "modules")
    modules = space.keep(corpus.parse_modules(pages.where("success")).drop("html"), "parsed").where("module.parsed")
    wanted = modules.select(F.explode("module.event_links.url").alias("url"))
    empty = spark.createDataFrame([], "event_key string")
    events = space.keep(corpus.parse_events(space.get(corpus.pending_events(wanted, empty), fetch, "event_pages")), "events")
    return corpus.with_events(modules, events, ["requested_url"])


def build_markdown_corpus(spark: SparkSession, links: DataFrame, fetch: Fetch, work: str, written: DataFrame | None = None) -> DataFrame:
    """Documents of the links that aren't written yet."""
    todo = corpus.pending_markdown(links, written) if written is not None else links
    return corpus.markdown_documents(crawl_modules(spark, todo, fetch, work))


def build_structured_corpus(spark: SparkSession, links: DataFrame, fetch: Fetch, work: str, written: DataFrame | None = None) -> DataFrame:
    todo = corpus.pending_structured(links, written) if written is not None else links
    return corpus.structured_documents(crawl_modules(spark, todo, fetch, work))


def run_etl(spark: SparkSession, links: DataFrame, fetch: Fetch, work: str, table: SnapshotTable) -> dict:
    """Crawl everything afresh and bring the chunk table in step."""
    documents = Workspace(spark, work).keep(build_markdown_corpus(spark, links, fetch, work), "documents")
    return sync(table, documents.select("doc_id", F.col("content_markdown").alias("content"), "metadata.url", "metadata.title"))


def build_roster(spark: SparkSession, faculties: DataFrame, fetch: Fetch, work: str) -> dict[str, DataFrame]:
    """roster (flat), people, chairs, unattached, counters, stats from faculty pages (ord, url): four levels of pages, each written before the next."""
    space = Workspace(spark, work)
    pages = space.get(faculties, fetch, "faculties")
    parsed = faculties.join(pages.where("success"), faculties["url"] == pages["requested_url"]).select("ord", team.faculty_of("html", pages["url"]).alias("f"))
    rows = parsed.select(F.col("ord").cast("int").alias("ord"), F.col("f.faculty_name").alias("faculty"), F.col("f.faculty_number").alias("faculty_number"), F.explode("f.chairs").alias("c")).select("ord", "faculty", "faculty_number", "c.*")
    chairs = roster.chair_status(rows.withColumns({"seq": F.array("ord", "institute_ord", "chair_ord"), "chair_id": F.concat_ws("/", "ord", "institute_ord", "chair_ord")}))
    chairs = space.keep(chairs, "chairs")
    landings = space.get(chairs.where("status = 'to_fetch'"), fetch, "landings")
    hit = landings.select(F.col("requested_url").alias("url"), "success", "html", F.col("url").alias("final_url"))
    landed = chairs.where("status = 'to_fetch'").join(hit, "url", "left")
    navs = space.keep(landed.where("success").select("chair_id", F.col("seq").alias("chair_seq"), F.col("final_url").alias("url"), team.nav_of("html", "final_url").alias("nav")), "navs")
    first = space.keep(roster.targets(navs).join(navs.select("chair_id", "chair_seq"), "chair_id"), "targets")
    one = space.keep(_read(first, fetch, space, "pages_1"), "parsed_1")
    more = space.keep(roster.sibling_targets(one, first).join(navs.select("chair_id", "chair_seq"), "chair_id"), "siblings")
    two = space.keep(_read(more, fetch, space, "pages_2"), "parsed_2")
    read = one.unionByName(two)
    people = roster.merge_in_chair(roster.sightings(read))
    heads, unattached = roster.attach_heads(people, chairs.where("status = 'to_fetch'").join(navs.select("chair_id"), "chair_id", "left_semi"), roster.loose_sections(read))
    heads = space.keep(heads, "people_by_chair")
    status = chairs.join(navs.select("chair_id", "nav.chair_title", (F.size("nav.team_sections") > 0).alias("team_menu_found")), "chair_id", "left")
    status = status.withColumns({"team_menu_found": F.coalesce("team_menu_found", F.lit(False)), "status": F.when(F.col("status") != "to_fetch", F.col("status")).when(F.col("chair_title").isNotNull() | F.col("team_menu_found"), "crawled").otherwise("fetch_failed")})
    crawled = navs.select("chair_id").withColumn("__ok", F.lit(True))
    status = status.join(crawled, "chair_id", "left").withColumn("status", F.when(F.col("__ok") & (F.col("status") == "fetch_failed"), "crawled").otherwise(F.col("status"))).drop("__ok")
    named = status.withColumns({"chair": F.coalesce("chair_title", "name"), "chair_url": F.col("url"), "chair_is_former": F.col("former")})
    everyone = space.keep(roster.merge_everywhere(heads, named), "people")
    counters = roster.crawl_counters(status, everyone).crossJoin(roster.head_counters(heads))  # one row each
    told = status.join(roster.chair_designations(navs), "chair_id", "left").join(roster.head_records(heads), "chair_id", "left")
    told = told.withColumns({"designations": F.coalesce("designations", F.array().cast("array<string>")), "head_of_chair_resolved": F.coalesce("head_of_chair_resolved", F.lit(False))})
    return {"roster": roster.flat_roster(everyone), "people": everyone, "chairs": told, "unattached": unattached, "counters": counters, "stats": fetch_stats(space.pages, space.lookups)}


def _read(wanted: DataFrame, fetch: Fetch, space: Workspace, name: str) -> DataFrame:
    """wanted with the parsed page of each URL; pages that didn't come are left out."""
    pages = space.get(wanted, fetch, name).where("success")
    parsed = pages.select(F.col("requested_url").alias("url"), F.col("url").alias("final_url"), team.people_of("html", "url").alias("page"))
    return wanted.join(parsed, "url")
