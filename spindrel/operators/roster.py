"""One record a person, from many sightings: merged by address or name inside a chair, then across chairs, in the order pages list them.

Order matters (first values win, longest texts win with the earliest on ties), so every row carries ``seq``, an array of ordinals (faculty,
institute, chair, page, person), and every merge orders by it: results don't depend on how rows are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrel.functions import fixed_values as V
from spindrel.functions import text
from spindrel.functions.names import looks_like_person
from spindrel.functions.repair import slug_of, tokens_of

LISTS = ("emails", "phones", "faxes", "mobiles", "address_lines", "other_lines", "links", "designations", "source_urls", "affiliations")
SCALARS = ("room", "building", "orcid", "section_heading", "image_url", "image_alt", "image_caption")
LONGEST = ("career", "office_hours")
_LINKS = "array<struct<label:string,url:string>>"
AFFILIATION = "struct<faculty:string,faculty_number:int,institute:string,chair:string,chair_url:string,chair_is_former:boolean,designations:array<string>,is_head_of_chair:boolean>"
_TYPES = {**dict.fromkeys(LISTS, "array<string>"), "links": _LINKS, "affiliations": f"array<{AFFILIATION}>", **dict.fromkeys((*SCALARS, *LONGEST, "raw_text"), "string"), "is_head_of_chair": "boolean"}


def normalized(sightings: DataFrame) -> DataFrame:
    """chair_id, seq, name and all merge fields; what a sighting lacks is empty. ``designation`` and ``source_url`` become lists of one."""
    have = set(sightings.columns)
    cols = {}
    for name, kind in _TYPES.items():
        if name in have:
            cols[name] = F.col(name).cast(kind)
        elif name[:-1] in have and name in ("designations", "source_urls"):
            cols[name] = F.filter(F.array(name[:-1]), lambda v: v.isNotNull() & (v != ""))
        else:
            cols[name] = F.lit(None).cast(kind)
        if name in LISTS:
            cols[name] = F.coalesce(cols[name], F.array().cast(kind))
    cols["is_head_of_chair"] = F.coalesce(cols["is_head_of_chair"], F.lit(False))
    return sightings.select("chair_id", F.col("seq").cast("array<int>").alias("seq"), F.coalesce("name", F.lit("")).alias("name"), *[c.alias(n) for n, c in cols.items()])


def _identity(people: DataFrame) -> DataFrame:
    """people with tokens, personal (addresses built from the name), key_kind and key."""
    known = people.withColumn("tokens", tokens_of("name")).withColumn("personal", text.personal_emails("emails", "tokens"))
    by_mail = F.size("personal") > 0
    by_name = F.when(F.size("tokens") > 0, F.array_join("tokens", " ")).otherwise(F.lower("name"))
    return known.withColumns({"key_kind": F.when(by_mail, "email").otherwise("name"), "key": F.when(by_mail, F.get("personal", F.lit(0))).otherwise(by_name)})


def _merged(rows: DataFrame, by: list[str], late: Column | None = None) -> DataFrame:
    """One row a group. Rows are taken in order of seq, those where ``late`` holds after the others; the group keeps the first row's seq."""
    rows = rows.withColumn("__o", F.struct((F.lit(False) if late is None else late).alias("late"), "seq"))
    said = lambda c: F.when(F.length(c) > 0, F.col("__o"))  # noqa: E731  null where there is nothing, which min_by passes over
    union = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("__o", c))), lambda x: x[c]))).alias(c)
    lists = [union(c) for c in LISTS]
    firsts = [F.min_by(c, said(c)).alias(c) for c in SCALARS]
    longest = [F.min_by(c, F.when(F.length(c) > 0, F.struct(-F.length(c), "__o"))).alias(c) for c in LONGEST]
    name = F.min_by("name", F.struct(-F.length("name"), "__o")).alias("name")
    return rows.groupBy(*by).agg(F.min_by("seq", "__o").alias("seq"), name, *lists, *firsts, *longest, F.min_by("raw_text", "__o").alias("raw_text"), F.bool_or("is_head_of_chair").alias("is_head_of_chair"))


def _fold_addressless(people: DataFrame, scope: list[str]) -> DataFrame:
    """Records without an address of their own join the first record in scope with one and the same name tokens."""
    own = _identity(people).drop("key_kind", "key")
    reachable = F.size("personal") > 0
    same = Window.partitionBy(*scope, "tokens")
    host = F.min(F.when(reachable, F.col("seq"))).over(same)
    own = own.withColumn("__host", F.when((F.size("tokens") > 0) & ~reachable, host))
    own = own.withColumn("__target", F.coalesce("__host", "seq"))
    return _merged(own, [*scope, "__target"], late=F.col("__host").isNotNull()).drop("__target")


def merge_in_chair(sightings: DataFrame) -> DataFrame:
    """Sightings (chair_id, seq, name, ...) as one record a person and chair."""
    people = _identity(normalized(sightings))
    return _fold_addressless(_merged(people, ["chair_id", "key_kind", "key"]).drop("key_kind", "key"), ["chair_id"])


def attach_heads(people: DataFrame, chairs: DataFrame, loose: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(people, unattached). chairs: chair_id, seq, head_of_chair. loose: chair_id, url, designation, career, office_hours, named_people.

    The first person of a chair whose name holds the head's last token is its head; a named head that nobody matches becomes a person.
    Careers and office hours of leadership pages that name nobody go to the head, others stay with the chair.
    """
    named = chairs.where(~text.is_vacant("head_of_chair")).select("chair_id", F.col("seq").alias("__chair_seq"), F.trim("head_of_chair").alias("__head"))
    named = named.withColumn("__last", F.try_element_at(tokens_of("__head"), F.lit(-1)))
    tokens = people.select("chair_id", "seq", tokens_of("name").alias("__tokens"))
    hit = named.join(tokens, "chair_id").where(F.array_contains("__tokens", F.col("__last"))).groupBy("chair_id").agg(F.min("seq").alias("__head_seq"))
    marked = people.join(hit, "chair_id", "left").withColumn("is_head_of_chair", F.col("is_head_of_chair") | F.coalesce(F.col("seq") == F.col("__head_seq"), F.lit(False))).drop("__head_seq")
    missing = named.join(hit, "chair_id", "left_anti").select("chair_id", F.concat(F.col("__chair_seq").cast("array<int>"), F.array(F.lit(2**31 - 1))).alias("seq"), F.col("__head").alias("name"), F.lit(True).alias("is_head_of_chair"))
    everyone = marked.unionByName(normalized(missing).select(*marked.columns))
    if loose is None:
        return everyone, people.sparkSession.createDataFrame([], "chair_id string, kind string, source_url string, text string")
    heads = named.select("chair_id").withColumn("__has", F.lit(True))
    to_head = F.coalesce(F.col("__has"), F.lit(False)) & F.coalesce(F.col("designation"), F.lit("")).rlike(f"(?iu){V.LEADERSHIP}") & (F.col("named_people") == 0)
    placed = loose.join(heads, "chair_id", "left").withColumn("__to_head", to_head)
    order = F.col("seq") if "seq" in loose.columns else F.col("url")
    told = placed.where("__to_head").groupBy("chair_id").agg(*[F.min_by(c, F.when(F.length(c) > 0, F.struct(-F.length(c), order))).alias(f"__{c}") for c in LONGEST])
    everyone = everyone.join(told, "chair_id", "left")
    for c in LONGEST:
        longer = F.col("is_head_of_chair") & (F.length(f"__{c}") > F.coalesce(F.length(c), F.lit(0)))
        everyone = everyone.withColumn(c, F.when(longer, F.col(f"__{c}")).otherwise(F.col(c)))
    left = placed.where("not __to_head").select("chair_id", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col("url").alias("source_url"), F.col(c).alias("text")) for c in LONGEST])).alias("x"))
    return everyone.select(*people.columns), left.select("chair_id", "x.*").where(F.length("text") > 0).distinct()


#: What a chair tells about its head.
HEAD_FIELDS = ("name", "emails", "phones", "faxes", "mobiles", "room", "building", "address_lines", "office_hours", "image_url", "career", "orcid", "designations", "source_urls")


def head_records(people_by_chair: DataFrame) -> DataFrame:
    """chair_id, head_of_chair_resolved (whether the chair's pages describe its head), head_of_chair_person, of every chair whose head is named."""
    heads = people_by_chair.where("is_head_of_chair").select("chair_id", "seq", F.struct(*HEAD_FIELDS).alias("__p"))
    first = heads.groupBy("chair_id").agg(F.min_by("__p", "seq").alias("head_of_chair_person"), F.min("seq").alias("__s"))
    listed = F.element_at("__s", -1) != 2**31 - 1  # the place of a head that nobody matches
    return first.select("chair_id", listed.alias("head_of_chair_resolved"), "head_of_chair_person")


def chair_designations(navs: DataFrame) -> DataFrame:
    """chair_id, designations: the roles in a chair's menu, each once, by code point."""
    roles = _menu_entries(navs).where("role is not null")
    return roles.groupBy("chair_id").agg(F.array_sort(F.collect_set("role")).alias("designations"))


def merge_everywhere(people: DataFrame, chairs: DataFrame) -> DataFrame:
    """One record a person over all chairs, with affiliations. chairs: chair_id and the fields of AFFILIATION that don't come from the person."""
    placed = people.drop("affiliations").join(chairs.select("chair_id", "faculty", "faculty_number", "institute", "chair", "chair_url", "chair_is_former"), "chair_id")
    one = F.struct("faculty", "faculty_number", "institute", "chair", "chair_url", "chair_is_former", "designations", "is_head_of_chair").cast(AFFILIATION)
    placed = placed.withColumn("affiliations", F.array(one))
    by_key = _merged(_identity(placed), ["key_kind", "key"]).drop("key_kind", "key")
    folded = _fold_addressless(by_key, [])
    named = folded.withColumn("tokens", tokens_of("name"))
    alike = F.when(F.size("tokens") > 0, F.array_join("tokens", " "))
    return _merged(named.withColumn("__same", F.coalesce(alike, F.concat(F.lit("#"), F.col("seq").cast("string")))), ["__same"]).drop("__same")


def flat_roster(people: DataFrame) -> DataFrame:
    """key and scalar fields of each person; people whose names reduce to one slug get -2, -3, ... in order."""
    each = lambda f: F.transform("affiliations", lambda a: a[f])
    flat = people.select(
        "seq",
        slug_of("name").alias("slug"),
        "name",
        text.joined("emails").alias("email"),
        text.joined("phones").alias("phone"),
        text.joined("mobiles").alias("mobile"),
        text.joined("faxes").alias("fax"),
        "room",
        "building",
        text.joined("address_lines", ", ").alias("address"),
        "office_hours",
        text.joined("designations").alias("designation"),
        *[text.joined(each(f)).alias(f) for f in ("faculty", "institute", "chair", "chair_url")],
        "is_head_of_chair",
        F.forall(each("chair_is_former"), lambda x: F.coalesce(x, F.lit(False))).alias("is_former_chair"),
        "image_url",
        "image_caption",
        "orcid",
        "career",
        text.joined(F.transform("links", lambda x: x["url"])).alias("website"),
        text.joined("source_urls").alias("profile_url"),
        text.joined("other_lines").alias("notes"),
    )
    nth = F.row_number().over(Window.partitionBy("slug").orderBy("seq"))
    key = F.when(nth == 1, F.col("slug")).otherwise(F.concat("slug", F.lit("-"), nth.cast("string")))
    return flat.withColumn("key", key).select("key", *[c for c in flat.columns if c not in ("slug", "seq")])


def search_roster(roster: DataFrame, faculty: str | None = None, q: str | None = None) -> DataFrame:
    """Flat records of a faculty (``fakultät <n>`` within its name, as a substring) and with q in name, address or chair."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    if faculty:
        roster = roster.where(F.contains(low("faculty"), F.lit(f"fakultät {faculty}".lower())))
    if q:
        needle = F.lit(q.lower())
        roster = roster.where(F.contains(low("name"), needle) | F.contains(low("email"), needle) | F.contains(low("chair"), needle))
    return roster


def crawl_counters(chairs: DataFrame, people: DataFrame) -> DataFrame:
    """One row of counts. chairs: faculty, institute, status, team_menu_found, chair_id; people: merged records with affiliations; heads by chair are counted before people merge."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    of_chairs = chairs.agg(
        F.count_distinct("faculty").alias("faculties"),
        F.count_distinct("faculty", F.coalesce("institute", F.lit(""))).alias("institutes"),
        F.count(F.lit(1)).alias("chairs"),
        F.count_if("team_menu_found").alias("chairs_with_team_menu"),
        is_("crawled").alias("chairs_crawled"),
        is_("no_link").alias("chairs_without_link"),
        is_("external").alias("chairs_hosted_externally"),
        is_("fetch_failed").alias("chairs_fetch_failed"),
    )
    has = lambda c: F.count_if(F.length(c) > 0)
    of_people = people.agg(F.count(F.lit(1)).alias("people"), F.count_if(F.size("emails") > 0).alias("people_with_email"), has("image_url").alias("people_with_image"), has("career").alias("people_with_career"), has("office_hours").alias("people_with_office_hours"))
    return of_chairs.crossJoin(of_people)  # one row each


def head_counters(people_by_chair: DataFrame) -> DataFrame:
    """One row: chairs whose head is named, and those whose head can be reached; on the chairs' own values."""
    heads = people_by_chair.where("is_head_of_chair").groupBy("chair_id").agg(F.bool_or((F.size("emails") > 0) | (F.size("phones") > 0)).alias("reach"))
    return heads.agg(F.count(F.lit(1)).alias("chairs_with_head_named"), F.count_if("reach").alias("chairs_with_head_contactable"))


# --- what to crawl ---


def chair_status(chairs: DataFrame) -> DataFrame:
    """chairs with status before the fetch: no_link, external or to_fetch."""
    return chairs.withColumn("status", F.when(F.coalesce(F.col("url"), F.lit("")) == "", "no_link").when(F.col("external"), "external").otherwise("to_fetch"))


def _menu_entries(navs: DataFrame) -> DataFrame:
    """chair_id, s, e, url, role (null for pages about the chair and for members by name) of the own pages in team menus."""
    sections = navs.select("chair_id", F.posexplode("nav.team_sections").alias("s", "section"))
    entries = sections.select("chair_id", "s", F.posexplode("section.entries").alias("e", "entry")).where(text.is_own_host("entry.url"))
    role = F.col("entry.is_designation") & ~looks_like_person("entry.designation")
    return entries.select("chair_id", "s", "e", F.col("entry.url").alias("url"), F.when(role, F.col("entry.designation")).alias("role"))


def targets(navs: DataFrame) -> DataFrame:
    """chair_id, ord, url, designation: the pages of a chair to read for people, each once. navs: chair_id, url (of the landing page), nav.

    A page listed with a role and without one keeps the role; ord is its first place.
    """
    own = navs.select("chair_id", F.array(F.lit(0)).alias("ord"), "url", F.lit(None).cast("string").alias("designation"))
    sections = navs.select("chair_id", F.posexplode("nav.team_sections").alias("s", "section"))
    menus = sections.where("section.url is not null").select("chair_id", F.array(F.lit(1), F.col("s"), F.lit(-1)).alias("ord"), F.col("section.url").alias("url"), F.lit(None).cast("string").alias("designation"))
    listed = _menu_entries(navs).select("chair_id", F.array(F.lit(1), F.col("s"), F.col("e")).alias("ord"), "url", F.col("role").alias("designation"))
    every = own.unionByName(menus).unionByName(listed)
    return every.groupBy("chair_id", "url").agg(F.min("ord").alias("ord"), F.min_by("designation", F.when(F.col("designation").isNotNull(), F.col("ord"))).alias("designation")).select("chair_id", "ord", "url", "designation")


def sibling_targets(pages: DataFrame, seen: DataFrame) -> DataFrame:
    """Pages that the sidebars of read pages name and that the chair hasn't read: chair_id, ord, url, designation of the page that named them first."""
    each = pages.select("chair_id", "ord", "designation", F.posexplode("page.siblings").alias("k", "x")).where(text.is_own_host("x.url"))
    each = each.select("chair_id", F.concat(F.array(F.lit(2)), F.col("ord"), F.array("k")).alias("ord"), F.col("x.url").alias("url"), "designation")
    first = each.groupBy("chair_id", "url").agg(F.min(F.struct("ord", "designation")).alias("f")).select("chair_id", "f.ord", "url", "f.designation")
    return first.join(seen.select("chair_id", "url"), ["chair_id", "url"], "left_anti").select("chair_id", "ord", "url", "designation")


def sightings(pages: DataFrame) -> DataFrame:
    """People of read pages with their designation: the heading above them unless that names no job, else the page's label. pages: chair_id, chair_seq, ord, designation, page, final_url.

    A page with a career or office hours but no person names its subject in the last breadcrumb or its heading, if anywhere.
    """
    seq = lambda k: F.concat(F.col("chair_seq"), F.col("ord"), F.array(k))
    people = pages.select("chair_id", "chair_seq", "ord", F.col("designation").alias("__label"), F.posexplode("page.people").alias("k", "p"))
    heading = F.when(~F.coalesce(F.col("p.section_heading"), F.lit("")).rlike(f"(?iu){V.NON_DESIGNATION}"), F.nullif("p.section_heading", F.lit("")))
    found = people.select("chair_id", seq(F.col("k")).alias("seq"), F.coalesce(heading, "__label").alias("designation"), "p.*")
    told = (F.size("page.people") == 0) & (F.length(F.coalesce("page.career", "page.office_hours")) > 0)
    crumb, head = F.try_element_at("page.breadcrumb", F.lit(-1)), F.col("page.page_heading")
    name = F.when(looks_like_person(F.coalesce(crumb, F.lit(""))), crumb).when(looks_like_person(F.coalesce(head, F.lit(""))), head)
    subjects = pages.where(told).withColumn("name", name).where("name is not null")
    subjects = subjects.select("chair_id", seq(F.lit(0)).alias("seq"), "designation", "name", F.col("page.career").alias("career"), F.col("page.office_hours").alias("office_hours"), F.col("final_url").alias("source_url"))
    return found.unionByName(subjects, allowMissingColumns=True)


def loose_sections(pages: DataFrame) -> DataFrame:
    """Careers and office hours that their page doesn't attach to anyone: chair_id, seq, url, designation, career, office_hours, named_people."""
    named = F.size("page.people")
    crumb, head = F.try_element_at("page.breadcrumb", F.lit(-1)), F.col("page.page_heading")
    has_subject = (named == 0) & (looks_like_person(F.coalesce(crumb, F.lit(""))) | looks_like_person(F.coalesce(head, F.lit(""))))
    rows = pages.select("chair_id", F.concat("chair_seq", "ord").alias("seq"), F.col("final_url").alias("url"), "designation", F.col("page.career").alias("career"), F.col("page.office_hours").alias("office_hours"), named.alias("named_people"), has_subject.alias("__s"))
    return rows.where((~F.col("__s")) & (F.length(F.coalesce("career", "office_hours")) > 0)).drop("__s")
