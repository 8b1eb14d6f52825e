"""Scalar text functions as Column expressions: they stay in the JVM and fold into generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spindrel.functions import fixed_values as V


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def collapse_space(c) -> Column:
    """White space of any kind (no-break spaces too) becomes single spaces; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"(?U)\s+", " "))


def word_count(c) -> Column:
    text = collapse_space(c)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def is_blank(c) -> Column:
    return ~F.coalesce(_c(c), F.lit("")).rlike(r"(?U)\S")


def slug(label) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(_c(label)), r"(?U)[^\w]+", "_"), "^_+|_+$", "")
    return F.when(s == "", "unnamed").otherwise(s)


def first_group(c, pattern: str, group: int = 1) -> Column:
    """A group of the first match, or null."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def module_key(url) -> Column:
    return first_group(url, V.PORDNR)


def event_id(url) -> Column:
    """The first query parameter whose name ends in the event suffix, decoded."""
    return F.try_url_decode(first_group(F.substring_index(_c(url), "#", 1), rf"[?&][^=&#]*{V.EVENT_ID_SUFFIX}=([^&#]+)"))


def event_key(url) -> Column:
    return F.coalesce(event_id(url), _c(url))


def document_id(url) -> Column:
    """modul_p<number>, or modul_x<md5> for a URL without one."""
    key = module_key(url)
    return F.coalesce(F.concat(F.lit("modul_p"), key), F.concat(F.lit("modul_x"), F.substring(F.md5(_c(url).cast("binary")), 1, 12)))


def structured_id(module_number, url) -> Column:
    return F.coalesce(F.concat(F.lit("modul_"), first_group(module_number, V.LEADING_DIGITS)), document_id(url))


def content_hash(c) -> Column:
    return F.md5(_c(c).cast("binary"))


def uuid5(name, namespace: str = V.NAMESPACE_URL) -> Column:
    """Version 5 UUID of a name: SHA-1 of namespace and name with the version and variant nibbles set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), _c(name).cast("binary")))
    part = lambda a, n: F.substring(h, a, n)
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def chunk_id(url, index) -> Column:
    return uuid5(F.concat(_c(url), F.lit("_chunk_"), _c(index).cast("string")))


def _through(c: Column, steps) -> Column:
    for pattern, replacement in steps:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def normalize_email(c) -> Column:
    """user@host of any published form of an address, or null. Text repairs (UTF-7) come before, where pages are parsed."""
    text = collapse_space(F.translate(F.coalesce(_c(c), F.lit("")), "\u00ad\u200b", ""))
    found = F.lower(F.regexp_extract(_through(text, V.EMAIL_BEFORE), f"({V.EMAIL})", 1))
    local, domain = _through(F.substring_index(found, "@", 1), V.EMAIL_AFTER), _through(F.substring_index(found, "@", -1), V.EMAIL_AFTER)
    return F.when((found != "") & (local != "") & (domain != ""), F.concat(local, F.lit("@"), domain))


def result_count(c) -> Column:
    return F.replace(first_group(c, V.RESULT_COUNT), F.lit("."), F.lit("")).cast("int")


def group_name(caption) -> Column:
    return F.nullif(F.trim(F.regexp_replace(_c(caption), V.GROUP_PREFIX, "")), F.lit(""))


def without_site(title) -> Column:
    return F.nullif(collapse_space(F.regexp_replace(collapse_space(title), f"(?iu){V.SITE_SUFFIX}", "")), F.lit(""))


def before_pipe(name) -> Column:
    return collapse_space(F.split_part(_c(name), F.lit("|"), F.lit(1)))


def without_items(text, items) -> Column:
    """A cell's lead-in: its text without the texts of its list items."""
    return collapse_space(F.aggregate(_c(items), _c(text), lambda a, i: F.replace(a, i, F.lit(""))))


def section_kind(heading) -> Column:
    return F.when(_c(heading).rlike(f"(?iu){V.HOURS_HEADING}"), "office_hours").when(_c(heading).rlike(f"(?iu){V.CAREER_HEADING}"), "career")


def joined(values, separator: str = "; ") -> Column:
    """Different non-blank values in order, or null if there are none."""
    kept = F.array_distinct(F.filter(F.transform(_c(values), lambda v: F.trim(v)), lambda v: v != ""))
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def personal_emails(emails, tokens) -> Column:
    """Addresses whose local part holds the start of one of the person's name tokens."""
    return F.filter(_c(emails), lambda e: F.exists(_c(tokens), lambda t: F.contains(F.substring_index(e, "@", 1), F.left(t, F.lit(4)))))


def is_vacant(head) -> Column:
    return F.replace(F.trim(F.coalesce(_c(head), F.lit(""))), F.lit(" "), F.lit("")).isin(*V.VACANT)


def is_own_host(url) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(_c(url), F.lit("HOST"))).isin(*V.OWN_HOSTS), F.lit(False))


def is_direction(vector) -> Column:
    """Whether a vector has a direction: not null, not zero, all components there and finite."""
    v = _c(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(v.isNotNull() & good, F.lit(False))


def cosine(a, b) -> Column:
    """Cosine of two vectors, whatever their lengths, in double precision, rounded to 12 places; null for one without a direction."""
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    u, v = _c(a), _c(b)
    return F.when(is_direction(u) & is_direction(v), F.round(dot(u, v) / F.sqrt(dot(u, u)) / F.sqrt(dot(v, v)), 12))


def web_query(message, context: str = "") -> Column:
    """The question for a web search, with the domain's context in front."""
    return collapse_space(F.concat(F.lit(context), F.lit(" "), _c(message)))
