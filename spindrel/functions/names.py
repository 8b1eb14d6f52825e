"""Is a line a person's name? Its measures lie within bounds and it holds nothing that a name doesn't hold. ``is_name`` and ``is_person`` are for the page
parsers; ``is_name_like`` and ``looks_like_person`` say the same of a column, from the same tables, in DataFrame functions."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from spindrel.functions import fixed_values as V

#: Of a text: its characters, its words, those that begin with a capital, those that are no title or particle, and such ones in lower case before a bracket.
BOUNDS = {"characters": (1, 90), "words": (2, 12), "capitals": (2, 90), "own": (1, 90), "prose": (0, 1)}
CAPITAL, LOWER = r"^\p{Lu}", r"^\p{Ll}"
#: No name holds one of these, whatever the case of its letters ...
FOREIGN = "|".join((r"[:;]", r"[!?]\s*$", r"""^[\[("'„]""", r"\s(?:&|/|and|und)\s", V.EMAIL, V.ROLE_LEAD, V.NAME_STOPWORDS))
#: ... or is in lower case at its start, in capitals throughout, or has a number but no title ...
MISSHAPED = (LOWER, r"^\P{Ll}{5,}$", rf"^(?!(?s:.*)(?i:{V.NAME_TITLE}))(?s:.*)\d")
#: ... or has one of these before a bracket.
FOREIGN_HEAD = f"{V.ORG_NAME}|{V.ROLE_PHRASE}"

_any = lambda p: regex.compile(p, regex.I)
TITLE, HINT = _any(V.NAME_TITLE), _any(V.DESIGNATION_HINT)
_FOREIGN, _FOREIGN_HEAD, _MISSHAPED = _any(FOREIGN), _any(FOREIGN_HEAD), [regex.compile(p) for p in MISSHAPED]
_CAPITAL, _LOWER = regex.compile(CAPITAL), regex.compile(LOWER)


def _own(words: list[str]) -> list[str]:
    """The words that are neither titles nor particles."""
    return [w for w in words if not TITLE.search(w) and w.strip(".,-").lower() not in V.NAME_PARTICLES]


def only_titles(text: str) -> bool:
    words = regex.findall(r"[^\s,]+", text)
    return bool(words) and not _own(words)


def measures(text: str) -> dict[str, int]:
    words, head = (regex.findall(r"[^\s,]+", t) for t in (text, text.partition("(")[0]))
    return {"characters": len(text), "words": len(words), "capitals": sum(map(bool, map(_CAPITAL.search, words))), "own": len(_own(words)), "prose": sum(map(bool, map(_LOWER.search, _own(head))))}


def is_name(text: str | None) -> bool:
    text = text or ""
    found = measures(text)
    return all(low <= found[k] <= high for k, (low, high) in BOUNDS.items()) and not (_FOREIGN.search(text) or _FOREIGN_HEAD.search(text.partition("(")[0]) or any(p.search(text) for p in _MISSHAPED))


def is_person(text: str | None) -> bool:
    """A name that isn't a role's."""
    return is_name(text) and not HINT.search(text)


def is_name_like(c) -> Column:
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    head = F.substring_index(text, "(", 1)
    any_case = lambda x, p: x.rlike(f"(?iuU){p}")
    words = lambda x: F.filter(F.split(x, r"(?U)[\s,]+"), lambda w: w != "")
    own = lambda x: F.filter(words(x), lambda w: ~any_case(w, V.NAME_TITLE) & ~F.lower(F.btrim(w, F.lit(".,-"))).isin(*V.NAME_PARTICLES))
    found = {
        "characters": F.length(text),
        "words": F.size(words(text)),
        "capitals": F.size(F.filter(words(text), lambda w: w.rlike(CAPITAL))),
        "own": F.size(own(text)),
        "prose": F.size(F.filter(own(head), lambda w: w.rlike(LOWER))),
    }
    fits = ~any_case(text, FOREIGN) & ~any_case(head, FOREIGN_HEAD)
    for p in MISSHAPED:
        fits &= ~text.rlike(f"(?uU){p}")
    for k, (low, high) in BOUNDS.items():
        fits &= found[k].between(low, high)
    return fits


def looks_like_person(c) -> Column:
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return is_name_like(text) & ~text.rlike(f"(?iuU){V.DESIGNATION_HINT}")
