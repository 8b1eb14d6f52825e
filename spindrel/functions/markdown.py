"""Deterministic markdown of parsed modules and their events. Equal input gives equal bytes, so content hashes only move with the content."""

from __future__ import annotations

from spindrel.functions import fixed_values as V


def _bullets(values) -> list[str]:
    return [f"- {str(v).strip()}" for v in values or [] if v is not None and str(v).strip()]


def _block(heading: str, lines: list[str], level: int = 2) -> list[str]:
    return ["", f"{'#' * level} {heading}", "", *lines] if lines else []


def _field(value) -> list[str]:
    """A field's lines: text inline, a list as bullets."""
    if not value or not value["items"]:
        return []
    return _bullets(value["items"]) if value["is_list"] else [t for t in [(value["items"][0] or "").strip()] if t]


def _one_line(value) -> str:
    return ", ".join(value["items"]) if value and value["items"] else ""


def _row(parts, joint: str) -> str:
    return joint.join(str(p) for p in parts if p and str(p).strip())


def event_markdown(event: dict, url: str = "", level: int = 2) -> str:
    """One event under a heading of the given level. What the page had beyond the known sections is printed too."""
    basic, sub = dict(event.get("basic_data") or {}), level + 1
    out = [f"{'#' * level} {event.get('heading') or basic.get('event_type') or 'Event'}"]
    out += ["", f"Source: {url}"] if url else []
    facts = [f"- **{label}:** {basic[key]}" for key, label in V.EVENT_FACTS if (basic.get(key) or "").strip()]
    out += ["", *facts] if facts else []
    for group in event.get("schedule_groups") or []:
        dates = [_row([d.get(k) for k in ("day", "time", "rhythm", "duration", "room")], " | ") for d in map(dict, group["dates"] or [])]
        out += ["", f"{'#' * sub} Schedule" + (f" — {group['group']}" if group["group"] else ""), "", *_bullets(dates)]
    rows = lambda field: [dict(r) for r in event.get(field) or []]
    out += _block("Lecturers / Staff", [f"- {_row([r.get('person'), r.get('responsibility')], ' — ')}" for r in rows("assigned_persons") if r.get("person")], sub)
    out += _block("Study Programmes", [f"- {_row([r.get('programme'), r.get('semester'), r.get('po')], ' | ')}" for r in rows("study_programmes") if r.get("programme")], sub)
    out += _block("Belongs to Modules", [f"- {r.get('module_number') or ''} {r.get('module_title') or ''}".rstrip() for r in rows("belongs_to_modules")], sub)
    out += _block("Institutions", [f"- {r['name']}" for r in rows("institutions") if r.get("name")], sub)
    for key, value in dict(event.get("additional_information") or {}).items():
        out += _block(key.replace("_", " ").title(), [value.strip()] if (value or "").strip() else [], sub)
    for section in event.get("unmapped_sections") or []:
        out += _block(section["caption"] or "Additional Section", _bullets(" | ".join(c or "" for c in row) for row in section["rows"] or []), sub)
    return "\n".join(out).strip()


def module_markdown(module: dict, url: str, events: list[dict] | None = None) -> str:
    """A module and its events: title, source, facts, sections, rows without a known label, then the events after rules."""
    fields = dict(module.get("fields") or {})
    number, title = _one_line(fields.get("module_number")), _one_line(fields.get("module_title")) or module.get("heading") or "Module"
    out = [f"# {f'Module {number}: ' if number else ''}{title}".rstrip(), "", f"Source: {url}"]
    translated = _one_line(fields.get("module_title_translated"))
    out += ["", f"*{translated}*"] if translated.strip() else []
    facts = [f"- **{label}:** {_one_line(fields[key])}" for key, label in V.MODULE_FACTS if _one_line(fields.get(key)).strip()]
    out += ["", *facts] if facts else []
    for key, heading in V.MODULE_SECTIONS:
        out += _block(heading, _field(fields.get(key)))
    for extra in module.get("unmapped_fields") or []:
        text = (extra["text"] or "").strip()
        out += _block(extra["label"] or "Additional Field", _bullets(extra["items"]) or ([text] if text else []))
    for event in events or []:
        out += ["", "---", ""]
        if event.get("fetched"):
            out.append(event_markdown(event, event.get("url") or ""))
        else:
            out += [f"## Event (not retrieved): {event.get('listed_as') or event.get('url') or ''}", "", f"- **Error:** {event.get('fetch_error') or 'unknown'}"]
    return "\n".join(out).strip() + "\n"
