"""Splitting texts into overlapping chunks along the coarsest separators that do."""

from __future__ import annotations

from collections import deque

import pandas as pd

from spindrel.functions import fixed_values as V
from spindrel.functions.udfs import column_function


def split_text(text: str | None, size: int = V.CHUNK_SIZE, overlap: int = V.CHUNK_OVERLAP, separators: tuple[str, ...] = V.CHUNK_SEPARATORS) -> list[str]:
    """Chunks of at most size code points; each starts with the pieces that end the one before, up to overlap.

    A text is cut at the first separator that it holds, pieces that are still too long at the next ones, and neighbours are put together
    again as long as they fit.
    """
    return _split(text or "", size, overlap, separators)


def _split(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> list[str]:
    at = next((k for k, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    separator, finer = separators[at], separators[at + 1 :]
    chunks, short = [], []
    for piece in filter(None, text.split(separator) if separator else text):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += _pack(short, separator, size, overlap)
        short = []
        chunks += _split(piece, size, overlap, finer) if finer else [piece]
    return chunks + _pack(short, separator, size, overlap)


def _pack(pieces: list[str], separator: str, size: int, overlap: int) -> list[str]:
    gap, held, length, out = len(separator), deque(), 0, []  # length of held, joined
    for piece in pieces:
        joined = length + gap * bool(held) + len(piece)
        if joined > size and held:
            out.append(separator.join(held))
            while held and (length > overlap or length + gap + len(piece) > size):
                length -= len(held.popleft()) + gap * bool(held)
        held.append(piece)
        length += len(piece) + gap * (len(held) > 1)
    if held:
        out.append(separator.join(held))
    return [c for c in map(str.strip, out) if c]


#: White space at a text's ends.
_EDGES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def held(text: str | None, chunks: list[str]) -> str:
    """The text without the white space around it, as far as its chunks, put together again, hold it. Splitting drops and joins white space, so only the rest is compared: each chunk begins
    where those before it end, or earlier."""
    text = (text or "").strip(_EDGES)
    marks, end = "".join(text.split()), 0
    for own in ("".join(c.split()) for c in chunks):
        at = marks.rfind(own, 0, end + len(own))
        if at < 0:
            break
        end = max(end, at + len(own))
    if end == len(marks):
        return text
    places = [k for k, c in enumerate(text) if not c.isspace()]
    return text[: places[end - 1] + 1] if end else ""


@column_function("string")
def held_by(text: pd.Series, chunks: pd.Series) -> pd.Series:
    return pd.Series([held(t, list(c)) for t, c in zip(text, chunks, strict=True)], dtype=object)


@column_function("array<string>")
def chunks_of(text: pd.Series) -> pd.Series:
    return text.map(split_text)
