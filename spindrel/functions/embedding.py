"""Unit vectors of texts. A model is an object with ``name``, ``width`` and ``encode(texts)``; the default one hashes words and needs no files."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from spindrel.functions import fixed_values as V


class Embedder(Protocol):
    name: str
    width: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEmbedder:
    """Signed hashing of words and word pairs, scaled to length 1. Deterministic, so that stores can be rebuilt alike."""

    def __init__(self, width: int = V.EMBEDDING_WIDTH):
        self.width, self.name = width, f"hashing-{width}"

    def encode(self, texts: list[str]) -> np.ndarray:
        hashes, row = [], []
        for k, text in enumerate(texts):
            words = [w.encode("utf-8", "surrogatepass") for w in (text or "").lower().split()]
            own = list(map(zlib.crc32, words))
            pairs = list(map(zlib.crc32, [b" " + w for w in words[1:]], own))  # a pair's checksum goes on from its first word's
            hashes += own + pairs
            row += [k] * (len(own) + len(pairs))
        h, n = np.array(hashes, np.int64), len(texts)
        cells = np.array(row, np.int64) * self.width + h % self.width
        out = np.bincount(cells, np.where(h >> 31, 1.0, -1.0), n * self.width).reshape(n, self.width)
        out[~out.any(axis=1), 0] = 1
        return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def embed(make=HashingEmbedder, batch: int = V.ENCODE_BATCH):
    """A column function; ``make`` builds the model once a Python worker."""

    @F.pandas_udf("array<float>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in batches:
            own = [t or "" for t in texts]
            yield pd.Series([v for a in range(0, len(own), batch) for v in model.encode(own[a : a + batch])], dtype=object)

    return encoded
