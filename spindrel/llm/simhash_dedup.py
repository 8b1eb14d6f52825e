"""SimHash near-duplicates, compared bit-sliced.

A document's fingerprint has bit b set where over half of its shingle hashes have it. Two fingerprints link at ``radius`` or
fewer differing bits. Candidates come from an exact cover: the 64 bits are cut into blocks, and fingerprints that differ in
``radius`` bits agree on some ``blocks - radius`` of them, so for each such choice of blocks those that agree are compared; no pair
can be missed. More blocks make the agreement narrower at the price of more choices, and the number of fingerprints picks them.

Inside a group fingerprints stand vertically: word p of a block of 64 holds bit p of its 64 fingerprints. A fingerprint is
compared with a whole block by one xor a plane, the differences are counted in carry-save form (three counter words and one
that saturates), and every eight planes the blocks in which all 64 lanes exceed the radius are left.

Equal fingerprints are one row from the start, however many documents have them. A large group is cut into sub-blocks that are
compared two and two in tasks of their own, and each task emits a spanning forest of the links it found, never its pairs. The
forests meet in a distributed connected-components run.

Cases: a null or wordless text has fingerprint zero, which links like any other; fewer words than a shingle are one shingle.
Repeated rows share their group. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrel.llm.common import by_group, deal, durable, group_numbers, local_components, texts_of, with_id_type
from spindrel.llm.graph import components, least_of

SHINGLE = 4
SEED = 42
RADIUS = 4
#: A group of more fingerprints is compared in sub-blocks of about so many.
SUB_BLOCK = 4096
#: Fingerprints that agree by chance on average, above which more blocks are taken.
MEAN_GROUP = 256
#: Cells (a fingerprint against a word of 64) compared at once, and shingle hashes counted at once: bounds on memory.
_CELLS, _HASHES = 1 << 16, 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; repeats count."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes.lower() turns A-Z only
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[width - 1 :].tolist() if len(words) >= width else ends[-1:].tolist()
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest, n = xxhash.xxh64_intdigest, len(last)
    counts = np.zeros(64, np.int64)
    for k in range(0, n, _HASHES):
        h = np.array([digest(whole[a:b], SEED) for a, b in zip(first[k : k + _HASHES], last[k : k + _HASHES], strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (the 64 bits as a signed long)."""
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField(id_col, T.StringType()), T.StructField("fp", T.LongType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.iloc[:, 1]], np.uint64)
            yield pd.DataFrame({id_col: batch.iloc[:, 0], "fp": fps.view(np.int64)})

    return with_id_type(texts_of(docs, id_col, text_col).mapInPandas(work, schema), docs, id_col)


def choices(n: int, radius: int = RADIUS, mean_group: int = MEAN_GROUP) -> list[int]:
    """Bit masks, unsigned: fingerprints within radius agree on all bits of at least one."""
    for blocks in range(radius + 1, 17):
        cuts = np.linspace(0, 64, blocks + 1).astype(int)
        masks = [sum(((1 << int(cuts[b + 1])) - (1 << int(cuts[b]))) for b in chosen) for chosen in combinations(range(blocks), blocks - radius)]
        if n / 2.0 ** min(m.bit_count() for m in masks) <= mean_group:
            break
    return masks


def within(a: np.ndarray, planes: np.ndarray, valid: np.ndarray, cell_a: np.ndarray, cell_w: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compare a[cell_a] with the block words cell_w: the cells left, and in each the lanes within the radius."""
    zero = np.zeros(len(cell_a), np.uint64)
    c0, c1, c2, over = zero, zero.copy(), zero.copy(), ~valid[cell_w]
    top = np.uint64(radius)
    for p in range(64):
        own = np.uint64(0) - ((a[cell_a] >> np.uint64(p)) & np.uint64(1))  # all ones or none
        x = planes[p, cell_w] ^ own
        c0, x = c0 ^ x, c0 & x
        c1, x = c1 ^ x, c1 & x
        c2, x = c2 ^ x, c2 & x
        over |= x  # eight and more
        if p % 8 == 7:
            over |= _exceeds(c0, c1, c2, int(top))
            live = over != _ALL
            if not live.all():
                cell_a, cell_w, c0, c1, c2, over = (v[live] for v in (cell_a, cell_w, c0, c1, c2, over))
                if not len(cell_a):
                    break
    return cell_a, cell_w, ~over


def _exceeds(c0, c1, c2, radius: int):
    """Lanes whose three-bit count is over radius (0 to 7)."""
    out = np.zeros_like(c0)
    for value in range(radius + 1, 8):
        out |= (c0 if value & 1 else ~c0) & (c1 if value & 2 else ~c1) & (c2 if value & 4 else ~c2)
    return out


def forest(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, root) that span what is within the radius. Rows are sorted by group; side 0 and 1 are two sub-blocks of which only
    mixed pairs are asked for, -1 a group of which all are."""
    n = len(fps)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    words = -(-sizes // 64)
    first_word = np.cumsum(words) - words
    lane = np.arange(n) - np.repeat(starts, sizes)
    at = np.repeat(first_word, sizes) + lane // 64
    table = np.zeros((int(words.sum()), 64), np.uint64)
    table[at, lane % 64] = fps
    real = np.zeros(table.shape, bool)
    real[at, lane % 64] = True
    row = np.zeros(table.shape, np.int64)
    row[at, lane % 64] = np.arange(n)
    pack = lambda bits: np.packbits(bits, axis=-1, bitorder="little").view("<u8")[..., 0]
    valid = pack(real)
    planes = np.stack([pack((table >> np.uint64(p)) & np.uint64(1) > 0) for p in range(64)]) if len(table) else np.zeros((64, 0), np.uint64)
    many = np.repeat(np.where(sizes > 1, words, 0), sizes) - np.where(np.repeat(sizes, sizes) > 1, lane // 64, 0)  # words at or after the own one
    upto = np.cumsum(many)
    label = np.arange(n)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + _CELLS, "right")))
        count = many[begin:end]
        if total := int(count.sum()):
            cell_a = np.repeat(np.arange(begin, end), count)
            cell_w = at[cell_a] + np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            cell_a, cell_w, hit = within(fps, planes, valid, cell_a, cell_w, radius)
            if len(cell_a):
                c, lanes = np.nonzero(np.unpackbits(hit.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                i, j = cell_a[c], row[cell_w[c], lanes]
                ok = (j > i) & ((side[i] < 0) | (side[i] != side[j]))
                label = label[local_merge(label, i[ok], j[ok])]
        begin = end
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def local_merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return local_components(len(label), label[i], label[j]) if len(i) else np.arange(len(label))


def links(fps: DataFrame, radius: int = RADIUS, sub_block: int = SUB_BLOCK, masks: list[int] | None = None) -> DataFrame:
    """(a, b): links among the distinct values of column fp that connect all values within the radius."""
    masks = masks or choices(fps.count(), radius)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = F.array(*[F.struct(F.lit(k).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("key")) for k, m in enumerate(masks)])
    rows = fps.select("fp", F.explode(keys).alias("x")).select("x.t", "x.key", "fp")
    keys = ["t", "key"]

    def linked(own: pd.DataFrame) -> pd.DataFrame:
        fps = own["fp"].to_numpy()
        i, root = forest(fps.view(np.uint64), group_numbers(own, [*keys, "p", "q"]), own["side"].to_numpy(), radius)
        return pd.DataFrame({"a": fps[i], "b": fps[root]})

    return deal(rows, keys, "fp", sub_block).mapInPandas(lambda batches: by_group(batches, [*keys, "p", "q"], linked), "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id (the smallest id reachable by links)."""
    own = durable(fingerprints(docs, id_col, text_col))
    fps = durable(own.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = components(links(fps, radius), "a", "b")
    classes = least_of(fps.withColumnRenamed("fp", "node"), roots, "least").toDF("fp", "component_id")
    return own.join(classes, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: 64 bit counts a document and a closure over links are beyond plain SQL on whole tables; tests compare all pairs by brute force.
ORACLE_SQL = None
