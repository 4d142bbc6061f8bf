"""Near duplicates by SimHash fingerprints.

Fingerprints are cut into six blocks. Two that differ in at most two bits agree in at least four blocks, so they meet
under one of the fifteen choices of four blocks (pigeonhole). What meets is checked by its Hamming distance. Only
distinct fingerprints take part: a group of copies of any size is one fingerprint. Under one key of four blocks
at most 22 bits are free, which bounds what can meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tunequorum.llm.components import components
from tunequorum.runtime import durable

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Bits of the blocks, from the lowest; one of any MAX_BITS + 4 blocks' choices of four is free of differences.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Fingerprints under one key that are compared pair by pair; more are looked up with up to two bits flipped.
PAIRWISE = 256

_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit, lowest bit first; eight bits at a time in the bytes of a word."""
    counts = np.zeros(64, np.int64)
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    rows = padded.reshape(-1, 255)
    for bit in range(8):
        lanes = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash; a text without words (or null) has zero, a short one its whole word sequence."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both treat ASCII only
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.r_[0, ends[:-1]].tolist()
    stops = (ends - 1).tolist()
    width = min(shingle, len(found))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, stops[width - 1 :])), np.uint64, len(found) - width + 1
    )
    ones = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def _fingerprints(text: Column) -> Column:
    def compute(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t.as_py()) for t in texts], np.uint64)
        return pa.array(values.view(np.int64))

    return F.arrow_udf(compute, "long")(text)


def _forest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A chain through each connected part of ``values``, given links between their indexes."""
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    order = np.argsort(label, kind="stable")
    same = label[order[1:]] == label[order[:-1]]
    return values[order[:-1][same]], values[order[1:][same]]


def link_under_key(values: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same of the distinct, ascending ``values`` as all pairs within MAX_BITS bits do.

    All ``values`` agree outside the mask ``free``.
    """
    if len(values) <= PAIRWISE:
        left, right = np.triu_indices(len(values), 1)
        close = np.bitwise_count(values[left] ^ values[right]) <= MAX_BITS
        return _forest(values, left[close], right[close])
    bits = [1 << b for b in range(64) if free >> b & 1]
    flips = bits + [a | b for a, b in combinations(bits, 2)]
    lefts, rights = [], []
    for flip in flips:
        other = values ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        hit = np.flatnonzero((values[at] == other) & (values < other))
        lefts.append(hit)
        rights.append(at[hit])
    return _forest(values, np.concatenate(lefts), np.concatenate(rights))


def _masks() -> list[int]:
    edges = np.cumsum((0, *BLOCKS)).tolist()
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, len(BLOCKS) - MAX_BITS)]


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): edges that connect the distinct fingerprints (column fp) as all pairs within MAX_BITS bits do."""
    masks = _masks()
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)]))
    dealt = fingerprints.select("fp", keys.alias("k")).select("k.choice", "k.key", "fp").repartition("choice", "key")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not read:
            return
        choice, key, fp = (np.concatenate(c) for c in zip(*read))
        fp = fp.view(np.uint64)
        order = np.lexsort((fp, key, choice))
        choice, key, fp = choice[order], key[order], fp[order]
        starts = np.flatnonzero(np.r_[True, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])])
        stops = np.r_[starts[1:], len(fp)]
        for a, b in zip(starts[stops - starts > 1], stops[stops - starts > 1]):
            left, right = link_under_key(fp[a:b], ~masks[choice[a]])
            if len(left):
                yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(link, "a long, b long").distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with their fingerprints (id, fp, row and, if ``whole``, the row as struct doc), and (fp, first) of
    each fingerprint that is linked to others; ``first`` has the smallest id of the component and its row."""
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if whole else []
    rows = docs.select(F.col(id_col).alias("id"), _fingerprints(F.col(text_col)).alias("fp"), F.monotonically_increasing_id().alias("row"), *doc)
    rows = durable(rows)
    distinct = durable(rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "row")).alias("first")))
    roots = components(links(distinct))
    members = durable(distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "first", "root"))
    firsts = durable(members.groupBy("root").agg(F.min("first").alias("first")))
    linked = durable(members.select("fp", "root").join(firsts, "root").select("fp", "first"))
    return rows, distinct.join(linked.withColumnRenamed("first", "linked"), "fp", "left").select(
        "fp", F.coalesce("linked", "first").alias("first")
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id): one row for each row of ``docs``.

    ``component_id`` is the smallest id that links lead to, the own one included; null ids are passed over, and a
    component without any id has null. Null and empty texts have the fingerprint zero and are linked like others.
    """
    rows, firsts = _grouped(docs, id_col, text_col, whole=False)
    return rows.select("id", "fp").join(durable(firsts), "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: of each component the row with the smallest id (one of them, if repeated)."""
    rows, firsts = _grouped(docs, id_col, text_col, whole=True)
    stay = firsts.select(F.col("first.row").alias("row")).distinct()
    return rows.join(stay, "row", "left_semi").select("doc.*")
