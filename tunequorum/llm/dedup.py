"""Exact duplicates through counting quotient filters.

Each partition of the corpus packs the 64-bit fingerprints of its texts into counting quotient filters, one for
each range of fingerprints (block). The filters of a block from all partitions are merged by their sorted
remainders, which loses nothing. Only texts whose fingerprint has a count above one are then compared byte by byte.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tunequorum.runtime import durable

#: Rows of one group of copies that meet in one task when they are told their keeper.
ROWS_PER_SALT = 4096

_HEADER = "<4sBBQ"
_MAGIC = b"CQF1"


@dataclass
class QuotientFilter:
    """Multiset of ``bits``-bit fingerprints: the high bits (quotient) name a slot, the low bits are stored.

    ``runs[q]`` is the length of slot q's run; the runs lie behind each other in ``remainders``, each sorted, and
    ``counts`` holds how often each fingerprint came. Nothing is lost: quotient and remainder give the fingerprint.
    """

    bits: int
    slot_bits: int
    runs: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def from_sorted(cls, bits: int, fingerprints: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """From distinct, ascending fingerprints; about as many slots as fingerprints."""
        slot_bits = min(bits, max(1, int(len(fingerprints)).bit_length()))
        rest = np.uint64(bits - slot_bits)
        quotients = (fingerprints >> rest).astype(np.int64)
        remainders = fingerprints & np.uint64((1 << int(rest)) - 1)
        return cls(bits, slot_bits, np.bincount(quotients, minlength=1 << slot_bits), remainders, counts)

    def fingerprints(self) -> np.ndarray:
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        return (quotients << np.uint64(self.bits - self.slot_bits)) | self.remainders

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter with the summed counts, whatever the numbers of slots."""
        bits = filters[0].bits
        every = np.concatenate([f.fingerprints() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(every, kind="stable")
        every, counts = every[order], counts[order]
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
        return cls.from_sorted(bits, every[first], np.add.reduceat(counts, first) if len(first) else counts)

    def to_bytes(self) -> bytes:
        width = (self.bits - self.slot_bits + 7) // 8
        low = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = struct.pack(_HEADER, _MAGIC, self.bits, self.slot_bits, len(self.remainders))
        return head + self.runs.astype("<u4").tobytes() + low.tobytes() + self.counts.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        magic, bits, slot_bits, n = struct.unpack_from(_HEADER, data)
        if magic != _MAGIC:
            raise ValueError("not a quotient filter")
        at, slots, width = struct.calcsize(_HEADER), 1 << slot_bits, (bits - slot_bits + 7) // 8
        runs = np.frombuffer(data, "<u4", slots, at).astype(np.int64)
        low = np.zeros((n, 8), np.uint8)
        low[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 4 * slots).reshape(n, width)
        counts = np.frombuffer(data, "<u8", n, at + 4 * slots + n * width).astype(np.int64)
        return cls(bits, slot_bits, runs, low.view("<u8").ravel(), counts)


def partition_filters(fingerprints: DataFrame, column: str, block_bits: int) -> DataFrame:
    """(block, filter): the quotient filters of each partition."""
    bits = 64 - block_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values, counts = np.unique(np.concatenate(read).view(np.uint64) if read else np.zeros(0, np.uint64), return_counts=True)
        blocks = (values >> np.uint64(bits)).astype(np.int64) if block_bits else np.zeros(len(values), np.int64)
        values &= np.uint64((1 << bits) - 1)
        edges = np.searchsorted(blocks, np.arange((1 << block_bits) + 1))
        full = np.flatnonzero(edges[1:] > edges[:-1])
        packed = [QuotientFilter.from_sorted(bits, values[edges[b] : edges[b + 1]], counts[edges[b] : edges[b + 1]]).to_bytes() for b in full]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(packed, pa.binary())], ["block", "filter"])

    return fingerprints.select(column).mapInArrow(build, "block long, filter binary")


def repeated_fingerprints(fingerprints: DataFrame, column: str) -> DataFrame:
    """(column, n): the fingerprints that come more than once, from the merged filters.

    There are some blocks for every shuffle partition, so a block's share stays small when a cluster raises
    ``spark.sql.shuffle.partitions`` with the data.
    """
    partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_bits = (4 * partitions - 1).bit_length()
    bits = 64 - block_bits

    def merge(key: tuple, pieces: pa.Table) -> pa.Table:
        merged = QuotientFilter.merge([QuotientFilter.from_bytes(f) for f in pieces.column("filter").to_pylist()])
        more = merged.counts > 1
        values = merged.fingerprints()[more] | np.uint64(key[0].as_py() << bits)
        return pa.table({column: pa.array(values.view(np.int64)), "n": pa.array(merged.counts[more].astype(np.int64))})

    blocks = partition_filters(fingerprints, column, block_bits)
    return blocks.groupBy("block").applyInArrow(merge, f"{column} long, n long")


def _text(column: Column, normalise: Callable[[Column], Column]) -> Column:
    return normalise(F.coalesce(column, F.lit("")))


def _routed(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column], whole: bool) -> DataFrame:
    """(id, fp, n, sha, row, body): n is the count of a repeated fingerprint, else null.

    ``body`` has all columns of the row if ``whole``, else only the text of rows that need the byte comparison.
    The table is written before any grouping, so that the join can split a fingerprint of very many rows.
    """
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole else F.struct(text_col)
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(_text(F.col(text_col), normalise)).alias("fp"), body.alias("body"))
    repeated = durable(repeated_fingerprints(keyed, "fp"))
    sha = F.sha2(_text(F.col("body")[text_col], normalise), 256)
    return durable(keyed.join(repeated, "fp", "left").select(
        "id", "fp", "n", sha.alias("sha"), F.monotonically_increasing_id().alias("row"),
        F.col("body") if whole else F.when(F.col("n") > 1, F.col("body")).alias("body"),
    ))


def _verified(routed: DataFrame, text_col: str, normalise: Callable[[Column], Column]) -> DataFrame:
    """(fp, sha, keep, group_size, n) of each text among the repeated fingerprints; compares whole texts."""
    return routed.where(F.col("n") > 1).groupBy("fp", _text(F.col("body")[text_col], normalise).alias("text")).agg(
        F.max("sha").alias("sha"), F.max(F.struct("id", "row")).alias("keep"),
        F.count(F.lit(1)).alias("group_size"), F.max("n").alias("n"),
    ).drop("text")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda text: text
) -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``.

    Texts are equal when their normalised bytes are; a null text counts as empty. Of equal texts the row with the
    largest id stays; a null id is below all others. Of rows that repeat both id and text exactly one is kept.
    An empty table gives no rows; other columns of ``docs`` are not read.
    """
    routed = _routed(docs.select(id_col, text_col), id_col, text_col, normalise, whole=False)
    single = routed.where(F.col("n").isNull()).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    salts = F.ceil(F.col("n") / ROWS_PER_SALT)
    groups = _verified(routed, text_col, normalise).select(
        "fp", "sha", "keep", "group_size", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")
    )
    several = routed.where(F.col("n") > 1).select("id", "row", "fp", "sha", F.pmod(F.xxhash64("row"), salts).alias("salt"))
    told = several.join(groups, ["fp", "sha", "salt"]).select(
        "id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "sha"
    )
    return single.unionByName(told).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda text: text
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that exact_groups() keeps; the same rules hold."""
    routed = _routed(docs, id_col, text_col, normalise, whole=True)
    best = _verified(routed, text_col, normalise).select(F.col("keep.row").alias("row"))
    repeated = routed.where(F.col("n") > 1).join(best, "row", "left_semi")
    return routed.where(F.col("n").isNull()).select("body.*").unionByName(repeated.select("body.*"))
