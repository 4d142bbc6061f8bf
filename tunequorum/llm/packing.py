"""Packing into length buckets with the least padding.

Documents are cut into pieces of at most MAX_TOKENS words, so the global histogram of piece lengths has at most
MAX_TOKENS + 1 rows whatever the corpus. A dynamic program over it finds the bucket bounds with the least padding. Inside
a bucket the pieces are numbered in ascending order and every so many form a batch that keeps the token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tunequorum.llm.text import let, words
from tunequorum.runtime import durable

MAX_TOKENS = 4096
BUCKETS = 16
BATCH_TOKENS = 1 << 16


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds, ascending, of at most ``buckets`` buckets with the least padding.

    ``lengths`` ascend. Among equal bounds the one with the smaller lower neighbour wins; more buckets are used only
    where they save padding.
    """
    n = len(lengths)
    if not n:
        return []
    length = np.array(lengths, np.int64)
    count = np.r_[0, np.cumsum(np.array(counts, np.int64))]
    total = np.r_[0, np.cumsum(length * np.array(counts, np.int64))]
    # cost[j]: padding of the first j lengths; came[k][j]: where the last bucket of k + 1 starts
    cost = np.r_[0, length * count[1:] - total[1:]]
    came = [np.zeros(n + 1, np.int64)]
    costs = [cost]
    for _ in range(1, min(buckets, n)):
        base, new, start = cost + total, np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            padding = base[:j] - length[j - 1] * count[:j]
            start[j] = int(np.argmin(padding))
            new[j] = padding[start[j]] + length[j - 1] * count[j] - total[j]
        cost = new
        costs.append(cost)
        came.append(start)
    used = int(np.argmin([c[n] for c in costs]))
    bounds, j = [], n
    for k in range(used, -1, -1):
        bounds.append(int(length[j - 1]))
        j = int(came[k][j])
    return bounds[::-1]


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def piece_texts(docs: DataFrame, id_col: str, text_col: str, max_tokens: int) -> DataFrame:
    """pieces() with their words, joined by one space, as column text; a text is split once however long it is."""
    def cut(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0)), F.lit(max_tokens))
        return F.transform(starts, lambda s: F.struct(s.cast("long").alias("start"), F.slice(found, s + 1, F.lit(max_tokens)).alias("words")))

    each = docs.select(F.col(id_col).alias("id"), F.posexplode(let(words(F.col(text_col)), cut)).alias("piece", "x"))
    return each.select(
        "id", F.col("piece").cast("long").alias("piece"), "x.start", F.size("x.words").cast("long").alias("n_tokens"), F.array_join("x.words", " ").alias("text")
    )


def pieces(docs: DataFrame, id_col: str, text_col: str, max_tokens: int, length: Column | None = None) -> DataFrame:
    """(id, piece, start, n_tokens): each text cut into pieces of at most ``max_tokens``; an empty one is one piece."""
    total = F.coalesce(n_words(F.col(text_col)) if length is None else length, F.lit(0)).cast("long")
    cut = docs.select(F.col(id_col).alias("id"), total.alias("total")).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("total") - 1) / max_tokens), F.lit(0)).cast("long")))
    )
    start = F.col("piece") * max_tokens
    return cut.select("id", "piece", start.alias("start"), F.least(F.col("total") - start, F.lit(max_tokens)).alias("n_tokens"))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
    max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, with_text: bool = False,
) -> DataFrame:
    """(id_col, piece, start, n_tokens, bucket, padded_to, batch, slot[, text]): one row for each piece of each row of ``docs``.

    Lengths are words unless ``length`` gives another count. Pieces of a bucket are padded to its bound; a batch holds
    as many as ``batch_tokens`` padded tokens allow, at least one. Inside a bucket pieces are numbered by id (null
    first), then piece, then length; repeated rows follow each other. Null and empty texts have one piece of length 0.
    An empty table gives no rows. ``with_text`` adds the words of each piece, joined by one space.
    """
    if with_text and length is not None:
        raise ValueError("texts are cut by words, not by another length")
    cut = durable(pieces(docs, id_col, text_col, max_tokens, length))
    histogram = sorted((r.n_tokens, r.n) for r in cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    bounds = best_bounds([x for x, _ in histogram], [n for _, n in histogram], buckets)
    ends = F.array(*map(F.lit, bounds)).cast("array<long>")
    bucket = F.size(F.filter(ends, lambda end: end < F.col("n_tokens"))).cast("long")
    order = ["bucket", "id", "piece", "n_tokens"]
    # ranges of the global order; an id says where in its range a row stands, and is kept by writing it
    rows = piece_texts(docs, id_col, text_col, max_tokens) if with_text else cut
    placed = durable(
        rows.withColumn("bucket", bucket).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", 33)
    parts = placed.groupBy("bucket", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("part")) - F.col("n")  # a row for each task and bucket
    offsets = durable(parts.select("bucket", "part", (before - F.col("first")).alias("shift")))
    numbered = placed.withColumn("part", part).join(offsets, ["bucket", "part"]).withColumn("number", F.col("place") + F.col("shift"))
    padded = F.get(ends, F.col("bucket").cast("int"))
    room = F.greatest(F.floor(F.lit(batch_tokens) / F.greatest(padded, F.lit(1))), F.lit(1)).cast("long")
    return numbered.select(
        F.col("id").alias(id_col), "piece", "start", "n_tokens", "bucket", padded.alias("padded_to"),
        F.floor(F.col("number") / room).cast("long").alias("batch"), F.pmod("number", room).alias("slot"), *["text"] * with_text,
    )


def batches(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(bucket, batch, padded_to, n_pieces, n_tokens, padding, members): what fits into a batch bounds ``members``."""
    member = F.struct("slot", F.col(id_col).alias("id"), "piece", "start", "n_tokens")
    return packed.groupBy("bucket", "batch").agg(
        F.first("padded_to").alias("padded_to"), F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("padded_to") - F.col("n_tokens")).alias("padding"), F.sort_array(F.collect_list(member)).alias("members"),
    )
