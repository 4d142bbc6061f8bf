"""Dense numbering without a window over a whole table or a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tunequorum.functions.hashing import hash_bucket


def number_rows(df: DataFrame, by: list[str], order: list[str], name: str, shards: int) -> DataFrame:
    """Add a dense 0-based number per ``by`` group (or over the table when ``by`` is empty).

    Rows are ordered by (hash shard of ``order``, ``order``). Each shard is numbered on its own and
    shifted by the sizes of the shards before it, so that no task holds a whole group: only the
    ``shards`` counts of a group meet in one window.
    """
    sharded = df.withColumn("_shard", hash_bucket(shards, *[F.col(c) for c in order]))
    counts = sharded.groupBy(*by, "_shard").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*by, "_shard").orderBy(*order)
    return (
        sharded.withColumn("_rn", F.row_number().over(within))
        .join(offsets, [*by, "_shard"])
        .withColumn(name, (F.col("_offset") + F.col("_rn") - 1).cast("bigint"))
        .drop("_shard", "_rn", "_offset")
    )


def id_index(ids: DataFrame, column: str, name: str = "idx", shards: int = 64) -> DataFrame:
    """Bijection between the distinct ids and 0..n-1."""
    distinct = ids.select(column).where(F.col(column).isNotNull()).distinct()
    return number_rows(distinct, [], [column], name, shards)
