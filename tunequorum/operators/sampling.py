"""Uniform sampling without replacement, by permuting positions instead of sorting populations.

A population is numbered once (``number_rows``); a sample of N is then the first N places of a keyed permutation of its
positions and an equi-join on the position. The work grows with the samples, not with samples x population, the
same way for every size, and a heavy user's history never meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tunequorum.functions.hashing import hash_number
from tunequorum.operators.lists import partitions_of
from tunequorum.operators.numbering import id_index, number_rows

#: Rounds of the Feistel network.
ROUNDS = 4


def _moved(i: int, l: Column, r: Column, rows: Column, width: Column, draw: Callable[..., Column]) -> tuple[Column, Column]:
    """One round over the grid of ``rows`` x ``width`` places: odd rounds move the row by a hash of the column, even ones the
    column by a hash of the row, so that different places stay different."""
    return ((l + draw(F.lit(i), r)) % rows, r) if i % 2 else (l, (r + draw(F.lit(i), l)) % width)


def _walk(x: Column, size: Column, rows: Column, width: Column, draw: Callable[..., Column]) -> Column:
    """Further passes from a place outside [0, size) until one ends inside."""

    def round_(i: int) -> Callable[[Column], Column]:
        def step(s: Column) -> Column:
            l, r = _moved(i, s["l"], s["r"], rows, width, draw)
            return F.struct(l.alias("l"), r.alias("r"))

        return step

    def once(x: Column) -> Column:
        at = F.struct(((x - x % width) / width).cast("bigint").alias("l"), (x % width).alias("r"))
        for i in range(1, ROUNDS + 1):
            at = F.get(F.transform(F.array(at), round_(i)), F.lit(0))
        return F.get(F.transform(F.array(at), lambda s: s["l"] * width + s["r"]), F.lit(0))

    return F.aggregate(F.sequence(F.lit(1).cast("bigint"), rows), x, lambda y, _: F.when(y < size, y).otherwise(once(y)))


def with_draws(df: DataFrame, size: Column, want: Column, seed, *keys: Column) -> DataFrame:
    """``df`` with one row for each of ``min(want, size)`` distinct positions in [0, size): columns slot (from 0) and drawn.

    They are the first places of a permutation of [0, size) that ``seed`` and ``keys`` choose, a Feistel network over a
    grid. The grid has fewer than sqrt(size) places too many; who lands there walks on until it is inside (cycle
    walking), which takes no more passes than there are such places. Rows without positions go.

    The planner doesn't see how many rows come out and takes them for few: joins with them must be hinted, or it broadcasts them.
    """
    rows = F.ceil(F.sqrt(F.col("_n").cast("double")))
    width = ((F.col("_n") + F.col("_rows") - 1 - (F.col("_n") + F.col("_rows") - 1) % F.col("_rows")) / F.col("_rows")).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    carried = df.columns
    out = df.withColumns({"_n": size.cast("bigint"), "_want": F.least(size.cast("bigint"), want.cast("bigint")), "_key": F.concat_ws("|", *[F.lit(str(seed)), *[k.cast("string") for k in keys]])})
    out = out.where("_n > 0 and _want > 0").withColumn("_rows", rows).withColumn("_width", width)
    out = out.withColumn("slot", F.explode(F.sequence(zero, F.col("_want") - one)))
    out = out.withColumns({"_l": ((F.col("slot") - F.col("slot") % F.col("_width")) / F.col("_width")).cast("bigint"), "_r": F.col("slot") % F.col("_width")})

    def draw(i: Column, half: Column) -> Column:
        return hash_number(F.col("_key"), i, half)

    for i in range(1, ROUNDS + 1):
        l, r = _moved(i, F.col("_l"), F.col("_r"), F.col("_rows"), F.col("_width"), draw)
        out = out.withColumns({"_l": l, "_r": r})
    out = out.withColumn("_x", F.col("_l") * F.col("_width") + F.col("_r"))
    # the branches of CASE are lazy: only the few that land outside walk on
    inside = F.when(F.col("_x") < F.col("_n"), F.col("_x")).otherwise(_walk(F.col("_x"), F.col("_n"), F.col("_rows"), F.col("_width"), draw))
    return out.withColumn("drawn", inside).select(*carried, "slot", "drawn")


def numbered_history(pairs: DataFrame, shards: int = 16) -> DataFrame:
    """History for sampling: liked pairs (user_id, track_id) with a dense position per user. Store it once."""
    return number_rows(pairs.select("user_id", "track_id"), ["user_id"], ["track_id"], "position_in_history", shards)


def history_sizes(history: DataFrame) -> DataFrame:
    return history.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_history"))


def sample_user_history(history: DataFrame, users: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` tracks from each user's own numbered history; fewer, flagged ``short``, where the history is shorter."""
    sized = users.select("user_id").join(history_sizes(history), "user_id")
    drawn = with_draws(sized, F.col("n_history"), F.lit(n), seed, F.col("user_id")).select(
        "user_id", (F.col("n_history") < n).alias("short"), "slot", F.col("drawn").alias("position_in_history")
    )
    return drawn.hint("merge").join(history, ["user_id", "position_in_history"]).select(
        "user_id", (F.col("slot") + 1).cast("bigint").alias("position"), "track_id", "short"
    )


def sample_group_history(
    history: DataFrame, groups: DataFrame, members: DataFrame, seed: int,
    key: str = "request_id", length: str = "playlist_length", distinct_tracks: bool = False,
) -> DataFrame:
    """Sample of the pooled history of each group: a bag, where a track liked by two members may occur twice.

    ``history`` comes from ``numbered_history``, ``groups`` carries (key, length), ``members`` (key, user_id). With ``distinct_tracks`` the pool is
    the set of tracks liked by any member.
    """
    if distinct_tracks:
        pool = members.join(history, "user_id").select(key, "track_id").distinct()
        numbered = number_rows(pool, [key], ["track_id"], "position_in_pool", 16)
        sizes = pool.groupBy(key).agg(F.count(F.lit(1)).alias("n_pool"))
        drawn = _draw_from_pool(groups, sizes, key, length, seed)
        return drawn.hint("merge").join(numbered, [key, "position_in_pool"]).select(key, "position", "track_id", "short")

    # the pool is the members' histories laid end to end, addressed without building it
    ordered = Window.partitionBy(key).orderBy("user_id")
    ranges = (
        members.join(history_sizes(history), "user_id")
        .withColumn("_end", F.sum("n_history").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_start", F.col("_end") - F.col("n_history"))
    )
    sizes = ranges.groupBy(key).agg(F.sum("n_history").alias("n_pool"))
    drawn = _draw_from_pool(groups, sizes, key, length, seed)
    addressed = (
        drawn.hint("merge").join(ranges.select(key, "user_id", "_start", "_end"), key)
        .where((F.col("position_in_pool") >= F.col("_start")) & (F.col("position_in_pool") < F.col("_end")))
        .select(key, "position", "short", "user_id",
                (F.col("position_in_pool") - F.col("_start")).alias("position_in_history"))
    )
    return addressed.hint("merge").join(history, ["user_id", "position_in_history"]).select(
        key, "position", "track_id", "short"
    )


def _draw_from_pool(groups: DataFrame, sizes: DataFrame, key: str, length: str, seed: int) -> DataFrame:
    # dealt to a set number of partitions: groups are small before they are drawn for, so adaptive execution would put many
    # into one task, which then sorts all their draws
    sized = groups.select(key, length).repartition(partitions_of(groups), key).join(sizes, key)
    return with_draws(sized, F.col("n_pool"), F.col(length), seed, F.col(key)).select(
        key, (F.col("n_pool") < F.col(length)).alias("short"), F.col("drawn").alias("position_in_pool"), (F.col("slot") + 1).alias("position")
    )


def random_members(population: DataFrame, column: str, draws: DataFrame, key: str, want: Column, seed) -> DataFrame:
    """``want`` random members of a population per row of ``draws``: (key, position, column)."""
    index = id_index(population, column)
    size = population.where(F.col(column).isNotNull()).agg(F.countDistinct(column)).scalar()
    drawn = with_draws(draws.withColumn("_size", size), F.col("_size"), want, seed, F.col(key)).select(key, "slot", F.col("drawn").alias("idx"))
    return drawn.hint("merge").join(index, "idx").select(key, (F.col("slot") + 1).cast("bigint").alias("position"), column)


def random_tracks(tracks: DataFrame, draws: DataFrame, key: str, want: Column, seed: int) -> DataFrame:
    """Random catalogue tracks per draw: cold-start fallback and random baseline."""
    ids = tracks.select(F.col("id").alias("track_id"))
    return random_members(ids, "track_id", draws, key, want, seed)


def random_groups(users: DataFrame, groups: DataFrame, seed: int, low: int = 2, high: int = 10) -> DataFrame:
    """Members of random groups: a size uniform in ``[low, high)`` per group, users without replacement."""
    size = F.lit(low) + hash_number(seed, F.lit("size"), F.col("group_id")) % (high - low)
    return random_members(users, "user_id", groups, "group_id", size, seed).select("group_id", "user_id")
