"""Per-user rankings and group playlists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tunequorum.operators.lists import block_ids, item_blocks, top_lists
from tunequorum.operators.rank_sums import least_rank_sums
from tunequorum.operators.scoring import score_ends
from tunequorum.runtime import durable

#: A user's list is cut into this many parts for the join with the groups, so that a user who is in
#: very many groups is spread over that many tasks (and AQE splits the parts further).
LIST_PARTS = 16


def user_topk(users: DataFrame, items: DataFrame, k: int | str, exclude: DataFrame | None = None) -> DataFrame:
    """Best ``k`` tracks (or as many as a column of ``users`` says) of each user: (user_id, track_id, score, rank).

    Already liked tracks stay in unless ``exclude`` names them.
    """
    return top_lists(users, items, k, exclude)


def _part(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(LIST_PARTS)).cast("int")


def _with_lists(members: DataFrame, lists: DataFrame, user: str = "user_id") -> DataFrame:
    """``members`` with all rows of their users' lists; a user of very many groups is spread over tasks by track."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(LIST_PARTS - 1))).alias("_part")
    listed = lists.withColumnRenamed("user_id", user).withColumn("_part", _part(F.col("track_id")))
    # hinted, since the planner takes exploded rows for few and would broadcast them
    return members.select("*", parts).hint("merge").join(listed, [user, "_part"]).drop("_part")


def list_overlap(pairs: DataFrame, lists: DataFrame, n: int) -> DataFrame:
    """Shared tracks of the two users' lists for each given pair (user_a, user_b): count and percent of ``n``."""
    b = lists.select(F.col("user_id").alias("user_b"), "track_id")
    shared = (
        _with_lists(pairs, lists.select("user_id", "track_id"), "user_a").join(b, ["user_b", "track_id"])
        .groupBy("user_a", "user_b").agg(F.count(F.lit(1)).alias("n_shared"))
    )
    return pairs.join(shared, ["user_a", "user_b"], "left").select(
        "user_a", "user_b",
        F.coalesce("n_shared", F.lit(0).cast("bigint")).alias("n_shared"),
        (F.coalesce("n_shared", F.lit(0)) * 100.0 / n).alias("percent_shared"),
    )


def common_tracks(members: DataFrame, lists: DataFrame, key: str = "request_id") -> DataFrame:
    """Tracks that are in the list of every member of a group."""
    asked = members.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("user_id"))).alias("members"))
    # the same members are asked about once; the answers then go to all their groups, spread over tasks by group
    sets = asked.groupBy("members").agg(F.min(key).alias("lead"))
    each = sets.select("lead", F.size("members").alias("n_members"), F.explode("members").alias("m")).select("lead", "n_members", "m.user_id")
    found = (
        _with_lists(each, lists.select("user_id", "track_id")).groupBy("lead", "n_members", "track_id").agg(F.count(F.lit(1)).alias("n_lists"))
        .where("n_lists = n_members").select("lead", "track_id", F.explode(F.sequence(F.lit(0), F.lit(LIST_PARTS - 1))).alias("_part"))
    )
    leads = asked.join(sets, "members").select(key, "lead", _part(F.col(key)).alias("_part"))
    return found.hint("merge").join(leads, ["lead", "_part"]).select(key, "track_id")


def group_playlists(
    groups: DataFrame, members: DataFrame, users: DataFrame, items: DataFrame,
    key: str = "request_id", length: str = "playlist_length", k_per_user: int | None = None,
    weight: str | None = None, blocks: DataFrame | None = None,
) -> DataFrame:
    """Playlists (key, position, track_id, mean_rank): the tracks with the least mean rank over the members.

    ``groups`` is (key, length), ``members`` (key, user_id), ``users`` (user_id, vec), ``items``
    (track_id, vec). Members without a vector are left out of the mean; a group of one gets its member's
    list; ties go to the smaller track id. The ranks are those of the whole lists, for groups and catalogues of any
    size. ``blocks``, from item_blocks(items), saves preparing the catalogue again for every call.

    With ``k_per_user`` each list is cut at that rank and only tracks in all the lists of a group count.
    With ``weight``, a positive column of ``members``, the mean is weighted by it.
    """
    wanted = groups.where(F.col(length) > 0).select(key, F.col(length).cast("bigint").alias("n_wanted"))
    share = F.col(weight).cast("double") if weight else F.lit(1.0)
    warm = (
        members.select(key, "user_id", share.alias("share")).distinct()
        .join(users.select("user_id"), "user_id", "left_semi")
    )
    asked = warm.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("user_id", "share"))).alias("members")).join(wanted, key)
    # the same members ask for one ranking, as long as the longest of their playlists
    sets = asked.groupBy("members").agg(F.min(key).alias("lead"), F.max("n_wanted").alias("n_wanted"))
    planned = sets.select(
        F.col("lead").alias(key), "n_wanted", F.size("members").cast("bigint").alias("n_members"),
        F.aggregate("members", F.lit(0.0), lambda total, m: total + m["share"]).alias("shares"), F.explode("members").alias("m"),
    ).select(key, "m.user_id", "m.share", "n_members", "shares", "n_wanted")
    listed = users.join(planned.select("user_id"), "user_id", "left_semi")
    per_set = sets.select(F.col("lead").alias(key), F.aggregate("members", F.lit(0.0), lambda total, m: total + m["share"]).alias("shares"), F.col("n_wanted").alias("most"))
    if k_per_user:
        found = _with_lists(planned, user_topk(listed, items, k_per_user).select("user_id", "track_id", "rank")).groupBy(key, "track_id").agg(
            F.count(F.lit(1)).alias("n_lists"), F.max("n_members").alias("n_members"), F.round(F.sum(F.col("share") * F.col("rank")), 6).alias("rank_sum")
        ).where("n_lists = n_members").withColumn("at", F.col("track_id"))
    else:
        blocks = item_blocks(items) if blocks is None else blocks
        found = least_rank_sums(durable(planned), listed, blocks, key)
    order = Window.partitionBy(key).orderBy("rank_sum", "at")
    best = found.withColumn("position", F.row_number().over(order).cast("bigint")).join(per_set, key).where("position <= most")
    if not k_per_user:
        best = best.join(block_ids(blocks), "at")
    best = best.select(F.col(key).alias("lead"), "position", "track_id", (F.col("rank_sum") / F.col("shares")).alias("mean_rank"))
    leads = asked.join(sets.select("members", "lead"), "members").select(key, "lead", "n_wanted")
    return best.join(leads, "lead").where("position <= n_wanted").select(key, "position", "track_id", "mean_rank")


def group_playlists_by_product(
    groups: DataFrame, members: DataFrame, users: DataFrame, items: DataFrame, k_per_member: int,
    key: str = "request_id", length: str = "playlist_length",
) -> DataFrame:
    """Playlists of the length asked for, ordered by the product of the members' scores, each scaled to [0, 1] per user.

    The lists are cut at ``k_per_member`` x group size, and only tracks in the lists of all members
    count. A zero in any list makes the product zero.
    """
    wanted = groups.where(F.col(length) > 0).select(key, F.col(length).cast("bigint").alias("n_wanted"))
    warm = members.select(key, "user_id").distinct().join(wanted.select(key), key, "left_semi").join(users.select("user_id"), "user_id", "left_semi")
    asked = warm.groupBy(key).agg(F.sort_array(F.collect_list("user_id")).alias("members")).join(wanted, key)
    # the same members ask for one list of products, as long as the longest of their playlists
    sets = durable(asked.groupBy("members").agg(F.min(key).alias("lead"), F.max("n_wanted").alias("most")))
    sized = sets.select("lead", F.size("members").cast("bigint").alias("n_members"), F.explode("members").alias("user_id")).withColumn("depth", F.col("n_members") * k_per_member)
    # a list is as long as the largest of its user's own groups needs
    listed_users = users.join(sized.groupBy("user_id").agg(F.max("depth").alias("longest")), "user_id")
    lists = user_topk(listed_users, items, "longest")
    # the least score of a user over all items scales the list; only the two ends leave the scoring tasks
    ends = score_ends(listed_users, items).groupBy("user_id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    scaled = lists.join(ends, "user_id").select(
        "user_id", "track_id", "rank",
        ((F.col("score") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))).alias("scaled"),
    )
    products = (
        _with_lists(sized, scaled).where(F.col("rank") < F.col("depth"))
        .groupBy("lead", "track_id", "n_members")
        .agg(F.count(F.lit(1)).alias("n_lists"), F.count_if(F.col("scaled") <= 0).alias("zeros"),
             F.sum(F.when(F.col("scaled") > 0, F.ln("scaled"))).alias("logs"))
        .where(F.col("n_lists") == F.col("n_members"))
        .withColumn("product", F.round(F.when(F.col("zeros") > 0, 0.0).otherwise(F.exp("logs")), 6))
    )
    order = Window.partitionBy("lead").orderBy(F.desc("product"), "track_id")
    best = products.withColumn("position", F.row_number().over(order).cast("bigint")).join(sets.select("lead", "most"), "lead").where("position <= most")
    leads = asked.join(sets.select("members", "lead"), "members").select(key, "lead", "n_wanted")
    return best.join(leads, "lead").where(F.col("position") <= F.col("n_wanted")).select(key, "position", "track_id", "product")
