"""From the session log to liked interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tunequorum.functions.columns import is_like, release_year
from tunequorum.functions.hashing import hash_bucket


def user_universe(sessions: DataFrame | None = None, profiles: DataFrame | None = None) -> DataFrame:
    """Users seen in sessions (distinct), or all profiles as they are. NULL ids are dropped."""
    if (sessions is None) == (profiles is None):
        raise ValueError("give either sessions or profiles")
    if sessions is not None:
        return sessions.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    return profiles.select("user_id").where(F.col("user_id").isNotNull())


def liked_pairs(sessions: DataFrame) -> DataFrame:
    """Distinct (user, track) pairs with a like."""
    return (
        sessions.where(is_like(F.col("event_type")) & F.col("user_id").isNotNull() & F.col("track_id").isNotNull())
        .select("user_id", "track_id").distinct()
    )


def like_weights(sessions: DataFrame, event_weights: DataFrame | None = None) -> DataFrame:
    """Summed event weight per (user, track).

    Without ``event_weights`` a like counts 1 and other events nothing; with a table
    (event_type, event_weight) every listed event counts with its weight.
    """
    keyed = sessions.where(F.col("user_id").isNotNull() & F.col("track_id").isNotNull())
    if event_weights is None:
        weighted = keyed.where(is_like(F.col("event_type"))).withColumn("event_weight", F.lit(1).cast("bigint"))
    else:
        weighted = keyed.join(event_weights, "event_type")
    return weighted.groupBy("user_id", "track_id").agg(F.sum("event_weight").alias("weight"))


def with_catalogue(interactions: DataFrame, tracks: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Inner join with the catalogue: interactions with unknown tracks disappear."""
    picked = tracks.select(F.col("id").alias("track_id"), *(columns or []))
    return interactions.join(picked, "track_id").select(*interactions.columns, *(columns or []))


def track_features(tracks: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Distinct rows of id, artist and numeric features; the year comes from the release date."""
    picked = [release_year(F.col("release_date")).alias(f) if f == "release_year" else F.col(f) for f in features]
    return tracks.select("id", "id_artist", *picked).distinct()


def binary_interactions(sessions: DataFrame, tracks: DataFrame, weight: str = "binary") -> DataFrame:
    """Training interactions (user, track, w): 1.0 per liked pair, or the summed weight with ``weight="sum"``."""
    if weight not in ("binary", "sum"):
        raise ValueError(f"unknown weight: {weight}")
    # known_ids keeps one row per pair even where the catalogue repeats an id
    known_ids = tracks.select(F.col("id").alias("track_id")).distinct()
    pairs = like_weights(sessions) if weight == "sum" else liked_pairs(sessions)
    w = F.col("weight").cast("double") if weight == "sum" else F.lit(1.0)
    return pairs.join(known_ids, "track_id", "left_semi").select("user_id", "track_id", w.alias("w"))


def split_interactions(interactions: DataFrame, seed: int = 42, train_percent: int = 80) -> DataFrame:
    """Add ``is_train``: a hash bucket below ``train_percent``; stable under any repartitioning."""
    bucket = hash_bucket(100, seed, F.col("user_id"), F.col("track_id"))
    return interactions.withColumn("is_train", bucket < train_percent)


def implied_ratings(sessions: DataFrame, play: float = 1.0, like: float = 3.0, skip: float = -2.0) -> DataFrame:
    """Explicit rating per (user, track) implied by the counts of plays, likes and skips."""
    kind = F.col("event_type")
    counts = (
        sessions.where(F.col("user_id").isNotNull() & F.col("track_id").isNotNull() & kind.isin("play", "like", "skip"))
        .groupBy("user_id", "track_id")
        .agg(*[F.count_if(kind == k).alias(f"n_{k}") for k in ("play", "like", "skip")])
    )
    total = F.col("n_play") + F.col("n_like") + F.col("n_skip")
    points = F.col("n_play") * play + F.col("n_like") * like + F.col("n_skip") * skip
    return counts.withColumn("rating", points / total)


def recency_weights(sessions: DataFrame, tau_days: float = 7.0, events: tuple[str, ...] = ("like", "play")) -> DataFrame:
    """Weight per (user, track) that decays with the age of each event before the newest timestamp."""
    newest = sessions.agg(F.max("timestamp")).scalar()
    age_days = F.timestamp_diff("MICROSECOND", F.col("timestamp"), newest) / F.lit(86_400_000_000.0)
    return (
        sessions.where(F.col("event_type").isin(*events) & F.col("user_id").isNotNull() & F.col("track_id").isNotNull())
        .withColumn("decayed", F.exp(-age_days / tau_days))
        .groupBy("user_id", "track_id").agg(F.sum("decayed").alias("weight"))
    )
