"""Requests as a table: validation, members, routing, responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tunequorum.functions.columns import ab_model

MODELS = ("base", "advanced")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add ``reason``: NULL for a valid request, else why it is rejected."""
    reason = (
        F.when(F.col("request_id").isNull(), "missing request_id")
        .when(F.col("user_id").isNull(), "missing user_id")
        .when(F.col("other_users").isNull(), "missing other_users")
        .when(F.col("playlist_length").isNull(), "missing playlist_length")
        .when(F.col("playlist_length") < 0, "negative playlist_length")
    )
    return requests.withColumn("reason", reason)


def request_members(requests: DataFrame) -> DataFrame:
    """Distinct members (request_id, user_id): the requesting user and the others."""
    everyone = F.array_distinct(F.concat(F.array("user_id"), "other_users"))
    return (
        requests.select("request_id", F.explode(everyone).alias("user_id"))
        .where(F.col("user_id").isNotNull())
    )


def rejected_requests(requests: DataFrame) -> DataFrame:
    """The requests that are not answered, each with its reason."""
    return validate_requests(requests).where(F.col("reason").isNotNull())


def route(requests: DataFrame, routing: str = "ab", models: Sequence[str] = MODELS) -> DataFrame:
    """Add ``model`` and ``is_ab``: by the user's A/B bucket, or one fixed model of ``models`` for all."""
    if routing == "ab":
        return requests.withColumn("model", ab_model(F.col("user_id"))).withColumn("is_ab", F.lit(True))
    if routing not in models:
        raise ValueError(f"unknown model: {routing}")
    return requests.withColumn("model", F.lit(routing)).withColumn("is_ab", F.lit(False))


def cold_users(users: DataFrame, known: DataFrame) -> DataFrame:
    """Users that the model does not know."""
    return users.select("user_id").where(F.col("user_id").isNotNull()).join(
        known.select("user_id"), "user_id", "left_anti"
    )


def playlist_entries(playlists: DataFrame, names: DataFrame) -> DataFrame:
    """Playlist with track and artist names, position kept; a track without a known artist disappears."""
    picked = names.select("track_id", F.col("track_name").alias("name"), F.col("artist_name").alias("artist"))
    return playlists.join(picked, "track_id").select(
        "request_id", "position", F.col("track_id").alias("id"), "name", "artist"
    )


def prediction_history(routed: DataFrame, playlists: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """One record per answered request; an empty playlist is a record too.

    ``routed`` carries (request_id, user_id, other_users, timestamp, model, is_ab).
    """
    lists = playlists.groupBy("request_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "track_id"))), lambda e: e["track_id"])
        .alias("playlist")
    )
    track_type = playlists.schema["track_id"].dataType.simpleString()
    return routed.join(lists, "request_id", "left").select(
        "request_id", "user_id", "other_users",
        F.coalesce("playlist", F.array().cast(f"array<{track_type}>")).cast("array<string>").alias("playlist"),
        "timestamp", F.lit(elapsed_seconds).cast("double").alias("elapsed_time"), "model", "is_ab",
    )
