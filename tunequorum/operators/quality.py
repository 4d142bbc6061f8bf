"""Data-quality rules over the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _broken(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """One pass over a table: (table_name, rule, n_bad) per rule."""
    counted = df.agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "n_bad").select(F.lit(table).alias("table_name"), "rule", "n_bad")


def dq_report(artists: DataFrame, tracks: DataFrame, sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Counts of bad rows per table and rule."""
    kind = F.col("event_type")
    repeated = sessions.groupBy("session_id", "timestamp").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_bad")
    )
    return (
        _broken(artists, "artists", {
            "missing_id": F.col("id").isNull() | (F.col("id").cast("string") == "-1"),
            "missing_genres": F.col("genres").isNull(),
        })
        .unionByName(_broken(tracks, "tracks", {"missing_id": F.col("id").isNull()}))
        .unionByName(_broken(sessions, "sessions", {
            "missing_session_id": F.col("session_id").isNull(),
            "missing_user": F.col("user_id").isNull(),
            "missing_event_type": kind.isNull(),
            "missing_track": F.col("track_id").isNull() & ~F.coalesce(kind == "advertisement", F.lit(False)),
        }))
        .unionByName(repeated.select(
            F.lit("sessions").alias("table_name"), F.lit("repeated_timestamp").alias("rule"), "n_bad"))
        .unionByName(_broken(users, "users", {"missing_genres": F.col("favourite_genres").isNull()}))
    )


def _same(tracks: DataFrame, same: list[str] | None) -> list[str]:
    return [c for c in tracks.columns if c not in ("id", "popularity")] if same is None else same


def rereleases(tracks: DataFrame, same: list[str] | None = None) -> DataFrame:
    """Groups of tracks that agree in ``same`` (by default all columns but id and popularity) and occur more than once."""
    return (
        tracks.groupBy(*_same(tracks, same))
        .agg(F.count(F.lit(1)).alias("n_releases"), F.min("id").alias("first_id"), F.max("popularity").alias("popularity"))
        .where(F.col("n_releases") > 1)
    )


def collapse_rereleases(tracks: DataFrame, same: list[str] | None = None) -> DataFrame:
    """One row per recording: the smallest id and the greatest popularity."""
    return tracks.groupBy(*_same(tracks, same)).agg(F.min("id").alias("id"), F.max("popularity").alias("popularity"))
