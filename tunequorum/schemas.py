"""Declared schemas of every table; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

ARTISTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
])

SESSIONS = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
])

TRACKS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("id_artist", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("popularity", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("explicit", T.LongType()),
    T.StructField("key", T.LongType()),
    T.StructField("acousticness", T.DoubleType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("instrumentalness", T.DoubleType()),
    T.StructField("liveness", T.DoubleType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("speechiness", T.DoubleType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("favourite_genres", T.ArrayType(T.StringType())),
])

TRACK_STORAGE = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("storage_class", T.StringType()),
    T.StructField("daily_cost", T.DoubleType()),
])

REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("other_users", T.ArrayType(T.LongType())),
    T.StructField("playlist_length", T.IntegerType()),
])

HISTORY = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("other_users", T.ArrayType(T.LongType())),
    T.StructField("playlist", T.ArrayType(T.StringType())),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("elapsed_time", T.DoubleType()),
    T.StructField("model", T.StringType()),
    T.StructField("is_ab", T.BooleanType()),
])

#: The five source tables by name.
SOURCE_TABLES = {
    "artists": ARTISTS,
    "sessions": SESSIONS,
    "track_storage": TRACK_STORAGE,
    "tracks": TRACKS,
    "users": USERS,
}

#: Timestamp format of the session log (fixed value).
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

#: Numeric track features used for modelling; release_year is derived (fixed values).
TRACK_FEATURES = (
    "acousticness", "danceability", "duration_ms", "energy", "instrumentalness", "key", "liveness",
    "loudness", "popularity", "release_year", "speechiness", "tempo", "valence",
)
