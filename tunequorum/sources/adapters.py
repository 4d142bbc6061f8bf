"""The source tables, requests and stand-in vectors rebuilt from the generic test tables.

Every function reads whole Parquet tables and returns a lazy DataFrame, so filters and column
pruning of the operators reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 10).cast("bigint").alias("session_id"),
        F.col("ts").alias("timestamp"),
        "user_id",
        F.when(kind == "purchase", "like").when(kind == "error", "skip")
        .when(kind == "signup", "advertisement").otherwise("play").alias("event_type"),
        F.when(kind == "signup", F.lit(None).cast("bigint"))
        .otherwise(F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")).alias("track_id"),
    )


def likes_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with the like filter written on the stored column, so that it is pushed to the scan."""
    return table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(
        "user_id",
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("track_id"),
        F.lit("like").alias("event_type"),
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_partkey") % 9 != 0).select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") % 27).alias("id_artist"),
        F.col("p_name").alias("name"),
        (F.col("p_partkey") % 101).alias("popularity"),
        (F.col("p_size") * 6000).cast("bigint").alias("duration_ms"),
        F.col("p_size").cast("double").alias("tempo"),
        F.col("p_retailprice").alias("loudness"),
        F.make_date(F.lit(1960) + F.col("p_size"), F.lit(1), F.lit(1)).alias("release_date"),
    )


def tracks_with_rereleases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracks, and for every seventh one a second release that differs only in id and popularity."""
    first = tracks(spark, sf_dir)
    again = first.where(F.col("id") % 7 == 0).withColumn("id", -F.col("id")).withColumn("popularity", F.col("popularity") + 1)
    return first.unionByName(again)


#: Numeric features that the adapted tracks carry.
TRACK_FEATURES = ("popularity", "duration_ms", "tempo", "loudness", "release_year")


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.array("r_name").alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles; the favourite genres are the region of the nation key and that of the customer key."""
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("k"), "r_name")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_nationkey") % 5).cast("bigint").alias("k1"),
        (F.col("c_custkey") % 5).alias("k2"),
    )
    first = region.select(F.col("k").alias("k1"), F.col("r_name").alias("g1"))
    second = region.select(F.col("k").alias("k2"), F.col("r_name").alias("g2"))
    return customer.join(first, "k1").join(second, "k2").select(
        "user_id", F.array_distinct(F.array("g1", "g2")).alias("favourite_genres")
    )


def profile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.col("o_custkey") % 20
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        host.alias("user_id"),
        F.array((host * 7 + 1) % 20, F.col("o_custkey")).alias("other_users"),
        ((F.col("o_orderkey") % 23).cast("int") - 2).alias("playlist_length"),
    )


def group_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of random groups and repetitions, one per supplier."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("group_id"))


def request_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time within the month of the session log for each request."""
    start = F.expr("timestamp_ntz '2024-01-01 00:00:00'")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        (start + F.make_dt_interval(days=F.col("o_orderkey") % 28)).alias("timestamp"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in item vectors; ids share a vector modulo 400, so exact score ties occur."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return (
        tracks(spark, sf_dir).select(F.col("id").alias("track_id"), (F.col("id") % 400).alias("vec_id"))
        .join(vectors, "vec_id").select("track_id", "vec")
    )


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in vectors of the users seen in sessions."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    seen = table(spark, sf_dir, "events").select("user_id").distinct()
    return (
        seen.withColumn("vec_id", F.lit(400) + F.col("user_id") % 100)
        .join(vectors, "vec_id").select("user_id", "vec")
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial log shaped from the supplier table: parameters and metrics per trial."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("trial"),
        (F.lit(1.0) / (1 + key % 37)).alias("learning_rate"),
        (F.lit(1.0) / (1 + key % 101)).alias("item_alpha"),
        (5 + key % 75).alias("no_components"),
        (F.lit(0.5) + (key * 7919 % 1000) / 2000.0).alias("auc_test"),
        ((key * 104729 % 997) / 997.0).alias("clustering_fm"),
        (F.lit(1.0) + (key * 1299709 % 991) / 991.0).alias("clustering_base"),
    )
