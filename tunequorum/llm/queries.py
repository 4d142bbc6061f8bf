"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunequorum.llm import (
    bpe, dedup, extraction, licenses, packing, prefixes, preferences, quality, rans, secrets,
    simhash, tiles, whitening,
)
from tunequorum.runtime import durable, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op7_quality_rules(spark, sf):
    return quality.quality_report(_table(spark, sf, "documents"))


@query
def op10_exact_dedup(spark, sf):
    return dedup.exact_groups(_table(spark, sf, "documents"))


@query
def op1_secret_scan(spark, sf):
    return secrets.secret_spans(_table(spark, sf, "documents"))


@query
def op4_simhash_dedup(spark, sf):
    return simhash.near_groups(_table(spark, sf, "documents"))


@query
def op9_token_files(spark, sf):
    path = scratch_path(spark, "tokens")
    rans.write_tokens(_table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return rans.read_tokens(spark, path)


@query
def op6_bpe_round_trip(spark, sf):
    coded = bpe.encode_decode(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_packing(spark, sf):
    return packing.pack(_table(spark, sf, "documents"))


@query
def op5_preference_format(spark, sf):
    """Conversations 2k are the chosen ones, 2k + 1 the rejected ones of pair k."""
    conv = F.col("conv_id")
    return preferences.preference_pairs(
        _table(spark, sf, "conversations"), F.floor(conv / 2).cast("long"), F.pmod(conv, F.lit(2)) == 0
    )


@query
def op3_licence_scan(spark, sf):
    return licenses.licence_report(_table(spark, sf, "documents")).drop("spans")


@query
def op8_html_extraction(spark, sf):
    return extraction.extract(_table(spark, sf, "pages"))


@query
def op12_embedding_whitening(spark, sf):
    return whitening.whiten(_table(spark, sf, "embeddings"))


@query
def op11_embedding_near_dedup(spark, sf):
    return tiles.near_vectors(_table(spark, sf, "embeddings"))


@query
def op13_prefix_trie(spark, sf):
    turns = durable(prefixes.number_turns(_table(spark, sf, "conversations")))
    return prefixes.prefix_trie(*prefixes.with_shared_openings(turns))
