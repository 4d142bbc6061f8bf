"""Documents to packed training pieces: each stage works on all rows that the one before it kept.

A stage's result must be written (or read to its end) before the next stage is called, as run() does: the next one begins
by deleting the scratch tables that the stages before it have left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tunequorum.llm.dedup import drop_exact_duplicates
from tunequorum.llm.packing import pack
from tunequorum.llm.quality import keep_good
from tunequorum.llm.secrets import redact_secrets
from tunequorum.llm.simhash import drop_near_duplicates
from tunequorum.runtime import delete_scratch, durable, scratch_mark, scratch_since

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: list[str] = []


def stage(function: Stage) -> Stage:
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scratch(spark, _left)
        _left.clear()
        mark = scratch_mark()
        out = function(spark, docs, sf_dir)
        _left[:] = scratch_since(mark)
        return out

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return drop_exact_duplicates(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document with the smallest doc_id stays."""
    return drop_near_duplicates(docs)


@stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of secrets are replaced in the texts, and ``n_chars``, if there is one, follows; all documents stay."""
    clean = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece: its words, where it lies in its document, in which bucket, batch and slot."""
    return pack(docs, with_text=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL cannot express fingerprints and their components.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``. Each stage says what becomes of nulls, repeats and long texts: rows whose
    text is null or empty fail the quality rules, null ids are kept, an empty table gives no rows, other columns are carried
    up to the last stage. The table needs doc_id, text, lang and source.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES:
        docs = durable(apply(spark, docs, sf_dir))
    return docs
