"""Registry of the source tables of one data version, and their readers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tunequorum.schemas import SOURCE_TABLES, TIMESTAMP_FORMAT


def table_paths(root: str, version: str, only: Iterable[str] | None = None, suffix: str = "jsonl") -> dict[str, str]:
    """Path of each source table of a data version; an unknown name in ``only`` is an error."""
    names = sorted(SOURCE_TABLES) if only is None else list(only)
    unknown = sorted(set(names) - set(SOURCE_TABLES))
    if unknown:
        raise KeyError(f"unknown source tables: {', '.join(unknown)}")
    return {name: f"{root.rstrip('/')}/{version}/{name}.{suffix}" for name in names}


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read one source table, JSON lines or Parquet by the suffix of the path, with its declared schema."""
    reader = spark.read.schema(SOURCE_TABLES[name])
    if path.rstrip("/").endswith(".parquet"):
        return reader.parquet(path)
    return reader.option("timestampFormat", TIMESTAMP_FORMAT).json(path)


def register_views(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read the given tables and register each as a temp view of its own name."""
    frames = {name: read_table(spark, name, path) for name, path in paths.items()}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return frames


def convert_to_parquet(spark: SparkSession, paths: dict[str, str], root: str, version: str) -> dict[str, str]:
    """Convert JSON lines to Parquet once, sessions partitioned by event type so that like scans prune."""
    targets = table_paths(root, version, paths, suffix="parquet")
    for name, path in paths.items():
        writer = read_table(spark, name, path).write.mode("overwrite")
        if name == "sessions":
            writer = writer.partitionBy("event_type")
        writer.parquet(targets[name])
    return targets
