"""Hash expressions that give the same value in Spark and in ANSI SQL engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def hash_number(*parts, digits: int = 15) -> Column:
    """First ``digits`` hex digits of the md5 of the parts joined by ``|``, as a BIGINT."""
    text = F.concat_ws("|", *[_text(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_bucket(buckets: int, *parts) -> Column:
    """A stable bucket in ``[0, buckets)``."""
    return hash_number(*parts, digits=8) % F.lit(buckets).cast("bigint")


def hash_fraction(*parts) -> Column:
    """A stable draw in ``[0, 1)``, a multiple of 1e-9."""
    return (hash_number(*parts) % F.lit(1_000_000_000).cast("bigint")) / F.lit(1e9)
