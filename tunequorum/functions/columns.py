"""Scalar expressions of the recommendation domain."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Modulus of Python's integer hash on 64-bit builds (fixed value).
PYTHON_HASH_MODULUS = 2**61 - 1


def release_year(col: Column) -> Column:
    """Year of a date or of a date string such as ``1994`` or ``1994-05``; NULL for a bad string."""
    return F.year(col.try_cast("date")).cast("bigint")


def is_like(event_type: Column) -> Column:
    """``LIKE 'like'`` has no wildcard, so it is a case-sensitive equality."""
    return event_type == "like"


def ab_model(user_id: Column) -> Column:
    """A/B bucket: an even Python hash of the user id goes to ``base``, an odd one to ``advanced``."""
    folded = user_id.cast("bigint") % F.lit(PYTHON_HASH_MODULUS).cast("bigint")
    hashed = F.when(folded == -1, F.lit(-2).cast("bigint")).otherwise(folded)
    return F.when(F.pmod(hashed, F.lit(2)) == 0, F.lit("base")).otherwise(F.lit("advanced"))


def percent_better(base: Column, advanced: Column) -> Column:
    """How much lower ``advanced`` is than ``base``, in percent of ``base``; NULL when ``base`` is zero."""
    return (base - advanced) * 100 / F.nullif(base, F.lit(0.0))


def log_uniform(fraction: Column, low: float, high: float) -> Column:
    """``10 ** U(low, high)`` from a draw in ``[0, 1)``."""
    return F.pow(F.lit(10.0), F.lit(low) + fraction * F.lit(high - low))


def uniform_int(fraction: Column, low: int, high: int) -> Column:
    """Integer in ``[low, high)`` from a draw in ``[0, 1)``."""
    return (F.lit(low) + F.floor(fraction * F.lit(high - low))).cast("bigint")


def dot(left: Column, right: Column) -> Column:
    """Inner product of two numeric arrays in double precision, rounded to 6 digits."""
    pairs = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.round(F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v), 6)


def l2_distance(left: Column, right: Column) -> Column:
    """Euclidean distance of two numeric arrays."""
    squares = F.zip_with(left, right, lambda a, b: F.pow(a.cast("double") - b.cast("double"), F.lit(2.0)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))
