"""Whitening of embeddings: exact integer sums, one covariance pass, QDWH eigenvectors, and a projection of every row.

Entries become integers on a grid, so that the mean needs no rounding. Tasks add up centred outer products of their
partition; only a d x d matrix reaches the driver, is split there (spectral.py) and goes back to the tasks as the
projection, whose size depends on the dimension alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tunequorum.llm.spectral import eigenvectors
from tunequorum.runtime import durable

#: Components that are returned at most.
COMPONENTS = 32
#: Grid of the integers: x = floor(GRID * c) + OFFSET.
GRID, OFFSET = 64, 1_000_000

_LONG = 2.0**63


@dataclass
class Whitening:
    """Fit over ``n`` vectors: exact sums per dimension, all eigenvalues (falling) and their eigenvectors (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        """Share of each component in the trace; zero if nothing varies."""
        total = self.values.sum()
        return self.values / total if total > 0 else np.zeros(len(self.values))

    def components(self) -> int:
        return min(COMPONENTS, len(self.values))

    def projection(self) -> np.ndarray:
        """d x components; columns without variance (to rounding) are NaN."""
        k = self.components()
        least = len(self.values) * np.finfo(float).eps * self.values.max(initial=0)
        positive = self.values[:k] > max(least, 0)
        return self.vectors[:, :k] / np.sqrt(np.where(positive, self.values[:k], np.nan))


def _grid(c: Column) -> Column:
    return F.floor(c.cast("double") * GRID)


def on_grid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): the usable vectors as arrays of integers; see whiten() for what is usable. Written once."""
    vec = F.col(vec_col)
    fits = F.forall(vec, lambda c: c.isNotNull() & (F.abs(c.cast("double") * GRID) < F.lit(_LONG / 4)))  # false for NaN
    usable = df.where(vec.isNotNull() & fits).select(
        F.col(id_col).alias("id"), F.transform(vec, lambda c: _grid(c) + F.lit(OFFSET).cast("long")).alias("x")
    )
    written = durable(usable)
    common = written.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return written.where(F.size("x") == (common.d if common else 0))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(x: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension. High and low halves are added up apart, so that no task overflows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, halves = 0, None
        for b in batches:
            if b.num_rows:
                m = matrix(b.column(0))
                here = np.stack([(m >> 32).sum(axis=0), (m & 0xFFFFFFFF).sum(axis=0)])
                n, halves = n + len(m), here if halves is None else halves + here
        if n:
            at = np.arange(halves.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (at, np.full(len(at), n), *halves)], ["i", "n", "high", "low"])

    parts = x.select("x").mapInArrow(add, "i long, n long, high long, low long")
    wide = "decimal(38,0)"
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).orderBy("i").collect()
    return (rows[0].n if rows else 0), [(int(r.high) << 32) + int(r.low) for r in rows]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - sums as exact integers, x - sums / n in double)."""
    floors, rests = zip(*(divmod(s, n) for s in sums))
    y = x - np.array(floors, np.int64)
    centred = y - np.array(rests, np.float64) / n
    largest = float(n) * (float(np.abs(y).max(initial=0)) + 1)
    if largest * largest * x.shape[1] < _LONG:
        return n * y - np.array(rests, np.int64), centred
    return n * y.astype(object) - np.array(rests, object), centred


def second_moments(vectors: DataFrame, width: int, centre) -> np.ndarray:
    """Sum of the outer products of centre(matrix) over all rows of the one array column."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                m = centre(matrix(b.column(0)))
                total += m.T @ m
        if total.any():
            rows, cols = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (rows, cols, total[rows, cols])], ["i", "j", "v"])

    out = np.zeros((width, width))
    for r in vectors.mapInArrow(add, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def fit(x: DataFrame) -> Whitening:
    """Fit over all rows of on_grid(); the driver holds d x d numbers."""
    n, sums = _sums(x)
    if not sums:
        return Whitening(n, [], np.zeros(0), np.zeros((0, 0)))
    covariance = second_moments(x.select("x"), len(sums), lambda m: _deviations(m, n, sums)[1]) / n
    values, vectors = eigenvectors(covariance)
    return Whitening(n, sums, np.maximum(values, 0), vectors)


def project(x: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened array<double>) of all rows of on_grid()."""
    n, sums, projection = model.n, model.sums, model.projection()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            exact, centred = _deviations(matrix(b.column("x")), n, sums)
            squares = (exact * exact).sum(axis=1).tolist()
            flat = (centred @ projection).ravel()
            offsets = np.arange(b.num_rows + 1, dtype=np.int32) * projection.shape[1]
            yield pa.RecordBatch.from_arrays([
                b.column("id"), pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, mask=np.isnan(flat))),
            ], ["id", "deviation", "whitened"])

    id_type = x.schema["id"].dataType.simpleString()
    return x.select("id", "x").mapInArrow(rows, f"id {id_type}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components that vary."""
    vary = np.flatnonzero(~np.isnan(model.projection()).any(axis=0))
    k = model.components()
    if not len(vary):
        return 0.0
    moments = second_moments(
        whitened.select(F.concat(F.array(F.lit(1.0)), F.transform("whitened", lambda w: F.coalesce(w, F.lit(0.0)))).alias("w")), k + 1, lambda m: m
    ) / model.n
    mean = moments[0, 1:]
    covariance = moments[1:, 1:] - np.outer(mean, mean)
    return float(np.abs(covariance[np.ix_(vary, vary)] - np.eye(len(vary))).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component.

    Dropped are vectors that are null, or hold null, NaN, infinite or such large entries that their integer would not
    fit into a long; also vectors whose length is not the most frequent one (the shorter one on a tie), and empty ones.
    Repeated rows and ids count each time, and null ids stay. ``whitened`` is null for a component without variance,
    ``deviation`` if it doesn't fit into a long. No usable vector gives no rows. Other columns are not read.
    """
    x = on_grid(df, id_col, vec_col)
    model = fit(x)
    rows = durable(project(x, model))
    error = identity_error(rows, model)
    explained = F.array(*[F.lit(float(v)) for v in model.explained[: model.components()]]).cast("array<double>")
    return rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
