"""Near duplicates of embeddings by tiled comparison in PCA order.

Unit vectors are turned into the principal axes of the whole table. Ranges of the first axis go to partitions, and each
partition halves its rows along their widest axes into tiles of few rows. Two tiles are compared only if their
boxes and balls come close enough. The comparison adds up the products of the leading axes first, bounds what is
left by the norms of the suffixes, and drops rows that cannot reach the threshold any more. Tiles whose balls lie so
close that all their pairs must be linked are counted without looking at a vector.

Tasks give numbers of links and enough edges to keep what is connected together, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tunequorum.llm.components import components
from tunequorum.llm.simhash import _forest as forest
from tunequorum.llm.spectral import eigenvectors
from tunequorum.llm.whitening import matrix, second_moments
from tunequorum.runtime import durable

THRESHOLD = 0.98
#: Vectors in a tile at most; bounds a comparison to TILE x TILE products.
TILE = 512
#: Bytes of vectors (as doubles) that a partition holds while it forms tiles.
PARTITION_BYTES = 16 << 20
#: Leading axes on which tiles have a box.
BOX = 16
#: Axes after which a comparison looks whether it can stop.
STOPS = (4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048)
#: Left tiles that meet one right tile in one place when the pairs of tiles are listed.
TILES_PER_SALT = 1024
#: Rounding of a product of unit vectors stays far below; closer calls are made on the vectors as given.
MARGIN = 1e-9


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest entry first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def turn(vectors: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors in the axes of ``basis``; vectors of another length keep their own axes."""
    unit = units(vectors.astype(np.float64))
    return unit @ basis if unit.shape[1] == len(basis) else unit


def halves(turned: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in parts of at most ``size``, cut at the median of the widest of the leading axes."""
    found, todo = [], [np.arange(len(turned))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            found.append(rows)
            continue
        lead = turned[rows, :BOX]
        axis = int(np.argmax(lead.max(axis=0) - lead.min(axis=0)))
        order = rows[np.argsort(lead[:, axis], kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return found


def linked(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have a cosine of at least ``threshold`` (boolean matrix)."""
    ya, yb = turn(a, basis), turn(b, basis)
    out = np.zeros((len(a), len(b)), bool)
    ia, ib = np.arange(len(a)), np.arange(len(b))
    width = ya.shape[1]
    stops = [s for s in STOPS if s < width] + [width]
    rest_a, rest_b = (np.sqrt(np.maximum(0, np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1])) for y in (ya, yb))
    dots, at = np.zeros((len(a), len(b))), 0
    for stop in stops:
        dots += ya[ia, at:stop] @ yb[ib, at:stop].T
        at = stop
        if stop == width:
            break
        alive = dots + np.outer(rest_a[ia, stop], rest_b[ib, stop]) >= threshold - MARGIN
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            return out
        if len(rows) * len(cols) < 0.75 * dots.size:
            dots, ia, ib = dots[np.ix_(rows, cols)], ia[rows], ib[cols]
    hit = dots >= threshold
    for i, j in np.argwhere(np.abs(dots - threshold) < MARGIN):
        x, y = a[ia[i]].astype(np.float64), b[ib[j]].astype(np.float64)
        hit[i, j] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold
    out[np.ix_(ia, ib)] = hit
    return out


_TILE_SCHEMA = (
    "grp {grp}, width int, tile long, total long, nodes array<long>, sizes array<long>, vecs binary, centre array<double>, "
    "radius double, low array<double>, high array<double>"
)


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _tiles(classes: DataFrame, basis: np.ndarray, dtype: str) -> DataFrame:
    """Tiles of the distinct vectors (grp, node, size, vec); a tile is named by its smallest node."""
    spark = classes.sparkSession
    first = basis[:, 0].tolist() if len(basis) else []
    scale = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, c: s + c.cast("double") * c))
    axis = F.array(*[F.lit(v) for v in first]).cast("array<double>")
    along = F.aggregate(F.zip_with("vec", axis, lambda c, w: c.cast("double") * w), F.lit(0.0), lambda s, c: s + c)
    lead = F.when(F.size("vec") == len(first), F.try_divide(along, scale))  # decides only which rows stand together
    sized = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("vec").cast("long")).alias("entries")).first()
    parts = max(1, math.ceil(8 * (sized.entries or 0) / PARTITION_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sized.n / (4 * TILE))))
    dealt = classes.select("grp", F.size("vec").alias("width"), lead.alias("lead"), "node", "size", "vec")
    dealt = dealt.repartitionByRange(parts, "grp", "width", "lead", "node").drop("lead")

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        whole = pa.Table.from_batches(read).sort_by([("grp", "ascending"), ("width", "ascending"), ("node", "ascending")]).combine_chunks()
        width, group = whole.column("width").to_numpy(), whole.column("grp").combine_chunks()
        changed = (width[1:] != width[:-1]) | pc.not_equal(group[1:], group[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(changed) + 1), len(width)]
        for start, stop in zip(edges, edges[1:]):
            part = whole.slice(start, stop - start).combine_chunks().to_batches()[0]
            vectors = matrix(part.column("vec")).astype(dtype)
            nodes, sizes = part.column("node").to_numpy(), part.column("size").to_numpy()
            turned = turn(vectors, basis)
            for rows in halves(turned, TILE):
                y = turned[rows]
                centre = y.mean(axis=0)
                radius = float(np.sqrt(((y - centre) ** 2).sum(axis=1).max()))
                yield pa.RecordBatch.from_arrays([
                    part.column("grp").slice(0, 1), pa.array([y.shape[1]], pa.int32()), pa.array([nodes[rows].min()]),
                    pa.array([sizes[rows].sum()]), _list(nodes[rows]), _list(sizes[rows]), pa.array([vectors[rows].tobytes()], pa.binary()),
                    _list(centre), pa.array([radius]), _list(y[:, :BOX].min(axis=0)), _list(y[:, :BOX].max(axis=0)),
                ], ["grp", "width", "tile", "total", "nodes", "sizes", "vecs", "centre", "radius", "low", "high"])

    return dealt.mapInArrow(form, _TILE_SCHEMA.format(grp=classes.schema["grp"].dataType.simpleString()))


def _pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """(a, b, total_a, total_b, sure): the unordered pairs of tiles, each with itself too, that may hold linked vectors.

    ``sure``: all their pairs are linked. Tiles meet in bins of the first axis as wide as links reach; a pair is taken in
    its first common bin only. Salts deal the tiles of one bin out.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    step = max(reach, 1 / 64)
    shapes = tiles.select("grp", "width", "tile", "total", "centre", "radius", "low", "high")
    salts = max(1, math.ceil(tiles.count() / TILES_PER_SALT))

    def bins(low: Column, high: Column) -> list[Column]:
        first, last = F.floor(low / step), F.floor(high / step)
        return [first.alias("first"), F.explode(F.sequence(first, last)).alias("bin")]

    low, high = F.col("low")[0], F.col("high")[0]
    a = shapes.select("*", *bins(low, high)).withColumn("salt", F.pmod(F.xxhash64("tile"), F.lit(salts))).alias("a")
    b = shapes.select("*", *bins(low - reach - MARGIN, high + reach + MARGIN)).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).alias("b")
    side = lambda x, y: F.col(f"{x}.{y}")
    square_sum = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v)
    gaps = F.transform(
        F.arrays_zip(side("a", "low").alias("al"), side("a", "high").alias("ah"), side("b", "low").alias("bl"), side("b", "high").alias("bh")),
        lambda z: F.greatest(F.lit(0.0), z["al"] - z["bh"], z["bl"] - z["ah"]),
    )
    apart = F.sqrt(square_sum(F.zip_with(side("a", "centre"), side("b", "centre"), lambda x, y: x - y)))
    radii = side("a", "radius") + side("b", "radius")
    met = a.join(b, ["grp", "width", "salt", "bin"]).where(
        (F.col("bin") == F.greatest(side("a", "first"), side("b", "first"))) & (side("a", "tile") <= side("b", "tile"))
    )
    met = met.where(square_sum(gaps) <= (reach + MARGIN) ** 2).withColumn("apart", apart).where(F.col("apart") - radii <= reach + MARGIN)
    return met.select(
        side("a", "tile").alias("a"), side("b", "tile").alias("b"), side("a", "total").alias("total_a"), side("b", "total").alias("total_b"),
        (F.col("apart") + radii <= reach - MARGIN).alias("sure"),
    )


def _compared(pairs: DataFrame, tiles: DataFrame, basis: np.ndarray, dtype: str, threshold: float) -> DataFrame:
    """(node, other, links): numbers of links of nodes (other is null) and edges (links is null) of the pairs of tiles."""

    def side(name: str) -> DataFrame:
        return tiles.select(F.col("tile").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("width", "nodes", "sizes", "vecs")])

    work = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def read(row: int, batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes, sizes = (batch.column(f"{c}_{name}")[row].values.to_numpy() for c in ("nodes", "sizes"))
        vectors = np.frombuffer(batch.column(f"vecs_{name}")[row].as_buffer(), dtype).reshape(len(nodes), -1)
        return nodes, sizes, vectors

    def rows(nodes: np.ndarray, others: np.ndarray | None, links: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(nodes), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), none if others is None else pa.array(others), none if links is None else pa.array(links)], ["node", "other", "links"]
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, size_a, va = read(row, batch, "a")
                b, size_b, vb = read(row, batch, "b")
                hit = linked(va, vb, basis, threshold)
                same = batch.column("a")[row] == batch.column("b")[row]
                if same:
                    np.fill_diagonal(hit, True)  # a vector and its equals
                for nodes, links in ((a, hit @ size_b), (b, size_a @ hit))[: 1 if same else 2]:
                    if links.any():
                        yield rows(nodes[links > 0], None, links[links > 0])
                left, right = np.nonzero(hit)
                if same:
                    chain = forest(a, left, right)
                else:
                    chain = forest(np.concatenate([a, b]), left, right + len(a))
                if len(chain[0]):
                    yield rows(*chain, None)

    return work.mapInArrow(compare, "node long, other long, links long")


def _sure(pairs: DataFrame, tiles: DataFrame) -> DataFrame:
    """The same rows as _compared() for pairs of tiles in which all pairs are linked, from the tiles' sizes alone."""
    sides = pairs.select(F.col("a").alias("tile"), F.col("total_b").alias("links")).unionAll(
        pairs.where("a <> b").select(F.col("b").alias("tile"), F.col("total_a").alias("links"))
    )
    each = sides.groupBy("tile").agg(F.sum("links").alias("links")).join(tiles.select("tile", "nodes"), "tile")
    each = each.select("tile", "links", F.explode("nodes").alias("node"))
    none = F.lit(None).cast("long")
    return each.select("node", none.alias("other"), "links").unionAll(
        each.select("node", F.col("tile").alias("other"), none.alias("links"))
    ).unionAll(pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), none.alias("links")))


def _basis(classes: DataFrame) -> np.ndarray:
    """Principal axes of all unit vectors of the most frequent length, by falling second moment."""
    common = classes.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return np.zeros((0, 0))
    vectors = classes.where(F.size("vec") == common.d).select(F.col("vec").cast("array<double>").alias("vec"))
    return eigenvectors(second_moments(vectors, common.d, units))[1]


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row for each row of ``df``.

    Vectors are linked if their group is equal and not null, their lengths are equal and their cosine in double precision
    reaches ``threshold`` (above 0). Null, empty and zero vectors and such with null, NaN or infinite entries link with nothing.
    ``component_id`` is the smallest id that links lead to, the own one included. Rows that repeat a vector are
    linked like others, each row counts, also if its id repeats; null ids are passed over for ``component_id``,
    which is null where no row of the component has an id; ``kept`` compares so that null equals null.
    An empty table gives no rows. Other columns are not read.
    """
    kind = df.schema[vec_col].dataType.elementType.simpleString()
    dtype = "float32" if kind == "float" else "float64"
    vec = F.col(vec_col).cast("array<float>" if kind == "float" else "array<double>")
    finite = F.forall("vec", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))) & F.exists("vec", lambda c: c != 0)
    rows = df.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), vec.alias("vec"), F.monotonically_increasing_id().alias("row"))
    usable = F.coalesce(F.col("grp").isNotNull() & F.col("vec").isNotNull() & finite, F.lit(False))
    rows = durable(rows.withColumn("usable", usable).withColumn("key", F.when(F.col("usable"), F.xxhash64("vec"))))
    classes = durable(rows.where("usable").groupBy("grp", "key", "vec").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("size"), F.min("id").alias("first")
    ))
    basis = _basis(classes)
    tiles = durable(_tiles(classes, basis, dtype))
    pairs = durable(_pairs(tiles, threshold))
    found = durable(_compared(pairs.where("not sure"), tiles, basis, dtype, threshold).unionAll(_sure(pairs.where("sure"), tiles)))
    links = found.where(F.col("links").isNotNull()).groupBy("node").agg((F.sum("links") - 1).alias("n_links"))
    roots = components(found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = durable(classes.join(links, "node").join(roots, "node", "left").select(
        "grp", "key", "vec", "first", "n_links", F.coalesce("root", "node").alias("root")
    ))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    told = durable(rooted.join(least, "root").select("grp", "key", "vec", "n_links", "least"))
    own = [F.col("n_links"), F.col("least").alias("component_id")]
    out = rows.where("usable").join(told, ["grp", "key", "vec"]).select("id", *own).unionAll(
        rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    )
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
