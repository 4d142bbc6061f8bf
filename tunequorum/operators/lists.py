"""Ranked lists of users: whole ones as rank arrays, and exact top lists by norm-bounded pruning.

Items are packed into blocks once and stored. A task holds a few blocks of users and reads the blocks of items one after
another, so neither side is copied for the other. For whole lists every user's scores leave the task as one packed array
for each item block; they are shuffled once, by user, and ranked there with one stable sort. For top lists the blocks
stand in the order of falling norm: the first ones give each user a score to beat, and by Cauchy and Schwarz a later
block cannot beat it if the product of the norms is smaller.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tunequorum.runtime import delete_scratch, durable, scratch_mark, scratch_since, small_batches

#: Items in a block, and users in a block, at most.
ITEMS, USERS = 4096, 4096
#: Items in a block of the norm order at most.
NORM_ITEMS = 4096
#: Blocks in a file of a stored table at most.
FILE_BLOCKS = 4
#: Rows for which a partition of its own is worth while.
FEW = 64
#: Scores that are in work at once.
CHUNK = 1 << 19
#: Scores are whole numbers of this part; a rounded score exceeds its bound by less than that.
DIGITS = 1e6
#: The part by which rounding to single precision may change a number. Longer vectors are multiplied in one way only, since the last
#: bits of large products in double precision, which depend on the order of summation, come near the 6 digits.
SINGLE, LONGEST = 2.0**-24, 1e3
#: So many products of a row are multiplied again one by one; of more the whole row is.
AGAIN = 64


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tasks_of(df: DataFrame) -> int:
    return 3 * max(2, df.sparkSession.sparkContext.defaultParallelism)


def parts_for(df: DataFrame, n: int) -> int:
    """Partitions for ``n`` rows that tasks hold: at most USERS rows in one, and enough for all cores if there are rows enough."""
    return max(1, min(math.ceil(n / FEW), tasks_of(df)), math.ceil(n / USERS))


def beside(blocks: DataFrame, packed: DataFrame, parts: int) -> DataFrame:
    """Every row of the stored table ``blocks`` next to every row of ``packed``, which has ``parts`` partitions.

    A task holds a partition of ``packed`` and reads the blocks one after another, each next to all the rows it holds. Nothing
    is shuffled for it. Only if there are too few partitions for the cores the blocks are split over several tasks.
    """
    cells = max(1, math.ceil(tasks_of(blocks) / parts))
    return blocks.coalesce(cells).hint("shuffle_replicate_nl").crossJoin(packed)


def slices(n: int, width: int) -> list[slice]:
    """``n`` rows of ``width`` scores each in pieces of about CHUNK scores."""
    step = max(1, CHUNK // max(1, width))
    return [slice(at, at + step) for at in range(0, n, step)]


def _matrix(data: pa.Array, row: int, n: int) -> np.ndarray:
    return np.frombuffer(data[row].as_buffer(), "<f8").reshape(n, -1)


def single(vectors: np.ndarray, longest: float) -> np.ndarray | None:
    """The vectors in single precision, or nothing if it doesn't hold their products."""
    return vectors.astype("<f4") if longest <= LONGEST else None


def slack(norms: np.ndarray, norm: float, width: int) -> np.ndarray:
    """How far products in single precision of vectors of these norms with ones of at most ``norm`` can be from those in double precision."""
    return 1.01 * norms * norm * (width + 8) * SINGLE + 1e-18


def below(bar: np.ndarray) -> np.ndarray:
    """Numbers in single precision that are less than ``bar``."""
    return np.nextafter(bar.astype("<f4"), np.float32(-np.inf))


def products(left: np.ndarray, right: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """The products of single rows of both sides in double precision."""
    found = np.empty(len(rows))
    for at in range(0, len(rows), 1 << 13):
        part = slice(at, at + (1 << 13))
        found[part] = np.einsum("ij,ij->i", left[rows[part]], right[cols[part]])
    return found


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """(part, seq, n, ids, data, norm[, cuts][, limit]) of sorted partitions of (id, vec[, cuts][, limit]): runs of at most ``size`` rows."""
    carried = [c for c in rows.columns if c in ("cuts", "limit")]
    small_batches(rows.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def run(rows: pa.Table) -> pa.RecordBatch:
            whole = rows.combine_chunks().to_batches()[0]
            vectors = np.ascontiguousarray(whole.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(whole.num_rows, -1), "<f8")
            ids = pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole.column("id"))
            norm = float(np.sqrt((vectors * vectors).sum(axis=1)).max())
            lists = [pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole.column(c)) for c in carried]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([whole.num_rows], pa.int64()), ids, pa.array([vectors.tobytes()], pa.binary()), pa.array([norm]), *lists],
                ["part", "seq", "n", "ids", "data", "norm", *carried],
            )

        count = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, size - count)
                held.append(piece)
                at, count = at + piece.num_rows, count + piece.num_rows
                if count == size:
                    yield run(pa.Table.from_batches(held))
                    seq, held, count = seq + 1, [], 0
        if count:
            yield run(pa.Table.from_batches(held))

    schema = f"part long, seq long, n long, ids array<{_type(rows, 'id')}>, data binary, norm double"
    return rows.select("id", "vec", *carried).mapInArrow(pack, ", ".join([schema, *[f"{c} array<{_type(rows, c)}>" for c in carried]]))


def _vectors(df: DataFrame, id_col: str, *others: str) -> DataFrame:
    usable = df.where(F.col(id_col).isNotNull() & F.col("vec").isNotNull())
    return usable.select(F.col(id_col).alias("id"), F.col("vec").cast("array<double>").alias("vec"), *others)


def number() -> Column:
    return F.col("part") * F.lit(1 << 32) + F.col("seq")


def item_blocks(items: DataFrame) -> DataFrame:
    """The catalogue (track_id, vec) in id order as a stored table of blocks: (block, start, n, ids, data).

    ``start`` counts the tracks before the block. Prepare it once for any number of rankings. Where blocks end matters to the
    mean ranks of a user who comes in several copies (``rank_sums.exact_ranks``).
    """
    rows = _vectors(items, "track_id").repartitionByRange(partitions_of(items), "id").sortWithinPartitions("id")
    spark, mark = items.sparkSession, scratch_mark()
    packed = durable(_packed(rows, ITEMS).drop("norm"), rows_per_file=FILE_BLOCKS)
    unnumbered = scratch_since(mark)
    order = Window.orderBy("part", "seq")  # a row a block, without the vectors
    starts = packed.select("part", "seq", (F.row_number().over(order) - 1).cast("long").alias("block"), (F.sum("n").over(order) - F.col("n")).alias("start"))
    blocks = durable(packed.join(F.broadcast(starts), ["part", "seq"]).select("block", "start", "n", "ids", "data"), rows_per_file=FILE_BLOCKS)
    delete_scratch(spark, unnumbered)
    return blocks


def block_ids(blocks: DataFrame) -> DataFrame:
    """(at, track_id): the place of every track in id order."""
    return blocks.select("start", F.posexplode("ids").alias("slot", "track_id")).select((F.col("start") + F.col("slot")).alias("at"), "track_id")


def user_blocks(users: DataFrame, *others: str) -> tuple[DataFrame, int]:
    """(no, users, user_data[, cuts][, limit]): blocks of users with a number of their own in a task, and how many partitions they fill."""
    rows = _vectors(users, "user_id", *others)
    parts = parts_for(users, rows.count())
    packed = _packed(rows.repartition(parts, "id"), USERS)
    return packed.select(number().alias("no"), F.col("ids").alias("users"), F.col("data").alias("user_data"), *others), parts


def _score_arrays(users: DataFrame, blocks: DataFrame) -> DataFrame:
    """(user_id, block, scores): the scores of a block's tracks as packed whole numbers, 4 bytes each if they fit."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("users")[row].values
                left = _matrix(batch.column("user_data"), row, len(ids))
                right = _matrix(batch.column("item_data"), row, batch.column("n")[row].as_py())
                for part in slices(len(ids), len(right)):
                    scores = np.rint(left[part] @ right.T * DIGITS)
                    scores = scores.astype("<i4" if np.abs(scores).max(initial=0) < 2**31 else "<i8")
                    yield pa.RecordBatch.from_arrays(
                        [ids[part], pa.array(np.full(len(scores), batch.column("block")[row].as_py())), pa.array([s.tobytes() for s in scores], pa.binary())], ["user_id", "block", "scores"]
                    )

    met = beside(blocks.select("block", "n", F.col("data").alias("item_data")), *user_blocks(users)).select("users", "user_data", "block", "n", "item_data")
    return met.mapInArrow(kernel, f"user_id {_type(users, 'user_id')}, block long, scores binary")


def rank_arrays(users: DataFrame, blocks: DataFrame, with_scores: bool = False) -> DataFrame:
    """(user_id, block, start, ranks[, scores]): 0-based ranks of the tracks of every block in each user's whole list.

    Lists go by score (rounded to 6 digits) descending, ties by track id. ``blocks`` comes from item_blocks(). A
    task holds the scores of one user at a time, 4 bytes a track.
    """
    sizes = blocks.select("block", "n")
    scores = _score_arrays(users, blocks).join(sizes, "block")
    dealt = scores.repartition(partitions_of(users), "user_id").sortWithinPartitions("user_id", "block").select("user_id", "block", "n", "scores")

    users_type = to_arrow_type(users.schema["user_id"].dataType)

    def rank_one(user, parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        whole = np.concatenate([np.frombuffer(s, f"<i{len(s) // n}") for _, n, s in parts])
        order = np.argsort(-whole.astype(np.int64), kind="stable")
        ranks = np.empty(len(order), np.int32)
        ranks[order] = np.arange(len(order), dtype=np.int32)
        edges = np.cumsum([0] + [n for _, n, _ in parts])
        lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(v)) for v in ((ranks, whole / DIGITS) if with_scores else (ranks,))]
        return pa.RecordBatch.from_arrays(
            [pa.array([user] * len(parts), users_type), pa.array([p[0] for p in parts], pa.int64()), pa.array(edges[:-1], pa.int64()), *lists],
            ["user_id", "block", "start", "ranks", "scores"][: 3 + len(lists)],
        )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            ids, of, sizes = (batch.column(c).to_pylist() for c in ("user_id", "block", "n"))
            data = batch.column("scores")
            for row, user in enumerate(ids):
                if parts and user != current:
                    yield rank_one(current, parts)
                    parts = []
                current = user
                parts.append((of[row], sizes[row], data[row].as_py()))
        if parts:
            yield rank_one(current, parts)

    schema = f"user_id {_type(users, 'user_id')}, block long, start long, ranks array<int>"
    return dealt.mapInArrow(rank, schema + (", scores array<double>" if with_scores else ""))


def full_lists(users: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, track_id, score, rank) of all tracks for all users: the output itself has users x tracks rows."""
    blocks = item_blocks(items)
    arrays = rank_arrays(users, blocks, with_scores=True).join(blocks.select("block", "ids"), "block")
    cells = F.explode(F.arrays_zip("ids", "scores", "ranks")).alias("cell")
    return arrays.select("user_id", cells).select(
        "user_id", F.col("cell.ids").alias("track_id"), F.col("cell.scores").alias("score"), F.col("cell.ranks").cast("bigint").alias("rank")
    )


# --- top lists --------------------------------------------------------------------------------------

def _norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))


class BestSoFar:
    """The best ``k[row]`` tracks of each user of a block, over the blocks of items shown so far."""

    def __init__(self, vectors: np.ndarray, k: np.ndarray):
        self.vectors, self.k = vectors, k
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.small = single(vectors, self.norms.max(initial=0))
        self.floor = np.full(len(k), -np.inf)  # a user's k-th score, once there are as many, as a whole number
        self.last = None  # and its track
        self.rows, self.ids, self.whole = np.zeros(0, np.int64), None, np.zeros(0)

    @property
    def scores(self) -> np.ndarray:
        return self.whole / DIGITS

    def show(self, ids: np.ndarray, vectors: np.ndarray, norm: float, hidden: np.ndarray) -> bool:
        """Whether the block of items, none longer than ``norm``, had to be multiplied. ``hidden`` are places (row * items +
        item) that do not count."""
        if self.ids is None:
            self.ids, self.last = ids[:0], np.full(len(self.k), "", object) if ids.dtype == object else np.zeros(len(self.k), ids.dtype)
        alive = np.flatnonzero(self.norms * norm + 2 / DIGITS >= self.floor / DIGITS)
        if not len(alive):
            return False
        small = None if self.small is None else single(vectors, norm)
        if small is None:
            found = [self._beyond(alive[part], ids, vectors, hidden) for part in slices(len(alive), len(ids))]
        else:
            by_id = np.argsort(ids, kind="stable")
            found = [self._screened(alive[part], ids, vectors, small, norm, hidden, by_id) for part in slices(len(alive), len(ids))]
        rows, whole, named = (np.concatenate(column) for column in zip(*found))
        if not len(rows):
            return True
        touched = np.zeros(len(self.k), bool)
        touched[rows] = True
        mine = touched[self.rows]
        rows, whole, named = np.r_[self.rows[mine], rows], np.r_[self.whole[mine], whole], np.r_[self.ids[mine], named]
        order = np.lexsort((np.unique(named, return_inverse=True)[1] if named.dtype == object else named, -whole, rows))
        rows, whole, named = rows[order], whole[order], named[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k[rows]
        full = place == self.k[rows] - 1
        self.floor[rows[full]], self.last[rows[full]] = whole[full], named[full]
        self.rows, self.whole, self.ids = np.r_[self.rows[~mine], rows[keep]], np.r_[self.whole[~mine], whole[keep]], np.r_[self.ids[~mine], named[keep]]
        return True

    def _hide(self, scores: np.ndarray, alive: np.ndarray, hidden: np.ndarray) -> None:
        if len(hidden):
            place = np.full(len(self.k), -1)
            place[alive] = np.arange(len(alive))
            at, item = place[hidden // scores.shape[1]], hidden % scores.shape[1]
            scores[at[at >= 0], item[at >= 0]] = -np.inf

    def _bars(self, scores: np.ndarray, alive: np.ndarray, less: np.ndarray | float = 0.0) -> np.ndarray:
        """Unrounded scores that a user's item must reach; those of ``scores`` are too great by ``less`` at most."""
        bar = self.floor[alive] / DIGITS
        new = np.flatnonzero(bar == -np.inf)  # only users without a floor need the best of the block sought
        if len(new):
            most = np.minimum(self.k[alive[new]], scores.shape[1])
            top = -np.partition(-scores[new], np.unique(most - 1), axis=1)
            bar[new] = top[np.arange(len(most)), most - 1]
            bar[new] -= less[new] if isinstance(less, np.ndarray) else less
        return np.where(np.isfinite(bar), bar - 2 / DIGITS - np.abs(bar) * 1e-12, bar)  # what rounds up to it counts too

    def _winners(self, rows: np.ndarray, whole: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # ties go to the smaller id, so a tie with the floor must have a smaller one than its track
        wins = (whole > self.floor[rows]) | ((whole == self.floor[rows]) & (whole > -np.inf) & (named < self.last[rows]))
        return rows[wins], whole[wins], named[wins]

    def _beyond(self, alive: np.ndarray, ids: np.ndarray, vectors: np.ndarray, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, score, id) of the items that beat the k-th score of a user of ``alive``; scores are rounded for those only."""
        scores = self.vectors[alive] @ vectors.T
        self._hide(scores, alive, hidden)
        at = np.flatnonzero((scores >= self._bars(scores, alive)[:, None]).ravel())
        rows, cols = np.divmod(at, len(ids))
        return self._winners(alive[rows], np.rint(scores.ravel()[at] * DIGITS), ids[cols])

    def _screened(
        self, alive: np.ndarray, ids: np.ndarray, vectors: np.ndarray, small: np.ndarray, norm: float, hidden: np.ndarray, by_id: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``_beyond`` gives, at most a list's length of it: products in single precision show which ones can beat a
        score, and those are multiplied again in double precision."""
        scores = self.small[alive] @ small.T
        self._hide(scores, alive, hidden)
        less = slack(self.norms[alive], norm, vectors.shape[1])
        at = np.flatnonzero((scores >= below(self._bars(scores, alive, less) - less)[:, None]).ravel())
        rows, cols = np.divmod(at, len(ids))
        many = np.bincount(rows, minlength=len(alive)) > AGAIN
        few = ~many[rows] & (scores.ravel()[at] > -np.inf)
        rows, cols = rows[few], cols[few]
        found = [(alive[rows], np.rint(products(self.vectors, vectors, alive[rows], cols) * DIGITS), cols)]
        again = np.flatnonzero(many)
        if len(again):
            mine = alive[again]
            whole = self.vectors[mine] @ vectors.T
            self._hide(whole, mine, hidden)
            whole = np.rint(whole * DIGITS)[:, by_id]
            most = np.minimum(self.k[mine], len(ids))
            last = -np.partition(-whole, np.unique(most - 1), axis=1)[np.arange(len(mine)), most - 1][:, None]
            last = np.maximum(last, self.floor[mine][:, None])
            more, same = whole > last, whole == last
            rows, places = np.nonzero(more | (same & (np.cumsum(same, axis=1) <= most[:, None])))
            found.append((mine[rows], whole[rows, places], by_id[places]))
        rows, whole, cols = (np.concatenate(column) for column in zip(*found))
        return self._winners(rows, whole, ids[cols])


def top_lists(users: DataFrame, items: DataFrame, k: int | str, exclude: DataFrame | None = None) -> DataFrame:
    """(user_id, track_id, score, rank): the exact best ``k`` unexcluded tracks of every user, ranks from 0, by score (6
    digits) descending, ties to the smaller id.

    ``k`` is a number or a column of ``users`` with one for each user; ``exclude`` is (user_id, track_id): a user's list is
    made longer by the tracks to leave out, which then go. A task holds its users' best so far, sees the blocks of items in the
    order of falling norm and no longer multiplies once norms are too small for any k-th score.
    """
    user_type, track_type = _type(users, "user_id"), _type(items, "track_id")
    wanted = F.lit(k) if isinstance(k, int) else F.col(k)
    users = users.where(F.col("vec").isNotNull() & F.col("user_id").isNotNull() & (wanted > 0)).select("user_id", "vec", wanted.cast("long").alias("k"))
    wish, wishing = F.col("k"), users
    if exclude is not None:
        left_out = exclude.select("user_id", "track_id").where("user_id is not null and track_id is not null").distinct()
        lost = left_out.join(items.select("track_id"), "track_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("lost"))
        wish, wishing = F.col("k") + F.coalesce("lost", F.lit(0)), users.join(lost, "user_id", "left")
    ordered = _vectors(items, "track_id").withColumn("norm", _norm(F.col("vec")))
    ordered = ordered.repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
    item_side = durable(_packed(ordered, NORM_ITEMS).select(F.col("ids").alias("tracks"), F.col("data").alias("item_data"), "norm"), rows_per_file=FILE_BLOCKS)
    # a user's wish travels as the first number of the vector
    with_wish = wishing.select("user_id", F.concat(F.array(wish.cast("double")), F.col("vec").cast("array<double>")).alias("vec"))
    work = beside(item_side, *user_blocks(with_wish)).select("no", "users", "user_data", "tracks", "item_data", "norm")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[pa.Array, BestSoFar]] = {}
        kind, nothing = None, np.zeros(0, np.int64)
        for batch in batches:
            for row, no in enumerate(batch.column("no").to_pylist()):
                if no not in held:
                    ids = batch.column("users")[row].values
                    wishes = _matrix(batch.column("user_data"), row, len(ids)).copy()
                    held[no] = pa.array(ids.to_pylist(), ids.type), BestSoFar(wishes[:, 1:], wishes[:, 0].astype(np.int64))
                tracks = batch.column("tracks")[row].values
                kind = tracks.type
                names = np.array(tracks.to_pylist(), dtype=object) if pa.types.is_string(kind) else tracks.to_numpy()
                held[no][1].show(names, _matrix(batch.column("item_data"), row, len(tracks)), batch.column("norm")[row].as_py(), nothing)
        for ids, best in held.values():
            for at in range(0, len(best.rows), CHUNK):
                part = slice(at, at + CHUNK)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(best.rows[part])), pa.array(best.ids[part].tolist(), kind), pa.array(best.scores[part])], ["user_id", "track_id", "score"])

    found = work.mapInArrow(kernel, f"user_id {user_type}, track_id {track_type}, score double")
    if exclude is not None:
        found = found.hint("merge").join(left_out, ["user_id", "track_id"], "left_anti")
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), "track_id")
    placed = found.withColumn("position", F.row_number().over(order))
    if isinstance(k, int):  # a literal bound lets tasks drop rows before the shuffle
        placed = placed.where(F.col("position") <= k)
    else:
        placed = placed.join(users.select("user_id", "k"), "user_id").where("position <= k")
    return placed.select("user_id", "track_id", "score", (F.col("position") - 1).cast("bigint").alias("rank"))
