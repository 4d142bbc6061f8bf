"""Prefix trie of conversations by range minima over sorted longest common prefixes (LCPs).

Conversations become sequences of turn digests and are sorted over the cluster. The members of a prefix then stand side
by side. Every sorted range builds a sparse table of range minima over the LCPs of neighbours; each candidate prefix
binary-searches in it how far it reaches to the left and to the right, on its own and without a stack, and reads its
values off prefix sums over the interval. What reaches over the end of a range is added up by the prefix's digest.

Long conversations are cut into blocks of BLOCK turns. Rows of a block are sorted among those that share everything
before it, so no row, and no task, ever holds a whole long conversation or a whole group of equal ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tunequorum.runtime import durable

#: Turns of one conversation in a row at most.
BLOCK = 256
#: Bytes of a turn's digest.
WIDTH = 16
#: Bytes of keys, and rows, that a sorted range is meant to have.
RANGE_BYTES, RANGE_ROWS = 8 << 20, 2048
#: Ids that are joined into one text at most before they are hashed.
IDS = 1 << 15


def _parts(df: DataFrame, size: Column) -> int:
    """Ranges for a sort: by bytes, or by rows as far as the session's partitions go."""
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    wanted = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total.n / RANGE_ROWS))
    return max(1, wanted, math.ceil((total.bytes or 0) / RANGE_BYTES))


def number_turns(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, place, digest, chars): the turns of each conversation numbered from 0.

    Turns are in the order of ``turn_col``, null first; equal ones in the order of their digests of role and text. Null
    roles and texts are empty. Rows with a null ``conv_col`` belong to no conversation and go. ``digest`` is
    hexadecimal, ``chars`` counts the text's code points. A conversation may spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.sha2(whole, 256), 1, 2 * WIDTH).alias("digest"), F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    turns = durable(turns)
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    dealt = turns.repartitionByRange(_parts(turns, F.lit(64)), *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column("conv").to_numpy()
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            run = np.diff(np.r_[starts, len(conv)])
            at = np.arange(len(conv)) - np.repeat(starts, run)
            if last == conv[0]:
                at[: run[0]] += seen
            last, seen = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("digest"), b.column("chars"), pa.array(np.full(len(conv), part), pa.int64()), pa.array(at, pa.int64())],
                ["conv", "digest", "chars", "part", "at"],
            )

    numbered = durable(dealt.mapInArrow(number, "conv long, digest string, chars long, part long, at long"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = numbered.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = durable(pieces.select("conv", "part", F.sum("n").over(before).alias("offset")).where("offset > 0"))  # a row a task at most
    return numbered.join(offsets, ["conv", "part"], "left").select(
        "conv", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("place"), "digest", "chars"
    )


def node_key(prefix: str, head: bytes = b"") -> bytes:
    """Name of the node that has the digests ``head`` behind the turns that ``prefix`` stands for."""
    return hashlib.blake2b(prefix.encode() + b"|" + head, digest_size=WIDTH).digest()


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys share from their start."""
    n = min(len(a), len(b)) // WIDTH * WIDTH
    if a[:n] == b[:n]:
        return n // WIDTH
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(np.argmax(differ)) // WIDTH


class RangeMinimum:
    """Sparse table: minima over all runs of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (half := 1 << (len(self.levels) - 1)) <= len(values):
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over [low, high], both included."""
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place p with all values in (at, p] no smaller than ``least``."""
        pos, n = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            fits = pos + (1 << k) < n
            go = np.flatnonzero(fits)[self.levels[k][pos[fits] + 1] >= least[fits]]
            pos[go] += 1 << k
        return pos

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place p with all values in (p, at] no smaller than ``least``."""
        pos = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = pos - (1 << k) >= 0
            go = np.flatnonzero(fits)[self.levels[k][pos[fits] - (1 << k) + 1] >= least[fits]]
            pos[go] -= 1 << k
        return pos


class SortedRange:
    """Rows of one sorted range with the LCPs of neighbours, also across its ends."""

    def __init__(self, rows: pa.Table, before: tuple | None, after: tuple | None):
        read = {c: rows.column(c).to_pylist() for c in ("block", "prefix", "key", "last", "conv", "chars")}
        places = sorted(range(rows.num_rows), key=lambda i: (read["block"][i], read["prefix"][i], read["key"][i], not read["last"][i], read["conv"][i]))
        self.order = places
        self.groups = [(read["block"][i], read["prefix"][i]) for i in places]
        self.keys = [read["key"][i] for i in places]
        self.convs = np.array([read["conv"][i] for i in places], np.int64)
        self.sums = [np.concatenate([[0], np.cumsum(read["chars"][i], dtype=np.int64)]) for i in places]
        self.lengths = np.array([len(k) // WIDTH for k in self.keys], np.int64)
        n = len(places)
        inner = [self._lcp(self.groups[i - 1], self.keys[i - 1], i) for i in range(1, n)]
        first = -1 if before is None else self._lcp(before[:2], before[2], 0)
        last = -1 if after is None else self._lcp(after[:2], after[2], n - 1)
        self.lcp = np.array([first, *inner], np.int64)
        self.next = np.array([*inner, last], np.int64)
        self.shared = np.array([self.sums[i][max(0, self.lcp[i])] for i in range(n)], np.int64)

    def _lcp(self, group: tuple, key: bytes, i: int) -> int:
        return common(key, self.keys[i]) if tuple(group) == self.groups[i] else -1


def _sorted_blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(part, block, prefix, following, key, conv, chars, last): blocks of turns in sorted ranges.

    ``prefix`` stands for all blocks before this one, ``following`` for all up to this one if it is full.
    """
    cut = turns.groupBy("conv", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("turns")  # BLOCK at most
    ).select("conv", "block", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.chars").alias("chars"))
    blocks = durable(convs.join(cut, "conv", "left").select(
        "conv", "n", F.coalesce("block", F.lit(0).cast("long")).alias("block"), F.coalesce("key", F.unhex(F.lit(""))).alias("key"),
        F.coalesce("chars", F.array().cast("array<long>")).alias("chars"),
    ).withColumn("last", (F.col("block") + 1) * BLOCK >= F.col("n")))
    sums = [F.xxhash64(F.lit(i), "block", "key").cast("decimal(38,0)") for i in (1, 2)]
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    name = lambda block, values: F.concat_ws(":", block, *values)
    through = [F.sum(s).over(upto) for s in sums]
    long = blocks.where(F.col("n") >= BLOCK).withColumns({"s1": through[0], "s2": through[1]})
    long = long.withColumn("following", F.when(F.length("key") == BLOCK * WIDTH, name(F.col("block") + 1, ["s1", "s2"])))
    long = long.withColumn("prefix", F.when(F.col("block") > 0, name(F.col("block"), [F.col("s1") - sums[0], F.col("s2") - sums[1]])).otherwise(""))
    short = blocks.where(F.col("n") < BLOCK).withColumns({"following": F.lit(None).cast("string"), "prefix": F.lit("")})
    columns = ["block", "prefix", "following", "key", "conv", "chars", "last"]
    every = durable(long.select(columns).unionByName(short.select(columns)))
    order = ["block", "prefix", "key", F.desc("last"), "conv"]  # who ends at a prefix comes before who goes on in another block
    dealt = every.repartitionByRange(_parts(every, F.length("key") * 2 + 64), *order).select(F.spark_partition_id().cast("long").alias("part"), *columns)
    return durable(dealt)


def _with_bounds(rows: DataFrame, ends: DataFrame):
    return rows.groupBy("part").cogroup(ends.groupBy("part"))


def _range_ends(rows: DataFrame) -> DataFrame:
    """(part, before, after): the last row of the range before and the first one of the range after; a row a range."""
    at = F.struct("block", "prefix", "key")
    ends = rows.groupBy("part").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    window = Window.orderBy("part")
    return durable(ends.select("part", F.lag("high").over(window).alias("before"), F.lead("low").over(window).alias("after")))


def _read(rows: pa.Table, ends: pa.Table) -> SortedRange:
    before, after = ((v["block"], v["prefix"], v["key"]) if (v := ends.column(c)[0].as_py()) else None for c in ("before", "after"))
    return SortedRange(rows, before, after)


def _later_blocks(rows: DataFrame) -> DataFrame:
    """(conv, block, later_saved, later_leaf): what the blocks after ``block`` add to every node of that block."""

    def measure(rows: pa.Table, ends: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("conv", pa.int64()), ("block", pa.int64()), ("saved", pa.int64()), ("leaf", pa.bool_()))})
        r = _read(rows, ends)
        last = rows.column("last").to_numpy()[r.order]
        return pa.table({"conv": r.convs, "block": np.array([g[0] for g in r.groups], np.int64), "saved": r.shared, "leaf": last & (r.next < r.lengths)})

    deep = rows.where("block > 0")
    found = durable(_with_bounds(deep, _range_ends(deep)).applyInArrow(measure, "conv long, block long, saved long, leaf boolean"))
    onward = Window.partitionBy("conv").orderBy(F.desc("block"))
    return found.select(
        "conv", (F.col("block") - 1).alias("block"), F.sum("saved").over(onward).alias("later_saved"), F.max("leaf").over(onward).alias("later_leaf")
    )


_PARTIAL = "node binary, parent binary, depth long, n long, first long, leaves long, saved long, part long, seq long, ids string"


def _intervals(rows: pa.Table, ends: pa.Table) -> pa.Table:
    """Partial nodes of one sorted range, and the ids that end at a node (rows with ``ids``)."""
    names = ["node", "parent", "depth", "n", "first", "leaves", "saved", "part", "seq", "ids"]
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    if not rows.num_rows:
        return pa.table({c: pa.array([], t) for c, t in zip(names, types)})
    r = _read(rows, ends)
    n, order = len(r.keys), r.order
    last = rows.column("last").to_numpy()[order]
    following, later = rows.column("following").to_pylist(), rows.column("later_saved").to_numpy()[order]
    later_leaf = rows.column("later_leaf").to_numpy(zero_copy_only=False)[order].astype(bool)
    leaf = np.where(last, r.next < r.lengths, later_leaf)
    inside = r.lcp.copy()
    inside[0] = -1
    least = np.array([0 if g[0] == 0 else 1 for g in r.groups])  # the depth 0 of later blocks is the full depth of the block before
    new_from = np.maximum(inside + 1, least)
    many = np.maximum(r.lengths - new_from + 1, 0)
    row = np.repeat(np.arange(n), many)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + new_from[row]
    lcps, ids = RangeMinimum(inside), RangeMinimum(r.convs)
    low, high = lcps.left(row, depth), lcps.right(row, depth)
    add = lambda values: np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    over = lambda sums, a, b: sums[b + 1] - sums[a]
    shared, laters, leaves = add(r.shared), add(later), add(leaf)
    above = np.array([r.sums[i][max(0, d - 1)] for i, d in zip(low, depth)], np.int64)
    saved = over(laters, low, high) + over(shared, low + 1, high) - (high - low) * above
    saved += np.where((low == 0) & (r.lcp[0] >= depth), r.shared[0] - above, 0)
    nodes, parents = [], []
    for i in np.flatnonzero(many):
        prefix, key, follows = r.groups[i][1], r.keys[i], following[order[i]]
        start = int(new_from[i])
        state = hashlib.blake2b(prefix.encode() + b"|" + key[: max(0, start - 1) * WIDTH], digest_size=WIDTH)
        name = state.copy().digest()
        for d in range(start, int(r.lengths[i]) + 1):
            parents.append(name if d else None)
            if d:
                state.update(key[(d - 1) * WIDTH : d * WIDTH])
                name = node_key(follows) if d == BLOCK else state.copy().digest()
            nodes.append(name)
    blocks = np.array([g[0] for g in r.groups], np.int64)
    none = np.zeros(len(row), np.int64)
    partial = pa.table([
        pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), pa.array(blocks[row] * BLOCK + depth), pa.array(high - low + 1),
        pa.array(ids.least(low, high)), pa.array(over(leaves, low, high)), pa.array(saved), pa.array(none), pa.array(none), pa.nulls(len(row), pa.string()),
    ], names)
    part, texts = rows.column("part")[0].as_py(), []
    run = np.cumsum(np.array([i == 0 or r.groups[i] != r.groups[i - 1] or r.keys[i] != r.keys[i - 1] for i in range(n)]))
    ending = np.flatnonzero(last)
    for members in np.split(ending, np.flatnonzero(np.diff(run[ending])) + 1) if len(ending) else []:
        i = members[0]
        name = node_key(following[order[i]]) if r.lengths[i] == BLOCK else node_key(r.groups[i][1], r.keys[i])
        for at in range(0, len(members), IDS):
            texts.append((name, len(texts), ",".join(map(str, r.convs[members[at : at + IDS]].tolist()))))
    count = len(texts)
    empty = pa.nulls(count, pa.int64())
    ended = pa.table([
        pa.array([t[0] for t in texts], pa.binary()), pa.nulls(count, pa.binary()), *[empty] * 5,
        pa.array(np.full(count, part), pa.int64()), pa.array([t[1] for t in texts], pa.int64()), pa.array([t[2] for t in texts], pa.string()),
    ], names)
    return pa.concat_tables([partial, ended])


def _digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, part, seq, ids); texts of a node are hashed one after the other, never joined."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, found = None, None, []
        for b in batches:
            for node, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if node != current:
                    if state is not None:
                        found.append((current, state.hexdigest()))
                    current, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found])], ["node", "ends_sha256"])
                found = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    dealt = ends.select("node", "part", "seq", "ids").repartition("node").sortWithinPartitions("node", "part", "seq")
    return dealt.mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct prefix (node): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``turns`` is (conv, place, digest, chars) with places from 0 without gaps, ``convs`` (conv, n) names every conversation
    with its number of turns, those without turns too. All are members of the root (depth 0, null parent). ``n_leaves``
    counts the childless nodes at and under a node; ``saved_tokens`` adds up (members - 1) x code points of the last turn
    over the same nodes; ``ends_sha256`` hashes the ids of the members that end at the node, ascending, comma-joined. Turns are
    the same if 128 bits of their digests are. Without any conversation there are no rows.
    """
    rows = _sorted_blocks(turns, convs)
    none = {"later_saved": F.lit(0).cast("long"), "later_leaf": F.lit(False)}
    full = rows.where("last").withColumns(none).unionByName(rows.where("not last").join(_later_blocks(rows), ["conv", "block"]))
    partial = durable(_with_bounds(full, _range_ends(rows)).applyInArrow(_intervals, _PARTIAL))
    nodes = durable(partial.where("ids is null").groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    ))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(children, "node", "left").join(_digests(partial.where("ids is not null")), "node", "left").join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """prefix_trie() of the conversations of a table as number_turns() reads them; other columns are not read."""
    turns = durable(number_turns(df, conv_col, turn_col, role_col, text_col))
    return prefix_trie(turns, turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")))


#: Conversations whose openings others take, and the most turns taken.
SHARE, MOST = 100, 5


def with_shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) for prefix_trie(): each conversation c begins with the first h turns of conversation c - c % SHARE
    (all if it has fewer, none if there is none) in place of its own first h; h = crc32 of c in decimal, modulo MOST + 1.

    At most 2 * SHARE conversations take the opening of one.
    """
    conv = F.col("conv")
    taken = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(MOST + 1))
    base = conv - conv % SHARE
    heads = durable(turns.where((conv % SHARE == 0) & (F.col("place") < MOST)).withColumnRenamed("conv", "base"))
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("given"))
    counts = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumns({"taken": taken, "base": base})
    given = F.least("taken", F.coalesce("given", F.lit(0).cast("long")))
    convs = durable(counts.join(lengths, "base", "left").select(
        "conv", "base", "taken", given.alias("given"), (given + F.greatest(F.col("own") - F.col("taken"), F.lit(0))).alias("n")
    ))
    opening = convs.join(heads, "base").where("place < given").select("conv", "place", "digest", "chars")
    rest = turns.withColumn("taken", taken).where("place >= taken").withColumn("base", base).join(lengths, "base", "left").select(
        "conv", (given + F.col("place") - F.col("taken")).alias("place"), "digest", "chars"
    )
    return opening.unionByName(rest), convs.select("conv", "n")
