"""What keeps queries within memory and disk: no broadcast of exploded rows, no score of a user and a track in a shuffle."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunequorum import runtime as rt
from tunequorum.operators import evaluation as ev
from tunequorum.operators import lists as ls
from tunequorum.operators import outcomes as oc
from tunequorum.operators import rank_sums as rs
from tunequorum.operators import ranking as rk
from tunequorum.operators import sampling as sp
from tunequorum.operators import scoring as sc


def vectors(spark, name, values):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], f"{name} bigint, vec array<double>")


def exploded_and_broadcast(df):
    """Whether a broadcast of the planned query holds rows of an explode."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            for below in plan[at + 1 :]:
                start = len(below) - len(below.lstrip(" :+-"))
                if start <= depth:
                    break
                if "Generate explode" in below:
                    return True
    return False


@pytest.mark.parametrize("n", [3, 20])
def test_random_tracks_are_not_broadcast(spark, n):
    tracks = spark.range(1000).withColumn("pad", F.lit("x" * 100))
    drawn = sp.random_tracks(tracks, spark.range(50).withColumnRenamed("id", "request_id"), "request_id", F.lit(n), 7)
    assert not exploded_and_broadcast(drawn)
    assert drawn.count() == 50 * n


def test_history_samples_are_not_broadcast(spark):
    history = spark.range(300).select((F.col("id") % 10).alias("user_id"), "id", F.floor(F.col("id") / 10).alias("position_in_history")).withColumnRenamed("id", "track_id")
    groups = spark.range(40).select(F.col("id").alias("request_id"), F.lit(5).alias("playlist_length"))
    members = spark.range(80).select((F.col("id") % 40).alias("request_id"), (F.col("id") % 10).alias("user_id")).distinct()
    assert not exploded_and_broadcast(sp.sample_group_history(history, groups, members, 7))
    assert not exploded_and_broadcast(sp.sample_user_history(history, spark.range(10).withColumnRenamed("id", "user_id"), 5, 7))


def test_common_tracks_are_not_broadcast_and_count_repeats(spark):
    lists = spark.createDataFrame([(u, t) for u, ts in ((1, (1, 2, 3)), (2, (2, 3, 4)), (3, (3, 9))) for t in ts], "user_id bigint, track_id bigint")
    members = spark.createDataFrame([(10, 1), (10, 2), (11, 1), (11, 2), (12, 3), (13, 1), (13, 3), (13, 3), (14, 1), (14, 8), (None, 1)], "request_id bigint, user_id bigint")
    found = rk.common_tracks(members, lists)
    assert not exploded_and_broadcast(found)
    assert sorted(map(tuple, found.collect())) == [(10, 2), (10, 3), (11, 2), (11, 3), (12, 3), (12, 9), (13, 3)]


def planned(spark, groups):
    rows = [(g, u, 1.0, n) for g, (users, n) in groups.items() for u in users]
    return spark.createDataFrame(rows, "request_id bigint, user_id bigint, share double, n_wanted bigint")


@pytest.mark.parametrize("kind", ["spread", "tied", "huge"])
def test_least_rank_sums_keep_few_tracks_and_are_exact(spark, monkeypatch, kind):
    """Whole lists would be 20 x 3000 ranks; only tracks near the best ones reach the last step."""
    monkeypatch.setattr(ls, "ITEMS", 256)
    rng = np.random.default_rng(4)
    u, i = rng.normal(size=(20, 8)), rng.normal(size=(3000, 8))
    if kind == "tied":
        i = i[np.arange(3000) % 12]
    if kind == "huge":
        u = u * 1e7
    groups = {g: (sorted(rng.choice(20, size=rng.integers(1, 4), replace=False).tolist()), 5) for g in range(15)}
    blocks = ls.item_blocks(vectors(spark, "track_id", i))
    found = rs.least_rank_sums(planned(spark, groups), vectors(spark, "user_id", u), blocks, "request_id").collect()
    assert len(found) < 3000
    scores = np.rint(u @ i.T * 1e6)
    ranks = np.argsort(np.argsort(-scores, axis=1, kind="stable"), axis=1, kind="stable")
    for g, (members, n) in groups.items():
        sums = ranks[members].sum(axis=0)
        best = np.lexsort((np.arange(3000), sums))[:n]
        mine = sorted((r.rank_sum, r["at"]) for r in found if r.request_id == g)[:n]
        assert mine == [(float(sums[t]), t) for t in best]


def test_group_playlists_move_no_score_arrays(spark, monkeypatch):
    def never(*_):
        raise AssertionError("scores of whole lists were shuffled")

    monkeypatch.setattr(ls, "_score_arrays", never)
    rng = np.random.default_rng(5)
    users, items = vectors(spark, "user_id", rng.normal(size=(4, 3))), vectors(spark, "track_id", rng.normal(size=(30, 3)))
    groups = spark.createDataFrame([(1, 3)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(1, 0), (1, 2)], "request_id bigint, user_id bigint")
    assert rk.group_playlists(groups, members, users, items).count() == 3


def test_top_lists_drop_later_ties_of_the_floor():
    best = ls.BestSoFar(np.array([[1.0, 0.0]]), np.array([2]))
    for start in (10, 0, 20):
        best.show(np.arange(start, start + 5), np.array([[1.0, 0.0]] * 5), 1.0, np.zeros(0, np.int64))
    assert sorted(best.ids.tolist()) == [0, 1] and best.scores.tolist() == [1.0, 1.0]


def test_few_and_many_cuts_count_alike():
    scores = np.round(np.random.default_rng(6).normal(size=(3, 200)), 1)
    cuts = [[0.1], sorted(set(scores[1]))[:20], [-0.3, 0.5, 0.5]]
    edges = np.concatenate([[0], np.cumsum([len(c) for c in cuts])])
    got = sc._at_least(scores, np.concatenate(cuts), edges)
    assert got.tolist() == [int((scores[r] >= c).sum()) for r, row in enumerate(cuts) for c in row]


def test_neither_side_is_shuffled_for_each_cell_of_the_other(spark):
    """The exchanges of a scoring query hold every user and every item once, whatever the number of tasks."""
    users, items = (vectors(spark, name, np.random.default_rng(7).normal(size=(n, 4))) for name, n in (("user_id", 200), ("track_id", 300)))
    asked = users.withColumn("cuts", F.array(F.lit(0.5)))
    for df in (sc.score_pairs(users, items), sc.count_at_least(asked, items), sc.score_ends(users, items), ls.top_lists(users, items, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "SortMergeJoin" not in plan and "Generate explode" not in plan


def test_counts_compare_unrounded_scores_as_if_rounded(spark):
    rng = np.random.default_rng(8)
    raw = np.r_[rng.normal(size=2000), np.arange(-50, 50) / 1e6 + 5e-7, np.arange(-50, 50) * 1e6 + 0.1234565]
    rounded = np.rint(raw * 1e6) / 1e6
    for cut in np.r_[rounded[:20], rounded[-210:]]:
        least = sc._least(np.array([cut]))[0]
        assert ((raw >= least) == (rounded >= cut)).all()


def test_top_lists_leave_out_more_than_a_list_is_long(spark):
    values = np.random.default_rng(9).normal(size=(150, 4))
    users, items = vectors(spark, "user_id", values[:2]), vectors(spark, "track_id", values)
    order = np.lexsort((np.arange(150), -np.round(values[0] @ values.T, 6)))
    gone = [(0, int(t)) for t in order[:140]] + [(0, None), (None, 3)]
    exclude = spark.createDataFrame(gone, "user_id bigint, track_id bigint")
    got = ls.top_lists(users, items, 20, exclude).where("user_id = 0").orderBy("rank").collect()
    assert [r.track_id for r in got] == order[140:].tolist()


def test_draws_of_small_groups_are_not_put_into_one_task(spark):
    """Adaptive execution sees groups before they are drawn for and would merge partitions that hold few bytes."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = spark.range(2000).select(F.col("id").alias("request_id"), F.lit(20).alias("playlist_length"))
    sizes = spark.range(2000).select(F.col("id").alias("request_id"), F.lit(50).cast("long").alias("n_pool")).hint("merge")
    per_task = sp._draw_from_pool(groups, sizes, "request_id", "playlist_length", 7).groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == n and sum(r["count"] for r in per_task) == 40000


def test_spread_sends_a_vector_once_to_a_part_and_not_to_every_entry(spark):
    rng = np.random.default_rng(10)
    values = rng.normal(size=(30, 4))
    lists = [(k, int(t)) for k in range(300) for t in rng.integers(0, 34, size=rng.integers(1, 9))] + [(300, 33), (None, 1), (301, None)]
    playlists = spark.createDataFrame(lists, "request_id bigint, track_id bigint")
    got = ev.playlist_spread(playlists, vectors(spark, "track_id", values), ["request_id"])
    want = {}
    for k in range(300):
        mine = values[[t for r, t in lists if r == k and t < 30]]
        if len(mine):
            want[k] = (np.sqrt(((mine - mine.mean(axis=0)) ** 2).sum(axis=1)).mean(), len(mine))
    found = {r.request_id: (r.spread, r.n_tracks) for r in got.collect()}
    assert found.keys() == want.keys()
    assert all(found[k][1] == want[k][1] and abs(found[k][0] - want[k][0]) < 1e-9 for k in want)
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    # what meets the vectors are distinct tracks of a part
    join = next(at for at, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate(keys=[_part" in line for line in lines[join:])


def test_spread_takes_tracks_that_come_twice_and_several_keys(spark):
    items = spark.createDataFrame([(1, [0.0]), (1, [4.0]), (2, [2.0])], "track_id bigint, vec array<double>")
    playlists = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 2), ("b", 1, 2)], "name string, length int, track_id bigint")
    got = sorted(map(tuple, ev.playlist_spread(playlists, items, ["name", "length"]).collect()))
    assert got == [("a", 1, pytest.approx(4 / 3), 3), ("b", 1, 0.0, 2)]


def test_no_rows_for_sessions_that_never_came(spark):
    sessions = spark.createDataFrame([(1, 100 + d, f"2024-01-0{d} 00:00:00") for d in (1, 2, 3)], "user_id bigint, session_id bigint, at string").selectExpr("user_id", "session_id", "cast(at as timestamp_ntz) as timestamp")
    runs = spark.createDataFrame([(7, "2024-01-01 12:00:00"), (8, "2024-01-09 00:00:00")], "request_id bigint, at string").selectExpr("request_id", "cast(at as timestamp_ntz) as timestamp")
    members = spark.createDataFrame([(7, 1), (8, 1), (7, 2)], "request_id bigint, user_id bigint")
    got = oc.next_sessions(runs, members, sessions, 20)
    assert sorted(map(tuple, got.collect())) == [(7, 1, 102), (7, 1, 103)]
    assert "_all" in got._jdf.queryExecution().optimizedPlan().toString()


def screened_and_not(users, items, ids, k, hidden=None):
    """The best lists found with products in single precision first, and in double precision only."""
    norms, found = np.sqrt((items * items).sum(axis=1)), []
    for double in (False, True):
        best = ls.BestSoFar(users, np.full(len(users), k))
        best.small = None if double else best.small
        for at in np.split(np.argsort(-norms, kind="stable"), 6):
            best.show(ids[at], items[at], norms[at].max(), np.zeros(0, np.int64))
        found.append(sorted(zip(best.rows.tolist(), best.whole.tolist(), best.ids.tolist())))
    return found


@pytest.mark.parametrize("kind", ["plain", "close", "copies", "large", "named"])
def test_screened_lists_are_exact(kind):
    rng = np.random.default_rng(11)
    users, items, ids = rng.normal(size=(40, 8)), rng.normal(size=(1200, 8)), rng.permutation(1200)
    if kind == "close":  # scores differ by less than single precision can tell
        items = items[:1] + rng.normal(size=(1200, 8)) * 3e-6
    if kind == "copies":  # more ties in a block than are multiplied one by one
        items = items[np.arange(1200) % 5]
    if kind == "large":
        users, items = users * 1e5, items * 1e4
    if kind == "named":
        ids = np.array([f"t{i}" for i in ids], dtype=object)
    screened, plain = screened_and_not(users, items, ids, 7)
    assert screened == plain and len(plain) == 280


def test_blocks_are_screened_in_single_precision(monkeypatch):
    """Only products that may beat a score are made in double precision."""
    made, products = [], ls.products
    monkeypatch.setattr(ls, "products", lambda *a: made.append(len(a[2])) or products(*a))
    rng = np.random.default_rng(12)
    best = ls.BestSoFar(rng.normal(size=(20, 8)), np.full(20, 5))
    for start in range(0, 5000, 500):
        best.show(np.arange(start, start + 500), rng.normal(size=(500, 8)), 10.0, np.zeros(0, np.int64))
    assert 0 < sum(made) < 20 * 5000 / 20


@pytest.mark.parametrize("kind", ["plain", "close", "copies", "large"])
def test_counts_in_single_precision_are_exact(kind):
    rng = np.random.default_rng(13)
    left, right = rng.normal(size=(30, 8)), rng.normal(size=(900, 8))
    if kind == "close":
        right = right[:1] + rng.normal(size=(900, 8)) * 3e-6
    if kind == "copies":
        right = right[np.arange(900) % 4]
    if kind == "large":
        left, right = left * 100, right * 100
    lengths = np.array([0, 1, 2, 3, 9, 20] * 5)
    edges = np.r_[0, np.cumsum(lengths)]
    rows = np.repeat(np.arange(30), lengths)
    cuts = np.rint((left[rows] * right[rng.integers(0, 900, len(rows))]).sum(axis=1) * 1e6) / 1e6
    least, norms = sc._least(cuts), np.sqrt((left * left).sum(axis=1))
    norm = np.sqrt((right * right).sum(axis=1).max())
    got = sc._count_products(left, right, ls.single(left, norms.max()), ls.single(right, norm), ls.slack(norms, norm, 8), least, edges)
    scores = left @ right.T
    assert got.tolist() == [int((scores[r] >= c).sum()) for r, c in zip(rows, least)]


def test_users_whose_cuts_are_settled_are_not_multiplied(monkeypatch):
    rng = np.random.default_rng(31)
    left, blocks = rng.normal(size=(50, 6)), [rng.normal(size=(200, 6)) for _ in range(5)]
    lengths = rng.integers(0, 4, 50)
    cuts = np.round(rng.normal(size=lengths.sum()) * 4, 6)
    exact, limited = (
        sc._Counts(list(range(50)), pa.int64(), left, cuts, lengths, limits) for limits in (None, np.full(50, 20))
    )
    rows = []
    count = sc._count_products
    monkeypatch.setattr(sc, "_count_products", lambda left, *others: rows.append(len(left)) or count(left, *others))
    for block in blocks:
        exact.show(left, block)
    assert rows == [50] * 5
    rows.clear()
    for block in blocks:
        limited.show(left, block)
    assert rows[0] == 50 and sum(rows) < 200
    scores = np.round(left @ np.concatenate(blocks).T, 6)
    n = [(scores[u] >= c).sum() for u, c in zip(np.repeat(np.arange(50), lengths), cuts)]
    assert exact.result()["n"].to_pylist() == n
    assert np.minimum(limited.counts, 20).tolist() == np.minimum(n, 20).tolist()


@pytest.mark.parametrize("k", [1, 10])
def test_ranks_up_to_k_give_the_same_precision_and_recall(spark, monkeypatch, k):
    monkeypatch.setattr(ls, "ITEMS", 64)
    monkeypatch.setattr(ev, "CUTS_PER_ROW", 4)
    rng = np.random.default_rng(32)
    items = vectors(spark, "track_id", np.concatenate([rng.normal(size=(300, 5)), np.ones((300, 5))]))  # many ties
    users = vectors(spark, "user_id", rng.normal(size=(40, 5)))
    split = spark.createDataFrame(
        [(u, int(t), bool(rng.random() < 0.5)) for u in range(40) for t in rng.choice(600, 20, replace=False)], "user_id long, track_id long, is_train boolean"
    )
    whole, some = ev.evaluation_ranks(users, items, split), ev.evaluation_ranks(users, items, split, upto=k)
    columns = ["user_id", "track_id", "score", "order", "n_candidates", "n_positives", "rank"]
    assert sorted(some.select(columns).collect()) == sorted(whole.withColumn("rank", F.least("rank", F.lit(k).cast("bigint"))).select(columns).collect())
    assert some.schema == whole.schema
    a, b = (ev.mean_metrics(ev.user_metrics(r, k)).first() for r in (whole, some))
    assert (a.precision, a.recall) == (b.precision, b.recall)


def test_workers_get_few_blocks_at_once_and_files_hold_few(spark, monkeypatch):
    """Rows with matrix blocks are megabytes: a batch of 64 MB of them, or a page of a hundred, is more than an executor has to spare."""
    monkeypatch.setattr(ls, "ITEMS", 512)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    users, items = (vectors(spark, name, np.random.default_rng(14).normal(size=(n, 64))) for name, n in (("user_id", 70), ("track_id", 20000)))
    met = sc._pairs(users, items.coalesce(1))
    size = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"]) for b in batches)
    sizes = [r.size for r in met.mapInArrow(size, "size long").collect()]
    assert sum(sizes) > 2 * (4 << 20) and max(sizes) <= (4 << 20) + (1 << 20)
    for blocks in (sc._pairs(users, items.coalesce(1)), ls.item_blocks(items.coalesce(1))):
        files = [f for f in blocks.inputFiles() if "/tables/" in f]
        stored = spark.read.parquet(*files)
        assert stored.count() >= 40 and stored.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] <= 4


def test_limit_of_batches_that_is_smaller_stays(spark):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))
    rt.small_batches(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(1 << 20)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def made(kind, rng, n_users=30, n_items=900):
    u, i = rng.normal(size=(n_users, 8)), rng.normal(size=(n_items, 8))
    if kind == "copies":
        i = i[np.arange(n_items) % 7]
    if kind == "close":  # scores differ by less than single precision can tell
        i = i[:1] + rng.normal(size=(n_items, 8)) * 3e-6
    if kind == "large":
        u, i = u * 1e4, i * 1e3
    if kind == "same":
        i = np.ones((n_items, 8))
    return u, i


KINDS = ["plain", "copies", "close", "large", "same"]


@pytest.mark.parametrize("kind", KINDS)
def test_ranks_of_wanted_tracks_are_exact(kind):
    u, i = made(kind, np.random.default_rng(41))
    scores = np.rint(u @ i.T * 1e6)
    ranks = np.argsort(np.argsort(-scores, axis=1, kind="stable"), axis=1, kind="stable")
    sizes = np.array([1, 5, 40] * 10)
    ats = np.concatenate([np.random.default_rng(42 + k).choice(900, n, replace=False) for k, n in enumerate(sizes)])
    of = np.repeat(np.arange(30), sizes)
    cuts = rs.Cuts(u, sizes, ats, scores[of, ats].astype(np.int64))
    plain = np.zeros(len(ats), np.int64)
    for at in np.split(np.arange(900), 4):
        cuts.show(at[0], i[at])
        inside = (ats >= at[0]) & (ats <= at[-1])
        rs._count_ranks(scores[:, at], cuts.cuts, np.clip(ats - at[0], 0, len(at)), inside, cuts.edges, plain, np.zeros(len(ats)))
    assert cuts.counts.tolist() == plain.tolist() == ranks[of, ats].tolist()
    assert cuts.copies.tolist() == [1] * len(ats)


def test_ties_of_wanted_tracks_count_as_in_a_sorted_block():
    u, i = made("copies", np.random.default_rng(43))
    scores, ats = np.rint(u @ i.T * 1e6), np.arange(30) * 30
    cuts = rs.Cuts(u, np.ones(30, np.int64), ats, scores[np.arange(30), ats].astype(np.int64))
    cuts.show(0, i)
    counts, ties = np.zeros(30, np.int64), np.zeros(30)
    rs._count_ranks(scores, cuts.cuts, ats, np.ones(30, bool), cuts.edges, counts, ties)
    assert cuts.counts.tolist() == counts.tolist() and cuts.ties.tolist() == ties.tolist() and ties.any()


def shown(u, i, sizes, of, shares, wanted):
    scores = np.rint(u @ i.T * 1e6)
    top, low = scores[:, ::9].max(axis=1), scores[:, ::9].min(axis=1)
    whole = np.column_stack([top, np.maximum((top - low) / (rs.BINS - 2), 1.0), u])
    counts, errors, ranges = np.zeros((len(u), rs.BINS), np.int64), np.zeros(len(u)), rs.Ranges(whole)
    for at in range(0, len(i), 300):
        rs._count_places(ranges, i[at : at + 300], counts, errors)
    assert (counts.sum(axis=1) == len(i)).all()
    block = rs.GroupBlock(wanted, sizes, of, shares, whole, np.c_[np.zeros(len(u), np.int64), counts.cumsum(axis=1)], errors)
    for at in range(0, len(i), 300):
        block.show(at, i[at : at + 300])
    block.settle()
    return scores, block


@pytest.mark.parametrize("kind", KINDS)
def test_groups_keep_their_best_tracks_within_bounds(kind):
    rng = np.random.default_rng(44)
    u, i = made(kind, rng)
    sizes, wanted = np.array([1, 2, 3, 4] * 6), np.array([5, 17, 1] * 8)
    of = np.concatenate([rng.choice(30, n, replace=False) for n in sizes])
    shares = rng.choice([1.0, 0.25, 3.0], len(of))
    scores, block = shown(u, i, sizes, of, shares, wanted)
    ranks = np.argsort(np.argsort(-scores, axis=1, kind="stable"), axis=1, kind="stable")
    edges = np.r_[0, np.cumsum(sizes)]
    for g, found in enumerate(block.found):
        mine = slice(edges[g], edges[g + 1])
        sums = (ranks[of[mine]] * shares[mine][:, None]).sum(axis=0)
        assert set(np.lexsort((np.arange(900), sums))[: wanted[g]]) <= set(found.at.tolist())
        assert (found.low <= sums[found.at] + 1e-9).all() and (sums[found.at] <= found.high + 1e-9).all()
        assert (found.scores == scores[of[mine]][:, found.at]).all()


def test_groups_make_few_products_in_double_precision(monkeypatch):
    made_again, products = [], ls.products
    monkeypatch.setattr(ls, "products", lambda *a: made_again.append(len(a[2])) or products(*a))
    rng = np.random.default_rng(45)
    u, i = rng.normal(size=(30, 8)), rng.normal(size=(9000, 8))
    shown(u, i, np.full(40, 3), np.concatenate([rng.choice(30, 3, replace=False) for _ in range(40)]), np.ones(120), np.full(40, 10))
    assert 0 < sum(made_again) < 40 * 3 * 9000 / 10
