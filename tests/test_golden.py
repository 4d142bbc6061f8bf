"""Hand-made cases for every semantic decision and tie rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tunequorum.functions.columns import ab_model, percent_better, release_year
from tunequorum.operators import evaluation as ev
from tunequorum.operators import fallbacks as fb
from tunequorum.operators import features as ft
from tunequorum.operators import interactions as it
from tunequorum.operators import numbering as nb
from tunequorum.operators import outcomes as oc
from tunequorum.operators import quality as ql
from tunequorum.operators import ranking as rk
from tunequorum.operators import requests as rq
from tunequorum.operators import sampling as sp
from tunequorum.plans.serving import answer_requests
from tunequorum.sources.views import table_paths


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def vectors(spark, name, data):
    return spark.createDataFrame(data, f"{name} bigint, vec array<double>")


def items_for(spark, lists):
    """Users and items whose scores give each user the stated ranking: one dimension per user."""
    users = vectors(spark, "user_id", [(u, [float(v == u) for v in lists]) for u in lists])
    ids = sorted({t for ranking in lists.values() for t in ranking})
    items = vectors(spark, "track_id", [(t, [-float(lists[u].index(t)) for u in lists]) for t in ids])
    return users, items


def test_like_is_equality(spark):
    s = spark.createDataFrame(
        [(1, 1, "like"), (1, 2, "Like"), (1, 3, "likes"), (1, 4, None), (None, 5, "like")],
        "user_id bigint, track_id bigint, event_type string")
    assert rows(it.liked_pairs(s), "track_id") == [(1, 1)]


def test_weight_sums_and_interaction_is_binary(spark):
    s = spark.createDataFrame([(1, 1, "like")] * 3 + [(1, 9, "like")], "user_id bigint, track_id bigint, event_type string")
    tracks = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert rows(it.with_catalogue(it.like_weights(s), tracks), "track_id") == [(1, 1, 3)]
    assert rows(it.binary_interactions(s, tracks), "track_id") == [(1, 1, 1.0)]
    assert rows(it.binary_interactions(s, tracks, "sum"), "track_id") == [(1, 1, 3.0)]
    weights = spark.createDataFrame([("like", 5)], "event_type string, event_weight bigint")
    assert rows(it.like_weights(s, weights), "track_id") == [(1, 1, 15), (1, 9, 5)]


def test_distinct_is_per_row(spark):
    t = spark.createDataFrame([(1, 1, 5), (1, 1, 6), (1, 1, 6)], "id bigint, id_artist bigint, popularity bigint")
    assert it.track_features(t, ("popularity",)).count() == 2


def test_release_year(spark):
    d = spark.createDataFrame([("1994",), ("1994-05",), ("1994-05-03",), ("abcd",)], "d string")
    assert [r[0] for r in d.select(release_year(F.col("d"))).collect()] == [1994, 1994, 1994, None]


def test_zscore_of_constant_and_null(spark):
    d = spark.createDataFrame([(1, 3.0, 1.0), (2, 3.0, 3.0), (3, 3.0, None)], "id bigint, tempo double, energy double")
    assert rows(ft.standardise(d, ("tempo", "energy")), "id") == [(1, None, -1.0), (2, None, 1.0), (3, None, None)]


def test_mean_rank_tie_goes_to_smaller_id(spark):
    users, items = items_for(spark, {1: [20, 10, 30], 2: [10, 20, 30]})
    groups = spark.createDataFrame([(7, 3)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(7, 1), (7, 2)], "request_id bigint, user_id bigint")
    assert rows(rk.group_playlists(groups, members, users, items), "position") == [
        (7, 1, 10, 0.5), (7, 2, 20, 0.5), (7, 3, 30, 2.0)]


def test_ranks_keep_gaps_in_cut_lists(spark):
    users, items = items_for(spark, {1: [1, 2, 3, 4], 2: [4, 3, 2, 1]})
    groups = spark.createDataFrame([(7, 9)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(7, 1), (7, 2)], "request_id bigint, user_id bigint")
    cut = rk.group_playlists(groups, members, users, items, k_per_user=3)
    assert rows(cut, "position") == [(7, 1, 2, 1.5), (7, 2, 3, 1.5)]


def test_group_of_one_cold_member_and_zero_length(spark):
    users, items = items_for(spark, {1: [3, 1, 2]})
    groups = spark.createDataFrame([(1, 2), (2, 2), (3, 0)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(1, 1), (2, 1), (2, 99), (3, 1)], "request_id bigint, user_id bigint")
    got = rows(rk.group_playlists(groups, members, users, items).select("request_id", "track_id"), "request_id", "position")
    assert got == [(1, 3), (1, 1), (2, 3), (2, 1)]


def test_all_cold_group_gets_random_tracks(spark):
    users, items = items_for(spark, {1: [3, 1, 2]})
    requests = spark.createDataFrame(
        [(1, 5, [7], 2), (2, 1, [], 2), (3, 1, [], -1)],
        "request_id bigint, user_id bigint, other_users array<bigint>, playlist_length int")
    tracks = items.select(F.col("track_id").alias("id"))
    likes = spark.createDataFrame([(1, 2)], "user_id bigint, track_id bigint")
    got = answer_requests(requests, users, items, sp.numbered_history(likes), tracks, routing="advanced")
    cold = got.where("request_id = 1").collect()
    assert len({r.track_id for r in cold}) == 2
    assert rows(got.where("request_id = 2"), "position") == [(2, "advanced", 1, 3), (2, "advanced", 2, 1)]
    assert got.where("request_id = 3").count() == 0
    with pytest.raises(ValueError):
        answer_requests(requests, users, items, likes, tracks, routing="other")


def test_short_history_and_shared_likes(spark):
    likes = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 10)], "user_id bigint, track_id bigint")
    history = sp.numbered_history(likes)
    users = spark.createDataFrame([(1,), (3,)], "user_id bigint")
    mine = sp.sample_user_history(history, users, 20, 7).collect()
    assert sorted(r.track_id for r in mine) == [10, 11, 12] and all(r.short for r in mine)
    groups = spark.createDataFrame([(5, 20)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(5, 1), (5, 2)], "request_id bigint, user_id bigint")
    bag = sp.sample_group_history(history, groups, members, 7)
    assert sorted(r.track_id for r in bag.collect()) == [10, 10, 11, 12]
    assert sorted(r.position for r in bag.collect()) == [1, 2, 3, 4]
    once = sp.sample_group_history(history, groups, members, 7, distinct_tracks=True)
    assert sorted(r.track_id for r in once.collect()) == [10, 11, 12]


def test_ab_assignment(spark):
    ids = [4, 5, -1, -3, 2**61 - 1, 2**61, -(2**61), -(2**63)]
    d = spark.createDataFrame([(i,) for i in ids], "user_id bigint")
    got = dict(d.select("user_id", ab_model(F.col("user_id"))).collect())
    assert got == {i: "base" if hash(i) % 2 == 0 else "advanced" for i in ids}


def test_request_validation_and_members(spark):
    r = spark.createDataFrame(
        [(1, 1, [2, 1, 2], 5), (2, 1, [], -1), (3, None, [], 5), (4, 1, None, 5), (5, 1, [], None), (6, 1, [], 0)],
        "request_id bigint, user_id bigint, other_users array<bigint>, playlist_length int")
    reasons = [x[0] for x in rq.validate_requests(r).orderBy("request_id").select("reason").collect()]
    assert reasons == [None, "negative playlist_length", "missing user_id", "missing other_users",
                       "missing playlist_length", None]
    assert rows(rq.request_members(r.where("request_id = 1")), "user_id") == [(1, 1), (1, 2)]


def eval_case(spark, scores, positives, train=()):
    users = vectors(spark, "user_id", [(1, [1.0])])
    items = vectors(spark, "track_id", [(i, [s]) for i, s in enumerate(scores)])
    split = spark.createDataFrame(
        [(1, p, False) for p in positives] + [(1, t, True) for t in train],
        "user_id bigint, track_id bigint, is_train boolean")
    return ev.evaluation_ranks(users, items, split)


def test_metrics(spark):
    ranks = eval_case(spark, [5.0, 4.0, 3.0, 2.0, 1.0], [0, 2])
    m = ev.mean_metrics(ev.user_metrics(ranks, 2)).first()
    assert (round(m.auc, 6), m.precision, m.recall, m.reciprocal_rank) == (round(5 / 6, 6), 0.5, 0.5, 1.0)


def test_metric_tie_counts_against_the_positive(spark):
    assert [r["rank"] for r in eval_case(spark, [1.0, 1.0, 0.5], [0]).collect()] == [1]


def test_train_positives_leave_the_candidates(spark):
    r = eval_case(spark, [5.0, 4.0, 3.0, 2.0], [2], train=[0]).first()
    assert (r["rank"], r.n_candidates, r.n_positives) == (1, 3, 1)


def test_many_positives_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ev, "CUTS_PER_ROW", 2)
    ranks = eval_case(spark, [float(-i) for i in range(50)], list(range(0, 50, 3)))
    assert sorted(r["rank"] for r in ranks.collect()) == list(range(0, 50, 3))


def test_spread(spark):
    items = vectors(spark, "track_id", [(1, [0.0, 0.0]), (2, [2.0, 0.0])])
    p = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (2, 2)], "k bigint, track_id bigint")
    got = {r.k: round(r.spread, 6) for r in ev.playlist_spread(p, items, ["k"]).collect()}
    assert got == {1: 1.0, 2: round((2 / 3 + 2 / 3 + 4 / 3) / 3, 6)}


def test_percent_better(spark):
    d = spark.createDataFrame([(0.644901, 0.451450), (0.0, 1.0)], "b double, a double")
    got = [r[0] for r in d.select(percent_better(F.col("b"), F.col("a"))).collect()]
    assert round(got[0], 3) == 29.997 and got[1] is None


def test_unknown_view_is_an_error():
    assert list(table_paths("/data", "v4", ["tracks"]).values()) == ["/data/v4/tracks.jsonl"]
    with pytest.raises(KeyError):
        table_paths("/data", "v4", ["songs"])


def test_uptake_counts_only_later_sessions(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    sessions = spark.createDataFrame(
        [(1, t(1), 1, 10, "play"), (2, t(5), 1, 10, "play"), (2, t(5), 1, 10, "play"), (3, t(6), 1, 11, "play"),
         (3, t(7), 1, 12, "like"), (4, t(8), 2, 11, "play")],
        "session_id bigint, timestamp timestamp_ntz, user_id bigint, track_id bigint, event_type string")
    runs = spark.createDataFrame([(1, t(5), "base"), (2, t(1), "advanced"), (3, t(9), "base")],
                                 "request_id bigint, timestamp timestamp_ntz, model string")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "request_id bigint, user_id bigint")
    lists = spark.createDataFrame([(r, p, x) for r in (1, 2, 3) for p, x in ((1, 10), (2, 11), (3, 12))],
                                  "request_id bigint, position bigint, track_id bigint")
    got = rows(oc.playlist_uptake(runs, members, lists, sessions), "request_id")
    # run 1 starts together with session 2, which counts as earlier; no session follows run 3
    assert [(r[0], round(r[2], 4), r[3]) for r in got] == [(1, 0.3333, False), (2, 0.3333, False), (3, 0.0, False)]
    timed = spark.createDataFrame([(10, 1.0), (11, 8.0), (12, 1.0)], "track_id bigint, duration double")
    by_time = oc.playlist_uptake(runs, members, lists, sessions, timed)
    assert rows(by_time.select("request_id", "best_share"), "request_id") == [(1, 0.8), (2, 0.8), (3, 0.0)]
    only_next = oc.playlist_uptake(runs, members, lists, sessions, timed, n_sessions=1)
    assert rows(only_next.select("request_id", "best_share"), "request_id") == [(1, 0.8), (2, 0.1), (3, 0.0)]
    outcome = {r.model: (r.n_runs, r.n_met, r.target_met) for r in oc.ab_outcome(by_time).collect()}
    assert outcome == {"base": (2, 1, True), "advanced": (1, 1, True)}


def test_quality_rules_find_bad_rows(spark):
    artists = spark.createDataFrame([("-1", None), (None, ["x"]), ("a", ["x"])], "id string, genres array<string>")
    tracks = spark.createDataFrame([(None,), ("t",)], "id string")
    at = dt.datetime(2024, 1, 1)
    sessions = spark.createDataFrame(
        [(1, at, None, None, "play"), (1, at, 2, "t", None), (None, at, 2, None, "advertisement")],
        "session_id bigint, timestamp timestamp_ntz, user_id bigint, track_id string, event_type string")
    users = spark.createDataFrame([(1, None)], "user_id bigint, favourite_genres array<string>")
    got = {(r.table_name, r.rule): r.n_bad for r in ql.dq_report(artists, tracks, sessions, users).collect()}
    assert got == {
        ("artists", "missing_id"): 2, ("artists", "missing_genres"): 1, ("tracks", "missing_id"): 1,
        ("sessions", "missing_session_id"): 1, ("sessions", "missing_user"): 1, ("sessions", "missing_event_type"): 1,
        ("sessions", "missing_track"): 1, ("sessions", "repeated_timestamp"): 2, ("users", "missing_genres"): 1}


def test_rereleases(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, "b", 1)], "id bigint, name string, popularity bigint")
    assert rows(ql.rereleases(t, ["name"]), "name") == [("a", 2, 1, 9)]
    assert rows(ql.collapse_rereleases(t, ["name"]), "name") == [("a", 1, 9), ("b", 3, 1)]


def test_genres_prefer_more_in_common(spark):
    profiles = spark.createDataFrame([(1, ["x", "y"])], "user_id bigint, favourite_genres array<string>")
    artists = spark.createDataFrame([(1, ["x"]), (2, ["y", "x"]), (3, ["z"])], "id bigint, genres array<string>")
    tracks = spark.createDataFrame([(10, 1, 99), (11, 2, 1), (12, 3, 50), (13, 1, 99)],
                                   "id bigint, id_artist bigint, popularity bigint")
    got = rows(fb.genre_playlists(profiles, tracks, artists, 2), "position")
    assert got == [(1, 1, 11, 2), (1, 2, 10, 1)]


def test_numbering_is_dense_for_any_shards(spark):
    d = spark.range(100).withColumn("k", F.col("id") % 3)
    for shards in (1, 5, 200):
        got = nb.number_rows(d, ["k"], ["id"], "n", shards).groupBy("k").agg(F.sort_array(F.collect_list("n")))
        assert {r[0]: r[1] for r in got.collect()} == {0: list(range(34)), 1: list(range(33)), 2: list(range(33))}
