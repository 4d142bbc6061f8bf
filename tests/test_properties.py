"""Properties of rankings, samples and splits, and brute-force checks on small random data."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunequorum.operators import evaluation as ev
from tunequorum.operators import fallbacks as fb
from tunequorum.operators import interactions as it
from tunequorum.operators import lists as ls
from tunequorum.operators import ranking as rk
from tunequorum.operators import sampling as sp
from tunequorum.operators.scoring import score_pairs
from tunequorum.plans.serving import MODELS, advanced_model, answer_requests
from tunequorum.plans.training import FactorModel, Hyperparameters, train
from tunequorum.plans.tuning import evaluate, evaluate_spread
from tunequorum.functions.hashing import hash_bucket
from tunequorum.sources import adapters as ad
from tunequorum.sources import sinks
from tunequorum.sources.views import convert_to_parquet, read_table, register_views, table_paths
from tunequorum.streaming.serve import serve_stream

SF = "/root/testdata/sf0.01"


def random_vectors(spark, name, n, d=4, seed=0, as_text=False):
    values = np.random.default_rng(seed).normal(size=(n, d)).round(1)  # one digit, so ties occur
    kind = "string" if as_text else "bigint"
    data = [(f"t{i}" if as_text else i, v.tolist()) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"{name} {kind}, vec array<double>").repartition(3), values


def brute_ranks(user_values, item_values, ids):
    scores = np.round(user_values @ item_values.T, 6)
    place = {t: i for i, t in enumerate(sorted(ids))}
    order = [sorted(range(len(ids)), key=lambda i: (-s[i], place[ids[i]])) for s in scores]
    ranks = np.empty(scores.shape, dtype=int)
    for u, o in enumerate(order):
        ranks[u, o] = np.arange(len(o))
    return ranks


@pytest.mark.parametrize("block", [4096, 16])
@pytest.mark.parametrize("as_text", [False, True])
def test_group_playlists_equal_brute_force(spark, monkeypatch, as_text, block):
    monkeypatch.setattr(ls, "ITEMS", block)
    monkeypatch.setattr(ls, "USERS", 5)
    users, uv = random_vectors(spark, "user_id", 12)
    items, iv = random_vectors(spark, "track_id", 150, seed=1, as_text=as_text)
    ids = [f"t{i}" if as_text else i for i in range(150)]
    rng = np.random.default_rng(2)
    groups = {g: (sorted(rng.choice(12, size=rng.integers(1, 8), replace=False).tolist()), int(rng.integers(1, 9))) for g in range(25)}
    wanted = spark.createDataFrame([(g, n) for g, (_, n) in groups.items()], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(g, u) for g, (m, _) in groups.items() for u in m], "request_id bigint, user_id bigint")
    got = {}
    for r in rk.group_playlists(wanted, members, users, items).orderBy("request_id", "position").collect():
        got.setdefault(r.request_id, []).append((r.track_id, round(r.mean_rank, 6)))
    ranks = brute_ranks(uv, iv, ids)
    for g, (m, n) in groups.items():
        means = ranks[m].mean(axis=0)
        best = sorted(range(150), key=lambda i: (means[i], ids[i]))[:n]
        assert got[g] == [(ids[i], round(means[i], 6)) for i in best]


def test_lengths_up_to_the_largest_number(spark):
    """A request for 2^31 - 1 tracks gets the catalogue, and neither its neighbours nor those with equal members suffer."""
    users, uv = random_vectors(spark, "user_id", 4)
    items, iv = random_vectors(spark, "track_id", 70, seed=1)
    wanted = spark.createDataFrame([(1, 2**31 - 1), (2, 3), (3, 5), (4, 0)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 1), (3, 2), (4, 2)], "request_id bigint, user_id bigint")
    got = rk.group_playlists(wanted, members, users, items).toPandas()
    assert got.groupby("request_id").size().to_dict() == {1: 70, 2: 3, 3: 5}
    means = brute_ranks(uv, iv, list(range(70)))[[0, 1]].mean(axis=0)
    order = sorted(range(70), key=lambda i: (means[i], i))
    for request, n in ((1, 70), (2, 3)):
        assert got[got.request_id == request].sort_values("position").track_id.tolist() == order[:n]


def test_a_prepared_catalogue_and_a_member_of_all_groups(spark):
    users, uv = random_vectors(spark, "user_id", 30)
    items, iv = random_vectors(spark, "track_id", 90, seed=1)
    groups = spark.range(200).select(F.col("id").alias("request_id"), F.lit(4).alias("playlist_length"))
    members = groups.select("request_id", F.explode(F.array(F.lit(0), F.col("request_id") % 30)).alias("user_id")).distinct()
    got = rk.group_playlists(groups, members, users, items, blocks=ls.item_blocks(items)).toPandas()
    ranks = brute_ranks(uv, iv, list(range(90)))
    for request, part in got.groupby("request_id"):
        means = ranks[sorted({0, request % 30})].mean(axis=0)
        assert part.sort_values("position").track_id.tolist() == sorted(range(90), key=lambda i: (means[i], i))[:4]
    lists = rk.user_topk(users, items, 30)
    common = rk.common_tracks(members, lists).toPandas()
    for request, part in common.groupby("request_id"):
        assert set(part.track_id) == {i for i in range(90) if (ranks[sorted({0, request % 30}), i] < 30).all()}


@pytest.mark.parametrize("as_text", [False, True])
def test_full_lists(spark, monkeypatch, as_text):
    monkeypatch.setattr(ls, "ITEMS", 16)
    monkeypatch.setattr(ls, "USERS", 3)
    users, uv = random_vectors(spark, "user_id", 6)
    items, iv = random_vectors(spark, "track_id", 200, seed=3, as_text=as_text)
    ids = [f"t{i}" if as_text else i for i in range(200)]
    ranks, scores = brute_ranks(uv, iv, ids), np.round(uv @ iv.T, 6)
    place = {t: i for i, t in enumerate(ids)}
    got = ls.full_lists(users, items).collect()
    assert len(got) == 1200 and all(r.rank == ranks[r.user_id, place[r.track_id]] and abs(r.score - scores[r.user_id, place[r.track_id]]) < 1e-9 for r in got)


def test_top_lists_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ls, "NORM_ITEMS", 16)
    monkeypatch.setattr(ls, "USERS", 4)
    users, uv = random_vectors(spark, "user_id", 20, d=3)
    items, iv = random_vectors(spark, "track_id", 300, d=3, seed=3)
    shrink = 1.0 / (1 + np.arange(300) // 10)
    items = items.select("track_id", F.transform("vec", lambda x: x / (1 + F.floor(F.col("track_id") / 10))).alias("vec"))
    scores = np.round(uv @ (iv * shrink[:, None]).T, 6)
    seen = {(u, i) for u in range(20) for i in range(300) if (u * 7 + i) % 3 == 0 and i < 40}
    exclude = spark.createDataFrame([*seen, (0, 9999), (777, 1)], "user_id bigint, track_id bigint")
    wanted = users.withColumn("n", F.col("user_id") % 5)
    for k, out in ((5, None), (5, exclude), ("n", exclude), (400, None)):
        got = ls.top_lists(wanted, items, k, out).collect()
        for u in range(20):
            free = [i for i in range(300) if out is None or (u, i) not in seen]
            best = sorted(free, key=lambda i: (-scores[u, i], i))[: u % 5 if k == "n" else k]
            mine = sorted((r.rank, r.track_id) for r in got if r.user_id == u)
            assert mine == list(enumerate(best)), (k, u)


def test_blocks_that_cannot_win_are_skipped():
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(8, 6)), rng.normal(size=(40, 30, 6)) / (1 + np.arange(40))[:, None, None]
    norms = [np.linalg.norm(block, axis=1).max() for block in items]
    best = ls.BestSoFar(users, np.full(8, 5))
    shown = [best.show(np.arange(30 * i, 30 * i + 30), items[i], norms[i], np.zeros(0, int)) for i in np.argsort(norms)[::-1]]
    assert shown[0] and sum(shown) < 20
    scores = np.round(users @ items.reshape(-1, 6).T, 6)
    for u in range(8):
        assert best.ids[best.rows == u].tolist() == sorted(range(1200), key=lambda i: (-scores[u, i], i))[:5]


def test_top_lists_of_nothing(spark):
    users, _ = random_vectors(spark, "user_id", 3)
    items, _ = random_vectors(spark, "track_id", 5)
    assert rk.user_topk(users, items.where("false"), 3).count() == 0 and rk.user_topk(users.where("false"), items, 3).count() == 0
    none = spark.createDataFrame([], "request_id bigint, playlist_length int, user_id bigint")
    assert rk.group_playlists(none, none, users, items).count() == 0


def test_scores_do_not_depend_on_partitioning(spark):
    users, uv = random_vectors(spark, "user_id", 40)
    items, iv = random_vectors(spark, "track_id", 60, seed=5)
    for u, i in ((users, items), (users.repartition(7), items.coalesce(1))):
        got = {(r.user_id, r.track_id): r.score for r in score_pairs(u, i).collect()}
        assert len(got) == 2400
        assert all(abs(got[a, b] - round(float(uv[a] @ iv[b]), 6)) < 1e-9 for a, b in got)


def test_identical_members_equal_the_single_list(spark):
    users, values = random_vectors(spark, "user_id", 1)
    twin = spark.createDataFrame([(9, values[0].tolist())], "user_id bigint, vec array<double>")
    items, _ = random_vectors(spark, "track_id", 50, seed=6)
    wanted = spark.createDataFrame([(1, 7), (2, 7)], "request_id bigint, playlist_length int")
    members = spark.createDataFrame([(1, 0), (2, 0), (2, 9)], "request_id bigint, user_id bigint")
    got = rk.group_playlists(wanted, members, users.union(twin), items).orderBy("position")
    one, two = ([r.track_id for r in got.where(f"request_id = {g}").collect()] for g in (1, 2))
    top = [r.track_id for r in rk.user_topk(users, items, 7).orderBy("rank").collect()]
    assert one == two == top


def test_random_scores_have_an_auc_of_one_half(spark):
    users, _ = random_vectors(spark, "user_id", 60)
    items, _ = random_vectors(spark, "track_id", 200, seed=7)
    rng = np.random.default_rng(8)
    split = spark.createDataFrame(
        [(u, int(t), False) for u in range(60) for t in rng.choice(200, 10, replace=False)],
        "user_id bigint, track_id bigint, is_train boolean")
    auc = ev.mean_metrics(ev.user_metrics(ev.evaluation_ranks(users, items, split))).first().auc
    assert abs(auc - 0.5) < 0.05


def test_samples_are_distinct_and_about_uniform(spark):
    draws = spark.range(400).withColumnRenamed("id", "k")
    for size in (30, 500):  # below and above the size that is permuted as a whole
        population = spark.range(size).withColumnRenamed("id", "x")
        got = sp.random_members(population, "x", draws, "k", F.lit(6), 1)
        assert got.groupBy("k").agg(F.count_distinct("x").alias("n")).where("n <> 6").isEmpty()
        counts = got.groupBy("x").count().agg(F.max("count")).first()[0]
        assert counts < 400 * 6 / size * 3 + 10


def test_split_is_complete_and_stable(spark):
    likes = spark.range(2000).select((F.col("id") % 40).alias("user_id"), F.col("id").alias("track_id"))
    split = it.split_interactions(likes)
    assert split.count() == 2000
    assert 0.75 < split.where("is_train").count() / 2000 < 0.85
    assert split.exceptAll(it.split_interactions(likes.repartition(7))).isEmpty()


def planted(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet").select(F.col("c_custkey").alias("user_id")).where("user_id < 150")
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("track_id"), "label")
    liked = customers.join(vectors, (F.col("user_id") % 10) == F.col("label"))
    return liked.where(hash_bucket(100, "like", F.col("user_id"), F.col("track_id")) < 60)


def test_quality_gates_on_planted_likes(spark, tmp_path):
    likes = planted(spark).select("user_id", "track_id")
    split = it.split_interactions(likes)
    model = train(split.where("is_train").withColumn("w", F.lit(1.0)),
                  Hyperparameters(rank=16, iterations=10, regularisation=0.1, alpha=1.0, seed=1))
    report = evaluate(model, split).first()
    assert report.auc_test > 0.9 and report.auc_train > 0.9
    groups = spark.range(60).withColumnRenamed("id", "group_id")
    spread = evaluate_spread(model, sp.numbered_history(likes), groups).first()
    assert spread.clustering_fm < spread.clustering_base and spread.percent_better > 0
    model.save(str(tmp_path / "model"))
    again = evaluate(FactorModel.load(spark, str(tmp_path / "model")), split).first()
    assert again == report


def test_cold_item_factors_beat_the_mean(spark):
    likes = planted(spark)
    interactions = likes.select("user_id", "track_id", F.lit(1.0).alias("w"))
    factors = train(interactions, Hyperparameters(rank=8, iterations=5, regularisation=0.1, alpha=1.0)).items().cache()
    labels = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("track_id"), F.array(*[(F.col("label") == k).cast("double") for k in range(10)]).alias("x"))
    warm = factors.where("track_id % 5 <> 0")
    predicted = {r.track_id: np.array(r.vec) for r in fb.cold_item_factors(labels, warm, ridge=1e-3).collect()}
    truth = {r.track_id: np.array(r.vec) for r in factors.where("track_id % 5 = 0").collect()}
    mean = np.mean([r.vec for r in warm.collect()], axis=0)
    ours = np.mean([np.linalg.norm(predicted[t] - v) for t, v in truth.items()])
    assert ours < 0.5 * np.mean([np.linalg.norm(mean - v) for v in truth.values()])


def test_stream_answers_each_id_once_over_batches_and_restarts(spark, tmp_path):
    users, _ = random_vectors(spark, "user_id", 6)
    items, _ = random_vectors(spark, "track_id", 40, seed=9)
    tracks = items.select(F.col("track_id").alias("id"))
    likes = spark.createDataFrame([(u, t) for u in range(6) for t in range(u, 40, 7)], "user_id bigint, track_id bigint")
    history = sp.numbered_history(likes)
    requests = [dict(request_id=i, user_id=i % 6, other_users=[(i + 1) % 6], playlist_length=4 - i % 7) for i in range(12)]
    source = tmp_path / "in"
    source.mkdir()
    nameless = dict(request_id=None, user_id=1, other_users=[], playlist_length=3)
    changed = dict(requests[0], playlist_length=9)  # the same id with another wish
    out, rejected = str(tmp_path / "out"), str(tmp_path / "rejected")
    answer = lambda batch: answer_requests(batch, users, items, history, tracks)
    files = [requests[:6] + [requests[1]], requests[6:] + [nameless, nameless], [changed, requests[2]]]
    for part, lines in enumerate(files):  # every file comes after a restart, the last ones repeat ids of earlier batches
        (source / f"{part}.json").write_text("\n".join(map(json.dumps, lines)))
        serve_stream(spark, str(source), out, str(tmp_path / "ck"), answer, max_files=1, rejected_dir=rejected).awaitTermination()
    records = sinks.read_history(spark, out).collect()
    assert sorted(r.request_id for r in records) == [r["request_id"] for r in requests if r["playlist_length"] >= 0]
    assert all(r.elapsed_time > 0 for r in records) and {r.model for r in records} == {"base", "advanced"}
    batch = answer(spark.createDataFrame(requests, "request_id bigint, user_id bigint, other_users array<bigint>, playlist_length int"))
    expected = {}
    for r in batch.orderBy("position").collect():
        expected.setdefault(r.request_id, []).append(str(r.track_id))
    assert {r.request_id: r.playlist for r in records} == {r.request_id: expected.get(r.request_id, []) for r in records}
    reasons = sorted((r.reason, -1 if r.request_id is None else r.request_id) for r in spark.read.json(rejected).collect())
    negative = [("negative playlist_length", r["request_id"]) for r in requests if r["playlist_length"] < 0]
    assert reasons == sorted([("missing request_id", -1)] * 2 + negative + [("repeated request_id", i) for i in (0, 1, 2)])


def test_a_third_model_and_the_fallbacks(spark):
    users, _ = random_vectors(spark, "user_id", 4)
    items, _ = random_vectors(spark, "track_id", 30, seed=2)
    tracks = items.select(F.col("track_id").alias("id"), (F.col("track_id") % 11).alias("popularity"), (F.col("track_id") % 3).alias("id_artist"))
    artists = spark.createDataFrame([(0, ["x"]), (1, ["y"]), (2, ["z"])], "id bigint, genres array<string>")
    profiles = spark.createDataFrame([(70, ["y"]), (71, ["none"])], "user_id bigint, favourite_genres array<string>")
    history = sp.numbered_history(spark.createDataFrame([(1, 2)], "user_id bigint, track_id bigint"))
    requests = spark.createDataFrame([(1, 70, [], 3), (2, 71, [], 2), (3, 1, [70], 2)], "request_id bigint, user_id bigint, other_users array<bigint>, playlist_length int")
    first = lambda wanted, members, tables: wanted.select("request_id", F.lit(1).alias("position"), F.lit(5).cast("bigint").alias("track_id"))
    ask = lambda **more: answer_requests(requests, users, items, history, tracks, profiles=profiles, artists=artists, **more)
    got = ask(routing="first", models={**MODELS, "first": first}).collect()
    assert sorted((r.request_id, r.model, r.track_id) for r in got) == [(i, "first", 5) for i in (1, 2, 3)]
    by = {f: ask(routing="advanced", models={"advanced": advanced_model(f)}).toPandas() for f in ("random", "popular", "genre")}
    best = sorted(range(30), key=lambda t: (-(t % 11), t))
    lists = {f: {k: g.sort_values("position").track_id.tolist() for k, g in d.groupby("request_id")} for f, d in by.items()}
    assert lists["popular"][1] == best[:3] and lists["popular"][2] == best[:2]
    assert lists["genre"][1] == [t for t in best if t % 3 == 1][:3] and len(set(lists["genre"][2])) == 2
    assert all(len(lists[f][1]) == 3 and lists[f][3] == lists["random"][3] for f in lists)
    with pytest.raises(ValueError):
        advanced_model("other")


def test_json_sources_and_conversion(spark, tmp_path):
    folder = tmp_path / "v1"
    folder.mkdir()
    lines = {
        "sessions": [{"session_id": 1, "timestamp": "2024-01-02T03:04:05.123456", "user_id": 7, "track_id": "t1", "event_type": "like"},
                     {"session_id": 1, "timestamp": "2024-01-02T03:05:00", "user_id": 7, "track_id": None, "event_type": "advertisement"}],
        "tracks": [{"id": "t1", "id_artist": "a1", "name": "n", "release_date": "1994-05", "popularity": 3}],
    }
    for name, data in lines.items():
        (folder / f"{name}.jsonl").write_text("\n".join(json.dumps(d) for d in data))
    paths = table_paths(str(tmp_path), "v1", ["sessions", "tracks"])
    frames = register_views(spark, paths)
    assert spark.sql("select count(*) from sessions where timestamp is not null").first()[0] == 2
    assert frames["tracks"].schema["popularity"].dataType.typeName() == "long"
    stored = convert_to_parquet(spark, paths, str(tmp_path / "pq"), "v1")
    assert "event_type=like" in os.listdir(stored["sessions"])
    again = read_table(spark, "sessions", stored["sessions"])
    assert it.liked_pairs(again).collect() == [(7, "t1")]


def test_history_appends(spark, tmp_path):
    path = str(tmp_path / "history")
    row = spark.createDataFrame(
        [(1, 2, [3], ["a", "b"], None, 0.5, "base", True)],
        "request_id bigint, user_id bigint, other_users array<bigint>, playlist array<string>, timestamp timestamp, "
        "elapsed_time double, model string, is_ab boolean")
    for _ in range(2):
        sinks.append_history(row, path)
    assert [r.playlist for r in sinks.read_history(spark, path).collect()] == [["a", "b"]] * 2
