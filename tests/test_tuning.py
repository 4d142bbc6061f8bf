"""The random search covers the whole trial table."""

import datetime
import threading

from pyspark.sql import functions as F

from tunequorum import runtime
from tunequorum.plans import tuning as tn
from tunequorum.plans.registry import QUERIES

SHARES = [f"{m}_{part}" for m in ("auc", "precision", "recall", "reciprocal_rank") for part in ("train", "test")]


def write_tables(spark, folder):
    at = datetime.datetime(2024, 1, 1)
    tables = {
        "supplier": spark.range(7).select(F.col("id").alias("s_suppkey")),
        "part": spark.range(1, 9).selectExpr("id as p_partkey", "'a' as p_name", "cast(3 as int) as p_size", "9.5D as p_retailprice"),
        "events": spark.createDataFrame([(k, at, k % 3, "purchase", f'{{"k": {1 + k % 8}}}') for k in range(20)], "event_id long, ts timestamp_ntz, user_id long, event_type string, props string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")


def test_every_trial_is_fitted_and_logged(spark, tmp_path, monkeypatch):
    write_tables(spark, tmp_path)
    fitted = []
    monkeypatch.setattr(tn, "train", lambda likes, parameters: fitted.append(parameters.rank))
    monkeypatch.setattr(tn, "evaluate", lambda model, split: spark.range(1).select(*[F.lit(0.5).alias(c) for c in SHARES]))
    monkeypatch.setattr(
        tn, "evaluate_spread", lambda model, history, groups: spark.range(1).selectExpr("1 as n_groups", "1.0D as clustering_fm", "2.0D as clustering_base", "50.0D as percent_better")
    )
    log = QUERIES["tuning_log"](spark, str(tmp_path)).collect()
    assert sorted(r.trial for r in log) == list(range(7)) and len(fitted) == 7
    assert all(r.metrics_in_range and r.percent_agrees for r in log)


def test_a_thread_sees_its_own_scratch_tables_only(spark):
    mark, other = runtime.scratch_mark(), []

    def work():
        own = runtime.scratch_mark()
        path = runtime.scratch_path(spark, "tables")
        other.append((path, runtime.scratch_since(own)))

    first = runtime.scratch_path(spark, "tables")
    thread = threading.Thread(target=work)
    thread.start()
    thread.join()
    assert runtime.scratch_since(mark) == [first] and other[0][1] == [other[0][0]]
    runtime.delete_scratch(spark, [first])
    assert runtime.scratch_since(mark) == []
