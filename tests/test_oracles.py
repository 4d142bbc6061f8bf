"""Every registered query against its oracle on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry
import compare
from tunequorum.checks.oracles import oracle_sql
from tunequorum.plans.registry import QUERIES, _train
from tunequorum.plans.tuning import evaluate

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    result = QUERIES[name](spark, SF)
    assert compare.type_differences(result.dtypes, con, ORACLES[name]) == []
    got, expected = result.toPandas(), con.execute(ORACLES[name]).df()
    if name == "sessions_scan":  # pandas keeps nullable integers of the two engines in different types
        got["track_id"], expected["track_id"] = got["track_id"].astype("Int64"), expected["track_id"].astype("Int64")
    assert compare.differences(got, expected) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_model_report_has_all_metrics(spark):
    row = evaluate(*_train(spark, SF)).first()
    assert row.auc_train > 0.9 and all(v is not None for v in row)
