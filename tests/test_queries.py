"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from riskloom.catalog import ORACLES, QUERIES
from tools.check import compare, connect

# Training queries without SQL are covered, smaller, in test_models.
UNCHECKED = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_names():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert UNCHECKED == ["anomaly_embeddings", "anomaly_score", "attribution", "batch_score", "cross_val", "gbt_predict",
                         "gbt_train", "hpo_search", "latent_search", "stream_model_score"]


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.count() == 1000
    assert {"uid1", "cnt_7d", "amt_vs_avg_ratio", "is_new_device_uid1"} <= set(flagship.columns)
