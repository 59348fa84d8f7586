"""Queries of the saved splits as the first of an application, on a cluster whose ``spark.checkpoint.dir`` is a bare path."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
import playrank.plans.fixtures as fixtures
import playrank.session as session

SF = "/root/testdata/sf0.001"
NAMES = [
    "ag11_monthly_resample",
    "ag12_pairwise_correlation",
    "ag13_population_deviation",
    "ag1_user_aggregate",
    "ag2_item_aggregate",
    "ag4_two_key_count",
    "ag3_sample_deviation",
    "ag7_value_counts",
    "ag5_max_and_first",
    "ag8_exact_quantiles",
    "ag9_global_counts",
    "ev3_ndcg",
    "ev2_recall",
    "ev1_history_and_truth",
    "ev4_catalog_coverage",
    "ev5_all_metrics",
    "ev7_model_comparison",
]


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "master", property(lambda self: "spark://one:7077"), raising=False)
    monkeypatch.setattr(fixtures, "_saved", {})
    monkeypatch.setattr(session, "_probed", set(), raising=False)
    assert ":" not in spark.conf.get("spark.checkpoint.dir")
    return spark


@pytest.mark.parametrize("name", NAMES)
def test_first_query_and_again_after_a_clearing(cluster, name):
    con, query, text = connect(SF), entry.queries()[name], entry.oracle_sql()[name]
    assert compare(query(cluster, SF), con, text) is None
    [(saved, _)] = fixtures._saved.values()
    session.drop_tables(cluster, [saved])
    assert compare(query(cluster, SF), con, text) is None
    assert fixtures.prepared(cluster, SF).path != saved
