"""Tables that grow with the users are not broadcast, however small Spark takes them for."""

import pytest

import __spark_entry__ as entry


@pytest.mark.parametrize("name", ["cnd1_ranking_candidates", "cnd2_retrieval_candidates", "cnd3_injected_positives", "cnd4_group_split", "ev6_ranker_metrics"])
def test_no_broadcast_by_user_and_item(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [user_id" in plan
    assert "BroadcastHashJoin [user_id" not in plan
