"""Totals per user and item in as many tasks as the rows need, with the same result as in few."""

import random

import pytest

import playrank.operators.relational as relational
from playrank.operators.candidates import most_played
from playrank.plans.fixtures import interactions, raw_events

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def plays(spark):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(60), rng.randrange(80), rng.randrange(40) / 10) for _ in range(4000)]
    rows += [(None, 1, 2.0), (3, None, 9.0), (7, 5, None), (61, 1, 0.1), (61, 1, 0.2), (61, 0, 0.3)]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, hours double")


@pytest.mark.parametrize("places", [None, 6])
def test_totals_dealt_to_many_tasks(plays, monkeypatch, places):
    few = most_played(plays, 3, places)
    monkeypatch.setattr(relational, "TASK_ROWS", 100)
    many = most_played(plays, 3, places)
    assert many.columns == few.columns == ["user_id", "item_id", "total_hours", "rank"]
    told = lambda df: sorted((r["user_id"], r["item_id"], r["rank"], round(r["total_hours"], 9) if r["total_hours"] is not None else None) for r in df.collect())
    key = lambda rows: sorted(rows, key=str)
    assert key([tuple(r) for r in few.select("user_id", "item_id", "rank").collect()]) == key([tuple(r) for r in many.select("user_id", "item_id", "rank").collect()])
    assert told(many.where("user_id > 0 AND item_id >= 0")) == told(few.where("user_id > 0 AND item_id >= 0"))
    first = {r["item_id"] for r in many.where("user_id = 61 AND rank = 1").collect()}
    assert first == ({0} if places else {1})  # 0.1 + 0.2 is above 0.3 until it is rounded


def test_tasks_follow_the_rows(spark, plays, monkeypatch):
    monkeypatch.setattr(relational, "TASK_ROWS", 100, raising=False)
    assert most_played(plays, 3).rdd.getNumPartitions() == 41
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    events = raw_events(spark, SF_DIR)
    assert events.rdd.getNumPartitions() == -(-lines // 100) and events.count() == lines
    rows = sorted(map(str, interactions(spark, SF_DIR).collect()))
    monkeypatch.setattr(relational, "TASK_ROWS", 10**9, raising=False)
    assert sorted(map(str, interactions(spark, SF_DIR).collect())) == rows
