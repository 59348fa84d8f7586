"""Tables that queries of one application share, when the folder or the given tables change between two queries."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import playrank.session as session
from playrank.plans.fixtures import prepared
from playrank.session import drop_tables, shared_dir

GIVEN = Path("/root/testdata/sf0.001")


@pytest.fixture
def given(tmp_path):
    for name in ("lineitem", "orders", "part"):
        shutil.copyfile(GIVEN / f"{name}.parquet", tmp_path / f"{name}.parquet")
    return tmp_path


@pytest.mark.parametrize("name", ["ag1_user_aggregate", "cnd4_group_split", "ev1_history_and_truth"])
def test_query_after_the_shared_folder_was_cleared(spark, given, name):
    query = entry.queries()[name]
    rows = sorted(map(tuple, query(spark, str(given)).collect()))
    saved = prepared(spark, str(given)).path
    drop_tables(spark, [saved])
    assert sorted(map(tuple, query(spark, str(given)).collect())) == rows
    again = prepared(spark, str(given)).path
    assert again != saved and prepared(spark, str(given)).path == again
    shutil.rmtree(Path(again, "items"))  # cleared in part
    assert sorted(map(tuple, query(spark, str(given)).collect())) == rows


def test_other_tables_at_the_same_path(spark, given):
    before = prepared(spark, str(given)).catalog.count()
    spark.read.parquet(str(given / "part.parquet")).where(F.col("p_partkey") % 2 == 0).write.parquet(str(given / "half"))
    (given / "part.parquet").unlink()
    (given / "half").rename(given / "part.parquet")
    assert 0 < prepared(spark, str(given)).catalog.count() < before


def test_a_bare_folder_on_a_cluster_is_tried(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "master", property(lambda self: "spark://one:7077"), raising=False)
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ":" not in configured and shared_dir(spark) == configured
    assert not list(Path(configured).glob("probe-*"))
    monkeypatch.setattr(session, "_seen_by_all", lambda *_: False)
    monkeypatch.setattr(session, "_probed", set())
    with pytest.raises(RuntimeError, match="shared one"):
        shared_dir(spark)
