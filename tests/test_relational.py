import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playrank.operators import relational
from playrank.operators.exploration import correlated_pairs, monthly_counts, quantiles
from playrank.operators.relational import cut_by_order, global_rank, heavy_values, latest_per_key, lookup_join, running_total, skewed_join, top_k_per_group
from playrank.operators.sampling import sample_rows
from playrank.operators.splitting import most_recent, time_based_split


def days(n, hot_share=0.0, seed=1):
    """Rows (user, item, time); a share of them falls on one instant."""
    rng = random.Random(seed)
    start, hot = dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 1, 12)
    rows = []
    for i in range(n):
        when = hot if rng.random() < hot_share else start + dt.timedelta(hours=rng.randrange(24 * 120))
        rows.append((i % 17, i, when))
    return rows


def events(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, event_time timestamp_ntz").repartition(5)


@pytest.mark.parametrize("small", [0, 10_000])
def test_global_rank_equals_sort(spark, small):
    rows = [(random.Random(i).randrange(10), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    ranked = {(r["a"], r["b"]): r["rn"] for r in global_rank(df, [F.col("a").desc(), F.col("b").asc()], small=small).collect()}
    expected = {row: n + 1 for n, row in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert ranked == expected


@pytest.mark.parametrize("small", [0, 10_000])
def test_running_total(spark, small):
    df = spark.createDataFrame([(i, i % 5) for i in range(200)], "k int, n int").repartition(6)
    got = {r["k"]: r["upto"] for r in running_total(df, [F.col("k").asc()], "n", small=small).collect()}
    total, expected = 0, {}
    for i in range(200):
        total += i % 5
        expected[i] = total
    assert got == expected


@pytest.mark.parametrize("hot_share", [0.0, 0.4, 1.0])
def test_time_split_is_exact_with_a_hot_instant(spark, monkeypatch, hot_share):
    monkeypatch.setattr(relational.global_rank, "__defaults__", ("rn", 0))
    rows = days(997, hot_share)
    ordered = sorted(rows, key=lambda r: (r[2], r[0], r[1]))
    upper = int(997 * (1 - 0.2))
    lower = int(upper * (1 - 0.1))
    expected = {r[1]: "train" if n < lower else "validation" if n < upper else "test" for n, r in enumerate(ordered)}
    split = time_based_split(events(spark, rows))
    assert {r["item_id"]: r["split"] for r in split.collect()} == expected


@pytest.mark.parametrize("keep", [0, 1, 500, 997, 5000])
def test_most_recent(spark, keep):
    rows = days(997, 0.4)
    ordered = sorted(rows, key=lambda r: (r[2], r[0], r[1]))
    expected = {r[1] for r in (ordered[-keep:] if keep else [])}
    assert {r["item_id"] for r in most_recent(events(spark, rows), keep).collect()} == expected


def test_cuts_that_coincide(spark):
    df = spark.range(100).withColumn("day", F.col("id") % 3)
    cuts = [lambda t: F.lit(0), lambda t: F.lit(40), lambda t: F.lit(40), lambda t: t]
    segments = cut_by_order(df, F.col("day"), [F.col("day"), F.col("id")], cuts).groupBy("segment").count()
    assert {r["segment"]: r["count"] for r in segments.collect()} == {1: 40, 3: 60}


def test_empty_input(spark):
    empty = events(spark, []).limit(0)
    assert time_based_split(empty).count() == 0
    assert most_recent(empty, 10).count() == 0
    assert sample_rows(empty, ["item_id"], 5).count() == 0


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    first = {r["k"] for r in sample_rows(df, ["k"], 300).collect()}
    again = {r["k"] for r in sample_rows(df.repartition(11), ["k"], 300).collect()}
    assert len(first) == 300 and first == again
    assert first != {r["k"] for r in sample_rows(df, ["k"], 300, seed=7).collect()}
    assert sample_rows(df, ["k"], 5000).count() == 2000
    assert sample_rows(df, ["k"], 0).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_broadcast(spark, how):
    left = spark.range(3000).select(F.col("id").alias("user_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("item_id"))
    right = spark.range(40).select(F.col("id").alias("item_id"), (F.col("id") * 2).alias("v"))
    small = lookup_join(left, right, "item_id", "user_id", how)
    large = lookup_join(left, right, "item_id", "user_id", how, limit=5)
    key = lambda df: sorted((r["user_id"], r["item_id"], r["v"] if r["v"] is not None else -1) for r in df.collect())
    assert key(small) == key(large)


def test_lookup_broadcasts_only_what_fits(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k").withColumn("u", F.col("k")), spark.range(60).withColumnRenamed("id", "k")
    plan = lambda limit: lookup_join(left, right, "k", "u", "left", limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(60 * 16)
    assert "broadcast" not in plan(10)


def test_lookup_measures_bytes_not_rows(spark):
    """Few rows with long values do not fit where many short ones do."""
    from playrank.operators.relational import fits_broadcast

    long = spark.range(10).select("id", F.array_repeat(F.lit(1.0), 1000).alias("vec"), F.repeat(F.lit("x"), 5000).alias("text"))
    assert not fits_broadcast(long, 100_000) and fits_broadcast(long, 200_000)
    assert fits_broadcast(spark.range(5000), 100_000) and fits_broadcast(spark.range(0), 0)


def test_rows_without_a_time_come_last_and_stay(spark):
    from playrank.operators.splitting import most_recent, time_based_split

    time = F.when(F.col("id") >= 10, F.lit("2020-01-01").cast("timestamp_ntz") + F.make_interval(days=(F.col("id") % 30).cast("int")))
    rows = spark.range(100).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("item_id"), time.alias("event_time"))
    split = time_based_split(rows).collect()
    assert len(split) == 100 and {r["split"] for r in split if r["event_time"] is None} == {"test"}
    assert sorted(r["split"] for r in split).count("test") == 20
    for n in (5, 10, 12, 95):
        kept = most_recent(rows, n).collect()
        assert len(kept) == n and sum(r["event_time"] is None for r in kept) == min(n, 10)


def test_latest_per_key_and_top_k(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "k string, v int")
    assert {(r["k"], r["v"]) for r in latest_per_key(df, ["k"], [F.col("v").desc()]).collect()} == {("a", 3), ("b", 5)}
    best = top_k_per_group(df, "k", [F.col("v").desc()], 2)
    assert {(r["k"], r["v"], r["rank"]) for r in best.collect()} == {("a", 3, 1), ("a", 2, 2), ("b", 5, 1)}


def test_top_k_prunes_before_the_shuffle(spark):
    df = top_k_per_group(spark.range(100).withColumn("g", F.col("id") % 3), "g", [F.col("id").desc()], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_quantiles_with_a_hot_value(spark):
    import numpy as np

    values = [2.0] * 400 + [float(i) / 7 for i in range(333)]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "x double, g int").repartition(5)
    got = {r["quantile"]: r["value"] for r in quantiles(df, "x", [0.0, 0.1, 0.5, 0.77, 1.0]).collect()}
    for q, v in got.items():
        assert v == pytest.approx(np.quantile(values, q))
    for r in quantiles(df, "x", [0.25, 0.9], by="g").collect():
        own = [v for i, v in enumerate(values) if i % 2 == r["g"]]
        assert r["value"] == pytest.approx(np.quantile(own, r["quantile"]))


def test_monthly_counts_fill_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 31),), (dt.datetime(2020, 4, 1),), (dt.datetime(2020, 4, 30, 23),)], "event_time timestamp_ntz")
    got = [(r["month_end"].isoformat(), r["interactions"]) for r in monthly_counts(df).orderBy("month_end").collect()]
    assert got == [("2020-01-31", 1), ("2020-02-29", 0), ("2020-03-31", 0), ("2020-04-30", 2)]


def test_correlation_is_pairwise_complete(spark):
    import numpy as np

    rng = random.Random(8)
    rows = []
    for i in range(300):
        a = rng.uniform(-1, 1)
        rows.append((1e6 + a, a * 2 + rng.uniform(-0.1, 0.1) if i % 3 else None, -a if i % 4 else None, 5.0, rng.random()))
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, noise double").repartition(4)
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in correlated_pairs(df, ["a", "b", "c", "flat", "noise"], 0.9).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (x, y), value in got.items():
        at = ["a", "b", "c"].index(x), ["a", "b", "c"].index(y)
        both = np.array([(r[at[0]], r[at[1]]) for r in rows if r[at[0]] is not None and r[at[1]] is not None])
        assert value == pytest.approx(np.corrcoef(both.T)[0, 1])


def test_heavy_keys_land_in_many_tasks(spark):
    """Half of all rows name one maker and a tenth none; the join gives what a plain one does."""
    maker = F.when(F.col("id") % 2 == 0, "big").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("m"), (F.col("id") % 700).cast("string")))
    rows = spark.range(20_000).select("id", maker.alias("maker"))
    sizes = rows.where("maker IS NOT NULL").groupBy("maker").count()
    assert heavy_values(rows, "maker") == ["big"]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = skewed_join(rows, sizes, "maker", "id")
        found = joined.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert joined.columns == ["maker", "id", "count"]
    plain = {(r["id"], r["maker"], r["count"]) for r in rows.join(sizes, "maker", "left").collect()}
    assert len(found) == 20_000 and {(r["id"], r["maker"], r["count"]) for r in found} == plain
    for value in ("big", None):
        assert len({r["task"] for r in found if r["maker"] == value}) > 15
    assert skewed_join(rows.where("id < 0"), sizes, "maker", "id").count() == 0
