import random

from playrank.llm.runs import components, join_by_share, split_by_keys


def test_components_with_a_hub(spark):
    rng = random.Random(2)
    edges = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(60)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_hot_and_rare_keys_join_alike(spark):
    left = [(0, k) for k in range(5000)] + [(k, k) for k in range(1, 3000)]
    right = [(0, 5000, "hot"), *[(k, 1, f"v{k}") for k in range(1, 3000, 2)]]
    got = join_by_share(spark.createDataFrame(left, "k bigint, x bigint"), spark.createDataFrame(right, "k bigint, n bigint, v string"), ["k"], len(left))
    assert got.columns == ["k", "x", "v"]
    names = {k: v for k, _, v in right}
    assert sorted(map(tuple, got.collect())) == sorted((k, x, names[k]) for k, x in left if k in names)


def test_rows_split_by_keys(spark):
    rows = spark.range(20_000).selectExpr("id * 7919 AS key", "id AS x")
    keys = rows.where("x % 97 = 0").select("key")
    asked, others = split_by_keys(rows, "key", keys)
    asked, others = [r["x"] for r in asked.collect()], [r["x"] for r in others.collect()]
    assert sorted(asked + others) == list(range(20_000))
    assert set(range(0, 20_000, 97)) <= set(asked) and len(asked) < 2000
    none, every = split_by_keys(rows, "key", keys.limit(0))
    assert none.count() == 0 and every.count() == 20_000
