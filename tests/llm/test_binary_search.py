import numpy as np
import pytest

from playrank.llm.binary_search import search_codes, sign_code


def brute(rows, queries, k):
    rows = [(i, c) for i, c in rows if i is not None and c is not None]
    result = []
    for q, code in queries:
        if q is None or code is None:
            continue
        near = sorted(((code ^ c) & ((1 << 64) - 1)).bit_count() * (1 << 40) + i for i, c in rows)[:k]
        result += [(q, n + 1, x % (1 << 40), x >> 40) for n, x in enumerate(near)]
    return sorted(result)


def codes(n, clusters, noise, seed):
    rng = np.random.default_rng(seed)
    centre = rng.integers(-(1 << 63), 1 << 63, clusters, dtype=np.int64)
    rows = []
    for i in range(n):
        code = int(centre[rng.integers(clusters)])
        for b in rng.integers(0, 64, rng.integers(0, noise + 1)):
            code ^= 1 << int(b)
        rows.append((i, code if code < 1 << 63 else code - (1 << 64)))
    return [(i, ((c + (1 << 63)) % (1 << 64)) - (1 << 63)) for i, c in rows]


@pytest.mark.parametrize(("n", "clusters", "noise", "k"), [(300, 300, 0, 10), (600, 5, 12, 7), (500, 2, 1, 10), (30, 30, 0, 50)])
def test_against_brute_force(spark, n, clusters, noise, k):
    rows = codes(n, clusters, noise, n)
    queries = rows[:: max(1, n // 12)]
    schema = "id bigint, code bigint"
    got = search_codes(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), k)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, queries, k)


def test_wide_segments_and_prefixes(spark):
    """More codes than a group holds, so that queries visit several prefixes."""
    import playrank.llm.binary_search as module

    rows = codes(5000, 40, 20, 8)
    queries = rows[::500]
    schema = "id bigint, code bigint"
    before = module.GROUP_CODES, module.LITERALS
    try:
        for module.GROUP_CODES, module.LITERALS in ((64, 512), (64, 3)):
            got = search_codes(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), 10)
            assert sorted(tuple(r) for r in got.collect()) == brute(rows, queries, 10)
    finally:
        module.GROUP_CODES, module.LITERALS = before


def test_equal_codes_nulls_and_empty_sides(spark):
    schema = "id bigint, code bigint, bound string"
    rows = [(i, 5 if i < 30 else i, "x") for i in range(40)] + [(None, 5, "x"), (41, None, "x")]
    table = spark.createDataFrame(rows, schema)
    got = search_codes(table, table.where("id IN (3, 35, 41)"), 4)
    assert sorted(tuple(r) for r in got.collect()) == brute([r[:2] for r in rows], [(3, 5), (35, 35)], 4)
    assert search_codes(table.limit(0), table, 4).count() == 0
    assert search_codes(table, table.limit(0), 4).count() == 0
    with pytest.raises(ValueError, match="k must"):
        search_codes(table, table, 0)


def test_sign_codes(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=64).tolist()) for i in range(20)] + [(20, None), (21, [0.0] * 64), (22, [1.0] * 70)]
    got = {r["id"]: r["code"] for r in spark.createDataFrame(vectors, "id bigint, v array<float>").select("id", sign_code("v").alias("code")).collect()}
    for i, v in vectors[:20]:
        assert got[i] & ((1 << 64) - 1) == sum(1 << b for b, x in enumerate(v) if x > 0)
    assert got[20] is None and got[21] == 0 and got[22] == -1
