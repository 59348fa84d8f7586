import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from playrank.llm.queries import whitening
from playrank.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<double>"


def usable(vector):
    return vector is not None and len(vector) > 0 and all(c is not None and math.isfinite(c) for c in vector)


def plain(rows, weights="copies"):
    """Lattice vectors, exact deviations, covariance, all from Python numbers."""
    kept = [(k, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for k, v in rows if usable(v)]
    fit = [x for _, x in kept] if weights == "copies" else sorted({x for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    deviation = [sum((n * x[i] - sums[i]) ** 2 for i in range(d)) for _, x in kept]
    y = np.array([[(n * x[i] - sums[i]) / n for i in range(d)] for x in fit])
    return kept, n, sums, deviation, y.T @ y / n


def table(n=400, d=12, seed=0, same=130):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) @ np.diag(np.linspace(2, 0.2, d))
    rows = [(k, base[k].tolist()) for k in range(n)]
    rows += [(n + k, base[3].tolist()) for k in range(same)]  # a hot vector
    return rows


@pytest.mark.parametrize("weights", ["copies", "one"])
def test_against_plain_numbers(spark, weights):
    rows = table()
    kept, n, sums, deviation, cov = plain(rows, weights)
    got, model = whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), components=8, weights=weights)
    found = {r["vec_id"]: r for r in got.collect()}
    assert len(found) == len(rows) and (model.n, model.sums) == (n, sums)
    values = np.linalg.eigvalsh(cov)[::-1]
    assert np.allclose(model.values, values[:8], rtol=1e-11)
    assert np.allclose(cov @ model.vectors, model.vectors * model.values, atol=1e-9 * values[0])
    assert np.allclose(model.vectors.T @ model.vectors, np.eye(8), atol=1e-12)
    assert np.allclose(model.explained, values[:8] / values.sum(), rtol=1e-10) and model.identity_error < 1e-10
    for (k, x), dev in zip(kept, deviation, strict=True):
        assert int(found[k]["deviation"]) == dev
        y = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
        assert np.allclose(found[k]["whitened"], y @ model.vectors / np.sqrt(model.values), atol=1e-10)


def test_hot_and_other_vectors_take_both_ways(spark, monkeypatch):
    import playrank.llm.whitening as module

    rows = table(seed=3)
    whole = {r["vec_id"]: r for r in whiten(spark.createDataFrame(rows, SCHEMA))[0].collect()}
    monkeypatch.setattr(module, "HOT", 10)
    df, _ = whiten(spark.createDataFrame(rows, SCHEMA))
    split = {r["vec_id"]: r for r in df.collect()}
    assert whole.keys() == split.keys() == {k for k, _ in rows}
    assert all(np.allclose(whole[k]["whitened"], split[k]["whitened"], atol=1e-9) for k in whole)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = table(60, 4, 5, 10)
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [nan, 1.0, 0.0, 0.0]), (904, [inf, 0.0, 0.0, 0.0]), (905, [1.0, 2.0]), (906, [1e300, 0.0, 0.0, 0.0])]
    rows = good + odd + [(None, [0.5, -0.25, 0.0, 1.0]), (7, [0.5, -0.25, 0.0, 1.0])]  # a null id and a repeated one
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("x", "digest", "key", "copies", "weight", "whitened", "n", "at")})
    got, model = whiten(docs)
    found = got.collect()
    assert len(found) == len(good) + 2 == model.n and {r["vec_id"] for r in found} == {k for k, _ in good} | {None}
    assert all(len(r["whitened"]) == 4 for r in found)


def test_huge_entries_stay_exact(spark):
    rows = [(k, [float(v), float(k % 3)]) for k, v in enumerate([1e15, -1e15, 3e15, 12345.0, 1e15 + 2])]
    kept, n, sums, deviation, _ = plain(rows)
    got, model = whiten(spark.createDataFrame(rows, SCHEMA))
    assert model.sums == sums
    assert {r["vec_id"]: int(r["deviation"]) for r in got.collect()} == {k: d for (k, _), d in zip(kept, deviation, strict=True)}


def test_directions_without_spread_and_empty_tables(spark):
    flat = [(k, [float(k), 1.0, 2.0 * k]) for k in range(20)]
    got, model = whiten(spark.createDataFrame(flat, SCHEMA))
    assert len(model.values) == 1 and {len(r["whitened"]) for r in got.collect()} == {1}
    alone, model = whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA))
    assert [r["whitened"] for r in alone.collect()] == [[]] * 3 and model.n == 3
    none, model = whiten(spark.createDataFrame([(1, None)], SCHEMA))
    assert none.collect() == [] and model.n == 0


def test_query(spark, tmp_path):
    rows = [(k, v) for k, v in table(300, 40, 9, 100)]
    spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "cast(embedding AS array<float>) AS embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    single = [(k, [float(np.float32(c)) for c in v]) for k, v in rows]
    kept, n, sums, deviation, cov = plain(single)
    got = whitening(spark, str(tmp_path)).toPandas()
    assert len(got) == len(rows) * 32 and set(got.component) == set(range(1, 33)) and set(got.n) == {n}
    values = np.linalg.eigvalsh(cov)[::-1][:32]
    assert np.allclose(got.groupby("component").explained.first(), values / np.trace(cov), rtol=1e-9)
    assert got.groupby("vec_id").deviation.first().to_dict() == {k: d for (k, _), d in zip(kept, deviation, strict=True)}
    white = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    error = np.abs(np.cov(white.T, bias=True) - np.eye(32)).max()
    assert error < 1e-9 and got.identity_error.nunique() == 1 and abs(got.identity_error[0] - error) < 1e-9
