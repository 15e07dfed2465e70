"""Whitening against numpy's eigenvectors."""

import numpy as np
import pytest

from tillroll.llm import whitening

from .conftest import with_clashes

SCHEMA = "vec_id bigint, embedding array<double>"


def by_hand(vectors, components, scale=64.0, offset=1_000_000):
    dims = max(map(len, vectors))
    x = np.array([[np.floor(scale * v[i]) if i < len(v) else 0 for i in range(dims)] for v in vectors]).astype(np.int64) + offset
    n, sums = len(x), x.sum(axis=0)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    y = (n * x - sums) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    keep = e > 1e-12 * np.trace(y.T @ y / n)
    return exact, y @ q[:, keep] / np.sqrt(e[keep]), e[keep] / np.trace(y.T @ y / n)


def check(spark, vectors, components=32, sharp=True, **how):
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(vectors)]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(4)
    out = whitening.whiten(df, components, **how).toPandas().sort_values(["vec_id", "component"])
    exact, white, explained = by_hand(vectors, components, **how)
    k = len(explained)
    assert len(out) == k * len(vectors) and set(out["n"]) == {len(vectors)}
    assert out["component"].tolist() == list(range(1, k + 1)) * len(vectors)
    assert out["deviation"].tolist() == [d for d in exact for _ in range(k)]
    assert np.abs(out["explained"].to_numpy().reshape(-1, k) - explained).max() < 1e-10
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9
    got = out["whitened"].to_numpy().reshape(-1, k)
    assert np.abs(got.T @ got / len(vectors) - np.eye(k)).max() < 1e-9
    if sharp:
        assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < 1e-8
    return out


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    check(spark, rng.standard_normal((400, 40)) * np.linspace(3, 0.5, 40))


def test_few_components_of_many_dimensions(spark):
    rng = np.random.default_rng(2)
    check(spark, rng.standard_normal((300, 6)) * [9, 7, 5, 4, 3, 2] @ rng.standard_normal((6, 90)) + 0.05 * rng.standard_normal((300, 90)), 4)


def test_a_third_of_all_rows_alike(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 12))
    vectors[::3] = 5
    check(spark, vectors)


def test_equal_deviations_and_empty_dimensions(spark):
    corners = [[a, b, c, 7, 0] for a in (-1, 1) for b in (-1, 1) for c in (-2, 2)]  # two equal deviations, two of zero
    out = check(spark, corners, sharp=False)
    assert out["component"].max() == 3


def test_shorter_vectors(spark):
    check(spark, [[1, 2, 3], [4], [], [2, 2], [9, 0, 1], [-3, 5, 8]])


def test_large_offsets_do_not_blur(spark):
    rng = np.random.default_rng(5)
    check(spark, rng.standard_normal((100, 5)) * 4 + 1e6)


def test_edges(spark):
    bad = [None, [None, 1.0], [float("nan"), 1.0], [1.0, float("inf")], [1.0, float("-inf")]]
    good = [(None, [1.0, 2.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (8, [0.0, -1.0])]
    rows = [*((90 + i, v) for i, v in enumerate(bad)), *good]
    out = whitening.whiten(with_clashes(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(str(r["vec_id"]) for r in out.where("component = 1").collect()) == ["7", "7", "8", "None"]
    assert {r["n"] for r in out.collect()} == {4}
    assert whitening.whiten(spark.createDataFrame(rows[:5], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).columns == out.columns
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, [])], SCHEMA)).count() == 0


def test_what_a_long_cannot_hold_is_refused(spark):
    with pytest.raises(Exception, match="beyond 2 \\*\\* 40"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [0.0])], SCHEMA))
    with pytest.raises(ValueError, match="beyond a long"):
        whitening.whiten(spark.createDataFrame([(1, [1e10]), (2, [0.0]), (3, [0.0])], SCHEMA))
