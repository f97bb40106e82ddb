"""Whitened embeddings against a dense eigendecomposition."""

import numpy as np
import pytest

from recordmill.llm import whitening
from recordmill.llm.queries import QUERIES


def want(rows):
    """n, S, deviations by id, V's eigenvalues and vectors, by plain numpy and Python integers."""
    x = [[int(np.floor(256.0 * float(c))) for c in v] for _, v in rows]
    distinct = np.array(sorted(set(map(tuple, x))))
    n, sums = len(distinct), [int(s) for s in distinct.astype(object).sum(axis=0)]
    centred = distinct - distinct.mean(axis=0)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return n, np.array(sums), deviation, e[::-1], u[:, ::-1], np.array(x)


def compared(got, rows):
    n, sums, deviation, e, u, x = want(rows)
    white = (x - sums / n) @ u[:, :4] / np.sqrt(e[:4])
    by = {}
    for r in got:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r)
    assert sorted(by) == list(range(1, min(4, len(e)) + 1))
    for k, found in by.items():
        mine = np.array([found[i].pop()["whitened"] for i, _ in rows])
        sign = np.sign(mine @ white[:, k - 1])
        assert np.allclose(mine * sign, white[:, k - 1], atol=1e-8)
    assert {r["n"] for r in got} == {n}
    assert all(abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-10 for r in got)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    of = {i: d for (i, _), d in zip(rows, deviation, strict=True)}
    assert all(r["deviation"] == of[r["vec_id"]] for r in got)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op12_whitening"](spark, folder).collect()
    assert len(got) == 4 * len(rows)
    compared(got, rows)


def test_hard_rows(spark):
    dice = np.random.default_rng(1)
    good = [(i, [float(c) for c in dice.normal(0, [3, 2, 1, 0.5, 0.4])]) for i in range(60)]
    good += [(60, good[0][1]), (61, good[0][1])]  # repeats count once in the fit
    bad = [(None, None), (70, None), (71, [1.0, None, 0.0, 0.0, 0.0]), (72, [float("nan")] * 5), (73, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (74, [1.0, 2.0]), (75, [])]
    table = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in good + bad], "vec_id long, embedding array<float>, n string, x string, component string")
    rows = [(r["vec_id"], r["embedding"]) for r in table.where("vec_id < 70").collect()]
    got = whitening.whiten(table).collect()
    assert {r["vec_id"] for r in got} == set(range(62))
    compared(got, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_no_variance(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() == []


def test_few_dimensions_and_zero_eigenvalues(spark):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.5, 1.0]), (None, [0.5, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["component"], r["vec_id"] or 0) for r in got) == [(1, 0), (1, 1), (1, 2), (1, 3)]
    assert all(abs(r["explained"] - 1) < 1e-12 for r in got)


def test_exact_beyond_a_long():
    c = whitening.Centre(3_000_000_000, [5, -7])
    assert c.deviation(np.array([[1, 2], [0, 0]])) == [None, 25 + 49]
    c = whitening.Centre(3, [5, -7])
    assert c.deviation(np.array([[1, 2], [0, -3]])) == [4 + 169, 25 + 4]
    assert whitening.whole_sums(np.array([[1 << 61, -1], [1 << 61, 2], [1 << 61, 2], [1 << 61, 2]])) == [1 << 63, 5]


def test_filter_finds_components_of_a_flat_spectrum(spark):
    dice = np.random.default_rng(7)
    x = np.floor(256 * dice.normal(0, 1, (3000, 96)) * np.linspace(1.2, 0.8, 96))
    fit = spark.createDataFrame([([int(c) for c in v],) for v in x], "x array<long>").repartition(5)
    centre = whitening.centre_of(fit, 96)
    found = whitening.components(fit, centre)
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(found.values, e[::-1][:4], rtol=1e-12)
    assert np.allclose(np.abs((u[:, ::-1][:, :4] * found.vectors).sum(axis=0)), 1, atol=1e-12)
    assert found.passes > 2 * whitening.DEGREE
