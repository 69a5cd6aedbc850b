"""Whitening: the spectral split against LAPACK, the query against numpy, odd rows."""

import math

import numpy as np
import pytest

from riskframe.llm import whitening
from riskframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def spectra():
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    yield "random", (lambda x: x @ x.T)(rng.normal(size=(40, 200)))
    yield "low rank", (lambda x: x @ x.T)(rng.normal(size=(40, 9)))
    yield "repeated", q @ np.diag(np.r_[np.ones(8), np.full(8, 2.0), np.full(8, 1e-9)]) @ q.T
    yield "graded", q @ np.diag(10.0 ** -np.arange(24)) @ q.T
    yield "multiple of the identity", 3.0 * np.eye(5)
    yield "zero", np.zeros((4, 4))
    yield "negative and positive", q @ np.diag(np.linspace(-3, 5, 24)) @ q.T
    yield "one", np.array([[2.5]])


@pytest.mark.parametrize("name,a", list(spectra()))
def test_split_matches_lapack(name, a):
    values, q = whitening.eigen_split(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * scale * len(a), rtol=0)
    assert np.allclose(q.T @ q, np.eye(len(a)), atol=1e-13)
    assert np.allclose(a @ q, q * values, atol=1e-13 * scale * len(a))


def test_polar_factor_is_sign_of_spectrum():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    w = np.r_[np.linspace(-4, -1e-9, 6), np.linspace(1e-9, 4, 6)]
    assert np.allclose(whitening.polar_factor(q @ np.diag(w) @ q.T), q @ np.diag(np.sign(w)) @ q.T, atol=1e-6)
    assert whitening.polar_factor(np.diag([1.0, 0.0])) is None


def brute(vectors):
    x = np.floor(64.0 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    w, q = np.linalg.eigh(y.T @ y / n)
    w, q = w[::-1], q[:, ::-1]
    dev = [int(sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s))) for row in x]
    return n, dev, y @ q / np.sqrt(w), w / w.sum()


def test_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    got = QUERIES["op12_qdwh_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    n, dev, white, explained = brute(np.stack(table.sort_values("vec_id")["embedding"]))
    assert len(got) == n * 32 and (got["n"] == n).all() and got["identity_error"].nunique() == 1
    assert got["identity_error"].max() < 1e-9
    assert got.groupby("vec_id")["deviation"].first().tolist() == dev
    assert np.allclose(got.groupby("component")["explained"].first(), explained[:32], rtol=1e-9)
    z = got["whitened"].to_numpy().reshape(n, 32)
    sign = np.sign((z * white[:, :32]).sum(axis=0))
    assert np.allclose(z * sign, white[:, :32], atol=1e-7)


def test_rows_that_do_not_count_and_layout(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(60, 4)).astype(float)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(good)]
    odd = [(100, None, "x"), (101, [1.0, None, 0.0, 0.0], "x"), (102, [math.nan, 0.0, 0.0, 0.0], "x"),
           (103, [math.inf, 0.0, 0.0, 0.0], "x"), (104, [], "x"), (105, [1.0, 2.0], "x")]
    schema = "vec_id long, embedding array<double>, whitened string"
    one = whitening.whiten(spark.createDataFrame(rows + odd, schema).repartition(1)).toPandas()
    many = whitening.whiten(spark.createDataFrame(odd + rows[::-1], schema).repartition(7)).toPandas()
    key = ["vec_id", "component"]
    one, many = (t.sort_values(key).reset_index(drop=True) for t in (one, many))
    assert set(one["vec_id"]) == set(range(60)) and one["component"].max() == 4
    assert np.array_equal(one["whitened"], many["whitened"])  # integer sums: no trace of the layout
    n, dev, white, _ = brute(good)
    assert one.groupby("vec_id")["deviation"].first().tolist() == dev


def test_empty_single_constant_repeated(spark):
    schema = "vec_id long, embedding array<float>"
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, schema)).toPandas()
    assert not len(make([])) and not len(make([(1, [1.0, 2.0])])) and not len(make([(1, [1.0]), (2, [1.0])]))
    got = make([(1, [0.0, 1.0, 5.0]), (1, [0.0, 1.0, 5.0]), (None, [1.0, 0.0, 5.0]), (4, [3.0, 3.0, 5.0])])
    assert sorted(got["component"].unique()) == [1, 2] and len(got) == 8  # the constant dimension has no component
    same = got[got["vec_id"] == 1].groupby("component")["whitened"].nunique()
    assert (same == 1).all() and got["vec_id"].isna().sum() == 2
    assert got["identity_error"].max() < 1e-12
    assert np.allclose(got.groupby("component")["whitened"].apply(lambda v: (v ** 2).mean()), 1)


def test_deviation_beyond_a_long_is_null(spark):
    schema = "vec_id long, embedding array<double>"
    got = whitening.whiten(spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [1e15, 2.0])], schema)).toPandas()
    assert got["deviation"].isna().all()
    got = whitening.whiten(spark.createDataFrame([(1, [1e5, 0.0]), (2, [-1e5, 1.0])], schema)).toPandas()
    assert got.groupby("vec_id")["deviation"].first().tolist() == brute([[1e5, 0.0], [-1e5, 1.0]])[1]
