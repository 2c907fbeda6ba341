"""The one-class fit over packed blocks against plain numpy and against the way for few rows."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from rosterline.operators import anomaly as A


def frame(spark, x):
    return spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3).select(array_to_vector("x").alias("features"))


def points(n=3000, seed=5):
    rng = np.random.default_rng(seed)
    hot = np.eye(4)[rng.integers(0, 4, n)]
    return np.hstack((rng.normal(1.0, 0.3, (n, 3)), hot, rng.integers(0, 2, (n, 1))))


def test_packed_blocks_give_their_rows_back():
    x = points(200)
    block = A._packed(x)
    w = np.arange(1.0, 9.0)
    assert list(block[1]) == [3, 4, 5, 6, 7] and (A._unpacked(block, np.arange(200)) == x).all()
    assert np.allclose(A._margins(block, w), x @ w) and np.allclose(A._total(block, x[:, 0] > 1), x[x[:, 0] > 1].sum(0))


@pytest.mark.parametrize("nu", [0.1, 0.5, 0.037])
def test_mean_of_the_lowest_share_takes_no_quantile_pass(spark, monkeypatch, nu):
    x = np.vstack([points()] * 2)  # every row twice
    w = np.linspace(-1, 2, 8)
    packed = A._Packed(frame(spark, x), "features")
    monkeypatch.setattr(A, "exact_quantiles", None)
    m = x @ w
    want = x[m <= np.quantile(m, nu) + 1e-12].mean(0)
    assert np.allclose(packed.lowest(w, nu, len(x), packed.sample(500)), want)
    assert np.allclose(packed.lowest(w, nu, len(x), packed.sample(500), most=2 * len(x)), want)
    assert packed.lowest(w, nu, len(x), packed.sample(500), most=0) is None
    packed.table.unpersist()


def test_both_ways_find_the_same_machine(spark):
    x = points()
    df = frame(spark, x)
    plain, packed = (A.fit_one_class(df, packed_rows=n) for n in (1 << 30, 0))
    assert packed.converged and np.allclose(plain.weights, packed.weights, atol=1e-3) and abs(plain.rho - packed.rho) < 1e-3
    same = np.full((500, 2), 2.0)  # one margin for all
    one = A.fit_one_class(frame(spark, same), packed_rows=0)
    assert one.weights == [2.0, 2.0] and one.rho == 8.0
