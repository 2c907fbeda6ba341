import time

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rosterline.operators.quantiles import exact_quantiles, medians, modes

PROBS = [0.0, 0.05, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]


def check(spark, data, **kw):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in data], "x double").repartition(4)
    got = exact_quantiles(df, {"x": (F.col("x"), PROBS)}, **kw)["x"]
    present = [float(v) for v in data if v is not None]
    want = np.quantile(present, PROBS) if present else [None] * len(PROBS)
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12) if present else got == list(want)


RNG = np.random.default_rng(1)


@pytest.mark.parametrize("data", [
    RNG.normal(size=3000),
    np.concatenate([np.zeros(1000), RNG.exponential(size=2000)]),  # a third of all rows share one value
    np.concatenate([np.full(1500, 7.0), np.full(1499, -7.0), [0.0]]),
    RNG.integers(0, 3, size=2000),
    np.exp(RNG.normal(scale=30, size=1500)),  # many orders of magnitude
    [None] * 50 + list(range(200)),
    [4.0], [None, None], [1.0, 2.0],
])
def test_narrowing_is_exact(spark, data):
    check(spark, data, direct=40, accuracy=20)


def test_direct_path(spark):
    check(spark, RNG.normal(size=999))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, -2.5]), st.floats(-1e6, 1e6)), max_size=60))
def test_narrowing_property(spark, data):
    check(spark, data, direct=5, accuracy=10)


def test_several_columns_share_passes(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"), (F.col("id") * -2.0).alias("b"))
    assert medians(df, ["a", "b"], direct=20, accuracy=50) == {"a": 500.0, "b": -1000.0}


def test_mode_prefers_smallest_on_ties_and_skips_nulls(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), (None,), (None,), (None,)], "k string")
    assert modes(df, ["k"]) == {"k": "a"}
    assert modes(df.filter("k is null"), ["k"]) == {"k": None}


def test_many_quantiles_of_many_columns_take_few_passes(spark):
    """One sketch per column and one pass per step, not some of each per quantile."""
    probs = [i / 64 for i in range(64)]
    columns = [f"x{i}" for i in range(16)]
    values = np.random.default_rng(5).normal(size=(5000, 16))
    values[:, 10:] = values[:, 10:] > 0.5
    df = spark.createDataFrame([tuple(map(float, r)) for r in values], ", ".join(f"{c} double" for c in columns)).repartition(4).cache()
    df.count()
    start = time.monotonic()
    got = exact_quantiles(df, {c: (F.col(c), probs) for c in columns}, direct=16 * 1000, accuracy=1000)
    seconds = time.monotonic() - start
    df.unpersist()
    for i, c in enumerate(columns):
        assert got[c] == pytest.approx(list(np.quantile(values[:, i], probs)), rel=1e-12, abs=1e-12)
    assert seconds < 30


def test_sketches_of_columns_meet_in_tasks_of_their_own(spark, monkeypatch):
    from rosterline.operators import quantiles as Q

    wide = []
    plain = Q._agg_row
    monkeypatch.setattr(Q, "_agg_row", lambda df, exprs: (wide.append([str(e) for e in exprs]), plain(df, exprs))[1])
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).cast("double").alias("a"), (F.col("id") % 50).cast("double").alias("b"))
    got = Q.exact_quantiles(df, {c: (F.col(c), [0.25, 0.5, 0.9]) for c in "ab"}, direct=100, accuracy=100)
    rows = df.toPandas()
    assert got == {c: pytest.approx(list(rows[c].quantile([0.25, 0.5, 0.9]))) for c in "ab"}
    assert not any("percentile_approx" in e for exprs in wide for e in exprs)
