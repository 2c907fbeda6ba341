"""Linear models of many penalties and folds in shared passes against single fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pair_area import auroc

from rosterline.operators import linear as L, tune as T
from rosterline.operators.models import ModelSpec, fit_model, load_model


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = (x @ [1.0, -2.0, 0.3, 0.0] + rng.normal(size=300) > 0.5).astype(int)
    data = [(i, [float(v) for v in r], int(t), i % 3) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "row_key long, x array<double>, drafted int, fold int") \
        .withColumn("features", array_to_vector("x")).repartition(4).cache()


def test_weights_as_by_single_fits(rows):
    settings = [L.LinearSetting("logistic", c, held=f) for c in (0.01, 1.0, 50.0) for f in (0, 2)] + \
        [L.LinearSetting("elasticnet", c, 0.5, held=1) for c in (0.02, 0.5)]
    got = L.fit_linear_many(L.dense_rows(rows, fold="fold"), settings)
    for s, w in zip(settings, got):
        part = rows.filter(F.col("fold") != s.held).withColumn("drafted", F.col("drafted").cast("double"))
        one = LogisticRegression(labelCol="drafted", regParam=1 / (s.C * part.count()), elasticNetParam=s.l1_ratio,
                                 standardization=False, maxIter=1000, tol=1e-12).fit(part)
        assert np.allclose(w, [*one.coefficients.toArray(), one.intercept], atol=1e-5)


def hinge_objective(w, x, y, c):
    return np.maximum(0, 1 - (2 * y - 1) * (x @ w[:-1] + w[-1])).mean() + 0.5 / (c * len(y)) * (w[:-1] ** 2).sum()


def test_linear_machine_near_the_least_hinge_loss(rows):
    data = rows.orderBy("row_key").collect()
    x, y = np.array([r.x for r in data]), np.array([r.drafted for r in data])
    for c in (0.01, 1.0):
        w = L.fit_linear_many(L.dense_rows(rows), [L.LinearSetting("svm", c)])[0]
        value, rng = hinge_objective(w, x, y, c), np.random.default_rng(0)
        assert all(hinge_objective(w + d * rng.normal(size=5), x, y, c) > value - L.HINGE / 2 for d in (0.01, 0.1, 1.0) for _ in range(50))


def test_layouts_balance_and_one_class(spark, rows):
    s = [L.LinearSetting("logistic", 1.0, balanced=True), L.LinearSetting("svm", 0.5, balanced=True)]
    a, b = (L.fit_linear_many(L.dense_rows(rows.repartition(n)), s) for n in (2, 7))
    assert (a == b).all()
    weight = {k: 300 / (2 * n) for k, n in rows.groupBy("drafted").count().collect()}
    weighed = rows.withColumn("w", F.when(F.col("drafted") == 1, weight[1]).otherwise(weight[0])).withColumn("drafted", F.col("drafted").cast("double"))
    one = LogisticRegression(labelCol="drafted", weightCol="w", regParam=1 / 300, standardization=False, maxIter=1000, tol=1e-12).fit(weighed)
    assert np.allclose(a[0], [*one.coefficients.toArray(), one.intercept], atol=1e-5)


def test_settings_in_groups_are_the_same(rows, monkeypatch):
    s = [L.LinearSetting("logistic", c) for c in (0.1, 1.0, 10.0)]
    dense = L.dense_rows(rows)
    whole = L.fit_linear_many(dense, s)
    assert np.allclose(whole, L.fit_linear_many(dense, s, task_bytes=0), atol=1e-9)
    monkeypatch.setattr(L, "PASS_BYTES", 1)
    assert np.allclose(whole, L.fit_linear_many(dense, s, task_bytes=0), atol=1e-9)


def test_models_score_and_reload(spark, rows, tmp_path):
    y = [r.drafted for r in rows.orderBy("row_key").collect()]
    for kind in ("logistic", "elasticnet", "svm"):
        model = fit_model(ModelSpec("m", kind, {"solver": "newton", "C": 0.5}), rows)
        model.save(spark, f"{tmp_path}/{kind}")
        got = [[r.m for r in m.score(rows).orderBy("row_key").collect()] for m in (model, load_model(spark, f"{tmp_path}/{kind}"))]
        assert got[0] == got[1] and auroc(got[0], y) > 0.95 and all(0 < p < 1 for p in got[0])


def test_searches(rows):
    log = T.search_cv(ModelSpec("m", "logistic"), rows, [{"C": 0.1}, {"C": -1.0}, {"C": 10.0}], folds=3)
    assert log[1].score is None and "above 0" in log[1].error and min(log[0].score, log[2].score) > 0.9
    held = T.search_holdout(ModelSpec("m", "svm"), rows.filter("fold > 0"), rows.filter("fold = 0"), [{"C": 0.1}, {"C": 1.0}])
    assert all(t.score > 0.9 for t in held)


def test_shared_passes_begin_close_to_the_solution(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8000, 4))
    y = (x @ [1.0, -2.0, 0.3, 0.0] + rng.normal(size=8000) > 0.5).astype(int)
    data = spark.createDataFrame([(i, r.tolist(), int(t)) for i, (r, t) in enumerate(zip(x, y))], "row_key long, x array<double>, drafted int") \
        .withColumn("features", array_to_vector("x"))
    dense, passes, one = L.dense_rows(data), [], L._pass
    monkeypatch.setattr(L, "_pass", lambda *a: passes.append(a[1][0].kind) or one(*a))
    for kind, most in (("logistic", 4), ("svm", 30)):  # from zero on: 8 of the first kind
        s = [L.LinearSetting(kind, c) for c in (0.01, 1.0)]
        whole = L.fit_linear_many(dense, s)
        assert np.allclose(whole, L.fit_linear_many(dense, s, task_bytes=dense.size // 2), atol=1e-3 if kind == "svm" else 1e-7)
        assert 0 < passes.count(kind) <= most, passes.count(kind)
    monkeypatch.setattr(L, "PART_BYTES", dense.size // 20)
    assert L.dense_rows(data).blocks.select("part").distinct().count() > 8
