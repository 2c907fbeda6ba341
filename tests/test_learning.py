"""Properties of the fitted operators: bounds, one row per key, repeatability, sane ranking."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rosterline.operators import anomaly as A, ensemble as E, models as M, reduce as R, select as S, silhouettes as SIL, tune as T
from rosterline.operators.evaluate import auroc_value
from rosterline.operators.split import hash_parts, with_stratified_fold
from rosterline.plans.modelling import oversample

KINDS = [
    M.ModelSpec("logreg", "logistic", {"max_iter": 20}), M.ModelSpec("elastic", "elasticnet", {"max_iter": 20}, True),
    M.ModelSpec("svm", "svm", {"max_iter": 15, "folds": 2}), M.ModelSpec("forest", "forest", {"trees": 8, "depth": 4}),
    M.ModelSpec("gbt", "gbt", {"trees": 5}), M.ModelSpec("ada", "adaboost", {"trees": 5, "checkpoint_every": 2}),
    M.ModelSpec("sgd", "sgd", {"max_iter": 20}),
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.4 * rng.normal(size=500) > 1.0).astype(int)
    data = [(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_key bigint, x array<double>, drafted int")
    return df.select("row_key", array_to_vector("x").alias("features"), "drafted", F.col("row_key").alias("player_id")).cache()


def test_forests_keep_places_of_bounded_size(spark, rows, monkeypatch):
    """The places of rows in trees are kept up to a bound, and the forest is the same with and without them."""
    spec = M.ModelSpec("forest", "forest", {"trees": 8, "depth": 6})
    assert M.estimator(spec, 500).getCacheNodeIds() and not M.estimator(spec, M.NODE_BYTES // 32 + 1).getCacheNodeIds()
    scores = lambda: [r.forest for r in M.fit_model(spec, rows).score(rows).orderBy("row_key").collect()]
    kept = scores()
    monkeypatch.setattr(M, "NODE_BYTES", 0)
    assert scores() == kept


@pytest.mark.parametrize("spec", KINDS, ids=lambda s: s.kind)
def test_models(spark, rows, spec, tmp_path):
    model = M.fit_model(spec, rows)
    got = model.score(rows)
    values = [r[spec.name] for r in got.select(spec.name).collect()]
    assert len(values) == 500 and all(0.0 <= v <= 1.0 for v in values)
    assert auroc_value(got, spec.name, "drafted") > 0.85
    assert got.columns == [*rows.columns, spec.name]
    model.save(spark, str(tmp_path / "m"))
    again = M.load_model(spark, str(tmp_path / "m")).score(rows)
    assert [r[spec.name] for r in again.select(spec.name).collect()] == values


def test_early_stop_ends_sooner(rows):
    marked = rows.withColumn("held", F.col("row_key") % 4 == 0)
    spec = M.ModelSpec("gbt", "gbt", {"trees": 20, "validation": "held", "tol": 0.05})
    assert M.fit_model(spec, marked).pipeline.stages[0].getNumTrees < 20


def test_stacks(spark, rows, tmp_path):
    train, validation = hash_parts(rows, F.col("row_key"))
    assert train.count() + validation.count() == 500
    held = E.fit_stack_holdout(train, validation, KINDS[:1] + KINDS[3:4])
    crossed = E.fit_stack_crossfit(rows, KINDS[:1] + KINDS[3:4], folds=2)
    vote = E.Vote(held.bases)
    for m in (held, crossed, vote):
        got = m.score(rows)
        assert got.count() == 500 and auroc_value(got, m.name, "drafted") > 0.85
        assert set(got.columns) == {*rows.columns, m.name}
    held.save(spark, str(tmp_path / "s"))
    again = E.Stack.load(spark, str(tmp_path / "s")).score(rows)
    assert again.select("stack").collect() == held.score(rows).select("stack").collect()


def test_search(spark, rows):
    folded = with_stratified_fold(rows, "drafted", F.col("row_key"), ["row_key"], folds=2)
    log = T.search_cv(KINDS[0], folded, T.grid({"C": [1e-6, 1.0]}), folds=2)
    assert [t.params["C"] for t in log] == [1e-6, 1.0] and all(t.score > 0.8 for t in log)
    log = T.search_cv(KINDS[2], folded, T.grid({"C": [1.0]}), folds=2)
    assert log[0][1] > 0.85


def test_failed_trials_lose(spark, rows):
    train, validation = hash_parts(rows, F.col("row_key"))
    log = T.search_holdout(KINDS[0], train, validation, [{"C": -1.0}, {"C": 1.0}])
    assert log[0][1] is None and log[1][1] > 0.85
    table = {r.trial: r.loss for r in T.trial_table(spark, log).collect()}
    assert table[0] == float("inf") and table[1] < 0
    assert T.best_params(log) == {"C": 1.0}


def test_spaces_are_seeded_and_bounded():
    a, b = T.draws(T.SPACES["gbt"], 20, 1), T.draws(T.SPACES["gbt"], 20, 1)
    assert a == b and a != T.draws(T.SPACES["gbt"], 20, 2)
    assert all(math.exp(-5) <= p["rate"] <= 1 and p["trees"] == int(p["trees"]) and 0.5 <= p["subsample"] <= 1 for p in a)
    assert len(T.grid(T.GRIDS["gbt"])) == 27


def test_oversampling_in_feature_space(rows):
    counts = {r.drafted: r["count"] for r in oversample(rows).groupBy("drafted").count().collect()}
    assert counts[0] == counts[1] > 0


def test_isolation_forest_finds_planted_outliers(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(950, 2)), rng.normal(size=(50, 2)) + 12])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id bigint, a double, b double")
    forest = A.fit_isolation_forest(df, ["id"], trees=30)
    got = {r.id: r.anomaly_score for r in forest.transform(df).collect()}
    assert sum(v < 0 for v in got.values()) == pytest.approx(50, abs=2)
    assert np.mean([got[i] < 0 for i in range(950, 1000)]) > 0.9
    again = A.fit_isolation_forest(df.repartition(7), ["id"], trees=30)
    assert {r.id: r.anomaly_score for r in again.transform(df).collect()} == got
    forest.save(spark, str(tmp_path / "f"))
    loaded = A.IsolationForest.load(spark, str(tmp_path / "f"))
    assert {r.id: r.anomaly_score for r in loaded.transform(df).collect()} == got


def test_tree_samples_are_bounded(spark):
    df = spark.range(6000)
    for trees, sample in ((4, 64), (50, 64)):
        sizes = [r["count"] for r in A.tree_samples(df, ["id"], 6000, trees, sample, 1).groupBy("tree").count().collect()]
        assert len(sizes) == trees and max(sizes) <= sample and min(sizes) > sample // 2


def test_one_class_share(spark):
    rng = np.random.default_rng(8)
    data = [([float(a), float(b)],) for a, b in rng.normal(size=(600, 2)) * 0.3 + 3]
    df = spark.createDataFrame(data, "x array<double>").select(array_to_vector("x").alias("features"))
    model = A.fit_one_class(df)
    assert model.inliers(df).count() == pytest.approx(540, abs=1)
    assert model.weights[0] > 0 and model.weights[1] > 0  # points away from the origin


def test_pca(spark, rows):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0], [0, 0, 0.1]]) + 5
    df = spark.createDataFrame([(i, *map(float, r), 1) for i, r in enumerate(x)], "id int, a double, b double, c double, y int")
    out, model = R.apply_pca(df, k=2, target="y", keep=["id"])
    w = R.loadings(model)
    assert np.allclose(w.T @ w, np.eye(2), atol=1e-9)
    got = np.array([[r.PC1, r.PC2] for r in out.orderBy("id").collect()])
    assert np.allclose(got, (x - x.mean(axis=0)) @ w, atol=1e-8)


def test_kmeans_distance_and_silhouette(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(40, 2)) * 0.2 + c for c in ((0, 0), (5, 5), (0, 9))])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double")
    scores = R.silhouette_by_k(df, ["a", "b"], [2, 3, 4])
    assert R.best_k(scores) == 3
    out, model = R.add_kmeans_feature(df, ["a", "b"], 3)
    centres = np.array(model.clusterCenters())
    want = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(-1)).min(1)
    assert np.allclose(sorted(r.kmeans_distance for r in out.collect()), sorted(want))


def test_silhouette_special_cases(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1), (5.0, 2)], "a double, c int").coalesce(1)
    got = [r.silhouette for r in R.silhouette(df, ["a"], "c").collect()]
    assert got == pytest.approx([(25 - 1) / 25, (16 - 1) / 16, 0.0])
    with pytest.raises(ValueError):
        R.silhouette(df.filter("c = 1"), ["a"], "c")


@pytest.mark.parametrize("whole_bytes, block_rows", [(1 << 20, 100), (0, 100_000), (0, 17)])
def test_plain_silhouette(spark, whole_bytes, block_rows):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(60, 3)) + c for c in ((0, 0, 0), (6, 0, 0), (1, 1, 1), (40, 40, 40))])
    c = np.repeat(list("abcd"), 60)
    x[:5] = x[0]  # repeated rows
    x, c = np.concatenate([x, [[3.0, 3.0, 3.0]]]) + 1e4, np.append(c, "alone")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = {}
    for i, own in enumerate(c):
        mean = {g: d[i, c == g].sum() / max(1, (c == g).sum() - (g == own)) for g in set(c)}
        a, b = mean.pop(own), min(v for g, v in mean.items() if g != own)
        want[i] = 0.0 if own == "alone" else (b - a) / max(a, b)
    df = spark.createDataFrame([(i, *map(float, r), str(g)) for i, (r, g) in enumerate(zip(x, c))],
                               "id int, x double, y double, z double, c string").repartition(3)
    out = R.plain_silhouette(df, ["x", "y", "z"], "c", whole_bytes=whole_bytes, block_rows=block_rows)
    assert out.columns == [*df.columns, "silhouette"]
    got = {r.id: r.silhouette for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_plain_silhouette_special_cases(spark):
    df = spark.createDataFrame([(0.0, 1), (0.0, 1), (0.0, 2), (0.0, 2)], "a double, c int")
    for size in (0, 1 << 20):
        assert [r.silhouette for r in R.plain_silhouette(df, ["a"], "c", whole_bytes=size).collect()] == [0.0] * 4
    with pytest.raises(ValueError, match="two clusters"):
        R.plain_silhouette(df.filter("c = 1"), ["a"], "c")
    for row in ((None, 1), (1.0, None), (float("nan"), 1)):
        with pytest.raises(ValueError, match="finite"):
            R.plain_silhouette(df.union(spark.createDataFrame([row], df.schema)), ["a"], "c")
    with pytest.raises(ValueError, match="plain or squared"):
        R.silhouette_by_k(df, ["a"], [2], distance="city")


def test_clusters_are_ruled_out(spark):
    x = np.array([[0.0], [1.0], [10.0], [11.0], [100.0], [101.0]]) - 37.0
    own = np.array([0, 0, 1, 1, 2, 2])
    n = np.array([2.0, 2.0, 2.0])
    m = SIL.Moments([], None, n, np.array([(x[own == g] ** 2).sum() for g in range(3)]), np.array([x[own == g].sum(0) for g in range(3)]))
    assert SIL.needed_clusters(x, own, m).tolist() == [[True, True, False]] * 4 + [[False, True, True]] * 2


def test_selection(spark):
    rng = np.random.default_rng(1)
    data = [(int(y), float(y + rng.normal() * 0.1), float(rng.normal()), "u" if y else "v", "abcd"[rng.integers(4)], "k_1")
            for y in rng.integers(0, 2, 300)]
    df = spark.createDataFrame(data, "drafted int, good double, noise double, tell string, dull string, under_score string")
    kept = S.select_features(df, top_numeric=1, top_categorical=2, trees=5, depth=3)
    assert kept.columns == ["good", "tell", "drafted"]
    left = S.remove_features(df, bottom_numeric=1, bottom_categorical=1, trees=5, depth=3)
    assert "noise" not in left.columns and "under_score" not in left.columns
    assert S.importance_topk(df, "drafted", ["good", "noise"], ["tell"], k=2, trees=10, depth=2).count() == 2


@pytest.mark.parametrize("whole_bytes", [1 << 20, 0])
def test_silhouettes_of_several_clusterings_share_distances(spark, whole_bytes):
    from rosterline.operators.silhouettes import mean_plain_silhouettes

    rng = np.random.default_rng(8)
    rows = [(float(a) + 1e5, float(b), int(i % 3) * 10, int(a > 0), 7 if i else 9) for i, (a, b) in enumerate(rng.normal(size=(150, 2)))]
    rows += rows[:5]  # copies
    df = spark.createDataFrame(rows, "x double, y double, c1 int, c2 int, c3 int").repartition(3)
    got = mean_plain_silhouettes(df, ["x", "y"], ["c1", "c2", "c3"], whole_bytes=whole_bytes)
    each = [R.plain_silhouette(df, ["x", "y"], c).agg(F.avg("silhouette")).first()[0] for c in ("c1", "c2", "c3")]
    assert got == pytest.approx(each, rel=1e-9, abs=1e-9)
    with pytest.raises(ValueError, match="two clusters"):
        mean_plain_silhouettes(df.withColumn("c2", F.lit(1)), ["x", "y"], ["c1", "c2"], whole_bytes=whole_bytes)
    with pytest.raises(ValueError, match="finite"):
        mean_plain_silhouettes(df.withColumn("x", F.lit(None).cast("double")), ["x", "y"], ["c1", "c2"], whole_bytes=whole_bytes)


def test_a_distance_serves_all_groups_of_a_row():
    from rosterline.operators.silhouettes import distance_sums, labelled_sums

    rng = np.random.default_rng(9)
    v, t = rng.normal(size=(130, 4)), rng.normal(size=(5000, 4))
    t[:130] = v
    labels = np.stack((rng.integers(0, 2, 5000), 2 + rng.integers(0, 3, 5000)), axis=1)
    got = labelled_sums(v, t, labels, 5)
    for g in range(5):
        assert got[:, g] == pytest.approx(distance_sums(v, t[(labels == g).any(1)], np.zeros(1, int))[:, 0], rel=1e-12)


def test_rows_of_one_partition_meet_the_others_in_many_tasks(spark):
    rows = [(float(i % 7), float(i % 11), i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, c int").coalesce(1)
    assert R.plain_silhouette(df, ["x", "y"], "c").rdd.getNumPartitions() >= 8


def test_embedding_columns_cast_no_vector_whole(spark, sf_dir):
    from rosterline.plans.vectors import _embedding_columns

    emb, cols = _embedding_columns(spark, sf_dir)
    assert "array<double>" not in emb._jdf.queryExecution().optimizedPlan().toString()
    assert emb.schema[cols[0]].dataType.simpleString() == "double"


def test_distance_sums_of_groups_across_tiles():
    from rosterline.operators.silhouettes import distance_sums

    rng = np.random.default_rng(10)
    v, t = rng.normal(size=(70, 3)), rng.normal(size=(9000, 3))
    starts = np.array([0, 10, 4096, 4097, 8500])
    each = np.sqrt(((v[:, None] - t[None]) ** 2).sum(axis=2))
    assert distance_sums(v, t, starts) == pytest.approx(np.add.reduceat(each, starts, axis=1), rel=1e-12)


def test_mean_silhouettes_of_many_rows_take_no_copies(spark, monkeypatch):
    """Beyond the byte bound parts meet one after another for all clusterings: rows are not copied to blocks of other rows."""
    monkeypatch.setattr(SIL, "_in_blocks", None)
    monkeypatch.setattr(SIL, "PACK_ROWS", 16)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(150, 2)), 1)
    x[:20] = x[0]
    labels = np.stack([rng.integers(0, k, 150) for k in (2, 3, 6)], axis=1)
    labels[7, 2] = 9  # alone in its cluster
    df = spark.createDataFrame([(*map(float, v), *map(int, c)) for v, c in zip(x, labels)], "a double, b double, c0 int, c1 int, c2 int")
    got = SIL.mean_plain_silhouettes(df, ["a", "b"], ["c0", "c1", "c2"], whole_bytes=16 * 40 * 2)
    far = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    for c, mean in zip(labels.T, got):
        each = []
        for i in range(150):
            others = [far[i, c == g].mean() for g in set(c.tolist()) - {c[i]}]
            inside = far[i, c == c[i]].sum() / max((c == c[i]).sum() - 1, 1)
            top = max(inside, min(others))
            each.append(0.0 if (c == c[i]).sum() == 1 or top <= 0 else (min(others) - inside) / top)
        assert mean == pytest.approx(np.mean(each), rel=1e-12)
