"""What a SQL comparison can't see: layout, size, missing values, files in another order, and where code runs."""

import os
import subprocess
import sys
import threading

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rosterline.functions.scalar import key_hash
from rosterline.operators import (
    anomaly as A, clean, ensemble as E, models as M, neighbors as N, reduce as R, score as S, split as X, tune as T)
from rosterline.operators.encode import fit_preprocessor
from rosterline.operators.evaluate import auroc_value
from rosterline.plans import QUERIES
from rosterline.session import cached
from rosterline.sources import frames, tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=400) > 0.5).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "row_key bigint, x array<double>, drafted int")
    return df.select("row_key", array_to_vector("x").alias("features"), "drafted").cache()


@pytest.mark.parametrize("spec", [
    M.ModelSpec("m", "logistic"), M.ModelSpec("m", "forest", {"trees": 5, "depth": 4}),
    M.ModelSpec("m", "gbt", {"trees": 4, "subsample": 0.7}), M.ModelSpec("m", "adaboost", {"trees": 3})], ids=lambda s: s.kind)
def test_layout_changes_no_score(rows, spec):
    scores = []
    for laid_out in (rows.repartition(2), rows.repartition(7, "features").sortWithinPartitions(F.desc("row_key"))):
        got = M.fit_model(spec, laid_out).score(rows).select("row_key", "m").collect()
        scores.append([r.m for r in sorted(got)])
    assert np.allclose(*scores, atol=1e-9)


def test_layout_changes_no_centres(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.normal(size=(300, 2))], "a double, b double")
    one, two = (R.fit_kmeans(d, ["a", "b"], 3).clusterCenters() for d in (df.repartition(2), df.repartition(5, "b")))
    assert np.allclose(sorted(map(tuple, one)), sorted(map(tuple, two)), atol=1e-9)


def test_depths_are_not_clipped(rows):
    with pytest.raises(ValueError):
        M.fit_model(M.ModelSpec("m", "forest", {"depth": 40}), rows)


@pytest.mark.parametrize("n", [640, 641, 5000])
def test_one_sampling_rule_at_any_size(spark, n):
    picked = A.tree_samples(spark.range(n), ["id"], n, 5, 32, 1).collect()
    sizes = np.bincount([r.tree for r in picked], minlength=5)
    assert sizes.max() <= 32 and sizes.min() >= 24
    if n < 1000:  # some row serves two trees
        assert len({r.id for r in picked}) < len(picked)


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_areas_with_nan_scores(spark, rows_per_range):
    from rosterline.operators.evaluate import auroc

    nan = float("nan")
    df = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.5, 0), (0.9, 1), (0.7, 0), (nan, 1), (nan, 0)], "s double, y int")
    # NaN is the largest score: wins of positives over negatives, ties half.
    assert auroc(df, "s", "y", rows_per_range=rows_per_range).first()["auroc"] == pytest.approx((1 + 3 + 3.5) / 12)


def test_csv_columns_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('pts,note,ast\n1.0,"a, ""b""",2.0\nNaN,,\n')
    got = tables.read_csv(spark, str(path), "ast double, pts double").collect()
    assert [tuple(r) for r in got] == [(2.0, 1.0), (None, None)]
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(path), "ast double, absent int")
    path.write_text('a,b\n"two\nlines",1\n')
    assert tables.read_csv(spark, str(path), "b int, a string", multiline=True).first().a == "two\nlines"


def test_vectors_without_attributes_are_measured(rows):
    model = A.OneClassModel([1.0, 2.0], 0.0)
    with pytest.raises(ValueError):
        model.transform(rows)


def test_rows_without_a_target_are_in_no_part(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 6 != 0, F.col("id") % 2).alias("y"))
    parts = X.with_stratified_part(df, "y", F.col("id"), ["id"]).collect()
    assert {r.part for r in parts if r.y is None} == {None} and {r.part for r in parts if r.y is not None} == {"train", "validation"}
    folds = X.with_stratified_fold(df, "y", F.col("id"), ["id"]).collect()
    assert {r.fold for r in folds if r.y is None} == {None}


def test_season_keys_are_distinct(spark):
    df = spark.range(3).crossJoin(spark.range(1800, 2101).toDF("year")).toDF("player_id", "year")
    assert df.select(X.season_key()).distinct().count() == df.count()


def test_large_salts(spark):
    got = spark.range(100).select(key_hash(F.col("id") + (1 << 40), 12345).alias("h")).agg(F.min("h"), F.max("h")).first()
    assert 0 <= got[0] < got[1] < 2 ** 31


def test_failed_trials_say_why_and_a_search_without_success_raises(spark, rows):
    log = T.search_holdout(M.ModelSpec("m", "logistic"), rows, rows, [{"C": -1.0}])
    assert log[0].score is None and "regParam" in log[0].error
    assert "regParam" in T.trial_table(spark, log).first().error
    with pytest.raises(RuntimeError):
        T.best_params(log)


def test_saved_ensembles(spark, rows, tmp_path):
    train, held = X.hash_parts(rows, F.col("row_key"))
    specs = [M.ModelSpec("a", "logistic"), M.ModelSpec("b", "adaboost", {"trees": 2})]
    stack = E.fit_stack_holdout(train, held, specs, held_out=rows)
    assert 0.5 < stack.validation_auroc <= 1 and stack.held_out_auroc == auroc_value(stack.score(rows), "stack", "drafted")
    for i, m in enumerate((stack, E.Vote(stack.bases))):
        m.save(spark, str(tmp_path / str(i)))
        again = M.load_model(spark, str(tmp_path / str(i)))
        assert again.score(rows).select(m.name).collect() == m.score(rows).select(m.name).collect()
    one = A.OneClassModel([1.0, 2.0, 3.0, 4.0], 0.5)
    one.save(spark, str(tmp_path / "one"))
    assert M.load_model(spark, str(tmp_path / "one")) == one


def test_one_folder_from_raw_rows_to_scores(spark, sf_dir, tmp_path):
    raw = frames.once(frames.raw_panel(spark, sf_dir))
    train = frames.train_rows(raw)
    scorer = S.RawScorer(None, None, "v4", clean.preprocess(train, "v4")[1],
                         {"part": {"column": "conf", "values": {"ASIA": "east"}, "default": "other"}})
    scorer.forest = A.fit_isolation_forest(scorer.cleaned(train), ["player_id", "year"], columns=["pts", "ht"], trees=5)
    scorer.prep = fit_preprocessor(scorer.cleaned(train), ["pts", "ht", "anomaly_score"], ["part"])
    scorer.model = M.fit_model(M.ModelSpec("m", "logistic"), scorer.features(train), key="player_id")
    scorer.save(spark, str(tmp_path / "all"))
    again = S.RawScorer.load(spark, str(tmp_path / "all"))
    test = frames.test_rows(raw)
    both = [sorted(tuple(r) for r in s.score(test).select("player_id", "m").collect()) for s in (scorer, again)]
    assert both[0] == both[1] and len(both[0]) == test.count() > 0


def test_mixture_of_means_says_when_it_stops_short():
    points = np.array([[1.0, 0.0], [0.0, 1.0], [2.0, 2.0]])
    start = np.array([0.0, 0.0, 1.0])
    with pytest.warns(RuntimeWarning, match="after 1 steps"):
        A._closest_to_origin(points, start, 1)
    assert np.allclose(A._closest_to_origin(points, start), [0.5, 0.5, 0.0])


def test_one_class_fit_says_when_it_stops_short(rows):
    with pytest.warns(RuntimeWarning):
        assert not A.fit_one_class(rows, max_iter=1, tol=1e-12).converged


def test_silhouettes_far_from_the_origin(spark):
    near = [(0.0, 1), (1.0, 1), (9.0, 2), (10.0, 2)]
    got = [[r.silhouette for r in R.silhouette(
        spark.createDataFrame([(a + shift, c) for a, c in near], "a double, c int").coalesce(1), ["a"], "c").collect()]
        for shift in (0.0, 1e9)]
    assert np.allclose(*got, atol=1e-6)


def test_neighbours_need_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "id bigint, x array<double>")
    with pytest.raises(Exception, match="no vector"):
        N.nearest(df, df, 1, q_key="id", t_key="id").collect()


def test_copies_are_spread_however_few_rows_they_come_from(spark):
    few = [(i, [float(i), 0.0], 1) for i in range(3)]
    df = spark.createDataFrame([*few, *((10 + i, [float(i), 9.0], 0) for i in range(903))], "id bigint, x array<double>, y int")
    out = N.smote(df, "id", "x", "y", k=2)
    assert out.filter("y = 1").count() == 903


def test_a_cache_entry_lasts_until_its_last_user(spark):
    df = spark.range(1000).selectExpr("id * 2 AS v")
    inside, leave = threading.Event(), threading.Event()

    def other():
        with cached(spark.range(1000).selectExpr("id * 2 AS v")):
            inside.set()
            leave.wait(20)

    t = threading.Thread(target=other)
    t.start()
    inside.wait(20)
    with cached(df) as mine:
        mine.count()
    assert df.storageLevel != StorageLevel.NONE
    leave.set()
    t.join()
    assert df.storageLevel == StorageLevel.NONE


SCANNED_ONCE = ["preprocess_v1", "preprocess_v4", "standard_scale", "minmax_scale", "fe_rate_pack", "team_tier", "auroc",
                "history_union", "rolling_test_split", "pca_project"]


@pytest.mark.parametrize("name", SCANNED_ONCE)
def test_facts_are_scanned_once(spark, sf_dir, name):
    """Input rows read by all tasks of the query: those of lineitem and orders once, and little else. (Passes over cached
    blocks count as well, so fits with dozens of passes are not listed.)"""
    spark.catalog.clearCache()
    before = _input_records(spark)
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    after = _input_records(spark)
    read = sum(n for stage, n in after.items() if stage not in before)
    facts = sum(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "orders"))
    # What is written on the way is read again, a row a season.
    assert facts <= read < 1.9 * facts, (read, facts)


def _input_records(spark):
    """Rows read from files by each stage so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, sc._jvm.java.util.ArrayList())
    return {(x.stageId(), x.attemptId()): x.inputRecords() for x in (stages.apply(i) for i in range(stages.size()))}


def test_code_reaches_executors_from_any_folder(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {ROOT!r})
from rosterline.session import build_session
from rosterline.plans import QUERIES
spark = build_session("local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
                                     "spark.checkpoint.dir": {str(tmp_path / 'shared')!r}}})
for name in ("isolation_forest", "knn_topk"):
    print("ROWS", name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("ROWS") == 2, done.stderr[-2000:]
