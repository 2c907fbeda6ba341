"""Classifier, ensemble and search queries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.scalar import hash_bucket
from ..operators import clean as C, ensemble as E, neighbors as N, reduce as R, tune as T
from ..operators.encode import Scaler, fit_preprocessor
from ..operators.evaluate import auroc_value
from ..operators.models import ModelSpec, fit_model, fit_models, scored
from ..operators.split import hash_parts, season_key, with_stratified_fold
from ..session import cached, checkpointed, in_parallel
from ..sources import frames
from .registry import query

NUMERIC = ["gp", "blk", "mp", "pts", "ast", "stl"]
CATEGORICAL = ["conf", "type"]
KEY = "row_key"

LOGISTIC = ModelSpec("logreg", "logistic")
ELASTIC = ModelSpec("elastic", "elasticnet", {"C": 1.0}, balanced=True)
SVM = ModelSpec("svm", "svm")
FOREST = ModelSpec("forest", "forest")
GBT = ModelSpec("gbt", "boosted")
ADA = ModelSpec("ada", "adaboost", {"variant": "real"})
SGD = ModelSpec("sgd", "sgd")
# For queries that fit them many times: solved in few passes.
NEWTON_LOGISTIC, NEWTON_ELASTIC, NEWTON_SVM = (s.with_params(solver="newton") for s in (LOGISTIC, ELASTIC, SVM))


@dataclass
class Data:
    """Assembled rows of the training seasons and of the season to score."""

    train: DataFrame
    test: DataFrame
    prep: PipelineModel | None = None

    def holdout(self) -> tuple[DataFrame, DataFrame]:
        return hash_parts(self.train, F.col(KEY))


def prepare(spark, sf_dir, *, all_categories: bool = False) -> Data:
    """Panel rows with a feature vector fitted on the training seasons, over the categories of
    all seasons if asked for. Learners read them many times, so they are checkpointed to the
    shared folder first."""
    panel = frames.panel(spark, sf_dir).withColumn("row_key", season_key())
    with cached(panel) as panel:
        prep = fit_preprocessor(
            frames.train_rows(panel), NUMERIC, CATEGORICAL, universe=panel if all_categories else None)
        rows = checkpointed(prep.transform(panel).select("player_id", "year", "row_key", "drafted", "features"))
    return Data(frames.train_rows(rows), frames.test_rows(rows), prep)


def _ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("player_id", *columns)


def _scores(spec: ModelSpec):
    def run(spark, sf_dir):
        data = prepare(spark, sf_dir)
        return _ids(fit_model(spec, data.train).score(data.test), spec.name)
    return run


query("logreg_scores")(_scores(LOGISTIC))
query("elasticnet_scores")(_scores(ELASTIC))
query("svm_platt_scores")(_scores(SVM))
query("rf_scores")(_scores(FOREST))
query("gbt_scores")(_scores(GBT))
query("adaboost_scores")(_scores(ADA))
query("sgd_logreg_scores")(_scores(SGD))
query("balanced_logreg_scores")(_scores(ModelSpec("balanced", "logistic", balanced=True)))


@query("gbt_early_stop")
def gbt_early_stop(spark, sf_dir):
    data = prepare(spark, sf_dir)
    rows = data.train.withColumn("held_out", hash_bucket(F.col(KEY), 10, 5) >= 8)
    spec = ModelSpec("gbt", "gbt", {"validation": "held_out", "tol": 0.01})
    return _ids(fit_model(spec, rows).score(data.test), "gbt")


# --- ensembles -----------------------------------------------------------------------

@query("ensemble_average")
def ensemble_average(spark, sf_dir):
    data = prepare(spark, sf_dir)
    models = fit_models((LOGISTIC, SVM), data.train)
    return _ids(E.average(scored(data.test, models), ["logreg", "svm"]), "logreg", "svm", "probability")


@query("vote_soft")
def vote_soft(spark, sf_dir):
    data = prepare(spark, sf_dir)
    vote = E.Vote(fit_models((LOGISTIC, SVM, FOREST, GBT), data.train))
    return _ids(vote.score(data.test), "vote")


@query("stack_holdout")
def stack_holdout(spark, sf_dir):
    data = prepare(spark, sf_dir)
    return _ids(E.fit_stack_holdout(*data.holdout(), [LOGISTIC, SVM]).score(data.test), "stack")


@query("stack_holdout_balanced")
def stack_holdout_balanced(spark, sf_dir):
    data = prepare(spark, sf_dir)
    specs = [ModelSpec(s.name, s.kind, s.params, balanced=True) for s in (LOGISTIC, SVM)]
    return _ids(E.fit_stack_holdout(*data.holdout(), specs).score(data.test), "stack")


def _with_centre_distance(panel: DataFrame, train: DataFrame) -> DataFrame:
    """The panel with the vector of scaled columns, distance to the nearest centre and categories, all fitted on train."""
    scale = Scaler().fit(train, NUMERIC)
    z = lambda df: df.withColumns({f"z_{c}": e for c, e in scale.exprs().items()})
    columns = [f"z_{c}" for c in NUMERIC]
    model = R.fit_kmeans(z(train), columns, R.best_k(R.silhouette_by_k(z(train), columns)))
    widened = lambda df: R.add_kmeans_distance(z(df), columns, model)
    return fit_preprocessor(widened(train), [*NUMERIC, "kmeans_distance"], CATEGORICAL).transform(widened(panel))


@query("stack_holdout_kmeans")
def stack_holdout_kmeans(spark, sf_dir):
    """Holdout stack with the distance to the nearest cluster centre as a further feature."""
    panel = frames.panel(spark, sf_dir).withColumn("row_key", season_key())
    panel = C.fill_medians(panel, frames.train_rows(panel), NUMERIC)
    with cached(panel) as panel:
        train, _ = hash_parts(frames.train_rows(panel), F.col(KEY))
        rows = checkpointed(_with_centre_distance(panel, train).select("player_id", "year", "row_key", "drafted", "features"))
    data = Data(frames.train_rows(rows), frames.test_rows(rows))
    return _ids(E.fit_stack_holdout(*data.holdout(), [LOGISTIC, SVM]).score(data.test), "stack")


@query("stack_crossfit")
def stack_crossfit(spark, sf_dir):
    data = prepare(spark, sf_dir)
    return _ids(E.fit_stack_crossfit(data.train, [NEWTON_LOGISTIC, NEWTON_SVM, GBT, FOREST]).score(data.test), "stack")


@query("ensemble_auroc_table")
def ensemble_auroc_table(spark, sf_dir):
    """Four bases under both combiners, with the exact area of each on held-out rows."""
    data = prepare(spark, sf_dir)
    train, held = data.holdout()
    specs = [NEWTON_LOGISTIC, NEWTON_SVM, GBT, FOREST]
    stack = E.fit_stack_crossfit(train, specs)
    models = [*stack.bases, stack, E.Vote(stack.bases)]
    with cached(held) as held:
        held.count()
        rows = in_parallel(spark, lambda m: (m.name, auroc_value(m.score(held), m.name, "drafted")), models)
    return spark.createDataFrame(rows, "model string, auroc double")


# --- searches ------------------------------------------------------------------------

@query("grid_search_trials")
def grid_search_trials(spark, sf_dir):
    data = prepare(spark, sf_dir)
    rows = with_stratified_fold(data.train, "drafted", F.col(KEY), ["row_key"], folds=5)
    return T.trial_table(spark, T.search_cv(LOGISTIC, rows, T.grid(T.GRIDS["linear"]), folds=5, parallelism=8))


@query("gbt_grid_search_trials")
def gbt_grid_search_trials(spark, sf_dir):
    data = prepare(spark, sf_dir)
    rows = with_stratified_fold(data.train, "drafted", F.col(KEY), ["row_key"], folds=3)
    return T.trial_table(spark, T.search_cv(GBT, rows, T.grid(T.GRIDS["gbt"]), folds=3, parallelism=8))


@query("random_search_trials")
def random_search_trials(spark, sf_dir):
    data = prepare(spark, sf_dir)
    rows = with_stratified_fold(data.train, "drafted", F.col(KEY), ["row_key"], folds=3)
    return T.trial_table(spark, T.search_cv(GBT, rows, T.draws(T.SPACES["gbt_lists"], 50), folds=3, parallelism=8))


@query("space_search_trials")
def space_search_trials(spark, sf_dir):
    data = prepare(spark, sf_dir)
    return T.trial_table(spark, T.search_holdout(GBT, *data.holdout(), T.draws(T.SPACES["gbt"], 100), parallelism=8))


# --- tuned stacks --------------------------------------------------------------------

def oversample(train: DataFrame) -> DataFrame:
    """Training rows with minority rows added in feature space."""
    x = vector_to_array("features")
    whole = F.when(F.size(x) > 0, x).otherwise(F.raise_error(F.lit("a training row has an empty vector")).cast("array<double>"))
    more = N.smote(train.select("row_key", whole.alias("x"), "drafted"), "row_key", "x", "drafted")
    # A made row takes its base row's key, which keeps both in one fold.
    return more.select("row_key", array_to_vector("x").alias("features"), "drafted")


def tuned_stack(data: Data, searches: Sequence[tuple[ModelSpec, dict, int]], *, resample: bool = True,
                name: str = "stack") -> E.Stack:
    """Search each base on the validation part with so many draws from its space, refit it with
    the best settings, stack. Only training rows are oversampled."""
    train, validation = data.holdout()
    rows = checkpointed(oversample(train)) if resample else train
    bases = []
    for spec, space, trials in searches:
        log = T.search_holdout(spec, rows, validation, T.draws(space, trials), parallelism=8)
        bases.append(fit_model(spec.with_params(**T.best_params(log)), rows))
    return E.fit_stack_holdout(rows, validation, [], bases=bases, name=name)


_THREE = [(NEWTON_LOGISTIC, T.SPACES["logistic"], 50), (GBT.with_params(depth=6), T.SPACES["gbt_small"], 50),
          (ADA, T.SPACES["adaboost"], 50)]
_TWO = [(NEWTON_LOGISTIC, T.SPACES["logistic"], 100), (NEWTON_SVM, T.SPACES["svm"], 50)]


@query("stack_three_models")
def stack_three_models(spark, sf_dir):
    data = prepare(spark, sf_dir)
    stack = tuned_stack(data, _THREE, resample=False)
    return _ids(stack.score(data.test), "stack")


@query("stack_three_models_smote")
def stack_three_models_smote(spark, sf_dir):
    data = prepare(spark, sf_dir)
    return _ids(tuned_stack(data, _THREE).score(data.test), "stack")


@query("stack_two_models_smote")
def stack_two_models_smote(spark, sf_dir):
    data = prepare(spark, sf_dir)
    return _ids(tuned_stack(data, _TWO).score(data.test), "stack")


@query("stack_grid_tuned")
def stack_grid_tuned(spark, sf_dir):
    """Balanced logistic, elastic-net and linear machine tuned over folds, then cross-fitted."""
    data = prepare(spark, sf_dir)
    rows = checkpointed(with_stratified_fold(data.train, "drafted", F.col(KEY), ["row_key"], folds=5))
    best = []
    for spec in (ModelSpec(s.name, s.kind, s.params, balanced=True) for s in (NEWTON_LOGISTIC, NEWTON_ELASTIC, NEWTON_SVM)):
        log = T.search_cv(spec, rows, T.grid(T.GRIDS["linear"]), folds=5, parallelism=8)
        best.append(spec.with_params(**T.best_params(log)))
    return _ids(E.fit_stack_crossfit(rows, best).score(data.test), "stack")


@query("knn_kmeans_model")
def knn_kmeans_model(spark, sf_dir):
    """Nearest-neighbour model on scaled columns, the distance to the nearest cluster centre and one-hot categories.
    One neighbour search per fold, with the largest k, serves every candidate."""
    panel = frames.panel(spark, sf_dir).withColumn("row_key", season_key())
    panel = C.fill_medians(panel, frames.train_rows(panel), NUMERIC)
    with cached(panel) as panel:
        prepared = _with_centre_distance(panel, frames.train_rows(panel))
        rows = checkpointed(prepared.select("player_id", "year", "row_key", "drafted", vector_to_array("features").alias("x")))
    folds = checkpointed(with_stratified_fold(frames.train_rows(rows), "drafted", F.col(KEY), ["row_key"], folds=5))
    best = best_knn(folds, folds_n=5)
    found = N.nearest(frames.test_rows(rows), folds, best["k"], q_key="row_key", t_key="row_key", payload="drafted")
    score = N.knn_scores(found, best["weights"]).withColumnRenamed("query", "row_key")
    return frames.test_rows(rows).select("player_id", "row_key").join(score, "row_key").select("player_id", "probability")


def best_knn(rows: DataFrame, *, folds_n: int, grid=None) -> dict:
    grid = grid or T.grid(T.GRIDS["knn"])
    largest = max(p["k"] for p in grid)
    sums = [0.0] * len(grid)
    for f in range(folds_n):
        held = rows.filter(F.col("fold") == f)
        found = N.nearest(held, rows.filter(F.col("fold") != f), largest, q_key="row_key", t_key="row_key",
                          payload="drafted")
        with cached(found) as found, cached(held.select(F.col("row_key").alias("query"), "drafted")) as truth:
            found.count(), truth.count()

            def area(p: dict) -> float:
                got = N.knn_scores(found.filter(F.col("rank") <= p["k"]), p["weights"]).join(truth, "query")
                return auroc_value(got, "probability", "drafted") or 0.0

            sums = [a + b for a, b in zip(sums, in_parallel(rows.sparkSession, area, grid))]
    return grid[max(range(len(grid)), key=lambda i: (sums[i], -i))]
