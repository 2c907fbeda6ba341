"""Classifiers under one contract: fit on (features, label), score to a probability column named
after the model. The distributed learners are Spark ML's; boosting of weighted stumps is built
on its decision tree."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import hash_bucket
from ..session import cached, checkpointed, in_parallel
from .evaluate import with_class_weight

WEIGHT = "_weight"
PARTITIONS = 8
NODE_BYTES = 256 << 20  # places of rows in a forest's trees that a fit may keep, one number per row and tree


@dataclass(frozen=True, eq=False)
class ModelSpec:
    """A learner by kind. C is the inverse regularisation over summed loss; rate, trees, depth,
    gamma, min_child, subsample and colsample are the usual boosting settings. gbt is Spark ML's learner, boosted the
    one of boosting.py, with penalties alpha and lam on leaves; adaboost is discrete, or real-valued with variant="real".
    solver="newton" takes linear models to linear.py. A parameter that the kind doesn't have is an error."""

    name: str
    kind: str  # logistic | elasticnet | svm | forest | gbt | boosted | adaboost | sgd
    params: dict[str, Any] = field(default_factory=dict)
    balanced: bool = False

    def with_params(self, **params) -> "ModelSpec":
        return ModelSpec(self.name, self.kind, {**self.params, **params}, self.balanced)


class FittedModel:
    """A fitted pipeline and the name of its probability column."""

    def __init__(self, name: str, pipeline: PipelineModel):
        self.name, self.pipeline = name, pipeline

    def score(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(df)
        return out.select(*df.columns, vector_to_array(f"{self.name}_prob")[1].alias(self.name))

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        _save_meta(spark, path, {"class": "pipeline", "name": self.name})


def _save_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])


def load_model(spark: SparkSession, path: str):
    meta = load_meta(spark, path)
    if meta["class"] == "linear":
        from .linear import LinearModel

        return LinearModel(**{k: v for k, v in meta.items() if k != "class"})
    if meta["class"] == "boosted":
        from .boosting import BoostedModel

        return BoostedModel.of(meta)
    if meta["class"] == "adaboost":
        return AdaBoostModel(meta["name"], meta["features"], [Stump(**s) for s in meta["stumps"]])
    if meta["class"] in ("stack", "vote"):
        from . import ensemble

        return {"stack": ensemble.Stack, "vote": ensemble.Vote}[meta["class"]].load(spark, path)
    if meta["class"] == "oneclass":
        from .anomaly import OneClassModel

        return OneClassModel(**{k: v for k, v in meta.items() if k != "class"})
    return FittedModel(meta["name"], PipelineModel.load(f"{path}/pipeline"))


def settled(rows: DataFrame, by: Sequence[Column], partitions: int = PARTITIONS) -> DataFrame:
    """The rows in an order that follows from their values alone: learners draw samples and add
    up per partition, so the result must not depend on how the rows were laid out. The number of
    partitions is part of a model's settings: raise it with the data, and the draws change."""
    return rows.repartition(partitions, *by).sortWithinPartitions(*by)


_TREE = {"rate", "trees", "depth", "gamma", "min_child", "subsample", "colsample", "seed"}
PARAMETERS = {
    "logistic": {"C", "max_iter", "solver"}, "elasticnet": {"C", "max_iter", "l1_ratio", "solver"}, "sgd": {"alpha", "max_iter"},
    "svm": {"C", "max_iter", "folds", "solver"}, "forest": {"trees", "depth", "seed"}, "gbt": {*_TREE, "validation", "tol"},
    "boosted": {*_TREE, "alpha", "lam", "task_bytes"}, "adaboost": {"rate", "trees", "checkpoint_every", "variant", "task_bytes"}}


def check_parameters(spec: ModelSpec) -> None:
    if spec.kind not in PARAMETERS:
        raise ValueError(f"unknown kind {spec.kind!r}")
    unknown = set(spec.params) - PARAMETERS[spec.kind] - {"partitions"}
    if unknown:
        raise ValueError(f"{spec.kind} has no parameter {', '.join(sorted(unknown))}")


def _columns(spec: ModelSpec, features: str, label: str) -> dict[str, str]:
    return {"featuresCol": features, "labelCol": label, "predictionCol": f"{spec.name}_pred",
            "rawPredictionCol": f"{spec.name}_raw"}


def estimator(spec: ModelSpec, n: int, features: str = "features", label: str = "drafted"):
    """The Spark estimator behind a spec, for the kinds that are a single one. Spark averages
    the loss, so C over summed loss becomes a penalty of 1/(C n)."""
    p = spec.params
    cols = {**_columns(spec, features, label), "probabilityCol": f"{spec.name}_prob"}
    weight = {"weightCol": WEIGHT} if spec.balanced else {}
    if spec.kind in ("logistic", "elasticnet", "sgd"):
        mix = {"logistic": 0.0, "elasticnet": p.get("l1_ratio", 0.5), "sgd": 0.0}[spec.kind]
        reg = p.get("alpha", 1e-4) if spec.kind == "sgd" else 1.0 / (p.get("C", 1.0) * max(n, 1))
        return LogisticRegression(
            elasticNetParam=mix, regParam=reg, maxIter=p.get("max_iter", 100), standardization=False, **cols, **weight)
    if spec.kind == "forest":
        if p.get("depth", 10) > 30:
            raise ValueError("a forest's depth can be 30 at most")
        trees = p.get("trees", 100)
        # Kept places save a walk from the root per row, tree and level. The trees are the same.
        return RandomForestClassifier(
            numTrees=trees, maxDepth=p.get("depth", 10), seed=p.get("seed", 42), featureSubsetStrategy="sqrt",
            cacheNodeIds=n * trees * 4 <= NODE_BYTES, checkpointInterval=-1, **cols, **weight)
    if spec.kind == "gbt":
        stop = {"validationIndicatorCol": p["validation"], "validationTol": p.get("tol", 0.01)} if "validation" in p else {}
        return GBTClassifier(
            featuresCol=features, labelCol=label, predictionCol=cols["predictionCol"],
            maxIter=int(p.get("trees", 100)), stepSize=p.get("rate", 0.1), maxDepth=int(p.get("depth", 3)),
            subsamplingRate=p.get("subsample", 1.0), featureSubsetStrategy=str(p.get("colsample", "all")),
            minInfoGain=p.get("gamma", 0.0), minInstancesPerNode=max(1, int(p.get("min_child", 1))),
            seed=p.get("seed", 42), **weight, **stop,
        ).setRawPredictionCol(cols["rawPredictionCol"]).setProbabilityCol(cols["probabilityCol"])
    raise ValueError(f"unknown kind {spec.kind!r}")


def fit_model(spec: ModelSpec, df: DataFrame, *, features: str = "features", label: str = "drafted",
              key: str = "row_key"):
    """Fit one model. The few columns it needs are cached for the passes of the learner, in an
    order that follows from key and values; a row without a label trains nothing."""
    check_parameters(spec)
    if spec.kind == "boosted" or spec.params.get("variant") == "real":
        return fit_boosted(spec, df, features, label, key)
    if spec.params.get("solver") == "newton":
        from .linear import fit_linear

        own = {k: v for k, v in spec.params.items() if k in ("C", "l1_ratio", "folds")}
        return fit_linear(spec.kind, df, name=spec.name, features=features, label=label, key=key, balanced=spec.balanced, **own)
    extra = [spec.params["validation"]] if "validation" in spec.params else []
    keyed = [key] if key in df.columns else []
    rows = df.select(features, F.col(label).cast("double").alias(label), *keyed, *extra).filter(F.col(label).isNotNull())
    if spec.balanced:
        rows = with_class_weight(rows, label, WEIGHT)
    rows = settled(rows, [*map(F.col, keyed), F.xxhash64(vector_to_array(features), F.col(label))],
                   spec.params.get("partitions", PARTITIONS))
    with cached(rows) as rows:
        n = rows.count()
        if spec.kind == "svm":
            return _fit_svm(spec, rows, n, features, label, key)
        if spec.kind == "adaboost":
            return fit_adaboost(spec, rows, features, label)
        return FittedModel(spec.name, PipelineModel([estimator(spec, n, features, label).fit(rows)]))


def boosted_setting(spec: ModelSpec, held: int | None = None):
    """The spec's settings for boosting.py, as they would be for one model."""
    from .boosting import Setting

    p = {k: v for k, v in spec.params.items() if k not in ("variant", "partitions", "task_bytes")}
    if "trees" in p:
        p["trees"] = int(round(p["trees"]))
    if spec.kind == "adaboost":
        return Setting(**{"rate": 1.0, "trees": 50, **p, "loss": "ada"}, held=held)
    if "depth" in p:
        p["depth"] = int(round(p["depth"]))
    return Setting(**{"rate": 0.1, "depth": 3, **p}, held=held)


def fit_boosted(spec: ModelSpec, df: DataFrame, features: str, label: str, key: str):
    from .boosting import TASK_BYTES, BoostedModel, bin_rows, fit_many

    rows = with_class_weight(df.filter(F.col(label).isNotNull()), label, WEIGHT) if spec.balanced else df
    setting = boosted_setting(spec)
    binned = bin_rows(rows, features=features, label=label, key=key, weight=WEIGHT if spec.balanced else None)
    try:
        trees, = fit_many(binned, [setting], task_bytes=spec.params.get("task_bytes", TASK_BYTES))
    finally:
        binned.unpersist()
    return BoostedModel(spec.name, features, trees, binned.cuts, setting.loss)


# --- linear machine with probabilities -----------------------------------------------

def _fit_svm(spec: ModelSpec, rows: DataFrame, n: int, features: str, label: str, key: str) -> FittedModel:
    """Hinge-loss machine; a one-feature logistic model turns margins into probabilities. It is
    fitted on margins of rows the machine behind them has not seen."""
    p = spec.params
    folds = p.get("folds", 3)
    cols = _columns(spec, features, label)
    weight = {"weightCol": WEIGHT} if spec.balanced else {}
    machine = lambda size: LinearSVC(
        regParam=1.0 / (p.get("C", 1.0) * max(size, 1)), maxIter=p.get("max_iter", 100), standardization=False,
        **cols, **weight)
    margin = VectorSlicer(inputCol=f"{spec.name}_raw", outputCol=f"{spec.name}_margin", indices=[1])
    fold = hash_bucket(F.col(key), folds, 7)

    def fit_without(f: int | None):
        return machine(n).fit(rows) if f is None else machine(n * (folds - 1) // folds).fit(rows.filter(fold != f))

    *parts, final = in_parallel(rows.sparkSession, fit_without, [*range(folds), None])
    unseen = reduce(DataFrame.unionByName, [
        margin.transform(m.transform(rows.filter(fold == f))).select(f"{spec.name}_margin", label)
        for f, m in enumerate(parts)])
    platt = LogisticRegression(
        featuresCol=f"{spec.name}_margin", labelCol=label, predictionCol=f"{spec.name}_label",
        rawPredictionCol=f"{spec.name}_logit", probabilityCol=f"{spec.name}_prob", standardization=False)
    with cached(unseen) as margins:
        calibrated = platt.fit(margins)
    return FittedModel(spec.name, PipelineModel([final, margin, calibrated]))


# --- boosted stumps ------------------------------------------------------------------

@dataclass(frozen=True)
class Stump:
    """Predict `low` when the feature is at most the threshold (or is one of the listed
    categories), else `high`."""

    feature: int
    threshold: float | None
    categories: list[float] | None
    low: float
    high: float
    weight: float

    def vote(self, x: Column) -> Column:
        """+1 or -1 for the positive class."""
        v = x[self.feature]
        left = (v <= F.lit(self.threshold)) if self.threshold is not None else v.isin(self.categories)
        sign = lambda p: F.lit(1.0 if p > 0.5 else -1.0)
        return F.when(left, sign(self.low)).otherwise(sign(self.high))


@dataclass
class AdaBoostModel:
    name: str
    features: str
    stumps: list[Stump]

    def margin(self, x: Column) -> Column:
        total = sum(s.weight for s in self.stumps) or 1.0
        out = F.lit(0.0)
        for s in self.stumps:
            out = out + F.lit(s.weight / total) * s.vote(x)
        return out

    def score(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.features))
        return df.withColumn("_x", x).withColumn(
            self.name, 1.0 / (1.0 + F.exp(-self.margin(F.col("_x"))))).drop("_x")

    def save(self, spark: SparkSession, path: str) -> None:
        _save_meta(spark, path, {"class": "adaboost", "name": self.name, "features": self.features,
                                 "stumps": [s.__dict__ for s in self.stumps]})


def _read_stump(tree, weight: float) -> Stump:
    """A tree whose two leaves agree comes back as one leaf: a constant vote."""
    root = tree._call_java("rootNode")
    if tree.depth == 0:
        return Stump(0, math.inf, None, float(root.prediction()), float(root.prediction()), weight)
    split = root.split()
    continuous = hasattr(split, "threshold") and split.getClass().getSimpleName() == "ContinuousSplit"
    return Stump(
        int(split.featureIndex()), float(split.threshold()) if continuous else None,
        None if continuous else [float(c) for c in split.leftCategories()],
        float(root.leftChild().prediction()), float(root.rightChild().prediction()), weight)


def fit_adaboost(spec: ModelSpec, rows: DataFrame, features: str, label: str) -> AdaBoostModel:
    """Discrete boosting. The row weight is a column updated from the last stump's vote, and is
    checkpointed every few rounds so plans stay short."""
    rounds, rate = int(spec.params.get("trees", 50)), spec.params.get("rate", 1.0)
    every = spec.params.get("checkpoint_every", 10)
    tree = DecisionTreeClassifier(
        featuresCol=features, labelCol=label, weightCol="_w", maxDepth=1, predictionCol="_p",
        rawPredictionCol="_r", probabilityCol="_q")
    x = vector_to_array(F.col(features))
    start = F.col(WEIGHT) if spec.balanced else F.lit(1.0)
    current = rows.select(features, label, start.cast("double").alias("_w"))
    stumps: list[Stump] = []
    for i in range(rounds):
        with cached(current) as now:
            stump = _read_stump(tree.fit(now), 1.0)
            wrong = stump.vote(x) != F.when(F.col(label) == 1, 1.0).otherwise(-1.0)
            bad, total = now.agg(F.sum(F.when(wrong, F.col("_w")).otherwise(0.0)), F.sum("_w")).first()
            err = bad / total
            if err <= 0.0:
                stumps.append(stump)
                break
            if err >= 0.5:
                break
            alpha = rate * math.log((1.0 - err) / err)
            stumps.append(Stump(**{**stump.__dict__, "weight": alpha}))
            # Normalised so that weights keep their total.
            scale = total / (total - bad + bad * math.exp(alpha))
            grown = F.col("_w") * F.lit(scale) * F.when(wrong, F.lit(math.exp(alpha))).otherwise(F.lit(1.0))
            current = now.withColumn("_w", grown)
            if (i + 1) % every == 0 and i + 1 < rounds:
                current = checkpointed(current)
    return AdaBoostModel(spec.name, features, stumps)


def fit_models(specs: Sequence[ModelSpec], df: DataFrame, **kw) -> list:
    """Fit several models on the same rows side by side."""
    with cached(df) as rows:
        rows.count()
        return in_parallel(df.sparkSession, lambda s: fit_model(s, rows, **kw), list(specs))


def scored(df: DataFrame, models: Sequence) -> DataFrame:
    """Add every model's probability column; rows stay where they are."""
    for m in models:
        df = m.score(df)
    return df
