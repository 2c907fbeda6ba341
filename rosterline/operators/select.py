"""Feature scores and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..session import cached
from ..sources.tables import numeric_columns, string_columns
from .encode import feature_names, fit_preprocessor
from .lookup import attach


def chi2_scores(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Chi-square of each (column, value) indicator against the target, over the rows having the
    value: sum over classes of (observed - expected)^2 / expected, where the expected count is
    the value's rows times the class share. That equals the sum of observed^2 / expected less
    the value's rows, so classes a value never meets need no row of their own."""
    cells = (
        df.filter(F.col(target).isNotNull())
        .select(target, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
        ])).alias("r")).select(target, "r.*").filter(F.col("value").isNotNull())
        .groupBy("column_name", "value", target).agg(F.count(F.lit(1)).alias("observed"))
    )
    classes = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    total = classes.agg(F.sum("_n")).scalar()
    shares = classes.select(target, (F.col("_n") / total).alias("share"))
    seen = F.col("observed").cast("double")
    # Values are regrouped from cells, a few rows per value however many rows hold it.
    return attach(cells, shares, [target]).groupBy("column_name", "value").agg(
        F.sum("observed").alias("n"), F.sum(seen * seen / F.col("share")).alias("s"),
    ).select("column_name", "value", "n", (F.col("s") / F.col("n") - F.col("n")).alias("chi2"))


def chi2_topk(df: DataFrame, columns: Sequence[str], target: str, k: int, *, least: bool = False) -> DataFrame:
    """The k best (or worst) indicators with the column each belongs to."""
    order = F.asc("chi2") if least else F.desc("chi2")
    return chi2_scores(df, columns, target).orderBy(order, "column_name", "value").limit(k)


def _forest(df: DataFrame, features: str, target: str, trees: int, depth: int, seed: int):
    return RandomForestClassifier(
        featuresCol=features, labelCol=target, numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy="sqrt").fit(df)


def forest_importances(df: DataFrame, target: str, columns: Sequence[str] | None = None, *, trees: int = 100,
                       depth: int = 10, seed: int = 42) -> dict[str, float]:
    """Importance per numeric column; missing values are taken as 0."""
    columns = list(columns or numeric_columns(df, [target, "player_id"]))
    filled = df.select(target, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    with cached(VectorAssembler(inputCols=columns, outputCol="_v").transform(filled).select(target, "_v")) as rows:
        return dict(zip(columns, map(float, _forest(rows, "_v", target, trees, depth, seed).featureImportances)))


def select_features(df: DataFrame, target: str = "drafted", *, top_numeric: int = 20, top_categorical: int = 5,
                    ids: Sequence[str] = ("player_id",), **forest) -> DataFrame:
    """Keep the most important numeric columns, the columns owning the best indicators, the
    target, in that order."""
    scores = forest_importances(df, target, numeric_columns(df, [target, *ids]), **forest)
    numeric = sorted(scores, key=lambda c: (-scores[c], c))[:top_numeric]
    categorical = _owners(df, target, ids, top_categorical, least=False)
    return df.select(*numeric, *categorical, target)


def remove_features(df: DataFrame, target: str = "drafted", *, bottom_numeric: int = 5, bottom_categorical: int = 5,
                    ids: Sequence[str] = ("player_id",), **forest) -> DataFrame:
    """Drop the least important numeric columns and the columns owning the worst indicators."""
    scores = forest_importances(df, target, numeric_columns(df, [target, *ids]), **forest)
    numeric = sorted(scores, key=lambda c: (scores[c], c))[:bottom_numeric]
    return df.drop(*numeric, *_owners(df, target, ids, bottom_categorical, least=True))


def _owners(df: DataFrame, target: str, ids: Sequence[str], k: int, least: bool) -> list[str]:
    columns = string_columns(df, [target, *ids])
    if not columns or not k:
        return []
    owning = {r["column_name"] for r in chi2_topk(df, columns, target, k, least=least).collect()}  # k rows
    return [c for c in columns if c in owning]


def importance_topk(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], k: int = 50, *,
                    trees: int = 100, depth: int = 10, seed: int = 42) -> DataFrame:
    """The k most important slots over numeric columns and indicators, with rank."""
    prepared = fit_preprocessor(df, numeric, categorical).transform(df)
    names = feature_names(prepared)
    with cached(prepared.select(target, "features")) as rows:
        weights = _forest(rows, "features", target, trees, depth, seed).featureImportances.toArray()
    order = sorted(range(len(names)), key=lambda i: (-weights[i], names[i]))[:k]
    return df.sparkSession.createDataFrame(
        [(r + 1, names[i], float(weights[i])) for r, i in enumerate(order)],
        "rank int, feature string, importance double")
