"""Class weights, exact AUROC and ROC points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cached, checkpointed
from .ranking import ROWS_PER_RANGE, running_totals


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("s")).scalar()
    return counts.select(
        target, "n", (size["rows"].cast("double") / (size["classes"] * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Balanced weights as a column, for a 0/1 target. The two counts are fitted first and
    enter the plan as constants."""
    neg, pos = df.agg(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).first()
    weight = lambda n: (neg + pos) / (2.0 * n) if n else 0.0
    return df.withColumn(out, F.when(F.col(target) == 1, F.lit(weight(pos))).otherwise(F.lit(weight(neg))))


def score_groups(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )


def auroc(df: DataFrame, score: str, label: str, *, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is absent. The rows
    are read once: what follows works on one row per distinct score."""
    with cached(score_groups(df, score, label)) as groups:
        ranked = running_totals(groups, "score", ["neg"], rows_per_range=rows_per_range)
        below = F.col("cum_neg") - F.col("neg")
        wins = F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") * F.lit(0.5))
        row = ranked.agg(
            F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
            F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auroc"),
        ).first()
    return df.sparkSession.createDataFrame([tuple(row)], "n_pos bigint, n_neg bigint, auroc double")


def auroc_value(df: DataFrame, score: str, label: str) -> float | None:
    return auroc(df, score, label).first()["auroc"]


def auroc_by(df: DataFrame, by: Sequence[str], score: str, label: str, *, ranges: int = 64) -> DataFrame:
    """by and auroc: the exact area of each group of rows, ties counted half, null when a class is absent. All groups share
    each pass; scores are cut into ranges at their quantiles, so a group is no task of its own."""
    groups = checkpointed(df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
                          .groupBy(*by, F.col(score).cast("double").alias("_s"))
                          .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    cuts = groups.select(F.percentile_approx("_s", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<double>")
    ranged = groups.withColumn("_range", F.size(F.filter(edges, lambda e: e <= F.col("_s"))))
    inside = Window.partitionBy(*by, "_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*by, "_range").agg(F.sum("neg").alias("_n")).select(
        *by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    below = F.col("_before") + F.sum("neg").over(inside) - F.col("neg")
    wins = ranged.join(offsets, [*by, "_range"]).select(*by, "pos", "neg", (F.col("pos").cast("double") * (
        below.cast("double") + F.col("neg").cast("double") * F.lit(0.5))).alias("_w"))
    return wins.groupBy(*by).agg(F.try_divide(
        F.sum("_w"), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auroc"))


def roc_curve(df: DataFrame, score: str, label: str, *, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One point per distinct score, from the highest down: rates of rows at or above it. It
    starts at (0, 0) with a threshold one above the highest score. The counts per score are
    checkpointed, as they are read several times."""
    groups = checkpointed(score_groups(df, score, label))
    total = groups.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
    ranked = running_totals(groups, "score", ["pos", "neg"], descending=True, rows_per_range=rows_per_range)
    start = groups.agg((F.max("score") + 1.0).alias("threshold")).filter(F.col("threshold").isNotNull()).select(
        "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), total["n"].cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), total["p"].cast("double")).alias("tpr")))


class ExactAuroc(Evaluator, HasLabelCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Scores a search by the exact area above. `rawPredictionCol` may be a number or a
    two-class vector; an undefined area counts as the worst."""

    @keyword_only
    def __init__(self, *, labelCol="drafted", rawPredictionCol="probability"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        col = self.getRawPredictionCol()
        numeric = dataset.schema[col].dataType.typeName() in ("double", "float", "integer", "long")
        score = F.col(col) if numeric else vector_to_array(F.col(col))[1]
        got = auroc_value(dataset.select(score.alias("s"), F.col(self.getLabelCol()).alias("y")), "s", "y")
        return float("-inf") if got is None else got

    def isLargerBetter(self) -> bool:
        return True
