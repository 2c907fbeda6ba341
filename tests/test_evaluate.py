import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.operators import evaluate as V


def brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def frame(spark, scores, labels, parts=3):
    rows = [(float(s), int(y)) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "s double, y int").repartition(parts)


RNG = np.random.default_rng(5)
CASES = [
    (RNG.integers(0, 40, 400), RNG.integers(0, 2, 400)),
    (RNG.normal(size=300), RNG.integers(0, 2, 300)),
    ([1, 1, 1, 1], [0, 1, 0, 1]), ([1, 2, 3, 4], [0, 0, 1, 1]), ([4, 3, 2, 1], [0, 0, 1, 1]), ([1, 2], [1, 1]),
]


@pytest.mark.parametrize("scores,labels", CASES)
@pytest.mark.parametrize("rows_per_range", [7, 10**6])
def test_auroc(spark, scores, labels, rows_per_range):
    got = V.auroc(frame(spark, scores, labels), "s", "y", rows_per_range=rows_per_range).first()["auroc"]
    want = brute(scores, labels)
    assert got == (None if want is None else pytest.approx(want))


def test_roc_curve_across_ranges(spark):
    scores, labels = CASES[0]
    one = V.roc_curve(frame(spark, scores, labels), "s", "y").orderBy(F.desc("threshold")).collect()
    many = V.roc_curve(frame(spark, scores, labels, 5), "s", "y", rows_per_range=5).orderBy(F.desc("threshold")).collect()
    assert one == many
    assert (one[-1].fpr, one[-1].tpr) == (1.0, 1.0)
    assert (one[0].fpr, one[0].tpr) == (0.0, 0.0)
    fpr, tpr = [r.fpr for r in one], [r.tpr for r in one]
    assert np.trapezoid(tpr, fpr) == pytest.approx(brute(scores, labels))


def test_evaluator(spark):
    df = frame(spark, *CASES[0])
    assert V.ExactAuroc(labelCol="y", rawPredictionCol="s").evaluate(df) == pytest.approx(brute(*CASES[0]))
    assert V.ExactAuroc(labelCol="y", rawPredictionCol="s").evaluate(df.filter("y = 1")) == float("-inf")


def test_class_weights(spark):
    df = frame(spark, [1, 2, 3, 4], [0, 0, 0, 1])
    assert {r.y: r.weight for r in V.class_weights(df, "y").collect()} == {0: 4 / 6, 1: 2.0}
    assert {r.y: r.weight for r in V.with_class_weight(df, "y").collect()} == {0: 4 / 6, 1: 2.0}
