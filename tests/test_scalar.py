import pytest
from pyspark.sql import functions as F

from rosterline.functions import scalar as S


def evaluate(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema).coalesce(1)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_heights(spark):
    cases = {
        None: None, "-": None, "None": None, "0": None, "Jr": None, "So": None, "Fr": None, "6'4": 76.0, "6'": None,
        "6'4'1": None, "Jun-00": 72.0, "11-May": 71.0, "2-Jul": 86.0, "Apr-11": 59.0, "5-Sep": None, "1-2-3": None,
        "76": None, "": None, "Jun-": None,
    }
    assert evaluate(spark, cases, S.height_inches) == list(cases.values())


def test_numbers(spark):
    cases = {None: None, "23": 23.0, " 7 ": 7.0, "1e1": 10.0, "23B": None, "4A": None, "12d": None, "--": None,
             "None": None, "nan": None, "31/24": None, "1_0": None, "-.5": -0.5, "+3.": 3.0, "": None}
    assert evaluate(spark, cases, S.safe_number) == list(cases.values())


def test_class_year(spark):
    assert evaluate(spark, ["Fr", "So", "Jr", "Sr", "0", None], S.class_year) == [1.0, 2.0, 3.0, 4.0, None, None]


def test_ratio_and_finite(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0)], "a double, b double").coalesce(1)
    assert [r[0] for r in df.select(S.ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]
    odd = [float("nan"), float("inf"), float("-inf"), 2.0, None]
    assert evaluate(spark, odd, S.finite, "v double") == [None, None, None, 2.0, None]


def test_key_hash_spreads_and_is_salted(spark):
    df = spark.range(20000).select(
        S.hash_bucket(F.col("id"), 10, 42).alias("a"), S.hash_bucket(F.col("id"), 2, 11).alias("b"))
    counts = {(r.a, r.b): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert len(counts) == 20
    assert min(counts.values()) > 700 and max(counts.values()) < 1300


@pytest.mark.parametrize("key", [0, 1, 2**31 + 5, 2**40, -3])
def test_key_hash_range(spark, key):
    got = evaluate(spark, [key], S.key_hash, "v bigint")[0]
    assert 0 <= got < S.HASH_MOD
