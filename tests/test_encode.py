import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rosterline.operators import encode as E
from rosterline.operators.anomaly import OneClassModel
from rosterline.operators.split import category_universe


@pytest.fixture
def cats(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string").coalesce(1)
    test = spark.createDataFrame([("b",), ("z",), (None,), ("a",)], "c string").coalesce(1)
    return train, test


def test_unknown_category_gives_zeros(cats):
    train, test = cats
    model = E.fit_one_hot(train)
    assert model.indicators() == [("c", "b"), ("c", "c")]
    assert [tuple(r) for r in model.transform(test).collect()] == [(1, 0), (0, 0), (0, 0), (0, 0)]


def test_vector_form(cats):
    train, test = cats
    hot = lambda m: [r[0] for r in m.transform(test).select(vector_to_array("c_hot")).collect()]
    assert hot(E.fit_one_hot_vector(train, ["c"])) == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    assert hot(E.fit_one_hot_vector(train, ["c"], drop_first=False)) == [
        [0.0, 1.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]


def test_universe_of_categories(cats):
    assert {r.value for r in category_universe(*cats, ["c"]).collect()} == {"a", "b", "c", "z"}
    train, test = cats
    df = train.withColumn("x", F.lit(1.0))
    both = df.unionByName(test.withColumn("x", F.lit(2.0)))
    prep = E.fit_preprocessor(df, ["x"], ["c"], universe=both)
    assert E.vector_width(prep.transform(df)) == 1 + 3


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double").coalesce(1)
    with pytest.raises(ValueError):
        E.Scaler().transform(df)
    assert [tuple(r) for r in E.Scaler().fit(df).transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    minmax = E.Scaler("minmax").fit(df)
    test = spark.createDataFrame([(5.0, 7.0)], "a double, b double")
    assert tuple(minmax.transform(test).first()) == (2.0, 2.0)  # not clipped
    assert E.Scaler.from_json(minmax.to_json()) == minmax


def test_pipeline_stage_equals_scaler(spark, tmp_path):
    df = spark.range(20).select(F.col("id").cast("double").alias("a"))
    scaler = E.Scaler().fit(df)
    staged = scaler.stage().transform(df)
    assert [r.a_std for r in staged.collect()] == [r.a for r in scaler.transform(df).collect()]


def test_width_guard_and_names(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    out = E.fit_preprocessor(df, ["x"], ["c"]).transform(df)
    assert E.vector_width(out) == 2 and E.feature_names(out)[0] == "x_std"
    with pytest.raises(ValueError, match="expects 3"):
        OneClassModel([1.0, 2.0, 3.0], 0.0).transform(out)
