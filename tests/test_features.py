import pytest
from pyspark.sql import functions as F

from rosterline.operators import features as G
from rosterline.sources import tables as S


def test_missing_inputs_leave_the_frame_alone(spark):
    df = spark.createDataFrame([(1.0,)], "other double")
    assert G.build_features(df).columns == ["other"]


def test_playmaking_with_zero_points(spark):
    df = spark.createDataFrame([(2.0, 0.0), (2.0, 4.0)], "ast double, pts double").coalesce(1)
    got = [r.playmaking_ability for r in G.playmaking_ability(df).collect()]
    assert got == [2.0 / 2.220446049250313e-16, 0.5]


def test_equal_width_bins(spark):
    values = [0.0, 1.0, 1.0001, 2.0, 2.0001, 3.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    got = [r.b for r in G.equal_width_bins(df, "x", "b").collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", None]
    same = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double").coalesce(1)
    assert [r.b for r in G.equal_width_bins(same, "x", "b").collect()] == ["Medium", "Medium", None]


def test_polynomial_names(spark):
    df = spark.createDataFrame([(2.0, 3.0, "t", 1)], "a double, b double, team string, y int")
    out = G.polynomial_features(df, target="y")
    assert out.columns == ["team", "y", "a", "b", "a^2", "a b", "b^2"]
    assert tuple(out.first()) == ("t", 1, 2.0, 3.0, 4.0, 6.0, 9.0)
    only = G.polynomial_features(df, ["a", "b"], interaction_only=True, include_bias=True)
    assert only.columns == ["team", "y", "1", "a", "b", "a b"]
    cubes = [n for n, _ in G.polynomial_terms(["a", "b"], 3)]
    assert cubes[-4:] == ["a^3", "a^2 b", "a b^2", "b^3"]


def test_wide_polynomials_need_a_vector(spark):
    df = spark.range(2).select(*[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(40)])
    with pytest.raises(ValueError):
        G.polynomial_features(df)
    assert G.polynomial_features(df, as_vector="v").first()["v"].size == 40 + 40 * 41 // 2


def test_pairwise(spark):
    out = G.pairwise_features(spark.createDataFrame([(1, 2.0, 5.0)], "player_id int, a double, b double"))
    assert out.columns == ["player_id", "a", "b", "a + b", "a * b"]
    assert tuple(out.first())[3:] == (7.0, 10.0)


def test_quantile_bins(spark):
    df = spark.range(9).select(F.col("id").cast("double").alias("x")).coalesce(1)
    assert [r.b for r in G.quantile_bins(df, "x", "b").collect()] == ["low"] * 3 + ["medium"] * 3 + ["high"] * 3


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 1)], "player_id bigint, team string, pts double, drafted int")
    assert S.numeric_columns(df, ["drafted"]) == ["player_id", "pts"]
    assert S.string_columns(df) == ["team"]
    assert S.split_features(df, "drafted") == (["team", "pts"], "drafted")
    assert S.align_to(df, ["pts", "new", "team"]).columns == ["pts", "new", "team"]


def test_dictionary(spark, tmp_path):
    d = spark.createDataFrame([(1, "team", 'Name, of "team"'), (2, "pts", "Points")], "feature int, name string, description string")
    S.write_csv(d, str(tmp_path / "d"))
    back = S.read_csv(spark, str(tmp_path / "d"), d.schema)
    assert S.describe_feature(back, "team") == 'Name, of "team"' and S.describe_feature(back, "x") is None
    noted = S.with_descriptions(spark.createDataFrame([("a", 1.0)], "team string, pts double"), back)
    assert noted.schema["pts"].metadata == {"description": "Points"}
