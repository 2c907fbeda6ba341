import math

import pytest

from rosterline.operators import temporal as T

SCHEMA = "player_id bigint, year int, x double, name string"


def rows(df):
    return {(r.player_id, r.year): r for r in df.collect()}


def test_rolling_and_growth(spark):
    df = spark.createDataFrame([
        (1, 2000, 4.0, "a"), (1, 2001, 6.0, "a"), (1, 2003, None, "a"), (1, 2004, 0.0, "a"), (1, 2005, 5.0, "a"),
        (2, 2000, 1.0, "b")], SCHEMA)
    got = rows(T.rolling_statistics(df))
    assert "rolling_mean_name" not in df.columns and "growth_rate_year" not in got[1, 2000].asDict()
    assert got[2, 2000].rolling_mean_x is None and got[2, 2000].growth_rate_x is None
    assert got[1, 2001].rolling_mean_x == 5.0
    assert got[1, 2001].rolling_std_x == pytest.approx(math.sqrt(2))
    assert got[1, 2003].rolling_mean_x is None  # only one of the two rows has a value
    assert got[1, 2003].growth_rate_x == 0.0  # carried forward
    assert got[1, 2004].growth_rate_x == -1.0
    assert got[1, 2005].growth_rate_x is None  # previous value is zero


def test_season_uses_only_the_window_before_it(spark):
    history = spark.createDataFrame([(1, 1999, 100.0, "a"), (1, 2000, 2.0, "a")], SCHEMA)
    current = spark.createDataFrame([(1, 2001, 4.0, "a"), (2, 2001, 9.0, "b")], SCHEMA)
    got = rows(T.season_statistics(current, history, 2001, window=2))
    assert set(got) == {(1, 2001), (2, 2001)}
    assert got[1, 2001].rolling_mean_x == 3.0 and got[2, 2001].rolling_mean_x is None


def test_one_shuffle_serves_all_features(spark):
    df = spark.createDataFrame([(1, 2000, 1.0, "a")], SCHEMA)
    plan = T.rolling_statistics(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
