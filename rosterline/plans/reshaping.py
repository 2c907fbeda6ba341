"""Temporal windows, unions, splits, folds, and schema alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as X, temporal as T
from ..sources import frames, tables
from .profiling import rounded
from .registry import PANEL, query, sql_hash

COLS = ["blk", "mp", "pts", "ast", "stl"]


def _roll_sql(stat: str, fn: str, digits: int, source: str = "panel", cols=tuple(COLS), window: int = 2) -> str:
    return ", ".join(
        f"round(CASE WHEN count({c}) OVER w = {window} THEN {fn}({c}) OVER w END, {digits}) AS rolling_{stat}_{c}"
        for c in cols)


def _growth_sql(cols=tuple(COLS)) -> str:
    cur = "last_value({c} IGNORE NULLS) OVER (PARTITION BY player_id ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    prev = "last_value({c} IGNORE NULLS) OVER (PARTITION BY player_id ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return ", ".join(
        f"round(({cur.format(c=c)} - {prev.format(c=c)}) / nullif({prev.format(c=c)}, 0), 6) AS growth_rate_{c}"
        for c in cols)


def _window(n: int) -> str:
    return f"WINDOW w AS (PARTITION BY player_id ORDER BY year ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query("rolling_mean", f"""WITH {PANEL}
SELECT player_id, year, {_roll_sql('mean', 'avg', 4, window=3)} FROM panel {_window(3)}""")
def rolling_mean(spark, sf_dir):
    panel = frames.panel(spark, sf_dir)
    out = panel.select("player_id", "year", *T.rolling_exprs(COLS, "player_id", "year", 3, "mean"))
    return rounded(out, 4, *out.columns[2:])


@query("rolling_std", f"""WITH {PANEL}
SELECT player_id, year, {_roll_sql('std', 'stddev_samp', 3)} FROM panel {_window(2)}""")
def rolling_std(spark, sf_dir):
    panel = frames.panel(spark, sf_dir)
    out = panel.select("player_id", "year", *T.rolling_exprs(COLS, "player_id", "year", 2, "std"))
    return rounded(out, 3, *out.columns[2:])


@query("growth_rate", f"WITH {PANEL} SELECT player_id, year, {_growth_sql()} FROM panel")
def growth_rate(spark, sf_dir):
    panel = frames.panel(spark, sf_dir)
    out = panel.select("player_id", "year", *T.growth_exprs(COLS, "player_id", "year"))
    return rounded(out, 6, *out.columns[2:])


@query("rolling_statistics", f"""WITH {PANEL}
SELECT player_id, year, pts, ast, {_roll_sql('mean', 'avg', 6, cols=('pts', 'ast'))},
  {_roll_sql('std', 'stddev_samp', 3, cols=('pts', 'ast'))}, {_growth_sql(('pts', 'ast'))} FROM panel {_window(2)}""")
def rolling_statistics(spark, sf_dir):
    out = T.rolling_statistics(frames.panel(spark, sf_dir).select("player_id", "year", "pts", "ast"))
    by = lambda p: [c for c in out.columns if c.startswith(p)]
    return rounded(rounded(rounded(out, 6, *by("rolling_mean")), 3, *by("rolling_std")), 6, *by("growth"))


@query("rolling_test_split", f"""WITH {PANEL}, both_parts AS (
  SELECT player_id, year, pts, ast FROM panel WHERE year BETWEEN {frames.TEST_YEAR - 1} AND {frames.TEST_YEAR}),
rolled AS (SELECT player_id, year, pts, ast, {_roll_sql('mean', 'avg', 6, cols=('pts', 'ast'))},
  {_roll_sql('std', 'stddev_samp', 3, cols=('pts', 'ast'))}, {_growth_sql(('pts', 'ast'))} FROM both_parts {_window(2)})
SELECT * FROM rolled WHERE year = {frames.TEST_YEAR}""")
def rolling_test_split(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "pts", "ast"))
    out = T.season_statistics(frames.test_rows(panel), frames.train_rows(panel), frames.TEST_YEAR)
    by = lambda p: [c for c in out.columns if c.startswith(p)]
    return rounded(rounded(rounded(out, 6, *by("rolling_mean")), 3, *by("rolling_std")), 6, *by("growth"))


@query("history_union", f"""WITH {PANEL}
SELECT player_id, year, team, pts, drafted FROM panel WHERE year < {frames.TEST_YEAR}
UNION ALL SELECT player_id, year, team, pts, NULL FROM panel WHERE year = {frames.TEST_YEAR}""")
def history_union(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "team", "pts", "drafted"))
    return tables.union_rows(frames.train_rows(panel), frames.test_rows(panel).drop("drafted"))


@query("category_universe", f"""WITH {PANEL}
SELECT 'team' AS column_name, team AS value FROM panel WHERE year < {frames.TEST_YEAR}
UNION SELECT 'team', team FROM panel WHERE year = {frames.TEST_YEAR}
UNION SELECT 'conf', conf FROM panel""")
def category_universe(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("year", "team", "conf"))
    return X.category_universe(frames.train_rows(panel), frames.test_rows(panel), ["team", "conf"])


@query("align_schema", f"""WITH {PANEL}
SELECT player_id, year, pts, ast, 0.0::DOUBLE AS conf_EUROPE, 0.0::DOUBLE AS conf_ASIA
FROM panel WHERE year = {frames.TEST_YEAR}""")
def align_schema(spark, sf_dir):
    test = frames.test_rows(frames.panel(spark, sf_dir)).select("ast", "stl", "pts", "year", "player_id")
    return tables.align_to(test, ["player_id", "year", "pts", "ast", "conf_EUROPE", "conf_ASIA"])


_KEY = "player_id * 10000 + year"


@query("hash_split", f"""WITH {PANEL}
SELECT player_id, year, CASE WHEN {sql_hash(_KEY, 42)} * 10 // 2147483648 < 8 THEN 'train' ELSE 'validation' END AS part
FROM panel""")
def hash_split(spark, sf_dir):
    panel = frames.panel(spark, sf_dir)
    return X.with_hash_part(panel, X.season_key(), test_tenths=2, seed=42).select("player_id", "year", "part")


_RANKED = f"""ranked AS (SELECT player_id, year, drafted, row_number() OVER (
    PARTITION BY drafted ORDER BY {sql_hash(_KEY, 42)}, player_id, year) AS rn,
  count(*) OVER (PARTITION BY drafted) AS n FROM panel)"""


@query("stratified_split", f"""WITH {PANEL}, {_RANKED}
SELECT player_id, year, drafted, CASE WHEN rn * 10 <= 8 * n THEN 'train' ELSE 'validation' END AS part FROM ranked""")
def stratified_split(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "drafted"))
    return X.with_stratified_part(panel, "drafted", X.season_key(), ["player_id", "year"], test_tenths=2, seed=42)


@query("stratified_folds", f"""WITH {PANEL}, {_RANKED}
SELECT player_id, year, drafted, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM ranked""")
def stratified_folds(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "drafted"))
    return X.with_stratified_fold(panel, "drafted", X.season_key(), ["player_id", "year"], folds=5, seed=42)
