"""Derived features, encoding and scaling."""

from __future__ import annotations

import itertools

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import encode as E, features as G
from ..sources import frames
from .profiling import rounded
from .registry import PANEL, query

TRAIN = f"year < {frames.TEST_YEAR}"

SHOTS = PANEL + """,
shots0 AS (
  SELECT player_id, year, team, conf, type, gp AS "GP", blk, mp, pts, ast, stl, drafted,
    CAST((player_id + year) % 5 AS DOUBLE) AS TPA, CAST(player_id % 2 AS DOUBLE) AS TPM,
    CAST((player_id*3 + year) % 7 AS DOUBLE) AS twoPA, CAST(player_id % 9 AS DOUBLE) AS FTA,
    CASE WHEN (player_id*3+year)%8 = 0 THEN 0.0::DOUBLE ELSE CAST((player_id*3+year)%25 AS DOUBLE) END AS TO_per,
    CAST((player_id*5 + year) % 12 AS DOUBLE) AS treb, pts / gp AS ORtg, ast / gp AS drtg FROM panel),
shots AS (SELECT *, least(twoPA, CAST(player_id % 4 AS DOUBLE)) AS twoPM,
                    least(FTA, CAST(year % 6 AS DOUBLE)) AS FTM FROM shots0)
"""
_RATIOS = """TPA / nullif(twoPA + TPA, 0) AS three_point_preference,
  twoPM / nullif(twoPA + TPA, 0) AS inside_scoring_ability,
  ast / CASE WHEN pts = 0 THEN 2.220446049250313e-16::DOUBLE ELSE pts END AS playmaking_ability,
  (stl + blk) / "GP" AS defensive_metric, pts * ast * stl * blk AS versatility_index"""


@query("fe_ratios", f"WITH {SHOTS} SELECT player_id, year, {_RATIOS} FROM shots")
def fe_ratios(spark, sf_dir):
    return G.ratio_features(frames.shot_panel(spark, sf_dir)).select(
        "player_id", "year", "three_point_preference", "inside_scoring_ability", "playmaking_ability",
        "defensive_metric", "versatility_index")


@query("fe_rate_pack", f"""WITH {SHOTS}, m AS (SELECT team, avg(ORtg) AS o, avg(drtg) AS d FROM shots GROUP BY team)
SELECT player_id, year, ORtg - drtg AS Net_Rating, pts / nullif(twoPA + TPA + 0.44::DOUBLE * FTA, 0) AS Scoring_Efficiency,
  treb / "GP" AS Rebound_Rate, ast / nullif(TO_per, 0) AS Ast_To_Turnover_Ratio,
  stl / nullif(TO_per, 0) AS Stl_To_Turnover_Ratio, pts / nullif(mp, 0) AS Points_Per_Minute,
  pts + ast + treb - (FTA - FTM) AS Impact_Score, pts + ast + treb AS Versatility_Index,
  round(o, 4) AS Team_Avg_ORtg, round(d, 4) AS Team_Avg_DRtg
FROM shots LEFT JOIN m USING (team)""")
def fe_rate_pack(spark, sf_dir):
    out = G.rate_features(frames.once(frames.shot_panel(spark, sf_dir))).select(
        "player_id", "year", "Net_Rating", "Scoring_Efficiency", "Rebound_Rate", "Ast_To_Turnover_Ratio",
        "Stl_To_Turnover_Ratio", "Points_Per_Minute", "Impact_Score", "Versatility_Index",
        "Team_Avg_ORtg", "Team_Avg_DRtg")
    return rounded(out, 4, "Team_Avg_ORtg", "Team_Avg_DRtg")


_BASE = ["gp", "blk", "mp", "pts", "ast", "stl"]


@query("fe_interactions", f"WITH {PANEL} SELECT player_id, year, " + ", ".join(
    [*_BASE, *(f"{c} * {b} AS {c}_{b}" for b in G.INTERACTION_BASES for c in _BASE)]) + " FROM panel")
def fe_interactions(spark, sf_dir):
    panel = frames.panel(spark, sf_dir).select("player_id", "year", *_BASE)
    return G.interaction_features(panel, columns=_BASE)


@query("equal_width_bins", f"""WITH {PANEL}, m AS (SELECT player_id, year, (stl + blk) / gp AS defensive_metric FROM panel),
e AS (SELECT min(defensive_metric) AS lo, max(defensive_metric) AS hi FROM m)
SELECT player_id, year, CASE WHEN defensive_metric <= lo + 1 * ((hi - lo) / 3) THEN 'Low'
  WHEN defensive_metric <= lo + 2 * ((hi - lo) / 3) THEN 'Medium'
  WHEN defensive_metric IS NOT NULL THEN 'High' END AS defensive_metric_bin FROM m, e""")
def equal_width_bins(spark, sf_dir):
    panel = frames.panel(spark, sf_dir).withColumnRenamed("gp", "GP")
    out = G.defensive_bins(G.defensive_index(frames.once(panel)))
    return out.select("player_id", "year", "defensive_metric_bin")


def _poly_sql(cols):
    sq = [f'{a} * {b} AS "{a}^2"' if a == b else f'{a} * {b} AS "{a} {b}"'
          for a, b in itertools.combinations_with_replacement(cols, 2)]
    return ", ".join([*cols, *sq])


@query("poly_features", f"WITH {PANEL} SELECT player_id, year, team, drafted, {_poly_sql(['pts', 'ast', 'stl', 'blk'])} FROM panel")
def poly_features(spark, sf_dir):
    panel = frames.panel(spark, sf_dir).select("player_id", "year", "team", "pts", "ast", "stl", "blk", "drafted")
    return G.polynomial_features(panel, ["pts", "ast", "stl", "blk"], target="drafted")


def _scaled(cols, center, scale):
    return ", ".join(
        f"({c} - (SELECT {center.format(c=c)} FROM panel WHERE {TRAIN})) / (SELECT {scale.format(c=c)} FROM panel WHERE {TRAIN}) AS {c}"
        for c in cols)


_STD = ("avg({c})", "stddev_pop({c})")


@query("scaled_poly", f"""WITH {PANEL}, z AS (SELECT player_id, year, {_scaled(['pts', 'ast', 'stl'], *_STD)} FROM panel)
SELECT player_id, year, """ + ", ".join(
    f'round({a} * {b}, 6) AS "{a}^2"' if a == b else f'round({a} * {b}, 6) AS "{a} {b}"'
    for a, b in itertools.combinations_with_replacement(["pts", "ast", "stl"], 2)) + """,
  round(pts, 6) AS pts, round(ast, 6) AS ast, round(stl, 6) AS stl FROM z""")
def scaled_poly(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "pts", "ast", "stl"))
    cols = ["pts", "ast", "stl"]
    scaled = E.Scaler().fit(frames.train_rows(panel), cols).transform(panel)
    out = G.polynomial_features(scaled, cols)
    return rounded(out, 6, *out.columns[2:])


_PAIRS = ["gp", "mp", "pts", "ast", "stl", "blk"]


@query("pairwise_features", f"WITH {PANEL} SELECT player_id, year, " + ", ".join(
    [*_PAIRS, *(f'{a} {op} {b} AS "{a} {op} {b}"' for a, b in itertools.combinations(_PAIRS, 2) for op in "+*")])
    + " FROM panel")
def pairwise_features(spark, sf_dir):
    return G.pairwise_features(frames.panel(spark, sf_dir).select("player_id", "year", *_PAIRS), _PAIRS)


@query("feature_chain", f"""WITH {SHOTS}, r AS (SELECT *, {_RATIOS} FROM shots),
e AS (SELECT min(defensive_metric) AS lo, max(defensive_metric) AS hi FROM r)
SELECT player_id, year, three_point_preference, versatility_index, pts * pts AS pts_pts, defensive_metric * blk AS defensive_metric_blk,
  CASE WHEN defensive_metric <= lo + 1 * ((hi - lo) / 3) THEN 'Low' WHEN defensive_metric <= lo + 2 * ((hi - lo) / 3) THEN 'Medium'
  WHEN defensive_metric IS NOT NULL THEN 'High' END AS defensive_metric_bin FROM r, e""")
def feature_chain(spark, sf_dir):
    return G.build_features(frames.once(frames.shot_panel(spark, sf_dir))).select(
        "player_id", "year", "three_point_preference", "versatility_index", "pts_pts", "defensive_metric_blk",
        "defensive_metric_bin")


@query("fe_efficiency", f"""WITH {SHOTS}, f AS (SELECT player_id, year,
  (pts + treb + ast + stl + blk - (FTA - FTM) - (twoPA + TPA - (twoPM + TPM)) - TO_per) / nullif(mp, 0) AS usage_efficiency,
  CASE WHEN pts + ast = 0 THEN 0.0::DOUBLE ELSE (stl + blk) / (pts + ast) END AS def_to_off_ratio,
  (pts + ast) / nullif(mp, 0) AS offensive_metric, pts / nullif(twoPA + TPA + 0.44::DOUBLE * FTA, 0) AS scoring_efficiency
  FROM shots),
e AS (SELECT quantile_cont(offensive_metric, 1.0/3) AS a, quantile_cont(offensive_metric, 2.0/3) AS b FROM f)
SELECT player_id, year, usage_efficiency, def_to_off_ratio, offensive_metric, scoring_efficiency,
  CASE WHEN offensive_metric <= a THEN 'low' WHEN offensive_metric <= b THEN 'medium'
       WHEN offensive_metric IS NOT NULL THEN 'high' END AS offensive_metric_bin FROM f, e""")
def fe_efficiency(spark, sf_dir):
    out = G.efficiency_features(frames.once(frames.shot_panel(spark, sf_dir)))
    return G.quantile_bins(out, "offensive_metric", "offensive_metric_bin").select(
        "player_id", "year", "usage_efficiency", "def_to_off_ratio", "offensive_metric", "scoring_efficiency",
        "offensive_metric_bin")


# --- encoding and scaling ------------------------------------------------------------

_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot_drop_first", f"WITH {PANEL} SELECT player_id, year, pts, " + ", ".join(
    f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS INTEGER) AS \"{c}_{v}\""
    for c, vs in (("conf", _REGIONS[1:]), ("type", _SEGMENTS[1:])) for v in vs) + " FROM panel")
def one_hot_drop_first(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "pts", "conf", "type"))
    return E.fit_one_hot(frames.train_rows(panel), ["conf", "type"]).transform(panel)


def _slots_sql(c: str) -> str:
    """Categories of the training rows in descending order; the last one has no slot."""
    return (f"{c}_cats AS (SELECT {c}, row_number() OVER (ORDER BY {c} DESC) - 1 AS slot, count(*) OVER () - 1 AS width "
            f"FROM (SELECT DISTINCT {c} FROM panel WHERE {TRAIN}))")


@query("one_hot_vector", f"""WITH {PANEL}, {_slots_sql('team')}, {_slots_sql('conf')}
SELECT player_id, year, CAST(CASE WHEN t.slot < t.width THEN t.slot ELSE -1 END AS INTEGER) AS team_slot,
  CAST((SELECT max(width) FROM team_cats) AS INTEGER) AS team_width,
  CAST(CASE WHEN c.slot < c.width THEN c.slot ELSE -1 END AS INTEGER) AS conf_slot,
  CAST((SELECT max(width) FROM conf_cats) AS INTEGER) AS conf_width
FROM panel LEFT JOIN team_cats t USING (team) LEFT JOIN conf_cats c USING (conf)""")
def one_hot_vector(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "team", "conf"))
    hot = E.fit_one_hot_vector(frames.train_rows(panel), ["team", "conf"]).transform(panel)
    slot = lambda c: (F.array_position(vector_to_array(f"{c}_hot"), 1.0) - 1).cast("int")
    no_slot = lambda c: F.when(slot(c) < 0, F.lit(-1)).otherwise(slot(c)).alias(f"{c}_slot")
    width = lambda c: F.size(vector_to_array(f"{c}_hot")).alias(f"{c}_width")
    return hot.select("player_id", "year", *[e for c in ("team", "conf") for e in (no_slot(c), width(c))])


def _scaling(kind, cols):
    def run(spark, sf_dir):
        panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", *cols))
        return rounded(E.Scaler(kind).fit(frames.train_rows(panel), cols).transform(panel), 6, *cols)
    return run


def _scaling_sql(cols, center, scale):
    return f"""WITH {PANEL}, z AS (SELECT player_id, year, {_scaled(cols, center, scale)} FROM panel)
SELECT player_id, year, {", ".join(f"round({c}, 6) AS {c}" for c in cols)} FROM z"""


query("standard_scale", _scaling_sql(_PAIRS, *_STD))(_scaling("standard", _PAIRS))
query("minmax_scale", _scaling_sql(_PAIRS, "min({c})", "max({c}) - min({c})"))(_scaling("minmax", _PAIRS))
