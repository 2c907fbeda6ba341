"""Derived features. Each function adds columns when its inputs exist and otherwise returns the
frame unchanged, so features chain with DataFrame.transform."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import FLOAT_EPS, ratio
from ..sources.tables import has_columns, numeric_columns
from .lookup import group_transform_mean
from .quantiles import exact_quantiles

MAX_NAMED_COLUMNS = 500
INTERACTION_BASES = ["pts", "ast", "stl", "blk"]
BIN_LABELS = ["Low", "Medium", "High"]


def field_goal_attempts(df: DataFrame) -> Column | None:
    if has_columns(df, "FGA"):
        return F.col("FGA")
    return F.col("twoPA") + F.col("TPA") if has_columns(df, "twoPA", "TPA") else None


def _pick(df: DataFrame, *names: str) -> Column | None:
    return next((F.col(n) for n in names if has_columns(df, n)), None)


def _add(df: DataFrame, name: str, needs: Sequence[Column | None], make) -> DataFrame:
    return df if any(n is None for n in needs) else df.withColumn(name, make(*needs))


def three_point_preference(df: DataFrame) -> DataFrame:
    return _add(df, "three_point_preference", [_pick(df, "3PA", "TPA"), field_goal_attempts(df)], ratio)


def inside_scoring_ability(df: DataFrame) -> DataFrame:
    return _add(df, "inside_scoring_ability", [_pick(df, "2P", "twoPM"), field_goal_attempts(df)], ratio)


def playmaking_ability(df: DataFrame) -> DataFrame:
    return _add(df, "playmaking_ability", [_pick(df, "ast"), _pick(df, "pts")], lambda ast, pts: ast / F.when(
        pts == 0, F.lit(FLOAT_EPS)).otherwise(pts))


def defensive_index(df: DataFrame) -> DataFrame:
    return _add(df, "defensive_metric", [_pick(df, c) for c in ("stl", "blk", "GP")],
                lambda stl, blk, gp: ratio(stl + blk, gp))


def versatility_index(df: DataFrame) -> DataFrame:
    return _add(df, "versatility_index", [_pick(df, c) for c in ("pts", "ast", "stl", "blk")],
                lambda *cols: reduce(lambda a, b: a * b, cols))


def ratio_features(df: DataFrame) -> DataFrame:
    for step in (three_point_preference, inside_scoring_ability, playmaking_ability, defensive_index, versatility_index):
        df = df.transform(step)
    return df


def rate_features(df: DataFrame, team: str | None = "team") -> DataFrame:
    """Ratings and per-game, per-minute and per-turnover rates, in one projection; team means
    of the ratings when a team column exists."""
    off, de, gp, mp, to = (_pick(df, c) for c in ("ORtg", "drtg", "GP", "mp", "TO_per"))
    pts, ast, stl, reb = (_pick(df, c) for c in ("pts", "ast", "stl", "treb"))
    fta, ftm, fga = _pick(df, "FTA"), _pick(df, "FTM"), field_goal_attempts(df)
    recipes = [
        ("Net_Rating", [off, de], lambda a, b: a - b),
        ("Scoring_Efficiency", [pts, fga, fta], lambda p, g, t: ratio(p, g + F.lit(0.44) * t)),
        ("Rebound_Rate", [reb, gp], ratio),
        ("Ast_To_Turnover_Ratio", [ast, to], ratio),
        ("Stl_To_Turnover_Ratio", [stl, to], ratio),
        ("Points_Per_Minute", [pts, mp], ratio),
        ("Impact_Score", [pts, ast, reb, fta, ftm], lambda p, a, r, t, m: p + a + r - (t - m)),
        ("Versatility_Index", [pts, ast, reb], lambda p, a, r: p + a + r),
    ]
    out = df.withColumns({n: make(*needs) for n, needs, make in recipes if all(x is not None for x in needs)})
    if team and has_columns(df, team, "ORtg", "drtg"):
        out = group_transform_mean(out, team, {"Team_Avg_ORtg": F.col("ORtg"), "Team_Avg_DRtg": F.col("drtg")})
    return out


def interaction_features(df: DataFrame, bases: Sequence[str] = tuple(INTERACTION_BASES),
                         columns: Sequence[str] | None = None, target: str = "drafted") -> DataFrame:
    """Every numeric column times each base, named <column>_<base>, in one projection."""
    cols = list(columns or numeric_columns(df, [target]))
    return df.select("*", *[
        (F.col(c) * F.col(b)).alias(f"{c}_{b}") for b in bases if has_columns(df, b) for c in cols])


def equal_width_edges(df: DataFrame, column: str, bins: int) -> list[float] | None:
    lo, hi = df.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    if lo is None:
        return None
    return [lo + i * ((hi - lo) / bins) for i in range(1, bins)] if hi > lo else []


def equal_width_bins(df: DataFrame, column: str, out: str, labels: Sequence[str] = tuple(BIN_LABELS)) -> DataFrame:
    """Right-closed bins of equal width between the column's minimum and maximum; a constant
    column falls into the middle bin."""
    if not has_columns(df, column):
        return df
    edges = equal_width_edges(df, column, len(labels))
    c = F.col(column)
    if edges is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    if not edges:
        return df.withColumn(out, F.when(c.isNotNull(), F.lit(labels[(len(labels) - 1) // 2])))
    return df.withColumn(out, _label(c, edges, labels))


def _label(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    out = F.when(c.isNotNull(), F.lit(labels[-1]))
    for edge, label in reversed(list(zip(edges, labels))):
        out = F.when(c <= F.lit(edge), F.lit(label)).otherwise(out)
    return out


def quantile_bins(df: DataFrame, column: str, out: str, labels: Sequence[str] = ("low", "medium", "high")) -> DataFrame:
    """Right-closed bins with equal numbers of rows."""
    probs = [i / len(labels) for i in range(1, len(labels))]
    edges = exact_quantiles(df, {"x": (F.col(column), probs)})["x"]
    if edges[0] is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    return df.withColumn(out, _label(F.col(column), edges, labels))


def defensive_bins(df: DataFrame) -> DataFrame:
    return equal_width_bins(df, "defensive_metric", "defensive_metric_bin")


def polynomial_terms(columns: Sequence[str], degree: int = 2, interaction_only: bool = False,
                     include_bias: bool = False) -> list[tuple[str, Column]]:
    """(name, product) per term: a, b, a^2, a b, b^2 for degree 2."""
    choose = itertools.combinations if interaction_only else itertools.combinations_with_replacement
    terms = [("1", F.lit(1.0))] if include_bias else []
    for d in range(1, degree + 1):
        for combo in choose(columns, d):
            powers = [(c, len(list(g))) for c, g in itertools.groupby(combo)]
            name = " ".join(c if n == 1 else f"{c}^{n}" for c, n in powers)
            terms.append((name, reduce(lambda a, b: a * b, [F.col(c).cast("double") for c in combo])))
    return terms


def polynomial_features(
    df: DataFrame, columns: Sequence[str] | None = None, *, target: str | None = None, degree: int = 2,
    interaction_only: bool = False, include_bias: bool = False, as_vector: str | None = None,
) -> DataFrame:
    """Polynomial terms of the numeric columns; other columns and the target are kept. With
    `as_vector` the terms form one vector column, the way to go when there are many."""
    cols = list(columns or numeric_columns(df, [target] if target else []))
    rest = [c for c in df.columns if c not in cols]
    if as_vector and not (interaction_only or include_bias):
        expand = [VectorAssembler(inputCols=cols, outputCol="_v"),
                  PolynomialExpansion(degree=degree, inputCol="_v", outputCol=as_vector)]
        return expand[1].transform(expand[0].transform(df)).select(*rest, as_vector)
    terms = polynomial_terms(cols, degree, interaction_only, include_bias)
    if as_vector:
        return df.select(*rest, array_to_vector(F.array(*[t for _, t in terms])).alias(as_vector))
    if len(terms) > MAX_NAMED_COLUMNS:
        raise ValueError(f"{len(terms)} terms: pass as_vector to get them as one vector column")
    return df.select(*rest, *[t.alias(n) for n, t in terms])


def pairwise_features(df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ("player_id",)) -> DataFrame:
    """Sum and product of every pair of numeric columns, in one projection."""
    cols = list(columns or numeric_columns(df, keep))
    return df.select("*", *[
        e for a, b in itertools.combinations(cols, 2)
        for e in ((F.col(a) + F.col(b)).alias(f"{a} + {b}"), (F.col(a) * F.col(b)).alias(f"{a} * {b}"))])


def efficiency_features(df: DataFrame) -> DataFrame:
    """Earlier per-minute measures: usage efficiency, defence to offence, offensive metric and
    true scoring efficiency."""
    pts, ast, stl, blk, mp = (_pick(df, c) for c in ("pts", "ast", "stl", "blk", "mp"))
    fta, ftm, fga, to, reb = _pick(df, "FTA"), _pick(df, "FTM"), field_goal_attempts(df), _pick(df, "TO_per"), _pick(df, "treb")
    made = F.col("twoPM") + F.col("TPM") if has_columns(df, "twoPM", "TPM") else None
    recipes = [
        ("usage_efficiency", [pts, reb, ast, stl, blk, fta, ftm, fga, made, to, mp],
         lambda p, r, a, s, b, ta, tm, ga, gm, o, m: ratio(p + r + a + s + b - (ta - tm) - (ga - gm) - o, m)),
        ("def_to_off_ratio", [stl, blk, pts, ast],
         lambda s, b, p, a: F.when(p + a == 0, F.lit(0.0)).otherwise(ratio(s + b, p + a))),
        ("offensive_metric", [pts, ast, mp], lambda p, a, m: ratio(p + a, m)),
        ("scoring_efficiency", [pts, fga, fta], lambda p, g, t: ratio(p, g + F.lit(0.44) * t)),
    ]
    return df.withColumns({n: make(*needs) for n, needs, make in recipes if all(x is not None for x in needs)})


def build_features(df: DataFrame) -> DataFrame:
    """The whole chain: ratios, interactions, bins."""
    return df.transform(ratio_features).transform(interaction_features).transform(defensive_bins)
