"""Sources, profiling and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookup as L, profile as P
from ..operators.evaluate import class_weights
from ..session import scratch_path
from ..sources import frames, tables
from .registry import NUMBER, PANEL, RAW_PANEL, query, unpivot_sql

STATS = ["gp", "blk", "mp", "pts", "ast", "stl"]
DIRTY = ["pick", "Rec_Rank", "dunksmade", "dunksmiss_dunksmade", "dunks_ratio", "TO_per", "AST_per"]
ALL_RAW = ["player_id", "year", "team", "conf", "type", *STATS, "drafted", "yr", "ht", "num", *DIRTY]


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources -------------------------------------------------------------------------

@query("csv_roundtrip", f"""WITH {RAW_PANEL}
SELECT player_id, year, team, 'q"' || conf || '",x' AS conf, pts, pick, ht FROM raw_panel""")
def csv_roundtrip(spark, sf_dir):
    df = frames.raw_panel(spark, sf_dir).select(
        "player_id", "year", "team", F.concat(F.lit('q"'), "conf", F.lit('",x')).alias("conf"), "pts", "pick", "ht")
    path = scratch_path(spark, "scores")
    tables.write_scores(df, path)
    return tables.read_csv(spark, path, df.schema)


@query("table_info", f"WITH {RAW_PANEL} " + unpivot_sql(
    ["player_id", "year", "team", "pts", "yr", "ht", "num", "pick", "dunks_ratio"],
    "'{c}' AS column_name, CASE '{c}' WHEN 'player_id' THEN 'bigint' WHEN 'year' THEN 'int' "
    "WHEN 'pts' THEN 'double' WHEN 'pick' THEN 'double' WHEN 'dunks_ratio' THEN 'double' ELSE 'string' END AS data_type, "
    "count(*) AS n_rows, count({c}) AS n_non_null", "raw_panel"))
def table_info(spark, sf_dir):
    return tables.table_info(frames.raw_panel(spark, sf_dir).select(
        "player_id", "year", "team", "pts", "yr", "ht", "num", "pick", "dunks_ratio"))


# --- missing values ------------------------------------------------------------------

_MISSING = unpivot_sql(
    ALL_RAW, "'{c}' AS column_name, count(*) - count({c}) AS missing, "
    "round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) AS percentage", "raw_panel")


@query("missing_profile", f"WITH {RAW_PANEL} SELECT * FROM ({_MISSING}) WHERE missing > 0 ORDER BY percentage DESC")
def missing_profile(spark, sf_dir):
    got = P.missing_profile(frames.raw_panel(spark, sf_dir)).orderBy(F.desc("percentage"))
    return rounded(got, 6, "percentage")


@query("sparse_columns", f"WITH {RAW_PANEL} SELECT column_name, percentage FROM ({_MISSING}) WHERE percentage > 50")
def sparse_columns(spark, sf_dir):
    got = P.sparse_columns(frames.raw_panel(spark, sf_dir), 50.0)
    return rounded(got.select("column_name", "percentage"), 6, "percentage")


@query("columns_with_nulls", f"WITH {RAW_PANEL} SELECT column_name FROM ({_MISSING}) WHERE missing > 0")
def columns_with_nulls(spark, sf_dir):
    return P.columns_with_nulls(frames.raw_panel(spark, sf_dir))


@query("non_numeric_values", f"WITH {RAW_PANEL} " + " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM raw_panel "
    f"WHERE {c} IS NOT NULL AND NOT regexp_matches({c}, {NUMBER})" for c in ("num", "ht", "yr")))
def non_numeric_values(spark, sf_dir):
    return P.non_numeric_values(frames.raw_panel(spark, sf_dir), ["num", "ht", "yr"])


# --- distributions and summaries -----------------------------------------------------

@query("target_distribution", f"""WITH {PANEL}
SELECT drafted, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM panel), 6) AS percentage
FROM panel GROUP BY drafted""")
def target_distribution(spark, sf_dir):
    return rounded(P.distribution(frames.panel(spark, sf_dir).select("drafted"), "drafted"), 6, "percentage")


@query("class_weights", f"""WITH {PANEL}, c AS (SELECT drafted, count(*) AS n FROM panel GROUP BY drafted)
SELECT drafted, n, round(CAST((SELECT sum(n) FROM c) AS DOUBLE) / ((SELECT count(*) FROM c) * n), 9) AS weight FROM c""")
def class_weights_query(spark, sf_dir):
    return rounded(class_weights(frames.panel(spark, sf_dir), "drafted"), 9, "weight")


@query("numeric_summary", f"WITH {RAW_PANEL} " + unpivot_sql(
    [*STATS, *DIRTY],
    "'{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 3) AS std, "
    "CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 7) AS q25, "
    "round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 7) AS q50, "
    "round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 7) AS q75, CAST(max({c}) AS DOUBLE) AS max", "raw_panel"))
def numeric_summary(spark, sf_dir):
    got = P.numeric_summary(frames.raw_panel(spark, sf_dir), [*STATS, *DIRTY])
    return rounded(rounded(rounded(got, 4, "mean"), 7, "q25", "q50", "q75"), 3, "std")


@query("categorical_summary", f"WITH {RAW_PANEL}, vc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM raw_panel WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("team", "conf", "type", "yr", "ht", "num")) + """),
ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM vc)
SELECT column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       max(CASE WHEN r = 1 THEN value END) AS top, max(CASE WHEN r = 1 THEN n END) AS freq
FROM ranked GROUP BY column_name""")
def categorical_summary(spark, sf_dir):
    return P.categorical_summary(frames.raw_panel(spark, sf_dir), ["team", "conf", "type", "yr", "ht", "num"])


# --- correlations --------------------------------------------------------------------

_CORR_COLS = [*STATS, *DIRTY[1:]]
_TARGET_CORR = unpivot_sql(
    _CORR_COLS, "'{c}' AS column_name, corr(CAST({c} AS DOUBLE), CAST(drafted AS DOUBLE)) AS corr", "raw_panel")


@query("target_correlation", f"WITH {RAW_PANEL} SELECT column_name, round(corr, 6) AS corr FROM ({_TARGET_CORR})")
def target_correlation(spark, sf_dir):
    return rounded(P.target_correlation(frames.raw_panel(spark, sf_dir), "drafted", _CORR_COLS), 6, "corr")


@query("correlation_matrix", f"WITH {RAW_PANEL} " + " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6) AS corr FROM raw_panel"
    for x in [*STATS, "dunksmade", "drafted"] for y in [*STATS, "dunksmade", "drafted"]))
def correlation_matrix(spark, sf_dir):
    got = P.correlation_matrix(frames.raw_panel(spark, sf_dir), [*STATS, "dunksmade", "drafted"])
    return rounded(got, 6, "corr")


@query("top_bottom_correlated", f"""WITH {RAW_PANEL}, c AS ({_TARGET_CORR})
SELECT * FROM (SELECT column_name, round(corr, 6) AS corr, 'top' AS part FROM c ORDER BY c.corr DESC LIMIT 4)
UNION ALL
SELECT * FROM (SELECT column_name, round(corr, 6) AS corr, 'bottom' AS part FROM c ORDER BY c.corr LIMIT 4)""")
def top_bottom_correlated(spark, sf_dir):
    return rounded(P.top_bottom_correlated(frames.raw_panel(spark, sf_dir), "drafted", _CORR_COLS, 4), 6, "corr")


_BOX = ["pts", "mp", "ast", "stl", "dunksmade"]


@query("boxplot_stats", f"WITH {RAW_PANEL}, v AS (" + unpivot_sql(
    _BOX, "drafted, '{c}' AS feature, {c} AS v", "raw_panel") + """),
q AS (SELECT drafted, feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
      FROM v GROUP BY drafted, feature)
SELECT drafted, feature, round(q1, 7) AS q1, round(q2, 7) AS median, round(q3, 7) AS q3,
  min(CASE WHEN v >= q1 - 1.5::DOUBLE*(q3-q1) AND v <= q3 + 1.5::DOUBLE*(q3-q1) THEN v END) AS whisker_low,
  max(CASE WHEN v >= q1 - 1.5::DOUBLE*(q3-q1) AND v <= q3 + 1.5::DOUBLE*(q3-q1) THEN v END) AS whisker_high,
  count(CASE WHEN v < q1 - 1.5::DOUBLE*(q3-q1) OR v > q3 + 1.5::DOUBLE*(q3-q1) THEN 1 END) AS outliers
FROM v JOIN q USING (drafted, feature) GROUP BY drafted, feature, q1, q2, q3""")
def boxplot_stats(spark, sf_dir):
    got = P.box_stats(frames.raw_panel(spark, sf_dir), "drafted", _BOX, [0, 1])
    return rounded(got, 7, "q1", "median", "q3")


@query("head_preview", f"WITH {PANEL} SELECT * FROM panel ORDER BY player_id, year LIMIT 5")
def head_preview(spark, sf_dir):
    return P.preview(frames.panel(spark, sf_dir), ["player_id", "year"])


# --- lookups and group statistics ----------------------------------------------------

# A fixed dictionary over the test data's own names, leaving some keys out.
NATION_LEVELS = {f"NATION_{i}": ("Power", "Mid-Major", "Minor")[i % 3] for i in range(18)}
NATION_REGIONS = {f"NATION_{i}": ("Northeast", "Southeast", "Midwest", "West")[i % 4] for i in range(20)}


def _case(column, mapping, default="NULL"):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {default} END"


@query("conf_level_lookup", f"""WITH {PANEL}
SELECT player_id, year, team, {_case('team', NATION_LEVELS)} AS conf_level FROM panel""")
def conf_level_lookup(spark, sf_dir):
    return frames.panel(spark, sf_dir).select(
        "player_id", "year", "team", L.lookup(F.col("team"), NATION_LEVELS).alias("conf_level"))


@query("region_lookup", f"""WITH {PANEL}
SELECT player_id, year, {_case('team', NATION_REGIONS, "'Other'")} AS region FROM panel""")
def region_lookup(spark, sf_dir):
    return frames.panel(spark, sf_dir).select(
        "player_id", "year", L.lookup(F.col("team"), NATION_REGIONS, L.DEFAULT_REGION).alias("region"))


@query("region_counts", f"""WITH {PANEL}
SELECT {_case('team', NATION_REGIONS, "'Other'")} AS region, count(*) AS n FROM panel GROUP BY 1 ORDER BY n DESC""")
def region_counts(spark, sf_dir):
    return P.value_counts(region_lookup(spark, sf_dir), "region").orderBy(F.desc("n"), "region")


@query("target_encode_team", f"""WITH {PANEL}, enc AS (
  SELECT team, avg(CAST(drafted AS DOUBLE)) AS team_encoded FROM panel WHERE year < {frames.TEST_YEAR} GROUP BY team)
SELECT player_id, year, team, round(team_encoded, 9) AS team_encoded FROM panel LEFT JOIN enc USING (team)""")
def target_encode_team(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "team", "drafted"))
    encoding = L.target_encoding(frames.train_rows(panel), "team", "drafted", "team_encoded")
    got = L.apply_target_encoding(panel.select("player_id", "year", "team"), encoding, "team")
    return rounded(got, 9, "team_encoded")


@query("team_tier", f"""WITH {PANEL}, m AS (
  SELECT team, avg(pts / gp) AS o, avg(ast / gp) AS d FROM panel GROUP BY team),
q AS (SELECT quantile_cont(o, 0.25) AS o25, quantile_cont(o, 0.75) AS o75,
             quantile_cont(d, 0.25) AS d25, quantile_cont(d, 0.75) AS d75 FROM m),
t AS (SELECT team, CASE WHEN o >= o75 AND d <= d25 THEN 'High' WHEN o <= o25 AND d >= d75 THEN 'Low'
                   ELSE 'Medium' END AS team_performance_tier FROM m, q)
SELECT player_id, year, team, team_performance_tier FROM panel LEFT JOIN t USING (team)""")
def team_tier(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "team", "pts", "ast", "gp"))
    per_game = lambda c: F.try_divide(F.col(c), F.col("gp").cast("double"))
    tiers = L.tier_table(panel, "team", per_game("pts"), per_game("ast"), "team_performance_tier")
    return L.attach(panel.select("player_id", "year", "team"), tiers, ["team"])


_CODES = [*L.CONF_LEVELS, "none"]


@query("bin_team_and_conf", f"""WITH {PANEL}, m AS (
  SELECT team, avg(pts / gp) AS o, avg(ast / gp) AS d FROM panel GROUP BY team),
q AS (SELECT quantile_cont(o, 0.25) AS o25, quantile_cont(o, 0.75) AS o75,
             quantile_cont(d, 0.25) AS d25, quantile_cont(d, 0.75) AS d75 FROM m),
t AS (SELECT team, CASE WHEN o >= o75 AND d <= d25 THEN 'High' WHEN o <= o25 AND d >= d75 THEN 'Low'
                   ELSE 'Medium' END AS team_performance_tier FROM m, q),
c AS (SELECT *, {_CODES}[player_id % {len(_CODES)} + 1] AS code FROM panel)
SELECT player_id, year, team, code, {_case('code', L.CONF_LEVELS)} AS "Conf_Level", team_performance_tier
FROM c LEFT JOIN t USING (team)""")
def bin_team_and_conf(spark, sf_dir):
    """Both binnings in one call; conference codes stand in by the player's number."""
    code = F.get(F.array(*map(F.lit, _CODES)), (F.col("player_id") % len(_CODES)).cast("int")).alias("code")
    panel = frames.once(frames.panel(spark, sf_dir).select("player_id", "year", "team", code, "pts", "ast", "gp"))
    per_game = lambda c: F.try_divide(F.col(c), F.col("gp").cast("double"))
    out = L.bin_team_and_conf(panel, conf="code", offence=per_game("pts"), defence=per_game("ast"))
    return out.select("player_id", "year", "team", "code", "Conf_Level", "team_performance_tier")


@query("team_avg_transform", f"""WITH {PANEL}, m AS (
  SELECT team, avg(pts / gp) AS team_avg_off, avg(ast / gp) AS team_avg_def FROM panel GROUP BY team)
SELECT player_id, year, team, round(team_avg_off, 5) AS team_avg_off, round(team_avg_def, 5) AS team_avg_def
FROM panel LEFT JOIN m USING (team)""")
def team_avg_transform(spark, sf_dir):
    per_game = lambda c: F.try_divide(F.col(c), F.col("gp").cast("double"))
    got = L.group_transform_mean(frames.panel(spark, sf_dir), "team", {
        "team_avg_off": per_game("pts"), "team_avg_def": per_game("ast")})
    return rounded(got.select("player_id", "year", "team", "team_avg_off", "team_avg_def"),
                   5, "team_avg_off", "team_avg_def")
