"""Cleaning and imputation queries on the dirty panel. Statistics are fitted on the training
seasons and applied to every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean as C
from ..sources import frames
from .profiling import rounded
from .registry import NUMBER, RAW_PANEL, query

TRAIN = f"year < {frames.TEST_YEAR}"


def height_sql(c: str) -> str:
    feet = lambda part: f"CASE {part} WHEN 'Apr' THEN 4 WHEN 'May' THEN 5 WHEN 'Jun' THEN 6 WHEN 'Jul' THEN 7 END"
    return f"""CAST(CASE WHEN {c} IN ('-', 'None', '0', 'Jr', 'So', 'Fr') THEN NULL
  WHEN regexp_matches({c}, '^[0-9]{{1,6}}''[0-9]{{1,6}}$')
    THEN TRY_CAST(split_part({c}, '''', 1) AS INTEGER) * 12 + TRY_CAST(split_part({c}, '''', 2) AS INTEGER)
  WHEN regexp_matches({c}, '^(Apr|May|Jun|Jul)-[0-9]{{1,6}}$')
    THEN ({feet(f"split_part({c}, '-', 1)")}) * 12 + TRY_CAST(split_part({c}, '-', 2) AS INTEGER)
  WHEN regexp_matches({c}, '^[0-9]{{1,6}}-(Apr|May|Jun|Jul)$')
    THEN ({feet(f"split_part({c}, '-', 2)")}) * 12 + TRY_CAST(split_part({c}, '-', 1) AS INTEGER) END AS DOUBLE)"""


def class_sql(c: str) -> str:
    return f"CAST(CASE {c} WHEN 'Fr' THEN 1 WHEN 'So' THEN 2 WHEN 'Jr' THEN 3 WHEN 'Sr' THEN 4 END AS DOUBLE)"


def number_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {NUMBER}) THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def mode_sql(c: str, source: str) -> str:
    return (f"(SELECT {c} FROM {source} WHERE {TRAIN} AND {c} IS NOT NULL "
            f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")


@query("height_inches", f"WITH {RAW_PANEL} SELECT player_id, year, ht, {height_sql('ht')} AS ht_inches FROM raw_panel")
def height_inches(spark, sf_dir):
    return frames.raw_panel(spark, sf_dir).select(
        "player_id", "year", "ht", S.height_inches(F.col("ht")).alias("ht_inches"))


@query("yr_ordinal", f"WITH {RAW_PANEL} SELECT player_id, year, yr, {class_sql('yr')} AS yr_ordinal FROM raw_panel")
def yr_ordinal(spark, sf_dir):
    return frames.raw_panel(spark, sf_dir).select(
        "player_id", "year", "yr", S.class_year(F.col("yr")).alias("yr_ordinal"))


@query("presence_flags", f"""WITH {RAW_PANEL}
SELECT player_id, year, CAST(CASE WHEN Rec_Rank IS NULL THEN 0 ELSE 1 END AS INTEGER) AS Rec_Rank,
       CAST(CASE WHEN pick IS NULL THEN 0 ELSE 1 END AS INTEGER) AS pick FROM raw_panel""")
def presence_flags(spark, sf_dir):
    return frames.raw_panel(spark, sf_dir).select(
        "player_id", "year", *[S.presence(F.col(c)).alias(c) for c in ("Rec_Rank", "pick")])


_REPAIR = f"""st AS (SELECT avg(dunksmade) AS m, avg(dunksmiss_dunksmade) AS t FROM raw_panel WHERE {TRAIN}),
fixed AS (SELECT * REPLACE (coalesce(dunksmade, m) AS dunksmade, coalesce(dunksmiss_dunksmade, t) AS dunksmiss_dunksmade,
    coalesce(dunks_ratio, dunksmade / nullif(dunksmiss_dunksmade, 0),
             coalesce(dunksmade, m) / nullif(coalesce(dunksmiss_dunksmade, t), 0)) AS dunks_ratio)
  FROM raw_panel, st)"""


@query("ratio_repair", f"""WITH {RAW_PANEL}, {_REPAIR}
SELECT player_id, year, round(dunksmade, 6) AS dunksmade, round(dunksmiss_dunksmade, 6) AS dunksmiss_dunksmade,
       round(dunks_ratio, 6) AS dunks_ratio FROM fixed""")
def ratio_repair(spark, sf_dir):
    raw = frames.once(frames.raw_panel(spark, sf_dir))
    spec = C.CleanSpec(height_col=None, class_col=None, ratio_specs=C.PRESET_V3.ratio_specs)
    out = C.apply(raw, spec, C.fit(frames.train_rows(raw), spec))
    cols = ["dunksmade", "dunksmiss_dunksmade", "dunks_ratio"]
    return rounded(out.select("player_id", "year", *cols), 6, *cols)


@query("safe_numeric", f"""WITH {RAW_PANEL}
SELECT player_id, year, coalesce({number_sql('num')}, -1.0::DOUBLE) AS num FROM raw_panel""")
def safe_numeric(spark, sf_dir):
    spec = C.CleanSpec(height_col=None, class_col=None, placeholder_cols=["num"])
    return C.parse(frames.raw_panel(spark, sf_dir), spec).select("player_id", "year", "num")


@query("coerce_median", f"""WITH {RAW_PANEL}, n AS (SELECT player_id, year, {number_sql('num')} AS num FROM raw_panel)
SELECT player_id, year, coalesce(num, (SELECT quantile_cont(num, 0.5) FROM n WHERE {TRAIN})) AS num FROM n""")
def coerce_median(spark, sf_dir):
    raw = frames.once(frames.raw_panel(spark, sf_dir))
    spec = C.CleanSpec(height_col=None, class_col=None, number_cols=["num"], median_cols=["num"])
    return C.apply(raw, spec, C.fit(frames.train_rows(raw), spec)).select("player_id", "year", "num")


@query("ratio_inf_guard", f"""WITH {RAW_PANEL},
n AS (SELECT player_id, year, AST_per / nullif(TO_per, 0) AS ast_tov FROM raw_panel)
SELECT player_id, year, round(coalesce(ast_tov, (SELECT quantile_cont(ast_tov, 0.5) FROM n WHERE {TRAIN})), 9) AS ast_tov
FROM n""")
def ratio_inf_guard(spark, sf_dir):
    raw = frames.once(frames.raw_panel(spark, sf_dir))
    spec = C.CleanSpec(height_col=None, class_col=None, guarded_ratios=C.PRESET_V3.guarded_ratios)
    out = C.apply(raw, spec, C.fit(frames.train_rows(raw), spec))
    return rounded(out.select("player_id", "year", "ast_tov"), 9, "ast_tov")


# --- fitted statistics and presets ---------------------------------------------------

_V2_MEDIANS = ["dunksmade", "dunksmiss_dunksmade", "dunks_ratio", "ast", "stl", "blk", "pts"]
_V2_MEANS = ["ht", "mp", "yr"]
_MEDIAN = "quantile_cont({c}, 0.5)"


def _parsed(source: str = "raw_panel") -> str:
    return (f"parsed AS (SELECT * REPLACE ({height_sql('ht')} AS ht, {class_sql('yr')} AS yr) FROM {source})")


def _long(stat: str, fn: str, columns: list[str], source: str) -> list[str]:
    return [f"SELECT '{stat}' AS stat, '{c}' AS column_name, round({fn.format(c=c)}, 6) AS number, "
            f"CAST(NULL AS VARCHAR) AS text FROM {source} WHERE {TRAIN}" for c in columns]


@query("impute_stats", f"WITH {RAW_PANEL}, {_parsed()} " + " UNION ALL ".join(
    _long("median", _MEDIAN, _V2_MEDIANS, "parsed") + _long("mean", "avg({c})", _V2_MEANS, "parsed")
    + [f"SELECT 'mode', '{c}', CAST(NULL AS DOUBLE), {mode_sql(c, 'parsed')}" for c in ("team", "conf", "num")]))
def impute_stats(spark, sf_dir):
    train = frames.train_rows(frames.raw_panel(spark, sf_dir))
    return rounded(C.fit(train, C.PRESET_V2).frame(spark), 6, "number")


def _fill(columns: dict[str, str]) -> str:
    return ", ".join(f"round(coalesce({c}, {s}), 6) AS {c}" for c, s in columns.items())


def _medians(columns, source):
    return {c: f"(SELECT quantile_cont({c}, 0.5) FROM {source} WHERE {TRAIN})" for c in columns}


def _means(columns, source):
    return {c: f"(SELECT avg({c}) FROM {source} WHERE {TRAIN})" for c in columns}


@query("impute_train_test", f"""WITH {RAW_PANEL}, {_parsed()}
SELECT player_id, year, {_fill({**_medians(['pts', 'dunksmade'], 'parsed'), **_means(['ht', 'mp'], 'parsed')})}
FROM parsed WHERE year = {frames.TEST_YEAR}""")
def impute_train_test(spark, sf_dir):
    raw = frames.once(frames.raw_panel(spark, sf_dir))
    spec = C.CleanSpec(class_col=None, median_cols=["pts", "dunksmade"], mean_cols=["ht", "mp"])
    out = C.apply(frames.test_rows(raw), spec, C.fit(frames.train_rows(raw), spec))
    cols = ["pts", "dunksmade", "ht", "mp"]
    return rounded(out.select("player_id", "year", *cols), 6, *cols)


def _preset(name: str):
    def run(spark, sf_dir):
        raw = frames.once(frames.raw_panel(spark, sf_dir))
        _, stats = C.preprocess(frames.train_rows(raw), name)
        out, _ = C.preprocess(raw, name, stats)
        return rounded(out, 6, *[c for c, t in out.dtypes if t == "double"])
    return run


_KEEP = "player_id, year, team, conf"
_COUNTS = "gp, drafted"

query("preprocess_v1", f"""WITH {RAW_PANEL}, parsed AS (SELECT * REPLACE ({height_sql('ht')} AS ht,
  {class_sql(f"coalesce(yr, {mode_sql('yr', 'raw_panel')})")} AS yr) FROM raw_panel)
SELECT {_KEEP}, type, {_COUNTS}, TO_per, AST_per,
  {_fill(_medians(['ht', 'yr', 'dunksmade', 'dunksmiss_dunksmade', 'dunks_ratio', 'mp', 'ast', 'stl', 'blk', 'pts'], 'parsed'))}
FROM parsed""")(_preset("v1"))

query("preprocess_v2", f"""WITH {RAW_PANEL}, {_parsed()}
SELECT {_KEEP}, {_COUNTS}, TO_per, AST_per,
  {_fill({**_medians(_V2_MEDIANS, 'parsed'), **_means(_V2_MEANS, 'parsed')})}
FROM parsed""")(_preset("v2"))

_V3 = f"""WITH {RAW_PANEL}, {_REPAIR}, {_parsed('fixed')},
ratioed AS (SELECT *, AST_per / nullif(TO_per, 0) AS ast_tov FROM parsed)
SELECT :keys team, conf, {_COUNTS}, TO_per, AST_per,
  CAST(CASE WHEN Rec_Rank IS NULL THEN 0 ELSE 1 END AS INTEGER) AS Rec_Rank,
  CAST(CASE WHEN pick IS NULL THEN 0 ELSE 1 END AS INTEGER) AS pick,
  {_fill({**_medians([*_V2_MEDIANS, 'ast_tov'], 'ratioed'), **_means(_V2_MEANS, 'ratioed')})}
FROM ratioed"""

query("preprocess_v3", _V3.replace(":keys", "player_id,"))(_preset("v3"))
query("preprocess_v4", _V3.replace(":keys", "player_id, year,"))(_preset("v4"))

query("clean_inline", f"""WITH {RAW_PANEL},
parsed AS (SELECT * REPLACE ({class_sql('yr')} AS yr, {number_sql('num')} AS num) FROM raw_panel)
SELECT {_KEEP}, type, {_COUNTS}, TO_per, AST_per,
  {_fill(_medians(['yr', 'num', 'dunksmade', 'dunksmiss_dunksmade', 'mp', 'ast', 'stl', 'blk', 'pts'], 'parsed'))}
FROM parsed""")(_preset("inline"))
