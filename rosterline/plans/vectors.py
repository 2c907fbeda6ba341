"""Evaluation, selection, neighbours, clustering, reduction and anomaly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as A, clean as C, evaluate as V, neighbors as N, reduce as R, select as S
from ..operators.encode import Scaler, fit_preprocessor
from ..operators.split import season_key
from ..session import checkpointed
from ..sources import frames
from ..sources.tables import table
from .profiling import rounded
from .registry import EMB, PANEL, query, sql_hash

DIM = 64
NUMERIC = ["gp", "blk", "mp", "pts", "ast", "stl"]


# --- evaluation ----------------------------------------------------------------------

def _groups(score: str) -> str:
    return (f"SELECT CAST({score} AS DOUBLE) AS score, sum(drafted) AS pos, sum(1 - drafted) AS neg "
            f"FROM panel WHERE {score} IS NOT NULL GROUP BY 1")


def _auc_sql(score: str) -> str:
    return f"""SELECT '{score}' AS score_name, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(sum(CAST(pos AS DOUBLE) * (coalesce(below, 0) + 0.5::DOUBLE * neg)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS auroc
FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM ({_groups(score)}))"""


@query("auroc", f"WITH {PANEL} {_auc_sql('gp')} UNION ALL {_auc_sql('pts')}")
def auroc(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).select("gp", "pts", "drafted"))
    parts = [V.auroc(panel, c, "drafted").withColumn("score_name", F.lit(c)) for c in ("gp", "pts")]
    return rounded(parts[0].unionByName(parts[1]), 9, "auroc")


@query("roc_curve", f"""WITH {PANEL}, g AS ({_groups('mp')})
SELECT score AS threshold, round(CAST(sum(neg) OVER w AS DOUBLE) / (SELECT sum(neg) FROM g), 9) AS fpr,
       round(CAST(sum(pos) OVER w AS DOUBLE) / (SELECT sum(pos) FROM g), 9) AS tpr
FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
UNION ALL SELECT max(score) + 1, 0.0::DOUBLE, 0.0::DOUBLE FROM g""")
def roc_curve(spark, sf_dir):
    return rounded(V.roc_curve(frames.panel(spark, sf_dir), "mp", "drafted"), 9, "fpr", "tpr")


# --- chi-square ----------------------------------------------------------------------

def _chi2_sql(columns: list[str], source: str, target: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n, sum(CASE WHEN {target} = 1 THEN 1 ELSE 0 END) AS pos "
        f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns)
    return f"""cells AS ({cells}),
share AS (SELECT avg(CASE WHEN {target} = 1 THEN 1.0::DOUBLE ELSE 0.0 END) AS p FROM {source}),
chi AS (SELECT column_name, value, n, round((pos - n*p) * (pos - n*p) / (n*p)
  + ((n - pos) - n*(1-p)) * ((n - pos) - n*(1-p)) / (n*(1-p)), 6) AS chi2 FROM cells, share)"""


@query("chi2_scores", f"WITH {PANEL}, {_chi2_sql(['team', 'conf', 'type'], 'panel', 'drafted')} SELECT * FROM chi")
def chi2_scores(spark, sf_dir):
    panel = frames.panel(spark, sf_dir).select("team", "conf", "type", "drafted")
    return rounded(S.chi2_scores(panel, ["team", "conf", "type"], "drafted"), 6, "chi2")


_DOCS = "docs AS (SELECT lang, source, quality FROM labels JOIN documents USING (doc_id))"


@query("chi2_topk", f"""WITH {_DOCS}, {_chi2_sql(['lang', 'source'], 'docs', 'quality')}
SELECT * FROM chi ORDER BY chi2 DESC, column_name, value LIMIT 3""")
def chi2_topk(spark, sf_dir):
    return rounded(S.chi2_topk(frames.doc_labels(spark, sf_dir), ["lang", "source"], "quality", 3), 6, "chi2")


def _selectable(spark, sf_dir):
    return frames.panel(spark, sf_dir).drop("year")


@query("select_features")
def select_features(spark, sf_dir):
    return S.select_features(_selectable(spark, sf_dir), top_numeric=3, top_categorical=3)


@query("remove_features")
def remove_features(spark, sf_dir):
    return S.remove_features(_selectable(spark, sf_dir), bottom_numeric=2, bottom_categorical=2)


@query("rf_importance_topk")
def rf_importance_topk(spark, sf_dir):
    return S.importance_topk(
        _selectable(spark, sf_dir), "drafted", NUMERIC, ["team", "conf", "type"])


# --- neighbours ----------------------------------------------------------------------

def _near_sql(rows: str, key: str, k: int) -> str:
    return f"""pairs AS (SELECT a.{key} AS query, b.{key} AS neighbor, b.drafted AS payload,
    round(list_distance(a.x, b.x), 9) AS dist FROM {rows} a JOIN {rows} b ON a.{key} <> b.{key}),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, neighbor) AS rank FROM pairs)
  WHERE rank <= {k})"""


@query("knn_topk", f"""WITH {EMB}, {_near_sql('emb', 'vec_id', 5)}
SELECT query AS vec_id, neighbor, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM near""")
def knn_topk(spark, sf_dir):
    emb = frames.embeddings(spark, sf_dir)
    found = N.nearest(emb, emb, 5, q_key="vec_id", t_key="vec_id", skip_same=True)
    return found.select(F.col("query").alias("vec_id"), "neighbor", "rank", F.round("dist", 6).alias("dist"))


@query("knn_classify", f"""WITH {EMB}, {_near_sql('emb', 'vec_id', 7)}
SELECT query AS vec_id, round(avg(CAST(payload AS DOUBLE)), 9) AS uniform,
  round(coalesce(avg(CASE WHEN dist = 0 THEN CAST(payload AS DOUBLE) END),
    sum(CASE WHEN dist > 0 THEN payload / dist END) / sum(CASE WHEN dist > 0 THEN 1.0::DOUBLE / dist END)), 6) AS weighted
FROM near GROUP BY query""")
def knn_classify(spark, sf_dir):
    emb = frames.embeddings(spark, sf_dir)
    found = N.nearest(emb, emb, 7, q_key="vec_id", t_key="vec_id", payload="drafted", skip_same=True)
    found = checkpointed(found)
    both = [N.knn_scores(found, w).withColumnRenamed("probability", w) for w in ("uniform", "distance")]
    return both[0].join(both[1], "query").select(
        F.col("query").alias("vec_id"), F.round("uniform", 9).alias("uniform"), F.round("distance", 6).alias("weighted"))


_SMOTE = f"""WITH {EMB}, c AS (SELECT CAST(sum(drafted) AS BIGINT) AS n, CAST(count(*) - 2 * sum(drafted) AS BIGINT) AS need FROM emb),
few AS (SELECT vec_id, x, drafted, row_number() OVER (ORDER BY {sql_hash('vec_id', 42)}, vec_id) AS rn FROM emb WHERE drafted = 1),
{_near_sql('few', 'vec_id', 5)},
copies AS (SELECT vec_id, x, unnest(range(need // n + CASE WHEN rn <= need % n THEN 1 ELSE 0 END)) AS copy FROM few, c),
picked AS (SELECT *, {sql_hash('vec_id * 1009 + copy * 7919', 42)} * 5 // 2147483648 + 1 AS rank,
  {sql_hash('vec_id * 2003 + copy * 104729', 43)} / 2147483648.0::DOUBLE AS gap FROM copies),
made AS (SELECT p.vec_id, p.copy, list_transform(range(1, {DIM + 1}), lambda i: p.x[i] + p.gap * (o.x[i] - p.x[i])) AS x
  FROM picked p JOIN near ON near.query = p.vec_id AND near.rank = p.rank JOIN few o ON o.vec_id = near.neighbor),
bal AS (SELECT vec_id, x, drafted, 0 AS synthetic, 0 AS copy FROM emb UNION ALL SELECT vec_id, x, 1, 1, copy FROM made)
SELECT vec_id, drafted, CAST(synthetic AS INTEGER) AS synthetic, CAST(copy AS BIGINT) AS copy,
       round(x[1], 9) AS x_first, round(x[{DIM}], 9) AS x_last, round(list_sum(x), 6) AS x_sum FROM bal"""


@query("smote_balance", _SMOTE)
def smote_balance(spark, sf_dir):
    out = N.smote(frames.embeddings(spark, sf_dir), "vec_id", "x", "drafted", k=5)
    return out.select(
        "vec_id", "drafted", "synthetic", "copy", F.round(F.col("x")[0], 9).alias("x_first"),
        F.round(F.col("x")[DIM - 1], 9).alias("x_last"),
        F.round(F.aggregate("x", F.lit(0.0), lambda s, v: s + v), 6).alias("x_sum"))


# --- clustering and reduction --------------------------------------------------------

_CENTRES = [[100.0, 300000.0, 15000.0], [250.0, 700000.0, 35000.0], [500.0, 1500000.0, 75000.0]]


@query("nearest_center_distance", f"WITH {PANEL} SELECT player_id, year, round(least(" + ", ".join(
    "sqrt(" + " + ".join(f"({c} - {m}::DOUBLE) * ({c} - {m}::DOUBLE)" for c, m in zip(("mp", "pts", "ast"), centre)) + ")"
    for centre in _CENTRES) + "), 4) AS distance FROM panel")
def nearest_center_distance(spark, sf_dir):
    return frames.panel(spark, sf_dir).select(
        "player_id", "year", F.round(R.nearest_centre_distance(["mp", "pts", "ast"], _CENTRES), 4).alias("distance"))


def _silhouette_sql(distance: str) -> str:
    return f"""WITH {EMB}, d AS (
  SELECT a.vec_id, a.label, b.label AS other, sum({distance.format(square=f"""list_sum(list_transform(range(1, {DIM + 1}),
    lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))""")}) AS total, count(*) AS n
  FROM emb a JOIN emb b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label),
ab AS (SELECT vec_id, label, max(CASE WHEN label = other THEN total / n END) AS a,
    min(CASE WHEN label <> other THEN total / n END) AS b FROM d GROUP BY vec_id, label)
SELECT vec_id, label, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM ab"""


def _embedding_columns(spark, sf_dir):
    cols = [f"x{i}" for i in range(DIM)]
    # Numbers are cast one by one: a cast of the whole vector would be repeated for each of its columns.
    x = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)]
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", *x), cols


@query("silhouette_exact", _silhouette_sql("{square}"))
def silhouette_exact(spark, sf_dir):
    emb, cols = _embedding_columns(spark, sf_dir)
    return rounded(R.silhouette(emb, cols, "label").select("vec_id", "label", "silhouette"), 6, "silhouette")


@query("silhouette_plain", _silhouette_sql("sqrt({square})"))
def silhouette_plain(spark, sf_dir):
    emb, cols = _embedding_columns(spark, sf_dir)
    return rounded(R.plain_silhouette(emb, cols, "label").select("vec_id", "label", "silhouette"), 6, "silhouette")


def _complete(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir))
    filled = C.fill_medians(panel, frames.train_rows(panel), NUMERIC)
    return filled.withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def _standard(spark, sf_dir):
    rows = _complete(spark, sf_dir)
    return Scaler().fit(frames.train_rows(rows), NUMERIC).transform(rows)


@query("pca_project")
def pca_project(spark, sf_dir):
    rows = _standard(spark, sf_dir).select("player_id", "year", *NUMERIC)
    model = R.fit_pca(frames.train_rows(rows), NUMERIC, 3)
    return R.pca_columns(rows, model, ["player_id", "year"])


@query("kmeans_distance")
def kmeans_distance(spark, sf_dir):
    rows = _standard(spark, sf_dir)
    model = R.fit_kmeans(frames.train_rows(rows), NUMERIC, 4)
    return R.add_kmeans_distance(rows, NUMERIC, model).select("player_id", "year", "kmeans_distance")


@query("kmeans_best_k")
def kmeans_best_k(spark, sf_dir):
    scores = R.silhouette_by_k(_standard(spark, sf_dir), NUMERIC)
    return scores.withColumn("best", F.col("k") == F.lit(R.best_k(scores)))


# --- anomalies -----------------------------------------------------------------------

@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir))
    forest = A.fit_isolation_forest(frames.train_rows(panel), ["player_id", "year"], columns=NUMERIC)
    return forest.transform(panel).select("player_id", "year", "anomaly_score")


@query("one_class_filter")
def one_class_filter(spark, sf_dir):
    panel = frames.once(frames.panel(spark, sf_dir).withColumn("row_key", season_key()))
    train = frames.train_rows(panel)
    prep = fit_preprocessor(train, NUMERIC, ["team", "conf"])
    model = A.fit_one_class(prep.transform(train))
    return model.inliers(prep.transform(panel)).select("player_id", "year")
