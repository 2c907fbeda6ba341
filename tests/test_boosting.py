"""Boosted trees of many settings against a plain grower, between both ways of running passes, and over layouts."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pair_area import auroc

from rosterline.operators import boosting as B, tune as T
from rosterline.operators.evaluate import auroc_by, auroc_value
from rosterline.operators.models import ModelSpec, fit_model, load_model


def table(n=160, seed=0, missing=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(1)
    x[:, 2] = rng.integers(0, 2, n)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.5 > 0.3).astype(int)
    x[rng.random(x.shape) < missing] = np.nan
    return x, y


def frame(spark, x, y, partitions=3):
    rows = [(i, [float(v) for v in r], int(t), i % 3) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_key long, x array<double>, drafted int, fold int") \
        .withColumn("features", array_to_vector("x")).repartition(partitions)


def soft(g, a):
    return math.copysign(max(abs(g) - a, 0.0), g)


def plain(x, y, s):
    """Margins of second-order boosting, every cut of every feature tried on floating-point sums."""
    margin = np.zeros(len(y))
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        step = np.zeros(len(y))

        def grow(rows, depth):
            gs, hs = g[rows].sum(), h[rows].sum()
            score = lambda a, b: 0.5 * soft(a, s.alpha) ** 2 / (b + s.lam)
            best = (1e-12, None)
            for f in range(x.shape[1]) if depth < s.depth else ():
                v = x[rows, f]
                for c in np.unique(x[~np.isnan(x[:, f]), f])[:-1]:  # beyond a node's own values, missing ones part from others
                    for empty_left in (False, True):
                        left = rows[np.where(np.isnan(v), empty_left, v <= c)]
                        right = np.setdiff1d(rows, left)
                        a, b = g[left].sum(), h[left].sum()
                        if not len(left) or not len(right) or b < s.min_child or hs - b < s.min_child:
                            continue
                        gain = score(a, b) + score(gs - a, hs - b) - score(gs, hs) - s.gamma
                        if gain > best[0] + 1e-7:
                            best = (gain, (left, right))
            if best[1] is None:
                step[rows] = -s.rate * soft(gs, s.alpha) / (hs + s.lam)
            else:
                grow(best[1][0], depth + 1), grow(best[1][1], depth + 1)

        grow(np.arange(len(y)), 0)
        margin = margin + step
    return margin


@pytest.mark.parametrize("s", [B.Setting(trees=4, depth=3, min_child=0.5), B.Setting(trees=3, depth=4, alpha=0.8, lam=0.3, gamma=0.05),
                               B.Setting(trees=2, depth=2, rate=1.0, min_child=3.0)])
def test_margins_as_by_a_plain_grower(spark, s):
    x, y = table()
    df = frame(spark, x, y)
    binned = B.bin_rows(df, bins=255)  # a bin for every value
    model = B.BoostedModel("m", "features", B.fit_many(binned, [s])[0], binned.cuts)
    got = [r[0][0] for r in model.staged(df, [s.trees]).orderBy("row_key").select("margins").collect()]
    assert np.allclose(got, plain(x, y, s), atol=1e-5)


def same(a, b):
    return a.start == b.start and all((getattr(a, c) == getattr(b, c)).all() for c in ("feature", "cut", "empty_left", "left", "value"))


def test_both_ways_and_all_layouts_give_the_same_trees(spark):
    x, y = table(300)
    settings = [B.Setting(trees=1, depth=3, held=0, subsample=0.7), B.Setting(trees=2, depth=2, alpha=0.5, colsample=0.6, held=1),
                B.Setting(trees=2, loss="ada", rate=0.7)]
    one = B.bin_rows(frame(spark, x, y, 1), fold="fold")
    seven = B.bin_rows(frame(spark, x, y, 7), fold="fold")
    a, b, c = B.fit_many(one, settings), B.fit_many(seven, settings), B.fit_many(seven, settings, task_bytes=0)
    assert all(same(p, q) and same(p, r) for p, q, r in zip(a, b, c))
    scores = lambda **kw: sorted(tuple(r) for r in B.held_margins(seven, settings[:1], [[1]], **kw).collect())
    assert scores() == scores(task_bytes=0) and len(scores()) == 100


def test_stages_are_separate_fits(spark):
    x, y = table(200, 3)
    binned = B.bin_rows(frame(spark, x, y), fold="fold")
    s = B.Setting(trees=9, depth=3, held=2, subsample=0.8, colsample=0.7)
    staged = B.held_margins(binned, [s], [[2, 5, 9]])
    for n in (2, 5, 9):
        alone = B.held_margins(binned, [B.Setting(**{**s.__dict__, "trees": n})], [[n]])
        got = sorted(r.score for r in staged.filter(f"trees = {n}").collect())
        assert np.allclose(got, sorted(r.score for r in alone.collect()), atol=1e-12)


def test_real_boosting_follows_its_definition(spark):
    """Weights after three rounds, from the votes of stumps found anew."""
    x, y = table(150, 5, missing=0)
    df = frame(spark, x, y)
    binned = B.bin_rows(df, bins=255)
    model = B.BoostedModel("m", "features", B.fit_many(binned, [B.Setting(trees=3, loss="ada", rate=0.5)])[0], binned.cuts, "ada")
    got = np.array([r[0] for r in model.staged(df, [1, 2, 3]).orderBy("row_key").select("margins").collect()]).T
    w, total = np.full(len(y), 1 / len(y)), np.zeros(len(y))
    for t in range(3):
        best = None
        for f in range(3):
            for c in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= c
                gini = sum((w[m & (y == k)].sum() ** 2) / w[m].sum() for m in (left, ~left) for k in (0, 1))
                if best is None or gini > best[0] + 1e-9:
                    best = (gini, left)
        vote = np.zeros(len(y))
        for m in (best[1], ~best[1]):
            p = np.clip(w[m & (y == 1)].sum() / w[m].sum(), B.TINY, 1 - B.TINY)
            vote[m] = 0.5 * np.log(p / (1 - p))
        total = total + vote
        assert np.allclose(got[t], total, atol=1e-5)
        w = w * np.exp(-0.5 * (2 * y - 1) * vote)
        w = w / w.sum()


def test_models_score_save_and_refuse_unknown_parameters(spark, tmp_path):
    x, y = table(200, 7)
    df = frame(spark, x, y)
    for spec in (ModelSpec("m", "boosted", {"trees": 8, "alpha": 0.1}), ModelSpec("m", "boosted", {"trees": 5}, balanced=True),
                 ModelSpec("m", "adaboost", {"variant": "real", "trees": 8})):
        model = fit_model(spec, df)
        model.save(spark, f"{tmp_path}/{spec.kind}{spec.balanced}")
        first = [r.m for r in model.score(df).orderBy("row_key").collect()]
        again = [r.m for r in load_model(spark, f"{tmp_path}/{spec.kind}{spec.balanced}").score(df).orderBy("row_key").collect()]
        assert first == again and all(0 < p < 1 for p in first) and auroc(first, y) > 0.85
    for kind in ("boosted", "gbt", "logistic", "adaboost"):
        with pytest.raises(ValueError, match="no parameter"):
            fit_model(ModelSpec("m", kind, {"reg_alpha": 1.0}), df)


def test_constants_missing_columns_and_one_class(spark):
    x = np.column_stack([np.full(30, 2.0), np.full(30, np.nan), np.arange(30.0)])
    model = fit_model(ModelSpec("m", "boosted", {"trees": 3}), frame(spark, x, (np.arange(30) > 14).astype(int)))
    assert set(model.trees.feature.tolist()) <= {-1, 2}
    alone = fit_model(ModelSpec("m", "boosted", {"trees": 3}), frame(spark, x, np.ones(30, int)))
    assert (alone.trees.feature == -1).all()


def test_areas_of_many_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(g, round(float(rng.normal() + y), 1), y) for g in range(4) for y in rng.integers(0, 2, 200).tolist()] + [(9, 1.0, 1)]
    df = spark.createDataFrame(rows, "g int, s double, y int")
    got = {r.g: r.auroc for r in auroc_by(df, ["g"], "s", "y", ranges=8).collect()}
    for g in range(4):
        assert got[g] == pytest.approx(auroc_value(df.filter(f"g = {g}"), "s", "y"), abs=1e-12)
    assert got[9] is None


def test_searches_fail_candidate_by_candidate(spark):
    x, y = table(150, 9)
    rows = frame(spark, x, y)
    spec = ModelSpec("m", "boosted", {"depth": 2})
    log = T.search_cv(spec, rows, [{"trees": 3}, {"trees": 3, "leaves": 4}, {"trees": 6}], folds=3)
    assert [t.error is None for t in log] == [True, False, True] and log[1].score is None
    for trial in (log[0], log[2]):
        single = [auroc_value(fit_model(spec.with_params(**trial.params), rows.filter(f"fold != {f}")).score(rows.filter(f"fold = {f}")),
                              "m", "drafted") for f in range(3)]
        assert trial.score == pytest.approx(np.mean(single), abs=0.05)  # bins follow all folds here


def test_of_two_children_only_the_smaller_is_counted(monkeypatch):
    """A level's histograms are those of all its rows, at half of their number at most."""
    rng = np.random.default_rng(11)
    n, counted = 4000, []
    bins = [rng.integers(0, 9, size=(5, n)).astype(np.uint8) for _ in range(2)]
    nodes = [rng.choice(6, n, p=[.3, .1, .05, .35, .1, .1]) for _ in bins]
    nodes[0][:50] = -1
    stats = [tuple(rng.integers(-1000, 1000, n).astype(float) for _ in range(2)) + (None,) for _ in bins]
    columns, whole = np.array([0, 2, 4]), B._histograms
    every = sum(whole(b, at, 6, g, h, 9, columns) for b, at, (g, h, _) in zip(bins, nodes, stats))
    parents = every.reshape(3, 2, *every.shape[1:]).sum(1)
    monkeypatch.setattr(B, "_histograms", lambda b, at, *rest: counted.append((at >= 0).sum()) or whole(b, at, *rest))
    assert (B._level(bins, nodes, 6, stats, 9, columns, parents) == every).all()
    assert sum(counted) <= sum((at >= 0).sum() for at in nodes) / 2
    assert not every[:, [1, 3]].any()  # features the tree doesn't see


def test_features_are_counted_together(monkeypatch):
    """Histograms in a task are those of each feature alone, at a fraction of the passes over the rows."""
    rng = np.random.default_rng(3)
    n, cuts = 20_000, np.array([9, 1, 1, 1, 2, 12, 1, 40])
    blocks = [B.Block(np.stack([rng.integers(0, c + 2, n) for c in cuts]).astype(np.uint8), np.zeros(n), np.ones(n), np.zeros(n), np.zeros(n))
              for _ in range(2)]
    stats = [(rng.integers(-1000, 1000, n).astype(float), rng.integers(0, 1000, n).astype(float), None) for _ in blocks]
    passes, whole = [], np.bincount
    rows = B._Rows(blocks, cuts)
    monkeypatch.setattr(np, "bincount", lambda at, w=None, minlength=0: passes.append(len(at)) or whole(at, w, minlength))
    for nodes, columns in ((1, np.arange(8)), (3, np.array([0, 2, 5])), (400, np.arange(8))):
        ranks = [rng.integers(-1 if nodes > 1 else 0, nodes, n) for _ in blocks]
        each = sum(B._histograms(b.bins, r, nodes, g, h, 42, columns) for b, r, (g, h, _) in zip(blocks, ranks, stats))
        alone = sum(passes)
        passes.clear()
        got = rows.counted(ranks, nodes, stats, columns)
        assert (got[:, columns] == each[:, columns]).all()
        assert nodes > 1 or sum(passes) <= alone / 2
        passes.clear()
