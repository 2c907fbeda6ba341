"""Linear classifiers, many penalties and folds per pass over the rows.

Rows lie in blocks of dense numbers. One pass returns loss, gradient and Hessian of every setting at its own weights: margins of all
settings are one matrix product per block. Each setting then takes a Newton step, whose cost depends on the features alone, damped
until it lowers the loss. An L1 penalty is met by coordinate descent on the second-order model.

Losses are averaged by weight, as Spark ML's are, and C over summed loss is a penalty of 1 / (C rows). The hinge of the
linear machine is rounded off over a width that shrinks from 1 to HINGE in steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import hash_bucket
from .models import PARTITIONS, settled

BLOCK_ROWS = 1 << 14
PASS_BYTES = 64 << 20  # Hessians of one pass
HINGE = 0.01
TOLERANCE = 1e-9  # of a step, relative to the weights
GAIN = {"logistic": 1e-17, "elasticnet": 1e-15, "svm": 1e-9}  # least decrease of the loss that a further step is made for
MAX_PASSES = 1000
TASK_BYTES = 64 << 20  # rows that a task may hold whole
PART_BYTES = 32 << 20  # rows of a partition, beyond the least number of partitions
START_BYTES = 16 << 20  # rows that a first solution is taken from


@dataclass(frozen=True)
class LinearSetting:
    """kind: logistic, elasticnet or svm. held: the fold that isn't trained on."""

    kind: str = "logistic"
    C: float = 1.0
    l1_ratio: float = 0.0
    balanced: bool = False
    held: int | None = None


@dataclass
class Dense:
    """Blocks of rows as a cached table, the number of features, rows by (fold, label), and bytes."""

    blocks: DataFrame
    width: int
    counts: dict[tuple[int, int], int]
    size: int


def dense_rows(df: DataFrame, *, features: str = "features", label: str = "drafted", key: str = "row_key",
               fold: str | None = None, partitions: int = PARTITIONS) -> Dense:
    keyed = [F.col(key)] if key in df.columns else []
    rows = df.filter(F.col(label).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("f"), *[k.alias("k") for k in keyed])
    first = df.select(F.size(vector_to_array(features)).alias("n")).filter("n >= 0").first()
    width = first[0] if first else 0
    found = df.filter(F.col(label).isNotNull()).groupBy((F.col(fold) if fold else F.lit(-1)).cast("int"), F.col(label).cast("int")).count().collect()
    partitions = max(partitions, sum(r[2] for r in found) * width * 8 // PART_BYTES)
    rows = settled(rows, [*([F.col("k")] if keyed else []), F.xxhash64("x", "y")], partitions).select("x", "y", "f")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
                out = [x.tobytes(), part.column(1).to_numpy().tobytes(), part.column(2).to_numpy().astype(np.int32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in out], names=["x", "y", "f"])

    table = rows.mapInArrow(blocks, "x binary, y binary, f binary").withColumn("part", F.spark_partition_id()) \
        .withColumn("at", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
    size = table.agg(F.sum(F.octet_length("x"))).first()[0] or 0
    return Dense(table, width, {(r[0], r[1]): r[2] for r in found}, size)


def _loaded(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y = np.frombuffer(row["y"])
    x = np.frombuffer(row["x"]).reshape(len(y), width)
    return np.hstack((x, np.ones((len(y), 1)))), y, np.frombuffer(row["f"], np.int32)


def _losses(kind: str, margin: np.ndarray, y: np.ndarray, hinge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature of each row."""
    if kind != "svm":
        p = 1.0 / (1.0 + np.exp(-margin))
        return np.logaddexp(0.0, margin) - y * margin, p - y, p * (1.0 - p)
    sign = 2.0 * y - 1.0
    gap = 1.0 - sign * margin
    inside, beyond = (gap > 0) & (gap < hinge), gap >= hinge
    loss = np.where(beyond, gap - hinge / 2, np.where(inside, gap * gap / (2 * hinge), 0.0))
    return loss, -sign * np.where(beyond, 1.0, np.where(inside, gap / hinge, 0.0)), inside / hinge


def _sums(row: dict, width: int, settings: Sequence[LinearSetting], weights: np.ndarray, classes: np.ndarray,
          hinges: Sequence[float], live: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Weighted sums of loss, gradient and Hessian of each live setting over a block, in one row of numbers."""
    x, y, f = _loaded(row, width)
    margins = x @ weights[list(live)].T
    for j, i in enumerate(live):
        c = classes[i][y.astype(int)] * (f != settings[i].held if settings[i].held is not None else 1.0)
        loss, slope, bend = _losses(settings[i].kind, margins[:, j], y, hinges[i])
        yield i, np.concatenate(([loss @ c], (slope * c) @ x, ((x * (bend * c)[:, None]).T @ x).ravel()))


def _pass(dense: Dense, settings: Sequence[LinearSetting], weights: np.ndarray, classes: np.ndarray, hinges: Sequence[float],
          live: Sequence[int]) -> dict[int, np.ndarray]:
    """_sums over all blocks, by setting."""
    width = dense.width
    data = dense.blocks.sparkSession.sparkContext.broadcast((weights, classes))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, by_class = data.value
        held: dict[int, np.ndarray] = {}
        part = None
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                for i, out in _sums(row, width, settings, w, by_class, hinges, live):
                    held[i] = held[i] + out if i in held else out
        for i, out in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([out.tobytes()], pa.binary())],
                                             names=["setting", "part", "sums"])

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")  # one order of adding up
        return pd.DataFrame({"setting": frame["setting"].iloc[:1], "sums": [sum(np.frombuffer(s) for s in frame["sums"]).tobytes()]})

    got = dense.blocks.mapInArrow(sums, "setting int, part int, sums binary").groupBy("setting") \
        .applyInPandas(total, "setting int, sums binary").collect()  # a row per setting
    return {r["setting"]: np.frombuffer(r["sums"]) for r in got}


def _pass_here(rows: Sequence[dict], width: int, settings, weights, classes, hinges, live) -> dict[int, np.ndarray]:
    """_pass over blocks that are all here, in the same order."""
    parts: dict[int, dict[int, np.ndarray]] = {}
    for row in sorted(rows, key=lambda r: (r["part"], r["at"])):
        held = parts.setdefault(row["part"], {})
        for i, out in _sums(row, width, settings, weights, classes, hinges, live):
            held[i] = held[i] + out if i in held else out
    return {i: sum(p[i] for _, p in sorted(parts.items())) for i in live} if parts else {}


def _penalised_step(w: np.ndarray, g: np.ndarray, h: np.ndarray, l1: float) -> np.ndarray:
    """Minimum of the second-order model with an L1 penalty on all but the last weight, by coordinate descent."""
    new, r = w.copy(), g.copy()  # r: gradient of the model at new
    diagonal = np.maximum(np.diag(h), 1e-12)
    for _ in range(2000):
        moved = 0.0
        for j in range(len(w)):
            bare = new[j] - r[j] / diagonal[j]
            to = bare if j == len(w) - 1 else np.sign(bare) * max(abs(bare) - l1 / diagonal[j], 0.0)
            if to != new[j]:
                r += h[:, j] * (to - new[j])
                moved = max(moved, abs(to - new[j]))
                new[j] = to
        if moved < 1e-12:
            break
    return new


def fit_linear_many(dense: Dense, settings: Sequence[LinearSetting], *, task_bytes: int = TASK_BYTES) -> np.ndarray:
    """Weights of all settings, the intercept last. Rows of up to `task_bytes` are handed whole to every task, and each
    setting is solved in one; beyond, all settings share passes over the rows where they lie, from the solutions over some of the
    blocks on, which lie close by."""
    n = dense.width + 1
    if dense.size <= task_bytes:
        return _by_setting(dense, settings)
    group = max(1, PASS_BYTES // (8 * n * n))
    start = _near(dense, settings, min(START_BYTES, task_bytes))
    return np.vstack([_solved(settings[i:i + group], dense.width, dense.counts,
                              lambda *state, part=settings[i:i + group]: _pass(dense, part, *state), start[i:i + group])
                      for i in range(0, len(settings), group)])


def _near(dense: Dense, settings: Sequence[LinearSetting], most: int) -> np.ndarray:
    """Weights that solve each setting over blocks of about `most` bytes, every so many of each part, under the penalties of all rows."""
    every = -(-dense.size // max(most, 1))
    part = dense.blocks.filter(F.pmod(F.col("at").bitwiseAND((1 << 33) - 1) + F.col("part"), F.lit(every)) == 0)
    counts: dict[tuple[int, int], int] = {}
    for row in part.select("y", "f").toLocalIterator():  # bounded by most
        for key, c in zip(*np.unique(np.stack((np.frombuffer(row["f"], np.int32), np.frombuffer(row["y"]).astype(np.int32)), 1), axis=0, return_counts=True)):
            counts[int(key[0]), int(key[1])] = counts.get((int(key[0]), int(key[1])), 0) + int(c)
    if not counts:
        return np.zeros((len(settings), dense.width + 1))
    share = sum(counts.values()) / max(sum(dense.counts.values()), 1)
    weaker = [replace(s, C=s.C / share) for s in settings]  # C sums over all rows
    return _by_setting(Dense(part, dense.width, counts, most), weaker, final=False)


def _by_setting(dense: Dense, settings: Sequence[LinearSetting], *, final: bool = True) -> np.ndarray:
    spark, width, counts = dense.blocks.sparkSession, dense.width, dense.counts
    data = spark.sparkContext.broadcast([r.asDict() for r in dense.blocks.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                own = [settings[i]]
                w = _solved(own, width, counts, lambda *state: _pass_here(data.value, width, own, *state), final=final)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([w[0].tobytes()])], names=["id", "w"])

    tasks = min(len(settings), 4 * spark.sparkContext.defaultParallelism)
    got = dict(spark.range(0, len(settings), 1, tasks).mapInArrow(run, "id long, w binary").collect())
    return np.vstack([np.frombuffer(got[i]) for i in range(len(settings))])


def _solved(settings: Sequence[LinearSetting], width: int, counts: dict, sums: Callable[..., dict[int, np.ndarray]],
            start: np.ndarray | None = None, final: bool = True) -> np.ndarray:
    """start: weights close to the solution, from which a machine's hinge is narrow at once. Not final: fits that have not settled are left."""
    n = width + 1
    many = len(settings)
    weights, classes = np.zeros((many, n)) if start is None else start.copy(), np.ones((many, 2))
    ridge, lasso, mass = np.zeros(many), np.zeros(many), np.zeros(many)
    for i, s in enumerate(settings):
        count = [sum(c for (f, y), c in counts.items() if y == k and (s.held is None or f != s.held)) for k in (0, 1)]
        rows = sum(count)
        if s.balanced:
            classes[i] = [rows / (2.0 * c) if c else 0.0 for c in count]
        mass[i] = max(classes[i] @ count, 1.0)
        share = s.l1_ratio if s.kind == "elasticnet" else 0.0
        ridge[i], lasso[i] = (1 - share) / (s.C * max(rows, 1)), share / (s.C * max(rows, 1))
    free = np.append(np.ones(width), 0.0)  # the intercept isn't penalised
    hinges = [(1.0 if start is None else HINGE) if s.kind == "svm" else 0.0 for s in settings]
    best: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}  # value, gradient and Hessian at the weights
    damping = np.zeros(many)
    live = list(range(many))
    trial = weights.copy()
    for _ in range(MAX_PASSES):
        got = sums(trial, classes, hinges, live)
        done = []
        for i in live:
            if i not in got:  # no rows
                done.append(i)
                continue
            loss, g, h = float(got[i][0]), got[i][1:1 + n], got[i][1 + n:].reshape(n, n)
            w = trial[i]
            value = loss / mass[i] + 0.5 * ridge[i] * (free * w) @ w + lasso[i] * np.abs(free * w).sum()
            if i not in best or value <= best[i][0] + 1e-15:
                weights[i], damping[i] = w, damping[i] / 10 if damping[i] > 1e-10 else 0.0
                best[i] = value, g / mass[i] + ridge[i] * free * w, h / mass[i] + np.diag(ridge[i] * free)
            else:
                damping[i] = max(10 * damping[i], 1e-8 * max(np.trace(best[i][2]) / n, 1e-8))
            _, g, h = best[i]
            h = h + np.diag(np.full(n, damping[i] + 1e-12))
            to = _penalised_step(weights[i], g, h, lasso[i]) if lasso[i] else weights[i] - np.linalg.lstsq(h, g, rcond=None)[0]
            step = to - weights[i]
            less = -(g @ step + 0.5 * step @ h @ step + lasso[i] * (np.abs(free * to).sum() - np.abs(free * weights[i]).sum()))
            small = np.abs(step).max() <= TOLERANCE * max(1.0, np.abs(weights[i]).max())
            if small or less <= GAIN[settings[i].kind] * max(1.0, abs(best[i][0])):
                done += _narrower(i, hinges, best, settings)
                trial[i] = weights[i]
                damping[i] = 0.0
            else:
                trial[i] = to
        live = [i for i in live if i not in done]
        if not live:
            return weights
    if not final:
        return weights
    raise RuntimeError(f"{len(live)} of {many} linear fits have not settled after {MAX_PASSES} passes")


def _narrower(i: int, hinges: list[float], best: dict, settings: Sequence[LinearSetting]) -> list[int]:
    """A settled machine goes on with a narrower hinge, or is done."""
    if settings[i].kind == "svm" and hinges[i] > HINGE:
        hinges[i] = max(hinges[i] / 4, HINGE)
        best.pop(i, None)
        return []
    return [i]


@dataclass
class LinearModel:
    """Weights, the intercept last, and the slope and intercept that turn margins into log odds."""

    name: str
    features: str
    weights: list[float]
    slope: float = 1.0
    shift: float = 0.0

    def score(self, df: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(v)) for v in self.weights[:-1]]).cast("array<double>")
        products = F.zip_with(vector_to_array(F.col(self.features)), w, lambda a, b: a * b)
        margin = F.aggregate(products, F.lit(float(self.weights[-1])), lambda a, b: a + b)
        return df.withColumn(self.name, 1.0 / (1.0 + F.exp(-(F.lit(float(self.slope)) * margin + F.lit(float(self.shift))))))

    def save(self, spark: SparkSession, path: str) -> None:
        from .models import _save_meta

        _save_meta(spark, path, {"class": "linear", **self.__dict__})


def fit_linear(kind: str, df: DataFrame, *, name: str, features: str, label: str, key: str, C: float = 1.0, l1_ratio: float = 0.5,
               balanced: bool = False, folds: int = 3) -> LinearModel:
    """One model. The linear machine's probabilities come from a logistic model of one feature, the margins of rows that
    the machine behind them has not seen."""
    if kind != "svm":
        dense = dense_rows(df, features=features, label=label, key=key)
        try:
            w = fit_linear_many(dense, [LinearSetting(kind, C, l1_ratio, balanced)])[0]
        finally:
            dense.blocks.unpersist()
        return LinearModel(name, features, w.tolist())
    parts = df.withColumn("_inner", hash_bucket(F.col(key), folds, 7))
    dense = dense_rows(parts, features=features, label=label, key=key, fold="_inner")
    try:
        settings = [LinearSetting("svm", C, 0.0, balanced, f) for f in [*range(folds), None]]
        w = fit_linear_many(dense, settings)
        unseen = held_margins_linear(dense, settings[:-1], w[:-1]).select(array_to_vector(F.array("score")).alias("m"), "label")
        one = dense_rows(unseen, features="m", label="label", key="_none")
        try:
            platt = fit_linear_many(one, [LinearSetting("logistic", C=1e6)])[0]
        finally:
            one.blocks.unpersist()
    finally:
        dense.blocks.unpersist()
    return LinearModel(name, features, w[-1].tolist(), float(platt[0]), float(platt[1]))


def held_margins_linear(dense: Dense, settings: Sequence[LinearSetting], weights: np.ndarray) -> DataFrame:
    """(setting, label, score): margins of the rows of each setting's held fold."""
    width = dense.width
    held = [s.held for s in settings]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y, f = _loaded(row, width)
                for i, own in enumerate(held):
                    rows = np.flatnonzero(f == own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), i, np.int32)), pa.array(y[rows].astype(np.int32)), pa.array(x[rows] @ weights[i])],
                        names=["setting", "label", "score"])

    return dense.blocks.mapInArrow(run, "setting int, label int, score double")
