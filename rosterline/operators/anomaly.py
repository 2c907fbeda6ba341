"""Isolation forest and linear one-class filter."""

from __future__ import annotations

import hashlib
import json
import math
import pickle
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cached
from ..sources.tables import numeric_columns
from .encode import vector_width
from .quantiles import exact_quantiles

EULER_GAMMA = 0.5772156649015329
HASH_SPACE = 1 << 40

_NODES = "tree int, node int, feature int, threshold double, low int, high int, depth double"


def _path_correction(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, threshold, low child, high child, depth); leaves have feature -1 and the
    expected depth of the rows they stand for."""
    nodes: list = [None]
    todo = [(0, np.arange(len(rows)), 0)]
    while todo:
        at, idx, depth = todo.pop()
        part = rows[idx]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(idx) > 1 else []
        if depth >= limit or len(spread) == 0:
            nodes[at] = (-1, 0.0, -1, -1, depth + _path_correction(len(idx)))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        below = part[:, f] <= cut
        nodes[at] = (f, cut, len(nodes), len(nodes) + 1, float(depth))
        todo += [(len(nodes), idx[below], depth + 1), (len(nodes) + 1, idx[~below], depth + 1)]
        nodes += [None, None]
    return nodes


def tree_samples(df: DataFrame, key: Sequence[str], n: int, trees: int, sample: int, seed: int) -> DataFrame:
    """At most `sample` rows for each tree, chosen by key hash. Rows are thinned to about the
    sample size before anything is shuffled. How many trees a row serves is drawn first, from the
    binomial distribution of as many independent draws; which, only for rows that serve any."""
    rate = min(1.0, (sample + 6.0 * math.sqrt(sample) + 10.0) / max(n, 1))
    chance, below = 0.0, []
    for m in range(trees):
        chance += math.comb(trees, m) * rate ** m * (1.0 - rate) ** (trees - m)
        below.append(min(HASH_SPACE, int(chance * HASH_SPACE)))
    drawn = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(HASH_SPACE))
    number = F.size(F.filter(F.array(*map(F.lit, below)), lambda b: b <= F.col("_u")))
    turns = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        F.xxhash64(*key, F.lit(seed + 1), t).alias("h"), t.alias("tree"))))
    picked = df.withColumn("_u", drawn).filter(F.col("_u") >= below[0]).withColumn(
        "tree", F.explode(F.transform(F.slice(turns, F.lit(1), number), lambda t: t["tree"]))).drop("_u")
    order = Window.partitionBy("tree").orderBy(F.xxhash64(*key, F.col("tree"), F.lit(seed)), *key)
    return picked.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= sample)


def _joined(trees: list[np.ndarray]) -> tuple:
    """All trees as one table of nodes, a leaf leading to itself, and the number of steps that reach every leaf."""
    sizes = [len(t) for t in trees]
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(int)
    nodes = np.concatenate(trees)
    own = np.arange(len(nodes))
    shift = np.repeat(first, sizes)
    leaf = nodes[:, 0] < 0
    low, high = (np.where(leaf, own, nodes[:, c] + shift).astype(int) for c in (2, 3))
    steps, at = 0, first
    while not leaf[at].all():
        at = np.unique(np.concatenate((low[at], high[at])))
        steps += 1
    return first, np.where(leaf, 0, nodes[:, 0]).astype(int), nodes[:, 1], low, high, nodes[:, 4], steps


@dataclass
class IsolationForest:
    columns: list[str]
    nodes: pd.DataFrame
    sample: int
    offset: float = 0.0

    def transform(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Adds the score: lower is more anomalous, below 0 is an outlier. The forest's size is
        set by trees and sample, not by the data, and is broadcast."""
        trees = [g.sort_values("node")[["feature", "threshold", "low", "high", "depth"]].to_numpy()
                 for _, g in self.nodes.groupby("tree")]
        shared = df.sparkSession.sparkContext.broadcast(_joined(trees))
        scale, offset = max(_path_correction(self.sample), 1e-12), self.offset

        @F.pandas_udf("double")
        def score(rows: pd.DataFrame) -> pd.Series:
            roots, feature, threshold, low, high, depth, steps = shared.value
            x = rows.to_numpy(dtype=float)
            out = np.zeros(len(x))
            block = max(1, 2_000_000 // max(1, len(roots)))
            for start in range(0, len(x), block):  # all trees together, a step down at a time
                part = x[start:start + block]
                row = np.arange(len(part))[:, None]
                at = np.broadcast_to(roots, (len(part), len(roots)))
                for _ in range(steps):
                    at = np.where(part[row, feature[at]] <= threshold[at], low[at], high[at])
                out[start:start + block] = depth[at].sum(axis=1)
            return pd.Series(-np.exp2(-out / (len(roots) * scale)) - offset)

        filled = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.columns])
        return df.withColumn(out, score(filled))

    def save(self, spark, path: str) -> None:
        spark.createDataFrame(self.nodes, _NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"columns": self.columns, "sample": self.sample, "offset": self.offset})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForest":
        return cls(nodes=spark.read.parquet(f"{path}/nodes").toPandas(),  # bounded by trees and sample
                   **json.loads(spark.read.parquet(f"{path}/meta").first()["meta"]))


def fit_isolation_forest(
    df: DataFrame, key: Sequence[str], *, columns: Sequence[str] | None = None, exclude: Sequence[str] = (),
    trees: int = 100, sample: int = 256, contamination: float = 0.05, seed: int = 42,
) -> IsolationForest:
    """Each tree is grown from its own small sample in one task; the score at which
    `contamination` of the training rows fall below 0 is an exact quantile."""
    columns = list(columns or numeric_columns(df, [*key, *exclude]))
    with cached(df.select(*key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])) as rows:
        n = rows.count()
        sample = min(sample, n)
        limit = math.ceil(math.log2(max(sample, 2)))

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            part = pdf.sort_values("_rn")[columns].to_numpy(dtype=float)
            grown = _grow(part, np.random.default_rng([seed, tree]), limit)
            return pd.DataFrame([(tree, i, *node) for i, node in enumerate(grown)],
                                columns=["tree", "node", "feature", "threshold", "low", "high", "depth"])

        picked = tree_samples(rows, key, n, trees, sample, seed)
        nodes = picked.groupBy("tree").applyInPandas(grow, _NODES).toPandas()  # bounded by trees and sample
        forest = IsolationForest(columns, nodes, sample)
        with cached(forest.transform(rows, "s").select("s")) as scored:
            forest.offset = exact_quantiles(scored, {"s": (F.col("s"), [contamination])})["s"][0]
    return forest


# --- one-class filter ----------------------------------------------------------------

PACKED_ROWS = 100_000
SAMPLE = 16_384  # rows that tell where to look for a quantile
CELLS = 2048  # around it
CELL_ROWS = 20_000  # of the cell that holds it
PATTERNS = 4096  # of the columns of marks in a block


@dataclass
class OneClassModel:
    """Rows with w.x >= rho are inliers."""

    weights: list[float]
    rho: float
    converged: bool = True

    def save(self, spark, path: str) -> None:
        meta = json.dumps({"class": "oneclass", **self.__dict__})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    def transform(self, df: DataFrame, features: str = "features", out: str = "inlier_score") -> DataFrame:
        check_width(df, len(self.weights), features)
        return df.withColumn(out, _margin(self.weights, features) - F.lit(self.rho)).withColumn(
            "inlier", F.col(out) >= 0)

    def inliers(self, df: DataFrame, features: str = "features") -> DataFrame:
        return self.transform(df, features).filter("inlier").drop("inlier", "inlier_score")


def check_width(df: DataFrame, expected: int, features: str = "features") -> None:
    """A scorer fitted on vectors of one width must not meet another. Vectors that carry no
    attributes are measured, in one aggregation."""
    width = vector_width(df, features)
    if width is not None:
        found = {width}
    else:
        size = F.size(vector_to_array(F.col(features)))
        found = {w for w in df.agg(F.min(size), F.max(size)).first() if w is not None}
    if found - {expected}:
        raise ValueError(f"feature mismatch: the model expects {expected} features but got {sorted(found)}")


def _margin(weights: Sequence[float], features: str):
    w = np.asarray(weights, dtype=float)

    @F.pandas_udf("double")
    def dot(x: pd.Series) -> pd.Series:
        return pd.Series(np.stack(x.to_numpy()) @ w if len(x) else np.empty(0))

    return dot(vector_to_array(F.col(features)))


def _closest_to_origin(points: np.ndarray, weights: np.ndarray, max_steps: int = 20_000) -> np.ndarray:
    """Convex weights of the points whose mean is closest to the origin, by pairwise steps from the given ones. Ending at
    max_steps warns; the fit goes on from there, as its own test of convergence doesn't rest on this one."""
    gram = points @ points.T
    w = weights.copy()
    for _ in range(max_steps):
        slope = gram @ w
        best = int(slope.argmin())
        worst = int(np.where(w > 0, slope, -np.inf).argmax())
        gap = slope[worst] - slope[best]
        curve = gram[best, best] - 2.0 * gram[best, worst] + gram[worst, worst]
        if gap <= 1e-12 * max(gram.diagonal().max(), 1e-18) or curve <= 0:
            break
        step = min(w[worst], gap / curve)
        w[best] += step
        w[worst] = w[worst] - step if step < w[worst] else 0.0
    else:
        warnings.warn(f"the mixture of means was left after {max_steps} steps", RuntimeWarning, stacklevel=3)
    return w


class _Packed:
    """Blocks of vectors as a cached table. Columns of a block that hold only 0 and 1 are kept as a code of their pattern a row."""

    def __init__(self, df: DataFrame, features: str):
        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = np.stack(batch.column(0).to_numpy(zero_copy_only=False)).astype(float)
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_packed(x))], pa.binary())], names=["block"])

        self.table = df.select(vector_to_array(F.col(features)).alias("x")).mapInArrow(blocks, "block binary") \
            .persist(StorageLevel.MEMORY_AND_DISK)

    def run(self, fn: Callable[[tuple], list[tuple]]) -> list[tuple]:
        """Numbers and vectors that fn gives for each block, the vectors and counts of a task added up: (kind, count, sum)."""
        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            for batch in batches:
                for block in batch.column(0):
                    for kind, n, total in fn(pickle.loads(block.as_buffer())):
                        known = held.get(kind)
                        held[kind] = (n, total) if known is None else (known[0] + n, known[1] + total)
            for kind, (n, total) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                                 names=["kind", "n", "total"])

        got = self.table.mapInArrow(tasks, "kind long, n long, total binary").collect()  # some rows a task
        return [(r["kind"], r["n"], np.frombuffer(r["total"])) for r in got]

    def sample(self, size: int) -> np.ndarray:
        """Up to about `size` rows, evenly from all blocks."""
        each = max(1, size // max(1, self.table.count()))

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column(0):
                    b = pickle.loads(block.as_buffer())
                    x = _unpacked(b, np.unique(np.linspace(0, len(b[0]) - 1, each).astype(int)))
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([len(x)], pa.int64())], names=["x", "n"])

        got = self.table.mapInArrow(some, "x binary, n long").collect()  # bounded by size
        return np.vstack([np.frombuffer(r["x"]).reshape(r["n"], -1) for r in got])

    def lowest(self, w: np.ndarray, nu: float, n: int, sample: np.ndarray, most: int = CELL_ROWS) -> np.ndarray | None:
        """The mean of the rows whose margin is at most the exact quantile nu of all margins. The sample only tells where to look: margins
        around its quantile are counted in cells, and rows of the cell that holds the quantile are looked at one by one. None if
        these are more than `most`, or elsewhere."""
        rank = nu * (n - 1)
        low, high = math.floor(rank), math.ceil(rank)
        near = np.sort(sample @ w)
        off = 5.0 * math.sqrt(max(nu * (1 - nu), 1e-4) * len(near)) + 2.0
        at = nu * (len(near) - 1)
        lo, hi = (float(near[int(min(max(v, 0), len(near) - 1))]) for v in (at - off, at + off))
        edges = np.unique(np.concatenate(([lo], lo + (hi - lo) * np.arange(1, CELLS) / CELLS, [hi])))

        def count(b: tuple) -> list[tuple]:
            return [(0, 0, np.bincount(np.searchsorted(edges, _margins(b, w), "right"), minlength=len(edges) + 1).astype(float))]

        above = np.cumsum(sum(r[2] for r in self.run(count)))
        first, last = (int(np.searchsorted(above, r, "right")) for r in (low, high))
        if first == 0 or last == len(edges) or above[last] - above[first - 1] > most:
            return None
        bottom, top, below = edges[first - 1], edges[last], int(above[first - 1])

        def pick(b: tuple) -> list[tuple]:
            m = _margins(b, w)
            inside = np.flatnonzero((m >= bottom) & (m < top))
            rows = np.hstack((m[inside, None], _unpacked(b, inside)))
            return [(0, int((m < bottom).sum()), _total(b, m < bottom)), *[(_key(r), 1, np.append(r, 1.0)) for r in rows]]

        got = self.run(pick)
        # Equal rows of a task were added up: the last number says how many.
        rows = [(t[:-1] / t[-1], t[-1]) for kind, _, t in got if kind]
        m, many = np.array([r[0][0] for r in rows]), np.array([r[1] for r in rows])
        order = np.argsort(m, kind="stable")
        reach = np.cumsum(many[order]) + below
        at = [m[order[int(np.searchsorted(reach, r, "right"))]] for r in (low, high)]
        cut = at[0] + (at[1] - at[0]) * (rank - low)
        taken = m <= cut
        total = sum(t for kind, _, t in got if not kind) + sum((r[0][1:] * r[1] for r, k in zip(rows, taken) if k), np.zeros(len(w)))
        return total / (below + many[taken].sum())


def _key(row: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(row.tobytes(), digest_size=8).digest(), "big", signed=True) or 1


def _packed(x: np.ndarray) -> tuple:
    """The other columns, those of marks, their patterns, and each row's pattern."""
    marks = np.flatnonzero(((x == 0) | (x == 1)).all(0))
    bits = np.packbits(x[:, marks].astype(bool), axis=1)
    patterns, code = np.unique(bits, axis=0, return_inverse=True) if len(marks) else (bits, None)
    if code is None or len(patterns) > PATTERNS:
        marks, patterns, code = marks[:0], np.zeros((1, 0), np.uint8), np.zeros(len(x), np.int64)
    else:
        patterns = np.unpackbits(patterns, axis=1, count=len(marks))
    return np.delete(x, marks, axis=1), marks, patterns.astype(float), code.reshape(-1).astype(np.uint16)


def _parted(w: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.delete(w, marks), w[marks]


def _margins(block: tuple, w: np.ndarray) -> np.ndarray:
    x, marks, patterns, code = block
    own, marked = _parted(w, marks)
    return x @ own + (patterns @ marked)[code]


def _unpacked(block: tuple, rows: np.ndarray) -> np.ndarray:
    x, marks, patterns, code = block
    out = np.empty((len(rows), x.shape[1] + len(marks)))
    out[:, np.setdiff1d(np.arange(out.shape[1]), marks)] = x[rows]
    out[:, marks] = patterns[code[rows]]
    return out


def _total(block: tuple, rows: np.ndarray) -> np.ndarray:
    x, marks, patterns, code = block
    out = np.empty(x.shape[1] + len(marks))
    out[np.setdiff1d(np.arange(len(out)), marks)] = x[rows].sum(0)
    out[marks] = np.bincount(code[rows], minlength=len(patterns)) @ patterns
    return out


def fit_one_class(df: DataFrame, features: str = "features", *, nu: float = 0.1, max_iter: int = 200,
                  tol: float = 1e-3, packed_rows: int = PACKED_ROWS) -> OneClassModel:
    """Linear one-class machine. Its solution is the point closest to the origin among the means
    of row sets holding at least a share nu of the rows. Each step finds the mean of the share
    with the lowest margins, of more than `packed_rows` rows by two passes over packed blocks, and moves to the closest point among the mixtures
    of the means found so far, a vector each. The share is cut at the exact quantile. A fit that ends at max_iter says so: it warns, and its model is not `converged`."""
    with cached(df.select(features)) as rows:
        mean = lambda part: part.select(Summarizer.mean(F.col(features)).alias("m")).first()["m"]
        start, n = mean(rows), rows.count()
        if start is None:
            raise ValueError("no rows to fit on")
        packed = _Packed(rows, features) if n > packed_rows else None
        sample = packed.sample(SAMPLE) if packed else None
        w = np.asarray(start.toArray())
        means, weights = w[None, :], np.ones(1)
        converged = False
        for _ in range(max_iter):
            worst = packed.lowest(w, nu, n, sample) if packed else None
            if worst is None:  # few rows, or many that share about one margin
                scored = rows.withColumn("_m", _margin(w, features))
                cut = exact_quantiles(scored, {"m": (F.col("_m"), [nu])})["m"][0]
                worst = np.asarray(mean(scored.filter(F.col("_m") <= F.lit(cut))).toArray())
            step = w - worst
            size = float(step @ step)
            gain = float(w @ step)
            if size < 1e-18 or gain <= tol * max(float(w @ w), 1e-18):
                converged = True
                break
            means, weights = np.vstack((means, worst)), np.append(weights, 0.0)
            weights = _closest_to_origin(means, weights)
            means, weights = means[weights > 0], weights[weights > 0]
            w = weights @ means
        if packed:
            packed.table.unpersist()
        with cached(rows.select(_margin(w, features).alias("m"))) as margins:
            rho = exact_quantiles(margins, {"m": (F.col("m"), [nu])})["m"][0]
    if not converged:
        warnings.warn(f"the one-class fit stopped after {max_iter} steps", RuntimeWarning, stacklevel=2)
    return OneClassModel([float(v) for v in w], float(rho), converged)
