"""Boosted trees on binned features, many settings and folds side by side.

Features are cut into at most BINS bins once, and rows are held as blocks of bytes. A tree grows level by level: every
block adds up the gradients and Hessians of its rows by (setting, node, feature, bin), these histograms are summed over
blocks, and the best split of each node follows from its histogram. One such pass serves all settings and folds. Gradients are
rounded to whole multiples of 2^-26 before they are summed, so sums are exact and a model depends neither on the layout of
the rows nor on how the passes are run.

Leaves and gains are of second order with L1 (alpha) and L2 (lam) penalties; gamma is the least gain of a split, and rows
without a value go to the side that gains more. `loss` is logistic or ada: real-valued boosting of stumps, whose votes are half the
logarithm of the class odds in a leaf, by Gini impurity.

Blocks of up to `task_bytes` in all are small enough to be handed whole to every task: then each setting is grown in a task of its own.
Beyond that bound passes run over the blocks where they lie, and histograms are summed and split by Spark, node by node."""

from __future__ import annotations

import base64
import io
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import key_hash
from ..session import checkpointed
from .quantiles import exact_quantiles

BINS = 64
BLOCK_ROWS = 1 << 16
TASK_BYTES = 64 << 20  # blocks that a task may hold whole
PASS_BYTES = 64 << 20  # histograms that a task adds up before it hands them on
SCALE = float(1 << 26)
ADA_SCALE = float(1 << 46)
TINY = np.finfo(float).eps
CHECKPOINT_EVERY = 10  # trees
FEW = 8  # cut points below which features are put together
CODES = 256  # patterns of bins that they take together
CELLS = 1 << 13  # of a histogram over two codes
PAIR_ROWS = 4  # rows a cell from which such a histogram is worth it


@dataclass(frozen=True)
class Setting:
    """One model: rate and number of trees, their depth, least Hessian of a child, least gain, shares of rows and features a
    tree sees, penalties. held: the fold that isn't trained on."""

    rate: float = 0.3
    trees: int = 100
    depth: int = 6
    min_child: float = 1.0
    gamma: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    alpha: float = 0.0
    lam: float = 1.0
    seed: int = 42
    loss: str = "logistic"
    held: int | None = None


# --- rows as blocks ------------------------------------------------------------------

@dataclass
class Block:
    bins: np.ndarray  # features x rows; bin 0 is a missing value
    label: np.ndarray
    weight: np.ndarray
    key: np.ndarray
    fold: np.ndarray

    @staticmethod
    def of(row: dict) -> "Block":
        label = np.frombuffer(row["label"], np.uint8).astype(float)
        return Block(np.frombuffer(row["bins"], np.uint8).reshape(-1, len(label)), label, np.frombuffer(row["weight"]),
                     np.frombuffer(row["key"], np.uint64), np.frombuffer(row["fold"], np.int32))


@dataclass
class Binned:
    """Blocks of rows, as a cached table, and the cut points of each feature."""

    blocks: DataFrame
    cuts: list[np.ndarray]
    size: int  # bytes

    def counts(self) -> np.ndarray:
        """Cut points of each feature."""
        return np.array([len(c) for c in self.cuts], np.int64)

    def unpersist(self) -> None:
        self.blocks.unpersist()


def binned_values(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """features x rows of bins: 0 without a value, else one more than the cut points below it."""
    out = np.zeros((len(cuts), len(x)), np.uint8)
    for f, c in enumerate(cuts):
        v = x[:, f]
        out[f] = np.where(np.isnan(v), 0, 1 + np.searchsorted(c, v, side="left"))
    return out


def bin_rows(df: DataFrame, *, features: str = "features", label: str = "drafted", key: str = "row_key",
             fold: str | None = None, weight: str | None = None, bins: int = BINS) -> Binned:
    """Rows with a label, binned at quantiles of their features. Rows without a key are told apart by their features."""
    if not 2 <= bins <= 255:
        raise ValueError("2 to 255 bins")
    name = key_hash(F.col(key)) if key in df.columns else F.xxhash64(features)
    rows = df.filter(F.col(label).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), name.cast("long").alias("k"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("f"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    width = rows.select(F.max(F.size("x"))).first()[0] or 0
    each = lambda i: F.when(~F.isnan(F.col("x")[i]), F.col("x")[i])
    probs = [i / bins for i in range(bins)]
    found = exact_quantiles(rows, {str(i): (each(i), probs) for i in range(width)})
    top = rows.agg(*[F.max(each(i)).alias(str(i)) for i in range(width)]).first() if width else {}
    cuts = [np.unique([v for v in found[str(i)] if v is not None and v < top[str(i)]]).astype(float) for i in range(width)]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            x = t["x"].combine_chunks()
            flat = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            col = lambda c, kind: t[c].to_numpy().astype(kind).tobytes()
            row = [binned_values(flat.astype(float), cuts).tobytes(), col("y", np.uint8), col("w", np.float64), col("k", np.int64), col("f", np.int32)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in row], names=["bins", "label", "weight", "key", "fold"])

        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(at, BLOCK_ROWS))
                n += held[-1].num_rows
                if n >= BLOCK_ROWS:
                    yield flush()
                    n = 0
        if n:
            yield flush()

    table = rows.mapInArrow(blocks, "bins binary, label binary, weight binary, key binary, fold binary") \
        .persist(StorageLevel.MEMORY_AND_DISK)
    size = table.agg(F.sum(sum(F.octet_length(c) for c in table.columns))).first()[0] or 0
    return Binned(table, cuts, size)


# --- trees ---------------------------------------------------------------------------

@dataclass
class Trees:
    """Trees one after another. A node has a feature (-1: leaf), the last bin that goes left, where rows without a value
    go, its left child (the right one follows), and its value."""

    start: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    empty_left: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def grow(self, n: int) -> int:
        """n further leaves; where they begin."""
        at = len(self.feature)
        self.feature = np.concatenate((self.feature, np.full(n, -1, np.int32)))
        self.cut = np.concatenate((self.cut, np.zeros(n, np.uint8)))
        self.empty_left = np.concatenate((self.empty_left, np.zeros(n, bool)))
        self.left = np.concatenate((self.left, np.zeros(n, np.int32)))
        self.value = np.concatenate((self.value, np.zeros(n)))
        return at

    def step(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The nodes that rows at the given nodes go to."""
        f = self.feature[at]
        b = bins[np.maximum(f, 0), np.arange(len(at))]
        right = np.where(b == 0, ~self.empty_left[at], b > self.cut[at])
        return np.where(f < 0, at, self.left[at] + right)

    def leaves(self, bins: np.ndarray, tree: int) -> np.ndarray:
        at = np.full(bins.shape[1], self.start[tree], np.int64)
        while (self.feature[at] >= 0).any():
            at = self.step(bins, at)
        return at

    def margins(self, bins: np.ndarray, stages: Sequence[int] | None = None) -> np.ndarray:
        """Sums of leaf values after each of the given numbers of trees (all: after the last)."""
        stages = [len(self.start)] if stages is None else list(stages)
        out, total = np.zeros((len(stages), bins.shape[1])), np.zeros(bins.shape[1])
        for t in range(max(stages, default=0)):
            for i, s in enumerate(stages):
                if s == t:
                    out[i] = total
            if t < len(self.start):
                total = total + self.value[self.leaves(bins, t)]
        for i, s in enumerate(stages):
            if s == max(stages):
                out[i] = total
        return out


def _noise(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number from 0 to 1 for each row, of the tree's own."""
    with np.errstate(over="ignore"):
        h = (key + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & ((1 << 64) - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(11)).astype(float) / float(1 << 53)


def _columns(s: Setting, tree: int, width: int) -> np.ndarray:
    """The features that a tree sees."""
    n = max(1, int(round(s.colsample * width)))
    if n >= width:
        return np.arange(width)
    return np.sort(np.random.default_rng([s.seed, tree]).choice(width, n, replace=False))


def _gradients(s: Setting, block: Block, margin: np.ndarray, tree: int, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers to sum for each row, and whether the tree trains on it."""
    seen = np.ones(len(margin), bool) if s.held is None else block.fold != s.held
    if s.subsample < 1:
        seen &= _noise(block.key, tree, s.seed) < s.subsample
    if s.loss == "ada":
        w = np.rint(block.weight * np.exp(-(2 * block.label - 1) * s.rate * margin - shift) * ADA_SCALE)
        return w * block.label, w, seen
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(block.weight * (p - block.label) * SCALE), np.rint(block.weight * np.maximum(p * (1 - p), 1e-16) * SCALE), seen


def _histograms(bins: np.ndarray, node: np.ndarray, n: int, g: np.ndarray, h: np.ndarray, width: int, columns: np.ndarray) -> np.ndarray:
    """node x feature x bin x (gradient, Hessian) of rows with a node >= 0, of the given features (else 0)."""
    rows = np.flatnonzero(node >= 0)
    if len(rows) < len(node):
        bins, node, g, h = bins[np.ix_(columns, rows)], node[rows], g[rows], h[rows]
    else:
        bins = bins[columns]
    out = np.zeros((n, int(columns.max(initial=-1)) + 1, width, 2), np.int64)
    first = node * width
    for f, b in zip(columns, bins, strict=True):
        at = first + b
        for k, v in enumerate((g, h)):
            out[:, f, :, k] = np.rint(np.bincount(at, v, n * width)).reshape(n, width)
    return out


def _level(bins: Sequence[np.ndarray], ranks: Sequence[np.ndarray], n: int, stats: Sequence[tuple], width: int, columns: np.ndarray,
           parents: np.ndarray | None, rows: "_Rows | None" = None) -> np.ndarray:
    """Histograms of a level, added up over blocks, by `rows` if they are laid out for it. Two children make up their parent, so of each pair
    only the one with fewer rows is counted, and the other follows, exactly, as sums are whole numbers."""
    def count(ranks: Sequence[np.ndarray], n: int) -> np.ndarray:
        if rows is not None:
            return rows.counted(ranks, n, stats, columns)
        return sum(_histograms(b, r, n, g, h, width, columns) for b, r, (g, h, _) in zip(bins, ranks, stats, strict=True))

    if parents is None:
        return count(ranks, n)
    size = sum(np.bincount(r + 1, minlength=n + 1)[1:] for r in ranks).reshape(-1, 2)
    fewer = np.arange(0, n, 2) + (size[:, 1] < size[:, 0])
    place = np.full(n + 1, -1)  # the last one is for rows without a node
    place[fewer] = np.arange(len(fewer))
    counted = count([place[r] for r in ranks], len(fewer))
    out = np.empty((n, *counted.shape[1:]), np.int64)
    out[fewer], out[fewer ^ 1] = counted, parents - counted
    return out


@dataclass
class _Unit:
    """Features counted as one: the code of a row stands for its bins in all of them."""

    features: np.ndarray
    bins: np.ndarray  # features x codes
    codes: list[np.ndarray]  # of each block

    def spread(self, sums: np.ndarray, out: np.ndarray) -> None:
        """Puts sums by (node, code, ...) into out by (node, feature, bin, ...). Sums are whole numbers below 2^53."""
        for f, bins in zip(self.features, self.bins, strict=True):
            if len(bins) == 1 or (np.diff(bins) == 1).all():
                out[:, f, bins[0]:bins[-1] + 1] = sums
            else:
                for b in np.unique(bins):
                    out[:, f, b] = sums[:, bins == b].sum(1)


def _units(blocks: Sequence[Block], cuts: np.ndarray) -> list[_Unit]:
    """Features with few bins are put together as long as their bins take up to CODES patterns in all."""
    small = [f for f in range(len(cuts)) if cuts[f] < FEW]
    out = [_Unit(np.array([f]), np.arange(cuts[f] + 2)[None], [b.bins[f] for b in blocks]) for f in range(len(cuts)) if cuts[f] >= FEW]
    members: list[int] = []
    patterns, codes = np.zeros((0, 1), np.int64), [np.zeros(b.bins.shape[1], np.int64) for b in blocks]

    def close() -> None:
        if members:
            out.append(_Unit(np.array(members), patterns, [c.astype(np.uint8) for c in codes]))

    for f in small:
        while True:
            wide = int(cuts[f]) + 2
            joint = [c * wide + b.bins[f] for c, b in zip(codes, blocks, strict=True)]
            there = np.flatnonzero(sum(np.bincount(j, minlength=patterns.shape[1] * wide) for j in joint))
            if len(there) <= CODES or not members:
                break
            close()
            members, patterns, codes = [], np.zeros((0, 1), np.int64), [np.zeros(len(c), np.int64) for c in codes]
        place = np.zeros(patterns.shape[1] * wide, np.int64)
        place[there] = np.arange(len(there))
        members, codes = [*members, f], [place[j] for j in joint]
        patterns = np.vstack((patterns[:, there // wide], there % wide))
    close()
    return out


class _Rows:
    """Blocks that are all here, laid out for counting. Units are counted two at a time where nodes have many rows: a histogram over
    the codes of both takes one pass, and each one's own follows from it."""

    def __init__(self, blocks: Sequence[Block], cuts: np.ndarray):
        self.blocks, self.features, self.width = blocks, len(cuts), int(cuts.max(initial=0)) + 2
        units = sorted(_units(blocks, cuts), key=lambda u: u.bins.shape[1])
        self.pairs: list[tuple] = []  # units, codes of each block, cells
        while units:
            one = units.pop()
            two = next((u for u in reversed(units) if u.bins.shape[1] * one.bins.shape[1] <= CELLS), None)
            if two is None:
                self.pairs.append(((one,), one.codes, one.bins.shape[1]))
                continue
            units = [u for u in units if u is not two]
            wide = two.bins.shape[1]
            codes = [(a.astype(np.uint16) * np.uint16(wide) + b).astype(np.uint16) for a, b in zip(one.codes, two.codes, strict=True)]
            self.pairs.append(((one, two), codes, one.bins.shape[1] * wide))
        self.by_row = [np.ascontiguousarray(b.bins.T).ravel() for b in blocks]
        self.first = [np.arange(b.bins.shape[1]) * len(cuts) for b in blocks]
        self.missing = [bool((b.bins == 0).any()) for b in blocks]

    def counted(self, ranks: Sequence[np.ndarray], n: int, stats: Sequence[tuple], columns: np.ndarray) -> np.ndarray:
        """node x feature x bin x (gradient, Hessian) of rows with a rank >= 0, of the given features (else 0 or as counted)."""
        some, nodes, values, size = [], [], [], 0  # rows of each block (none: all)
        for r, (g, h, _) in zip(ranks, stats, strict=True):
            at = np.flatnonzero(r >= 0)
            size += len(at)
            some.append(at if len(at) < len(r) else None)
            nodes.append(r.take(at) if len(at) < len(r) else r)
            values.append((g.take(at), h.take(at)) if len(at) < len(r) else (g, h))
        out = np.zeros((n, self.features, self.width, 2), np.int64)
        wanted = set(columns.tolist())
        for units, codes, cells in self.pairs:
            used = [u for u in units if not wanted.isdisjoint(u.features.tolist())]
            if not used:
                continue
            together = len(used) == 2 and size >= n * cells * PAIR_ROWS
            for unit in ([None] if together else used):
                own, wide = (codes, cells) if unit is None else (unit.codes, unit.bins.shape[1])
                sums = np.zeros((n * wide, 2))
                for i, code in enumerate(own):
                    at = code if some[i] is None else code.take(some[i])
                    at = at.astype(np.int64) if n == 1 else nodes[i] * wide + at
                    for k, v in enumerate(values[i]):
                        sums[:, k] += np.bincount(at, v, n * wide)
                sums = np.rint(sums).astype(np.int64).reshape(n, wide, 2)
                if unit is not None:
                    unit.spread(sums, out)
                    continue
                both = sums.reshape(n, -1, units[1].bins.shape[1], 2)
                units[0].spread(both.sum(2), out)
                units[1].spread(both.sum(1), out)
        return out

    def step(self, tree: "Trees", at: Sequence[np.ndarray]) -> list[np.ndarray]:
        """The nodes that rows at the given nodes go to."""
        leaf = tree.feature < 0
        own = np.arange(len(leaf))
        feature, low = np.where(leaf, 0, tree.feature).astype(np.int64), np.where(leaf, own, tree.left)
        cut = np.where(leaf, 255, tree.cut).astype(np.uint8)
        out = []
        for a, flat, first, missing in zip(at, self.by_row, self.first, self.missing, strict=True):
            b = flat.take(first + feature.take(a))
            right = b > cut.take(a)
            if missing:
                right = np.where(b == 0, ~(tree.empty_left | leaf).take(a), right)
            out.append(low.take(a) + right)
        return out


def _score(s: Setting, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    if s.loss == "ada":
        return np.where(h > 0, (g * g + (h - g) * (h - g)) / np.maximum(h, TINY), 0.0)
    t = np.sign(g) * np.maximum(np.abs(g) - s.alpha, 0.0)
    return 0.5 * t * t / (h + s.lam) if s.lam > 0 else np.where(h > 0, 0.5 * t * t / np.maximum(h, 1e-300), 0.0)


def _value(s: Setting, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    if s.loss == "ada":
        p = np.clip(np.divide(g, h, out=np.full_like(g, 0.5), where=h > 0), TINY, 1 - TINY)
        return 0.5 * np.log(p / (1 - p))
    t = np.sign(g) * np.maximum(np.abs(g) - s.alpha, 0.0)
    return -s.rate * np.divide(t, h + s.lam, out=np.zeros_like(t), where=(h + s.lam) > 0)


def best_splits(s: Setting, hist: np.ndarray, columns: np.ndarray, cuts: np.ndarray) -> dict[str, np.ndarray]:
    """For each node: the feature (-1: none), last bin to the left, side of missing values, and the values of the node and
    of both children. cuts: cut points of each feature. Of equal gains the first feature, the lowest cut and the right side
    for missing values count."""
    scale = ADA_SCALE if s.loss == "ada" else SCALE
    total = hist[:, columns[0] if len(columns) else 0].sum(1)
    g, h = total[:, 0] / scale, total[:, 1] / scale
    feature = np.repeat(columns, cuts[columns])
    cut = np.concatenate([np.arange(1, cuts[c] + 1) for c in columns] or [np.zeros(0)]).astype(np.int64)
    if not len(cut):
        none = np.full(len(hist), -1)
        return {"feature": none, "cut": none, "empty_left": none > 0, "value": _value(s, g, h), "left": _value(s, g, h), "right": _value(s, g, h)}
    below = hist[:, columns].cumsum(2)[:, np.repeat(np.arange(len(columns)), cuts[columns]), cut]
    missing = hist[:, feature, 0]
    sides = [below - missing, below] if missing.any() else [below]  # without missing values both sides are the same
    left = np.stack(sides, axis=2)  # node, cut, side, (g, h)
    right = total[:, None, None] - left
    gl, hl, gr, hr = left[..., 0] / scale, left[..., 1] / scale, right[..., 0] / scale, right[..., 1] / scale
    gain = _score(s, gl, hl) + _score(s, gr, hr) - _score(s, g, h)[:, None, None] - s.gamma
    least = s.min_child if s.loss == "logistic" else 0.0
    gain = np.where((left[..., 1] > 0) & (right[..., 1] > 0) & (hl >= least) & (hr >= least), gain, -np.inf).reshape(len(hist), -1)
    best = gain.argmax(1)
    at = (np.arange(len(hist)), best // len(sides), best % len(sides))
    found = gain[at[0], best] > 1e-12
    pick = lambda a, o: np.where(found, a[at], o)
    return {"feature": np.where(found, feature[at[1]], -1), "cut": cut[at[1]], "empty_left": at[2] == 1, "value": _value(s, g, h),
            "left": _value(s, pick(gl, g), pick(hl, h)), "right": _value(s, pick(gr, g), pick(hr, h))}


def _apply(trees: Trees, nodes: np.ndarray, split: dict[str, np.ndarray]) -> np.ndarray:
    """Puts splits onto nodes; the children."""
    trees.value[nodes] = split["value"]
    has = np.flatnonzero(split["feature"] >= 0)
    at = trees.grow(2 * len(has))
    where = nodes[has]
    trees.feature[where], trees.cut[where], trees.empty_left[where] = split["feature"][has], split["cut"][has], split["empty_left"][has]
    trees.left[where] = at + 2 * np.arange(len(has))
    trees.value[at:at + 2 * len(has):2], trees.value[at + 1:at + 2 * len(has):2] = split["left"][has], split["right"][has]
    return np.arange(at, at + 2 * len(has))


def _depth(s: Setting) -> int:
    return 1 if s.loss == "ada" else int(s.depth)


def _shift(s: Setting, blocks: Sequence[Block], margins: Sequence[np.ndarray]) -> float:
    """Logarithm of the total weight, by which real boosting keeps weights in range."""
    if s.loss != "ada":
        return 0.0
    logs = [np.log(np.maximum(b.weight, 1e-300)) - (2 * b.label - 1) * s.rate * m for b, m in zip(blocks, margins, strict=True)]
    top = max(float(x.max(initial=-np.inf)) for x in logs)
    # Rounded, so that it can be summed in any order.
    return _settled_log(sum(int(np.rint(np.exp(x - top) * float(1 << 30)).astype(np.int64).sum()) for x in logs), top)


def _settled_log(total: int, top: float) -> float:
    return float(np.round(np.log(max(total, 1) / float(1 << 30)) + top, 6))


def grown(s: Setting, blocks: Sequence[Block], cuts: np.ndarray) -> Trees:
    """A model of rows that are all here. cuts: cut points of each feature."""
    trees: list[Trees] = []
    if s.loss != "ada" and s.held is not None:  # rows that are held out have no part in the growth
        blocks = [Block(b.bins[:, own], *(v[own] for v in (b.label, b.weight, b.key, b.fold)))
                  for b in blocks for own in [np.flatnonzero(b.fold != s.held)] if len(own)]
    rows = _Rows(blocks, cuts) if len(cuts) and blocks else None
    margins = [np.zeros(b.bins.shape[1]) for b in blocks]
    for t in range(int(s.trees) if rows else 0):
        shift = _shift(s, blocks, margins)
        stats = [_gradients(s, b, m, t, shift) for b, m in zip(blocks, margins, strict=True)]
        columns = _columns(s, t, len(cuts))
        tree = Trees([0])
        tree.grow(1)
        at = [np.zeros(len(m), np.int64) for m in margins]
        nodes, parents = np.array([0]), None
        for _ in range(_depth(s)):
            ranks = [np.where(seen, _rank(a, nodes), -1) for a, (_, _, seen) in zip(at, stats, strict=True)]
            hist = _level([], ranks, len(nodes), stats, rows.width, columns, parents, rows)
            split = best_splits(s, hist, columns, cuts)
            nodes, parents = _apply(tree, nodes, split), hist[split["feature"] >= 0]
            if not len(nodes):
                break
            at = rows.step(tree, at)
        margins = [m + tree.value[a] for m, a in zip(margins, at, strict=True)]
        trees.append(tree)
    return joined(trees)


def joined(trees: Sequence[Trees]) -> Trees:
    """Single trees as one model."""
    if not trees:
        return Trees()
    starts = np.concatenate(([0], np.cumsum([len(t.feature) for t in trees])))[:-1]
    left = [np.where(t.feature >= 0, t.left + at, 0).astype(np.int32) for t, at in zip(trees, starts, strict=True)]
    return Trees(starts.tolist(), *(np.concatenate([getattr(t, c) for t in trees]) for c in ("feature", "cut", "empty_left")),
                 np.concatenate(left), np.concatenate([t.value for t in trees]))


def _rank(at: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Place of each row's node among the (ascending) nodes, or -1."""
    if nodes[-1] - nodes[0] + 1 == len(nodes):  # without gaps
        i = at - nodes[0]
        return np.where((i >= 0) & (i < len(nodes)), i, -1)
    i = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
    return np.where(nodes[i] == at, i, -1)


# --- many models ---------------------------------------------------------------------

def fit_many(binned: Binned, settings: Sequence[Setting], *, task_bytes: int = TASK_BYTES) -> list[Trees]:
    """The models of all settings."""
    if binned.size <= task_bytes:
        return _by_setting(binned, settings)
    return _by_block(binned, list(settings))


def _held_blocks(binned: Binned):
    """The blocks, whose size is known to be bounded, for every task."""
    rows = [r.asDict() for r in binned.blocks.collect()]
    return binned.blocks.sparkSession.sparkContext.broadcast(rows)


def _dealt(binned: Binned, settings: Sequence[Setting]) -> DataFrame:
    """A task for each setting, the dearest first."""
    cost = lambda s: -s.trees * _depth(s)
    order = sorted(range(len(settings)), key=lambda i: cost(settings[i]))
    spark = binned.blocks.sparkSession
    return spark.createDataFrame([(int(i),) for i in order], "setting int").repartitionByRange(len(order), F.monotonically_increasing_id())


def _by_setting(binned: Binned, settings: Sequence[Setting]) -> list[Trees]:
    data, cuts = _held_blocks(binned), binned.counts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                made = grown(settings[i], [Block.of(r) for r in data.value], cuts)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pickle.dumps(made)])], names=["setting", "trees"])

    got = dict(_dealt(binned, settings).mapInArrow(run, "setting int, trees binary").collect())
    return [pickle.loads(got[i]) for i in range(len(settings))]


STATE = "bins binary, label binary, weight binary, key binary, fold binary, margins binary"


def _by_block(binned: Binned, settings: list[Setting]) -> list[Trees]:
    """All settings grow together; a pass over the blocks per level. Margins of the trees so far lie beside the blocks."""
    many = len(settings)
    done: list[list[Trees]] = [[] for _ in settings]
    cuts = binned.counts()
    features, width = len(cuts), int(cuts.max(initial=0)) + 2
    state = binned.blocks.withColumn("margins", F.lit(b""))
    sc = state.sparkSession.sparkContext

    def margins_of(row: dict, n: int) -> np.ndarray:
        return np.frombuffer(row["margins"]).reshape(many, n) if row["margins"] else np.zeros((many, n))

    def shifts() -> list[float]:
        if all(s.loss != "ada" for s in settings):
            return [0.0] * many

        def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    b = Block.of(row)
                    for i, (s, m) in enumerate(zip(settings, margins_of(row, len(b.label)), strict=True)):
                        x = np.log(np.maximum(b.weight, 1e-300)) - (2 * b.label - 1) * s.rate * m
                        yield pa.RecordBatch.from_pydict({"setting": [i], "top": [float(x.max())], "x": [x.tobytes()]})

        each = state.mapInArrow(logs, "setting long, top double, x binary")
        tops = {r["setting"]: r["top"] for r in each.groupBy("setting").agg(F.max("top").alias("top")).collect()}

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    total = int(np.rint(np.exp(np.frombuffer(r["x"]) - tops[r["setting"]]) * float(1 << 30)).astype(np.int64).sum())
                    yield pa.RecordBatch.from_pydict({"setting": [r["setting"]], "total": [total]})

        totals = each.mapInArrow(sums, "setting long, total long").groupBy("setting").agg(F.sum("total").alias("total")).collect()
        found = {r["setting"]: _settled_log(r["total"], tops[r["setting"]]) for r in totals}
        return [found.get(i, 0.0) if s.loss == "ada" else 0.0 for i, s in enumerate(settings)]

    for t in range(max((int(s.trees) for s in settings), default=0) if features else 0):
        growing = [i for i, s in enumerate(settings) if t < int(s.trees)]
        shift = shifts()
        trees = {i: Trees([0]) for i in growing}
        nodes = {i: np.array([trees[i].grow(1)]) for i in growing}
        for level in range(max(_depth(settings[i]) for i in growing)):
            live = [i for i in growing if level < _depth(settings[i]) and len(nodes[i])]
            if not live:
                break
            partial = sc.broadcast(pickle.dumps({i: (trees[i], nodes[i]) for i in live}))

            def sums(batches: Iterator[pa.RecordBatch], live=live, partial=partial, t=t, level=level) -> Iterator[pa.RecordBatch]:
                known, held, weight = pickle.loads(partial.value), {}, 0

                def flush() -> Iterator[pa.RecordBatch]:
                    for (i, node), hist in held.items():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([i], pa.int32()), pa.array([node], pa.int32()), pa.array([hist.tobytes()])], names=["setting", "node", "hist"])
                    held.clear()

                for batch in batches:
                    for row in batch.to_pylist():
                        b = Block.of(row)
                        margins = margins_of(row, len(b.label))
                        for i in live:
                            tree, wanted = known[i]
                            g, h, seen = _gradients(settings[i], b, margins[i], t, shift[i])
                            at = np.zeros(len(b.label), np.int64)
                            for _ in range(level):
                                at = tree.step(b.bins, at)
                            rank = np.where(seen, _rank(at, wanted), -1)
                            there = np.unique(rank[rank >= 0])  # nodes that have rows here
                            if len(there):
                                found = _histograms(b.bins, np.where(rank >= 0, np.searchsorted(there, rank), -1), len(there), g, h, width,
                                                    _columns(settings[i], t, features))
                                for node, hist in zip(wanted[there].tolist(), found, strict=True):
                                    if (i, node) in held:
                                        held[i, node] += hist
                                    else:
                                        held[i, node] = hist
                                        weight += hist.nbytes
                            if weight >= PASS_BYTES:
                                yield from flush()
                                weight = 0
                yield from flush()

            def split(frame: pd.DataFrame) -> pd.DataFrame:
                i, node = int(frame["setting"].iloc[0]), int(frame["node"].iloc[0])
                hist = sum(np.frombuffer(x, np.int64).reshape(-1, width, 2) for x in frame["hist"])
                best = best_splits(settings[i], hist[None], _columns(settings[i], t, features), cuts)
                return pd.DataFrame({"setting": [i], "node": [node], "split": [pickle.dumps(best)]})

            rows = state.mapInArrow(sums, "setting int, node int, hist binary").groupBy("setting", "node") \
                .applyInPandas(split, "setting int, node int, split binary").collect()  # as many rows as nodes
            splits = {(r["setting"], r["node"]): pickle.loads(r["split"]) for r in rows}
            for i in live:
                known = np.array([n for n in nodes[i] if (i, n) in splits], np.int64)
                parts = [splits[i, n] for n in known]
                nodes[i] = _apply(trees[i], known, {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}) if parts else known
        for i in growing:
            done[i].append(trees[i])
        last = sc.broadcast(pickle.dumps(trees))

        def further(batches: Iterator[pa.RecordBatch], last=last) -> Iterator[pa.RecordBatch]:
            grown_now = pickle.loads(last.value)
            for batch in batches:
                for row in batch.to_pylist():
                    b = Block.of(row)
                    margins = margins_of(row, len(b.label)).copy()
                    for i, tree in grown_now.items():
                        margins[i] += tree.value[tree.leaves(b.bins, 0)]
                    row["margins"] = margins.tobytes()
                    yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(c.split()[0], pa.binary()) for c in STATE.split(", ")]))

        before, state = state, state.mapInArrow(further, STATE).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % CHECKPOINT_EVERY == 0:
            state = checkpointed(state)
        else:
            state.count()
        if t:
            before.unpersist()
    return [joined(t) for t in done]


def held_margins(binned: Binned, settings: Sequence[Setting], stages: Sequence[Sequence[int]], *,
                 task_bytes: int = TASK_BYTES) -> DataFrame:
    """(setting, trees, label, score): margins of the rows of each setting's held fold after each of its stages."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    names = ["setting", "trees", "label", "score"]

    def rows(i: int, model: Trees, b: Block) -> pa.RecordBatch:
        held = np.flatnonzero(b.fold == settings[i].held)
        margins = model.margins(b.bins[:, held], stages[i])
        n = len(held)
        cols = [np.full(margins.size, i), np.repeat(list(stages[i]), n), np.tile(b.label[held], len(stages[i])), margins.ravel()]
        return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(cols, kinds, strict=True)], names=names)

    if binned.size <= task_bytes:  # models need not leave their tasks
        data, cuts = _held_blocks(binned), binned.counts()

        def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    blocks = [Block.of(r) for r in data.value]
                    model = grown(settings[i], blocks, cuts)
                    yield from (rows(i, model, b) for b in blocks)

        return _dealt(binned, settings).mapInArrow(fitted, "setting int, trees int, label int, score double")
    models = binned.blocks.sparkSession.sparkContext.broadcast(pickle.dumps(fit_many(binned, settings, task_bytes=task_bytes)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(models.value)
        for batch in batches:
            for row in batch.to_pylist():
                b = Block.of(row)
                yield from (rows(i, model, b) for i, model in enumerate(known))

    return binned.blocks.mapInArrow(scored, "setting int, trees int, label int, score double")


# --- a model that scores -------------------------------------------------------------

@dataclass
class BoostedModel:
    """Trees with the cut points they were grown on, scoring a vector column to a probability column `name`."""

    name: str
    features: str
    trees: Trees
    cuts: list[np.ndarray]
    loss: str = "logistic"

    def _margins(self, df: DataFrame, stages: Sequence[int]) -> DataFrame:
        trees, cuts, stages = self.trees, self.cuts, list(stages)

        @F.pandas_udf("array<double>")
        def margins(x: pd.Series) -> pd.Series:
            rows = np.array([[np.nan] * len(cuts) if v is None else v for v in x], float).reshape(len(x), len(cuts))
            return pd.Series(list(trees.margins(binned_values(rows, cuts), stages).T))

        return df.withColumn("_margins", margins(vector_to_array(F.col(self.features))))

    def staged(self, df: DataFrame, stages: Sequence[int], out: str = "margins") -> DataFrame:
        """Adds the margins after each of the given numbers of trees, as one array column."""
        return self._margins(df, stages).withColumnRenamed("_margins", out)

    def score(self, df: DataFrame) -> DataFrame:
        n = max(1, len(self.trees.start))
        factor = 2.0 / n if self.loss == "ada" else 1.0
        margin = F.element_at("_margins", 1) * F.lit(factor)
        return self._margins(df, [len(self.trees.start)]).withColumn(self.name, 1.0 / (1.0 + F.exp(-margin))).drop("_margins")

    def save(self, spark: SparkSession, path: str) -> None:
        from .models import _save_meta

        _save_meta(spark, path, self.meta())

    def meta(self) -> dict:
        t, packed = self.trees, io.BytesIO()
        np.savez_compressed(packed, start=np.array(t.start, np.int64), feature=t.feature, cut=t.cut, empty_left=t.empty_left,
                            left=t.left, value=t.value, **{f"cuts{i}": c for i, c in enumerate(self.cuts)})
        return {"class": "boosted", "name": self.name, "features": self.features, "loss": self.loss, "width": len(self.cuts),
                "model": base64.b64encode(packed.getvalue()).decode()}

    @classmethod
    def of(cls, meta: dict) -> "BoostedModel":
        got = np.load(io.BytesIO(base64.b64decode(meta["model"])), allow_pickle=False)
        trees = Trees(got["start"].tolist(), *(got[c] for c in ("feature", "cut", "empty_left", "left", "value")))
        return cls(meta["name"], meta["features"], trees, [got[f"cuts{i}"] for i in range(meta["width"])], meta["loss"])
