"""Exact quantiles and modes with bounded task state.

The built-in exact percentile keeps every distinct value of a column in one buffer. Here a
column with few values goes straight to it; a larger one is first narrowed: one sketch per column
brackets all its wanted order statistics, a counting pass fixes how many rows lie at and between the edges
of the brackets, and only values strictly inside a bracket remain, which are sorted bracket by bracket. Each
round is one pass over all columns and brackets, however many quantiles are wanted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIRECT_VALUES = 2_000_000
SKETCH_ACCURACY = 10_000
GRID = 64  # steps through a bracket that is still too large


def _agg_row(df: DataFrame, exprs: Sequence[Column]):
    return df.agg(*[e.alias(f"a{i}") for i, e in enumerate(exprs)]).first()


class _Cell(NamedTuple):
    """An open interval of one column that holds wanted order statistics (ranks, counted from 0): rows below it and in it."""

    name: str
    lo: float | None
    hi: float | None
    below: int
    inside: int
    ranks: tuple[int, ...]


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]], *,
    direct: int = DIRECT_VALUES, accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of numeric expressions; nulls are skipped. All wanted
    expressions share each pass. Returns name -> values in the order asked."""
    names = list(wanted)
    exprs = {n: wanted[n][0].cast("double") for n in names}
    if not names:
        return {}
    counts = dict(zip(names, _agg_row(df, [F.count(exprs[n]) for n in names])))
    out: dict[str, list[float | None]] = {n: [None] * len(wanted[n][1]) for n in names}
    budget = max(1, direct // len(names))
    small = [n for n in names if 0 < counts[n] <= budget]
    if small:
        row = _agg_row(df, [F.percentile(exprs[n], [float(p) for p in wanted[n][1]]) for n in small])
        out.update({n: list(v) for n, v in zip(small, row)})
    large = [n for n in names if counts[n] > budget]
    ends = {n: [(math.floor(p * (counts[n] - 1)), math.ceil(p * (counts[n] - 1))) for p in wanted[n][1]] for n in large}
    found = _search(df, exprs, {n: (counts[n], sorted({r for pair in ends[n] for r in pair})) for n in large}, budget, accuracy)
    for n in large:
        for i, (p, (floor, ceil)) in enumerate(zip(wanted[n][1], ends[n])):
            low, high = found[n, floor], found[n, ceil]
            out[n][i] = low + (high - low) * (p * (counts[n] - 1) - floor)
    return out


def _search(df: DataFrame, exprs: dict[str, Column], wanted: dict[str, tuple[int, list[int]]], budget: int,
            accuracy: int) -> dict[tuple[str, int], float]:
    """(column, rank) -> value, for the wanted ranks of columns with so many rows."""
    found: dict[tuple[str, int], float] = {}
    cells = [_Cell(n, None, None, 0, rows, tuple(ranks)) for n, (rows, ranks) in wanted.items() if ranks]
    while cells:
        small = [c for c in cells if c.inside <= max(1, budget)]
        if small:
            found.update(_picked(df, exprs, small))
        cells = [c for c in cells if c.inside > max(1, budget)]
        if cells:
            known, cells = _narrowed(df, exprs, cells, _edges(df, exprs, cells, accuracy))
            found.update(known)
    return found


def _edges(df: DataFrame, exprs: dict[str, Column], cells: Sequence[_Cell], accuracy: int) -> dict[str, np.ndarray]:
    """Values of each column by which to cut its cells: on both sides of each rank, by one sketch of a whole column; later,
    in even steps through each cell."""
    margin = 2.0 / accuracy
    if all(c.lo is None and c.hi is None for c in cells):
        sides = [sorted({min(1.0, max(0.0, r / max(c.inside - 1, 1) + side)) for r in c.ranks for side in (-margin, margin)}) for c in cells]
        every = sorted({p for own in sides for p in own})
        # Sketches meet column by column: in one row of all columns, a single task would merge those of all partitions.
        got = _inside(df, exprs, cells).groupBy("cell").agg(F.percentile_approx("v", every, accuracy).alias("e")).collect()
        place = {p: i for i, p in enumerate(every)}
        rows = [(cells[r["cell"]].name, [r["e"][place[p]] for p in sides[r["cell"]]]) for r in got]
    else:
        steps = F.percentile_approx("v", [i / GRID for i in range(GRID + 1)], accuracy)
        got = _inside(df, exprs, cells).groupBy("cell").agg(steps.alias("e")).collect()  # a row per cell
        rows = [(cells[r["cell"]].name, r["e"]) for r in got] + [(c.name, [v for v in (c.lo, c.hi) if v is not None]) for c in cells]
    out: dict[str, list[float]] = {}
    for name, edges in rows:
        out.setdefault(name, []).extend(edges)
    return {n: np.unique(np.array(e, float)) for n, e in out.items()}


def _columns(df: DataFrame, exprs: dict[str, Column], names: Sequence[str]) -> DataFrame:
    return df.select(*[exprs[n].alias(f"c{i}") for i, n in enumerate(names)])


def _values(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column(i).drop_null().to_numpy(zero_copy_only=False)


def _narrowed(df: DataFrame, exprs: dict[str, Column], cells: Sequence[_Cell],
              edges: dict[str, np.ndarray]) -> tuple[dict[tuple[str, int], float], list[_Cell]]:
    """Ranks that fall on an edge, and the cells between edges that hold the others: one pass counts the rows at and between
    the edges of all columns."""
    names = list(edges)
    cuts = [edges[n] for n in names]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(2 * len(c) + 1, np.int64) for c in cuts]  # before the first edge, at it, behind it, ...
        for batch in batches:
            for i, c in enumerate(cuts):
                v = _values(batch, i)
                sums[i] += np.bincount(np.searchsorted(c, v, "left") + np.searchsorted(c, v, "right"), minlength=len(sums[i]))
        for i, n in enumerate(sums):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at), pa.array(n[at])], names=["col", "at", "n"])

    sums = [np.zeros(2 * len(c) + 1, np.int64) for c in cuts]
    got = _columns(df, exprs, names).mapInArrow(counted, "col int, at long, n long").groupBy("col", "at").agg(F.sum("n").alias("n"))
    for r in got.collect():  # two rows per edge
        sums[r["col"]][r["at"]] = r["n"]
    found, ranks = {}, {}
    for cell in cells:
        i = names.index(cell.name)
        above = np.cumsum(sums[i])
        for rank in cell.ranks:
            at = int(np.searchsorted(above, rank, "right"))
            if at % 2:
                found[cell.name, rank] = float(cuts[i][at // 2])
            else:
                ranks.setdefault((i, at), []).append(rank)
    left = []
    for (i, at), those in ranks.items():
        lo, hi = (float(cuts[i][k]) if 0 <= k < len(cuts[i]) else None for k in (at // 2 - 1, at // 2))
        left.append(_Cell(names[i], lo, hi, int(sums[i][:at].sum()), int(sums[i][at]), tuple(those)))
    return found, left


def _inside(df: DataFrame, exprs: dict[str, Column], cells: Sequence[_Cell]) -> DataFrame:
    """(cell, v): the values that lie inside a cell, by its place in the list. Cells of one column don't meet."""
    names = list(dict.fromkeys(c.name for c in cells))
    inf = float("inf")
    order = [sorted((k for k, c in enumerate(cells) if c.name == n), key=lambda k: -inf if cells[k].lo is None else cells[k].lo)
             for n in names]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in enumerate(order):
                v = np.sort(_values(batch, i))
                for k in own:
                    c = cells[k]
                    first = 0 if c.lo is None else np.searchsorted(v, c.lo, "right")
                    last = len(v) if c.hi is None else np.searchsorted(v, c.hi, "left")
                    if first < last:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(last - first, k, np.int32)), pa.array(v[first:last])], names=["cell", "v"])

    return _columns(df, exprs, names).mapInArrow(kept, "cell int, v double")


def _picked(df: DataFrame, exprs: dict[str, Column], cells: Sequence[_Cell]) -> dict[tuple[str, int], float]:
    """The ranks of cells whose values a task can sort."""

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        cell = cells[int(frame["cell"].iloc[0])]
        v = np.sort(frame["v"].to_numpy())
        ranks = np.array(cell.ranks, np.int64)
        return pd.DataFrame({"cell": frame["cell"].iloc[0], "rank": ranks, "v": v[ranks - cell.below]})

    got = _inside(df, exprs, cells).groupBy("cell").applyInPandas(pick, "cell int, rank long, v double").collect()
    return {(cells[r["cell"]].name, r["rank"]): r["v"] for r in got}


def medians(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, float | None]:
    got = exact_quantiles(df, {c: (F.col(c), [0.5]) for c in columns}, **kw)
    return {c: v[0] for c, v in got.items()}


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, value, n) for several text columns in one shuffle; nulls left out. Counting is
    combined before the shuffle, so a value holding most rows is no hot spot."""
    return (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in columns
        ])).alias("r")).select("r.*")
        .filter(F.col("value").isNotNull())
        .groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per text column, the smallest one on ties."""
    if not columns:
        return {}
    best = (
        value_counts_long(df, columns)
        .groupBy("col").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("best"))
        .select("col", "best.value")
    )
    found = {r["col"]: r["value"] for r in best.collect()}  # one row per column
    return {c: found.get(c) for c in columns}
