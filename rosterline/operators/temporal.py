"""Rolling and growth features per entity over time.

The key (entity, time) is unique, so a window partition holds one row per season of one
entity; a partition cannot outgrow the number of seasons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.tables import numeric_columns, union_rows


def _columns(df: DataFrame, columns: Sequence[str] | None, key: str, order: str, exclude: Sequence[str]) -> list[str]:
    return list(columns) if columns else numeric_columns(df, [key, order, *exclude])


def rolling_exprs(columns: Sequence[str], key: str, order: str, window: int, stat: str) -> list[Column]:
    """Mean or sample std over the last `window` rows; null until they hold `window` values."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(1 - window, 0)
    fn = {"mean": F.avg, "std": F.stddev_samp}[stat]
    return [
        F.when(F.count(c).over(w) == window, fn(F.col(c).cast("double")).over(w)).alias(f"rolling_{stat}_{c}")
        for c in columns
    ]


def growth_exprs(columns: Sequence[str], key: str, order: str) -> list[Column]:
    """(current - previous) / previous with missing values carried forward first; a zero
    previous value gives null."""
    w = Window.partitionBy(key).orderBy(order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    out = []
    for c in columns:
        cur = F.last(F.col(c).cast("double"), ignorenulls=True).over(upto)
        prev = F.last(F.col(c).cast("double"), ignorenulls=True).over(before)
        out.append(F.try_divide(cur - prev, prev).alias(f"growth_rate_{c}"))
    return out


def rolling_statistics(
    df: DataFrame, columns: Sequence[str] | None = None, *, key: str = "player_id", order: str = "year",
    window: int = 2, exclude: Sequence[str] = (),
) -> DataFrame:
    """All rolling and growth features, on one shuffle and one sort."""
    cols = _columns(df, columns, key, order, exclude)
    return df.select(
        "*", *rolling_exprs(cols, key, order, window, "mean"), *rolling_exprs(cols, key, order, window, "std"),
        *growth_exprs(cols, key, order))


def season_statistics(
    current: DataFrame, history: DataFrame, season: int, columns: Sequence[str] | None = None, *,
    key: str = "player_id", order: str = "year", window: int = 2, exclude: Sequence[str] = (),
) -> DataFrame:
    """The same for one season, using the window-1 seasons before it. The year range is
    filtered before the union, so only those seasons are read."""
    past = history.filter(F.col(order).between(season - window + 1, season - 1))
    both = union_rows(past, current.filter(F.col(order) == season))
    return rolling_statistics(
        both, columns, key=key, order=order, window=window, exclude=exclude).filter(F.col(order) == season)
