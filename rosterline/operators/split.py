"""Train/validation parts and folds that depend only on the key, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import hash_bucket
from .ranking import hashed_row_number


def season_key(player: str = "player_id", year: str = "year") -> Column:
    """One integer per (player, season), for years 0 to 9999."""
    return F.col(player) * 10000 + F.col(year)


def _part(in_train: Column) -> Column:
    """Null where the condition is: such rows belong to neither part."""
    return F.when(in_train, "train").when(~in_train, "validation")


def with_hash_part(df: DataFrame, key: Column, *, test_tenths: int = 2, seed: int = 42) -> DataFrame:
    """Adds `part`: about test_tenths/10 of the rows are validation. No shuffle."""
    return df.withColumn("part", _part(hash_bucket(key, 10, seed) < 10 - test_tenths))


def hash_parts(df: DataFrame, key: Column, **kw) -> tuple[DataFrame, DataFrame]:
    """The two parts as frames."""
    both = with_hash_part(df, key, **kw)
    return tuple(both.filter(F.col("part") == p).drop("part") for p in ("train", "validation"))


def with_stratified_part(df: DataFrame, target: str, key: Column, tie: Sequence[str], *,
                         test_tenths: int = 2, seed: int = 42) -> DataFrame:
    """Adds `part` with the same share of every class on both sides, exact to one row. A row
    without a target has a null part."""
    ranked = hashed_row_number(df, key, tie, strata=target, salt=seed, name="_rn", total="_n")
    in_train = F.col("_rn") * 10 <= F.col("_n") * (10 - test_tenths)
    return ranked.withColumn("part", _part(in_train)).drop("_rn", "_n")


def with_stratified_fold(df: DataFrame, target: str, key: Column, tie: Sequence[str], *,
                         folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds `fold` 0..folds-1 with each class dealt out in turn. A row without a target has a
    null fold, so it is in none and trains no model."""
    ranked = hashed_row_number(df, key, tie, strata=target, salt=seed, name="_rn")
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % folds).cast("int")).drop("_rn")


def category_universe(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column over both frames."""
    values = lambda df: df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("r")).select("r.*")
    return values(train).union(values(test)).filter(F.col("value").isNotNull()).distinct()
