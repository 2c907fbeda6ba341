"""Whole-table running totals and row numbers without a one-task window.

Both cut the table into ranges, work inside each range, and add the totals of the ranges
before it. The table of range totals is bounded by the number of ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalar import hash_bucket, key_hash
from ..session import rank_buckets

ROWS_PER_RANGE = 1_000_000
SKETCH = 1_000_000  # largest accuracy of the sketch that the cut points are taken from


def range_edges(df: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Cut points that split the rows into ranges of about the given size; their number follows
    the rows. NaN is no cut point."""
    n = df.select(F.count(order)).first()[0]
    ranges = -(-n // rows_per_range)
    if ranges <= 1:
        return []
    probs = [i / ranges for i in range(1, ranges)]
    cuts = df.select(F.percentile_approx(order, probs, min(SKETCH, 10 * ranges))).first()[0]
    return sorted({c for c in cuts if c == c})


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], *, descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Adds cum_<c>, the total of c over all rows up to and including this one in order of a
    column without repeats or nulls. NaN is above every number."""
    edges = range_edges(df, order, rows_per_range)
    sort = F.col(order).desc() if descending else F.col(order).asc()
    inf = float("inf")
    if edges:
        cut = Bucketizer(splits=[-inf, *(e for e in edges if abs(e) != inf), inf] if len(edges) > 1 or abs(edges[0]) != inf
                         else [-inf, 0.0, inf], inputCol="_o", outputCol="_range", handleInvalid="keep")
        ranged = cut.transform(df.withColumn("_o", F.col(order).cast("double"))).drop("_o")
    else:
        ranged = df.withColumn("_range", F.lit(0.0))
    inside = Window.partitionBy("_range").orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy(F.col("_range").desc() if descending else F.col("_range")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
        .select("_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums])
    )  # a row for each range
    return (
        ranged.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
        .join(F.broadcast(offsets), "_range")
        .select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in sums])
    )


def hashed_row_number(
    df: DataFrame, key: Column, tie: Sequence[str], *, strata: str | None = None, salt: int = 0,
    buckets: int | None = None, name: str = "rn", total: str | None = None,
) -> DataFrame:
    """Row number 1..n in order of the hash of a unique key (ties by the given columns), over the
    whole table or within each stratum. A stratum holding most rows is spread over the hash ranges.
    With `total` the stratum size is added as well."""
    buckets = buckets or rank_buckets(df.sparkSession)
    group = [strata] if strata else []
    b = df.withColumn("_b", hash_bucket(key, buckets, salt)).withColumn("_h", key_hash(key, salt))
    inside = Window.partitionBy(*group, "_b").orderBy("_h", *tie)
    by_range = Window.partitionBy(*group) if strata else Window.partitionBy(F.lit(0))
    sizes = b.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n")).select(
        *group, "_b",
        F.coalesce(F.sum("_n").over(by_range.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
        F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    # Joined on the window's own keys, so the rows are not shuffled again. Rows without a stratum
    # are kept and stay unnumbered.
    numbered = b.withColumn("_in", F.row_number().over(inside)).join(sizes, [*group, "_b"], "left")
    extra = [F.col("_total").alias(total)] if total else []
    return numbered.select(*df.columns, (F.col("_in") + F.col("_before")).alias(name), *extra)
