"""Table profiling. Each report is one aggregation over the rows; the result, one value per
column and statistic, is then turned into rows."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import NUMBER_PATTERN
from ..session import cached
from ..sources.tables import numeric_columns, string_columns
from .quantiles import exact_quantiles, value_counts_long


def to_rows(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Spread a one-row aggregate into one row per struct."""
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def missing_profile(df: DataFrame, *, only_missing: bool = True) -> DataFrame:
    """Missing count and percentage per column."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = to_rows(one, [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing"),
                 (F.try_divide(F.col(c).cast("double"), F.col("_rows").cast("double")) * 100).alias("percentage"))
        for c in df.columns])
    return rows.filter(F.col("missing") > 0) if only_missing else rows


def sparse_columns(df: DataFrame, threshold: float) -> DataFrame:
    """Columns missing in more than `threshold` percent of the rows."""
    return missing_profile(df).filter(F.col("percentage") > threshold)


def drop_sparse(df: DataFrame, threshold: float) -> DataFrame:
    return df.drop(*[r["column_name"] for r in sparse_columns(df, threshold).collect()])


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return missing_profile(df).select("column_name")


def non_numeric_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of supposedly numeric text columns that are no number."""
    return (
        value_counts_long(df.select(*columns), columns)
        .filter(~F.col("value").rlike(NUMBER_PATTERN))
        .select(F.col("col").alias("column_name"), "value")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Share of each value in percent; the total is summed from the counts, not the rows."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", (F.col("n") / total * 100).alias("percentage"))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column. The rows are read
    once; the answer has one row per column."""
    columns = list(columns or numeric_columns(df))
    with cached(df.select(*columns)) as rows:
        cuts = exact_quantiles(rows, {c: (F.col(c), [0.25, 0.5, 0.75]) for c in columns})
        stats = rows.agg(*[e for c in columns for e in (
            F.count(c), F.avg(c), F.stddev_samp(c), F.min(c).cast("double"), F.max(c).cast("double"))]).first()
    table = []
    for i, c in enumerate(columns):
        n, mean, std, low, high = stats[5 * i:5 * i + 5]
        table.append((c, n, mean, std, low, *cuts[c], high))
    return df.sparkSession.createDataFrame(
        table, "column_name string, count bigint, mean double, std double, min double, "
               "q25 double, q50 double, q75 double, max double")


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, number of distinct values, most frequent value (smallest on ties) and its count."""
    columns = list(columns or string_columns(df))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value")))
    return (
        value_counts_long(df, columns).groupBy("col")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("best"))
        .select(F.col("col").alias("column_name"), "count", "unique",
                F.col("best.value").alias("top"), (-F.col("best.neg")).alias("freq"))
    )


def correlation_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation per column pair over the rows where both are present, all pairs in
    one pass; corr itself leaves out rows where one is missing."""
    one = df.agg(*[F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"c{i}") for i, (x, y) in enumerate(pairs)])
    return to_rows(one, [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"c{i}").alias("corr"))
                         for i, (x, y) in enumerate(pairs)])


def target_correlation(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or numeric_columns(df, [target]))
    return correlation_pairs(df, [(c, target) for c in columns]).select(
        F.col("x").alias("column_name"), "corr")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The full matrix in long form; the lower half and the diagonal come from the upper half."""
    columns = list(columns or numeric_columns(df))
    upper = correlation_pairs(df, list(itertools.combinations_with_replacement(columns, 2)))
    return upper.select(F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y", "corr"))).otherwise(
        F.array(F.struct("x", "y", "corr"),
                F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("corr"))))).alias("r")).select("r.*")


def top_bottom_correlated(df: DataFrame, target: str, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The n highest followed by the n lowest correlations; a feature can be in both. One row
    per feature enters the ranking."""
    corr = target_correlation(df, target, columns).filter(F.col("corr").isNotNull())
    top = corr.orderBy(F.desc("corr"), "column_name").limit(n).withColumn("part", F.lit("top"))
    low = corr.orderBy(F.asc("corr"), F.desc("column_name")).limit(n).withColumn("part", F.lit("bottom"))
    return top.unionByName(low)


def box_stats(df: DataFrame, by: str, columns: Sequence[str], groups: Sequence) -> DataFrame:
    """Box-plot numbers per class of a low-cardinality column: quartiles, whiskers (the most
    extreme values within 1.5 interquartile ranges) and the count outside them."""
    cells = [(g, c) for g in groups for c in columns]
    values = [F.when(F.col(by) == F.lit(g), F.col(c).cast("double")) for g, c in cells]
    with cached(df.select(by, *columns)) as rows:
        cuts = exact_quantiles(rows, {str(i): (v, [0.25, 0.5, 0.75]) for i, v in enumerate(values)})
        used = [(i, *cuts[str(i)]) for i in range(len(cells)) if cuts[str(i)][0] is not None]
        aggs = []
        for i, q1, _, q3 in used:
            v, reach = values[i], 1.5 * (q3 - q1)
            inside = (v >= q1 - reach) & (v <= q3 + reach)
            aggs += [F.min(F.when(inside, v)), F.max(F.when(inside, v)), F.count_if(~inside)]
        found = rows.agg(*aggs).first() if aggs else ()
    table = [(*cells[i], q1, q2, q3, *found[3 * at:3 * at + 3]) for at, (i, q1, q2, q3) in enumerate(used)]
    return df.sparkSession.createDataFrame(
        table, f"`{by}` {df.schema[by].dataType.simpleString()}, feature string, q1 double, median double, q3 double, "
               "whisker_low double, whisker_high double, outliers bigint")


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def dictionary_from_metadata(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The data dictionary of a frame whose columns carry descriptions."""
    rows = [(i + 1, f.name, f.metadata.get("description")) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "feature int, name string, description string")
