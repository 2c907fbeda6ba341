"""Table scans and sinks."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, multiline: bool = False) -> DataFrame:
    """CSV with a header, doubled quotes and empty cells as null. Columns are found by their
    name in the header, whatever their order; a column that the schema lacks is left out, one
    that the file lacks is an error. Types are given, so the file is read once but for its first
    line; NaN and infinities in double columns become null. With multiline, quoted cells may
    hold line ends, and a file is read by one task."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multiline}
    header = spark.read.csv(path, **options).columns
    types = {f.name: f for f in wanted.fields}
    if absent := [c for c in types if c not in header]:
        raise ValueError(f"{path} lacks the columns {absent}")
    in_file = T.StructType([types.get(c, T.StructField(c, T.StringType())) for c in header])
    df = spark.read.csv(
        path, schema=in_file, nullValue="", emptyValue="", mode="FAILFAST", enforceSchema=False, **options,
    ).select(*wanted.names)
    inf = float("inf")
    return df.select(*[
        F.when(F.isnan(f.name) | (F.abs(f.name) == inf), None).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="")


def write_scores(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Prediction sink: one row per key with its probability."""
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def describe_feature(dictionary: DataFrame, name: str) -> str | None:
    """Look one column up in a data dictionary of (feature, name, description)."""
    row = dictionary.filter(F.col("name") == name).select("description").first()
    return row["description"] if row else None


def with_descriptions(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Attach dictionary descriptions as column metadata. A dictionary has one row per
    column of the table, so reading it whole is bounded by the schema."""
    wanted = dictionary.filter(F.col("name").isin(df.columns)).select("name", "description")
    notes = {r["name"]: r["description"] for r in wanted.collect()}
    return df.select(*[
        F.col(c).alias(c, metadata={"description": notes[c]}) if c in notes else F.col(c)
        for c in df.columns
    ])


def table_info(df: DataFrame) -> DataFrame:
    """Rows and non-null counts per column with the column type, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]
    )
    types = dict(df.dtypes)
    return counts.select(F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
            F.col("_rows").alias("n_rows"), F.col(c).alias("n_non_null"),
        ) for c in df.columns
    ])).alias("r")).select("r.*")


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    skip = {c.lower() for c in exclude}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name.lower() not in skip]


def string_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    skip = {c.lower() for c in exclude}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name.lower() not in skip]


def split_features(df: DataFrame, target: str, ids: tuple[str, ...] = ("player_id",)) -> tuple[list[str], str]:
    """Feature column names and the target, with identifiers left out."""
    skip = {target.lower(), *(i.lower() for i in ids)}
    return [c for c in df.columns if c.lower() not in skip], target


def has_columns(df: DataFrame, *names: str) -> bool:
    have = {c.lower() for c in df.columns}
    return all(n.lower() in have for n in names)


def align_to(df: DataFrame, columns: list[str], fill: float = 0.0) -> DataFrame:
    """Reorder to the given columns, adding absent ones as a constant and dropping others."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])


def union_rows(*frames: DataFrame) -> DataFrame:
    """Row append by name; a column one frame lacks is null there."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
