"""One-hot encoding and scaling as fit/transform pairs, and the column-wise preprocessor that
feeds the models."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import numeric_columns, string_columns

MAX_NAMED_CATEGORIES = 1000
MAX_INDEXED_CATEGORIES = 1_000_000


def check_categories(df: DataFrame, columns: Sequence[str], limit: int) -> None:
    """Raise if a column has more distinct values than the limit; what follows brings them to the driver."""
    counts = df.agg(*[F.count_distinct(c) for c in columns]).first()
    if over := [f"{c} ({n})" for c, n in zip(columns, counts, strict=True) if n > limit]:
        raise ValueError(f"more than {limit} categories: {', '.join(over)}")


@dataclass
class OneHotModel:
    """Categories per column in ascending order, the first one dropped if asked for."""

    categories: dict[str, list[str]]
    drop_first: bool = True

    def to_json(self) -> str:
        return json.dumps({"categories": self.categories, "drop_first": self.drop_first})

    @classmethod
    def from_json(cls, text: str) -> "OneHotModel":
        return cls(**json.loads(text))

    def indicators(self) -> list[tuple[str, str]]:
        """The (column, value) pair behind each indicator."""
        return [(c, v) for c, values in self.categories.items() for v in values[int(self.drop_first):]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Indicator columns named <column>_<value>; an unknown value gives all zeros."""
        keep = [c for c in df.columns if c not in self.categories]
        hot = [F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c, v in self.indicators()]
        return df.select(*keep, *hot)


def fit_one_hot(df: DataFrame, columns: Sequence[str] | None = None, *, drop_first: bool = True,
                limit: int = MAX_NAMED_CATEGORIES) -> OneHotModel:
    """Named indicator columns suit few categories; beyond the limit, for any one column, use
    one_hot_vector."""
    columns = list(columns or string_columns(df))
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])).alias("r")) \
        .select("r.*").filter(F.col("v").isNotNull()).distinct()
    check_categories(df, columns, limit)
    found = values.collect()  # at most limit values a column, as just checked
    return OneHotModel({c: sorted(r["v"] for r in found if r["c"] == c) for c in columns}, drop_first)


def one_hot_stages(columns: Sequence[str], *, drop_first: bool = True, suffix: str = "_hot") -> list:
    """Index descending and drop the last slot, so that the slot given up is the one for
    unknown values, which become all zeros."""
    indexed = [f"{c}_idx" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, stringOrderType="alphabetDesc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}{suffix}" for c in columns], dropLast=True,
                      handleInvalid="error"),
    ]


def fit_one_hot_vector(df: DataFrame, columns: Sequence[str], *, drop_first: bool = True) -> PipelineModel:
    """One vector per column, named <column>_hot. With drop_first the alphabetically first
    category, which sits in the last slot, is cut off too."""
    check_categories(df, columns, MAX_INDEXED_CATEGORIES)  # the indexer keeps them all on the driver
    if not drop_first:
        return Pipeline(stages=one_hot_stages(columns)).fit(df)
    model = Pipeline(stages=one_hot_stages(columns, suffix="_all")).fit(df)
    slices = [
        VectorSlicer(inputCol=f"{c}_all", outputCol=f"{c}_hot", indices=list(range(max(len(labels) - 1, 0))))
        for c, labels in zip(columns, model.stages[0].labelsArray) if len(labels) > 1]
    return PipelineModel([*model.stages, *slices])


@dataclass
class Scaler:
    """(x - center) / scale per column; a column without spread becomes 0. Fitted on the
    training rows and applied to any frame."""

    kind: str = "standard"
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame, columns: Sequence[str] | None = None, target: str | None = None) -> "Scaler":
        cols = list(columns or numeric_columns(df, [target] if target else []))
        x = {c: F.col(c).cast("double") for c in cols}
        stats = {
            "standard": lambda v: (F.avg(v), F.stddev_pop(v)),
            "minmax": lambda v: (F.min(v), F.max(v) - F.min(v)),
        }[self.kind]
        row = df.agg(*[e for c in cols for e in stats(x[c])]).first()
        self.center = {c: row[2 * i] or 0.0 for i, c in enumerate(cols)}
        self.scale = {c: row[2 * i + 1] or 1.0 for i, c in enumerate(cols)}
        return self

    def _check(self) -> None:
        if not self.scale:
            raise ValueError("the scaler has not been fitted yet: fit it on the training data first")

    def exprs(self) -> dict[str, Column]:
        self._check()
        return {c: (F.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c]) for c in self.scale}

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.exprs())

    def stage(self, suffix: str = "_std") -> SQLTransformer:
        """The same as a pipeline stage that saves and loads with its model."""
        self._check()
        cols = ", ".join(
            f"coalesce((CAST(`{c}` AS DOUBLE) - {self.center[c]!r}D) / {self.scale[c]!r}D, 0D) AS `{c}{suffix}`"
            for c in self.scale)
        return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")

    def to_json(self) -> str:
        return json.dumps({"kind": self.kind, "center": self.center, "scale": self.scale})

    @classmethod
    def from_json(cls, text: str) -> "Scaler":
        return cls(**json.loads(text))


def fit_preprocessor(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), *, drop_first: bool = True,
    universe: DataFrame | None = None, out: str = "features",
) -> PipelineModel:
    """Numeric columns standardised, categorical ones one-hot, assembled into one vector.
    `universe` widens the categories, for instance to those of train and test together."""
    scaler = Scaler().fit(df, numeric)
    stages = [scaler.stage()]
    if categorical:
        stages += fit_one_hot_vector(universe if universe is not None else df, categorical, drop_first=drop_first).stages
    hot = [s.getOutputCol() for s in stages if isinstance(s, VectorSlicer)] if drop_first else [
        f"{c}_hot" for c in categorical]
    stages.append(VectorAssembler(inputCols=[*(f"{c}_std" for c in numeric), *hot], outputCol=out))
    return PipelineModel(stages)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its attributes."""
    attrs = df.schema[features].metadata["ml_attr"]
    named = {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.get("attrs", {}).values() for a in group}
    return [named.get(i, str(i)) for i in range(attrs["num_attrs"])]


def vector_width(df: DataFrame, features: str = "features") -> int | None:
    return df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
