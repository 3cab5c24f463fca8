"""Preprocessing as learn -> few parameters -> apply.

The learned parameters are exact (interpolated medians, population deviations, smallest level on a tie), which the
ready-made imputer and scaler are not. Applying them is a projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.errors import InputError
from staywise.operators.ordering import ROWS_PER_BUCKET, exact_quantiles


@dataclass(frozen=True)
class NumericParam:
    name: str
    median: float
    mean: float
    deviation: float

    @property
    def expression(self) -> str:
        filled = f"coalesce(nanvl(double(`{self.name}`), NULL), {self.median!r}D)"
        return f"({filled} - {self.mean!r}D) / {self.deviation!r}D"


@dataclass(frozen=True)
class CategoryParam:
    name: str
    mode: str
    levels: tuple[str, ...]


@dataclass(frozen=True)
class Preparation:
    """Learned parameters of a feature table, one entry per column."""

    numeric: tuple[NumericParam, ...]
    categorical: tuple[CategoryParam, ...]

    @property
    def feature_names(self) -> list[str]:
        """Names in vector order: the numeric block, then every level of each category."""
        return [f"num__{p.name}" for p in self.numeric] + [
            f"cat__{p.name}_{level}" for p in self.categorical for level in p.levels
        ]

    @property
    def inputs(self) -> list[str]:
        return [p.name for p in (*self.numeric, *self.categorical)]

    def encoded(self) -> list[Column]:
        """One column per feature name, as plain expressions."""
        numbers = [F.expr(p.expression).alias(f"num__{p.name}") for p in self.numeric]
        flags = [
            (category_text(p.name, p.mode) == F.lit(level)).cast("double").alias(f"cat__{p.name}_{level}")
            for p in self.categorical
            for level in p.levels
        ]
        return numbers + flags

    def vector(self) -> Column:
        """The encoded row as array<double>, for distances and interpolation."""
        return F.array(*self.encoded())

    def stages(self, output: str = "features") -> list[Transformer]:
        """The same encoding as persistable ML stages that end in a vector column."""
        columns = [f"{p.expression} AS `num__{p.name}`" for p in self.numeric]
        columns += [
            f"{_category_sql(p.name, p.mode)} AS `txt__{p.name}`" for p in self.categorical
        ]
        stages: list[Transformer] = [
            SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")
        ]
        blocks = [f"num__{p.name}" for p in self.numeric]
        for p in self.categorical:
            # One indexer each: label lists of different length cannot share one.
            stages.append(
                StringIndexerModel.from_labels(
                    list(p.levels),
                    inputCol=f"txt__{p.name}",
                    outputCol=f"idx__{p.name}",
                    handleInvalid="keep",
                )
            )
        if self.categorical:
            encoder = OneHotEncoder(
                inputCols=[f"idx__{p.name}" for p in self.categorical],
                outputCols=[f"cat__{p.name}" for p in self.categorical],
                dropLast=True,  # the dropped slot is the one of unseen levels
            )
            stages.append(_fit_encoder(encoder, stages[1:], self.categorical))
            blocks += [f"cat__{p.name}" for p in self.categorical]
        stages.append(VectorAssembler(inputCols=blocks, outputCol=output, handleInvalid="error"))
        return stages

    def model(self, classifier: Transformer, features: str = "features") -> PipelineModel:
        """Preprocessing and fitted classifier as one model that can be saved; no resampling in it."""
        return PipelineModel([*self.stages(features), classifier])


def _fit_encoder(
    encoder: OneHotEncoder, indexers: Sequence[Transformer], params: Sequence[CategoryParam]
) -> Transformer:
    """Level counts come with the index columns as metadata, so this fit needs no data rows."""
    spark = SparkSession.getActiveSession()
    indexed = spark.createDataFrame([], ", ".join(f"`txt__{p.name}` string" for p in params))
    for indexer in indexers:
        indexed = indexer.transform(indexed)
    return encoder.fit(indexed)


def category_text(name: str, mode: str) -> Column:
    return F.expr(_category_sql(name, mode))


def _category_sql(name: str, mode: str) -> str:
    quoted = mode.replace("\\", "\\\\").replace("'", "\\'")
    return f"coalesce(string(`{name}`), '{quoted}')"


def level_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Category columns as text; a whole number has no decimals (``1``, never ``1.0``)."""
    types = dict(df.dtypes)
    made = {}
    for c in columns:
        if types[c] in ("double", "float"):
            whole = F.col(c) == F.floor(F.col(c))
            made[c] = F.when(whole, F.col(c).cast("bigint").cast("string")).otherwise(
                F.col(c).cast("string")
            )
        elif types[c] != "string":
            made[c] = F.col(c).cast("string")
    return df.withColumns(made) if made else df


def learn_medians(
    df: DataFrame,
    columns: Sequence[str],
    exact: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Median per numeric column as (feature, median); ``exact=False`` trades it for one sketch pass."""
    if exact:
        found = exact_quantiles(df, columns, [0.5], rows_per_bucket=rows_per_bucket)
        return found.select("feature", F.col("quantiles")[0].alias("median"))
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10_000).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("median")) for c in columns]
    return row.select(F.inline(F.array(*cells))).where("median IS NOT NULL")


def count_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (feature, level) of the category columns; nulls are left out."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], [*columns], "feature", "level").where(F.col("level").isNotNull())
    return long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))


def learn_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent level per category column as (feature, mode), the smallest on a tie."""
    order = F.struct(-F.col("n"), F.col("level"))
    return count_levels(df, columns).groupBy("feature").agg(F.min_by("level", order).alias("mode"))


def learn_scaling(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column as (feature, mean, deviation), in one pass."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"m_{c}").alias("mean"),
            F.col(f"s_{c}").alias("deviation"),
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def impute_median(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """The columns as double, with the median (of whole numbers, too, it may lie between two) in place of null and NaN."""
    medians = {r["feature"]: r["median"] for r in learn_medians(df, columns, exact).collect()}
    present = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in medians}
    return df.withColumns({c: F.coalesce(x, F.lit(medians[c])) for c, x in present.items()})


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    modes = {r["feature"]: r["mode"] for r in learn_modes(df, columns).collect()}
    return df.fillna(modes)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Subtract the mean and divide by the population deviation; a constant column is divided by 1."""
    scaled = {}
    for r in learn_scaling(df, columns).collect():
        c, mean, deviation = r["feature"], r["mean"], r["deviation"]
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(scaled)


def one_hot(df: DataFrame, column: str, levels: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column per level, in level order; an unseen level is 0 in all of them."""
    if levels is None:
        levels = _levels(count_levels(df, [column]))[column][0]
    return df.withColumns(
        {f"{column}_{lv}": F.coalesce((F.col(column) == F.lit(lv)).cast("int"), F.lit(0)) for lv in levels}
    )


def _levels(counted: DataFrame) -> dict[str, tuple[tuple[str, ...], str]]:
    """Levels and mode per category column. Each level is a dimension of the model, which the driver holds anyway."""
    found: dict[str, list] = {}
    for r in counted.collect():
        found.setdefault(r["feature"], []).append((r["n"], r["level"]))
    return {
        c: (tuple(sorted(level for _, level in ls)), min(ls, key=lambda x: (-x[0], x[1]))[1])
        for c, ls in found.items()
    }


def learn_preparation(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], exact: bool = True
) -> Preparation:
    """Learn medians, then the scaling of the imputed columns, then levels and modes: three bounded reads.

    A column without any value is left out, as there is nothing to learn from it.
    """
    medians = {}
    if numeric:
        medians = {r["feature"]: r["median"] for r in learn_medians(df, numeric, exact).collect()}
    kept = [c for c in numeric if c in medians]
    numbers: list[NumericParam] = []
    if kept:
        present = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in kept}
        imputed = df.select(*[F.coalesce(x, F.lit(medians[c])).alias(c) for c, x in present.items()])
        for r in learn_scaling(imputed, kept).collect():
            c = r["feature"]
            numbers.append(NumericParam(c, float(medians[c]), r["mean"], r["deviation"] or 1.0))
    categories = []
    if categorical:
        found = _levels(count_levels(level_text(df, categorical), categorical))
        categories = [CategoryParam(c, found[c][1], found[c][0]) for c in categorical if c in found]
    if not numbers and not categories:
        raise InputError("no usable feature column")
    return Preparation(tuple(numbers), tuple(categories))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes x rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("k"))
    weight = totals.select("all").scalar() / (totals.select("k").scalar() * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))
