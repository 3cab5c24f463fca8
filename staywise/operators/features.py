"""Feature derivation, one function for training, batch scoring and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise import functions as fn
from staywise import values
from staywise.operators.cleaning import normalize_categories, to_numbers


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which part in the derivation. Absent columns are skipped."""

    numeric: Sequence[str] = values.NUMERIC_COLUMNS
    synonyms: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: values.CATEGORY_SYNONYMS)
    coded: Sequence[str] = values.CODED_COLUMNS
    percents: Sequence[str] = values.PERCENT_COLUMNS
    ratios: Sequence[tuple[str, str, str]] = values.RATIOS
    mean_of: Sequence[str] = values.SATISFACTION_COLUMNS
    mean_output: str = values.MEAN_OUTPUT
    deltas: Sequence[tuple[str, str, str]] = (values.DELTA,)

    @classmethod
    def of(cls, numeric: Sequence[str], mean_of: Sequence[str]) -> FeatureSpec:
        """With the numeric columns and the columns of the row mean that a run's settings name."""
        return cls(numeric=tuple(numeric), mean_of=tuple(mean_of))

    @property
    def derived(self) -> list[str]:
        return [r[0] for r in self.ratios] + [self.mean_output] + [d[0] for d in self.deltas]


def add_ratios(df: DataFrame, ratios: Sequence[tuple[str, str, str]]) -> DataFrame:
    made = {
        out: fn.safe_ratio(F.col(a), F.col(b))
        for out, a, b in ratios
        if a in df.columns and b in df.columns
    }
    return df.withColumns(made) if made else df


def add_row_mean(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    present = [F.col(c) for c in columns if c in df.columns]
    return df.withColumn(output, fn.row_mean(present)) if present else df


def add_deltas(df: DataFrame, deltas: Sequence[tuple[str, str, str]]) -> DataFrame:
    made = {
        out: fn.difference(F.col(now), F.col(then))
        for out, now, then in deltas
        if now in df.columns and then in df.columns
    }
    return df.withColumns(made) if made else df


def derive_features(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Percents, spellings, codes and numbers, then ratios, mean and change.

    Percent text is parsed before the general coercion, which would null it. Everything is a projection:
    the optimiser folds the whole chain into the scan stage.
    """
    percents = [c for c in spec.percents if c in df.columns]
    numbers = [c for c in spec.numeric if c not in percents and c not in spec.derived]
    if percents:
        df = df.withColumns({c: fn.parse_percent(F.col(c)) for c in percents})
    return (
        df.transform(normalize_categories, spec.synonyms, spec.coded)
        .transform(to_numbers, numbers)
        .transform(add_ratios, spec.ratios)
        .transform(add_row_mean, spec.mean_of, spec.mean_output)
        .transform(add_deltas, spec.deltas)
    )
