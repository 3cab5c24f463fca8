"""Cleaning of raw tables: missing-value tokens, keys, rows without content, optional columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from staywise import functions as fn
from staywise.errors import InputError
from staywise.values import KEY


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude
    ]


def feature_columns(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> tuple[list[str], list[str]]:
    """Declared columns that are present; by type where none of a kind is declared or present."""
    num = [c for c in numeric if c in df.columns] or numeric_columns(df, exclude)
    cat = [c for c in categorical if c in df.columns] or [
        c for c in df.columns if c not in numeric_columns(df) and c not in exclude
    ]
    return num, cat


def clean_text(df: DataFrame, mode: str = "compat", columns: Sequence[str] | None = None) -> DataFrame:
    """Null the missing-value tokens of every string column and strip the rest, in one projection."""
    chosen = set(string_columns(df) if columns is None else columns)
    return df.select(
        *[fn.blank_to_null(F.col(c), mode).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def rename_column(df: DataFrame, source: str, target: str) -> DataFrame:
    """Rename ``source`` if it is there; an existing ``target`` column gives way to it."""
    if source not in df.columns or source == target:
        return df
    return df.drop(target).withColumnRenamed(source, target)


def harmonize_id(df: DataFrame, column: str = KEY, digits_only: bool = True) -> DataFrame:
    """Bring a dirty key to bigint; a table without that column passes through."""
    if column not in df.columns:
        return df
    return df.withColumn(column, fn.extract_key(F.col(column), digits_only))


def prepare_source(
    df: DataFrame, key: str = KEY, source_key: str | None = None, mode: str = "compat"
) -> DataFrame:
    """Rename the key, clean the text and harmonise the key: the one chain for every raw source."""
    if source_key:
        df = rename_column(df, source_key, key)
    return df.transform(clean_text, mode).transform(harmonize_id, key)


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce the columns that are present to double; what is not a number becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: fn.to_number(F.col(c)) for c in present}) if present else df


def drop_empty_rows(df: DataFrame, required: bool = False) -> DataFrame:
    """Drop rows that are null in every column; with ``required`` at least one row must remain."""
    kept = df.na.drop("all")
    if required and kept.isEmpty():
        raise InputError("enter at least one complete row")
    return kept


def align_features(df: DataFrame, features: Mapping[str, DataType | str] | Sequence[str]) -> DataFrame:
    """Exactly the expected columns in the expected order; an absent one is added as null."""
    types = features if isinstance(features, Mapping) else dict.fromkeys(features, "double")
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()]
    )


def require_columns(df: DataFrame, columns: Sequence[str], label: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise InputError(f"{label}: missing column(s) {', '.join(missing)}")
    return df


def split_target(
    df: DataFrame, target: str, key: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Rows with an integer target, and the names of the feature columns (neither target nor key)."""
    require_columns(df, [target], "training table")
    features = [c for c in df.columns if c not in (target, key)]
    return df.withColumn(target, F.col(target).cast("int")), features


def normalize_target(df: DataFrame, target: str) -> DataFrame:
    """Target spellings to 0/1; rows with any other spelling are dropped."""
    require_columns(df, [target], "merged table")
    return df.withColumn(target, fn.normalize_target(F.col(target))).where(F.col(target).isin(0, 1))


def invalid_targets(df: DataFrame, target: str) -> DataFrame:
    """Rows, and rows that ``normalize_target`` drops.

    A count of its own and no ``observe``: after an observation the session can no longer be serialised,
    and the summary of a fitted model takes the session into its tasks (Spark 4.1).
    """
    mapped = fn.normalize_target(F.col(target))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(mapped.isNull()).alias("n_dropped"))


def normalize_categories(
    df: DataFrame, synonyms: Mapping[str, Mapping[str, str]], coded: Sequence[str] = ()
) -> DataFrame:
    """Canonical spellings per column, then the number of each coded level."""
    spelled = {c: fn.normalize_category(F.col(c), m) for c, m in synonyms.items() if c in df.columns}
    coded = [c for c in coded if c in df.columns]
    if spelled:
        df = df.withColumns(spelled)
    return df.withColumns({c: fn.extract_code(F.col(c)) for c in coded}) if coded else df
