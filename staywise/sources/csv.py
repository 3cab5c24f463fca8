"""CSV and in-memory sources. Everything is read as text; types come from explicit expressions later."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from staywise.errors import InputError
from staywise.operators.cleaning import drop_empty_rows, string_columns
from staywise.session import materialize
from staywise.sources import csv_splits
from staywise.values import CSV_NULL_TOKENS

log = logging.getLogger(__name__)


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    strict: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """All columns as text, missing-value spellings as null.

    Columns go by the names in the header, whatever their order; ``columns`` chooses some of them, and one that the
    file lacks is null. Files of one folder must have the same header. ``strict`` fails on a malformed line. A quoted
    text may hold line breaks, and large files are split between tasks all the same, at the price of a second scan; say
    ``multi_line=False`` for files that are known to have none.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )
    try:
        if multi_line:
            df = csv_splits.read_quoted(spark, path, strict)
            names = df.columns
        else:
            names = reader.csv(path).columns
            # every file's own header is held against these names; a schema alone would be laid over it by position
            df = reader.schema(text_schema(names)).option("enforceSchema", False).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in columns])
    return null_tokens(df)


def null_tokens(df: DataFrame, tokens: Sequence[str] = CSV_NULL_TOKENS) -> DataFrame:
    """Null for every text field that spells a missing value; a reader option takes only one token."""
    chosen = set(string_columns(df))
    return df.select(
        *[
            F.when(~F.col(c).isin(*tokens), F.col(c)).alias(c) if c in chosen else F.col(c)
            for c in df.columns
        ]
    )


def safe_read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Like ``read_csv``, but a missing or unreadable file is an empty table, with a message in the log."""
    try:
        return read_csv(spark, path, columns, strict=False)
    except FileNotFoundError:
        log.warning("file not found: %s", path)
    except PySparkException as error:
        log.error("cannot read %s: %s", path, error)
    return spark.createDataFrame([], text_schema(columns or []))


def read_supplied_csv(spark: SparkSession, path: str | None, label: str) -> DataFrame:
    """A file that a person handed in; what is wrong with it is said with the label they know it by.

    The file is parsed here, once, and what comes back reads the parsed rows.
    """
    if not path:
        raise InputError(f"please supply the file {label}")
    try:
        return materialize(read_csv(spark, path), "supplied")
    except (FileNotFoundError, PySparkException) as error:
        raise InputError(f"cannot read the file {label}: {error}") from error
    except Py4JJavaError as error:  # what a task met comes up as it is
        cause = error.java_exception.getCause() or error.java_exception
        raise InputError(f"cannot read the file {label}: {cause.getMessage()}") from error


def rows_to_table(
    spark: SparkSession, rows: object, headers: Sequence[str] = (), required: bool = True
) -> DataFrame:
    """A table from a DataFrame, a pandas frame, a list of rows or mappings, or None.

    Values become text, and rows without any value are dropped.
    """
    if isinstance(rows, DataFrame):
        df = rows
    elif rows is None:
        df = spark.createDataFrame([], text_schema(headers))
    elif hasattr(rows, "to_dict"):
        df = rows_to_table(spark, rows.to_dict("records"), headers or list(rows.columns), False)
    else:
        rows = list(rows)
        if rows and isinstance(rows[0], Mapping):
            headers = list(headers) or list(dict.fromkeys(k for r in rows for k in r))
            rows = [[r.get(h) for h in headers] for r in rows]
        elif not headers:
            raise InputError("rows without names need headers")
        as_text = [[None if v is None or v != v else str(v) for v in r] for r in rows]
        df = spark.createDataFrame(as_text, text_schema(headers))
    return drop_empty_rows(df, required)


def form_to_table(spark: SparkSession, features: Sequence[str], entered: Sequence[object]) -> DataFrame:
    """The one row that a filled-in form stands for."""
    if not features:
        raise InputError("a form needs the list of its fields")
    return rows_to_table(spark, [list(entered)], features, required=False)


def missing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that do not exist, on whatever file system they are. Nothing is read."""
    missing = []
    for path in paths:
        try:
            spark.read.schema("value string").text(path)
        except AnalysisException:
            missing.append(path)
    if missing:
        log.warning("missing files: %s", ", ".join(missing))
    return missing


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per partition; Parquet is the format between stages."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
