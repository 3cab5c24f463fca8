"""Data-quality figures: each check is one pass of conditional counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Domain = Sequence[str] | tuple[float, float]


def integrity_checks(
    df: DataFrame, key: str, target: str, allowed: Sequence[str], expected_rows: int | None = None
) -> DataFrame:
    """Null keys and targets outside the allowed texts, as (rule, n_checked, n_bad).

    With ``expected_rows`` also the rows that are missing or too many, as after a merge that should keep them all.
    """
    text = F.col(target).cast("string")
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(key).isNull()).alias("key_null"),
        F.count_if(F.col(key).try_cast("bigint").isNull() & F.col(key).isNotNull()).alias("key_not_integer"),
        F.count_if(~F.coalesce(text.isin(*allowed), F.lit(False))).alias("target_outside"),
        F.abs(F.count(F.lit(1)) - F.lit(expected_rows)).alias("row_count_kept"),
    )
    cells = [
        F.struct(F.lit(rule).alias("rule"), F.col("n").alias("n_checked"), F.col(rule).alias("n_bad"))
        for rule in ("key_null", "key_not_integer", "target_outside", "row_count_kept")
        if rule != "row_count_kept" or expected_rows is not None
    ]
    return row.select(F.inline(F.array(*cells)))


def _violates(column: str, domain: Domain) -> Column:
    """True where a value is present and outside its domain: a list of texts, or a numeric (low, high)."""
    c = F.col(column)
    if len(domain) == 2 and all(isinstance(v, (int, float)) for v in domain):
        bad = ~c.cast("double").between(float(domain[0]), float(domain[1]))
    else:
        bad = ~c.cast("string").isin(*domain)
    return F.coalesce(bad, F.lit(False))


def domain_checks(df: DataFrame, rules: Mapping[str, Domain]) -> DataFrame:
    """(column, n_checked, n_null, n_bad) per rule, for the columns that are present."""
    present = [c for c in rules if c in df.columns]
    row = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in present],
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present],
        *[F.count_if(_violates(c, rules[c])).alias(f"bad_{c}") for c in present],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n_{c}").alias("n_checked"),
            F.col(f"null_{c}").alias("n_null"),
            F.col(f"bad_{c}").alias("n_bad"),
        )
        for c in present
    ]
    return row.select(F.inline(F.array(*cells)))


def quarantine(df: DataFrame, rules: Mapping[str, Domain]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that keep all rules, and the others with the list of columns at fault."""
    present = [c for c in rules if c in df.columns]
    faults = F.array_compact(F.array(*[F.when(_violates(c, rules[c]), F.lit(c)) for c in present]))
    marked = df.withColumn("faults", faults)
    return marked.where(F.size("faults") == 0).drop("faults"), marked.where(F.size("faults") > 0)
