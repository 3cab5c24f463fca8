"""Expressions on text columns. All of them stay in the JVM; none is a UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from staywise.functions.numbers import to_number
from staywise.values import CODE_PATTERN, KEY_PATTERN, NULL_TOKENS, TARGET_LABELS, WHITESPACE


def strip(col: Column) -> Column:
    """Remove every kind of leading and trailing white space, not only the blank."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column, mode: str = "compat", tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null for the tokens that spell a missing value, else the stripped text.

    ``compat`` compares before stripping, so ``" Unknown "`` stays as ``"Unknown"``; ``strict`` strips
    first, which makes the operation idempotent.
    """
    if mode not in ("compat", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    compared = strip(col) if mode == "strict" else col
    return F.when(~compared.isin(*tokens), strip(col))


def extract_key(col: Column, digits_only: bool = True) -> Column:
    """A dirty key as bigint: its first run of digits, or with ``digits_only=False`` its numeric value."""
    if digits_only:
        digits = F.regexp_extract(col.cast("string"), KEY_PATTERN, 1)
        return F.nullif(digits, F.lit("")).try_cast("bigint")
    return to_number(col).try_cast("bigint")


def extract_code(col: Column) -> Column:
    """The leading number of a coded level (``"1, junior"`` is 1.0); text without digits is null."""
    found = F.nullif(F.regexp_extract(col.cast("string"), CODE_PATTERN, 0), F.lit(""))
    return F.translate(found, ",", ".").try_cast("double")


def _lookup(mapping: Mapping[str, object], key: Column) -> Column:
    literals = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*literals), key)


def normalize_target(col: Column, labels: Mapping[str, int] = TARGET_LABELS) -> Column:
    """Yes/no spellings as 1/0; anything unknown is null, for the caller to drop and count."""
    return _lookup(labels, F.lower(strip(col.cast("string")))).cast("int")


def normalize_category(col: Column, synonyms: Mapping[str, str]) -> Column:
    """The canonical spelling of a category; an unknown one is kept, stripped."""
    text = strip(col.cast("string"))
    return F.coalesce(_lookup(synonyms, F.lower(text)), text)


def humanize(name: str) -> str:
    """Column name as a label: ``monthly_income`` becomes ``Monthly income``."""
    return name.replace("_", " ").capitalize()
