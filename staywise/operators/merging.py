"""Inner merge of several keyed sources, and what to know about their keys beforehand."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.errors import InputError
from staywise.operators.cleaning import require_columns
from staywise.operators.skew import MIN_ROWS, draw_salt, hot_keys_of, skew_join
from staywise.session import materialize


def id_diagnostics(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows, distinct keys and duplicates (rows minus distinct, so a null key counts) per source."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_distinct")).select(
            F.lit(name).alias("source"),
            "n_rows",
            "n_distinct",
            (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"),
        )
        for name, df in frames.items()
        if key in df.columns
    ]
    if not parts:
        raise InputError(f"no source has the key column {key}")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def merge_sources(
    frames: Mapping[str, DataFrame],
    key: str,
    null_safe: bool = False,
    min_skew_rows: int = MIN_ROWS,
    stored: bool = False,
    part_rows: int | None = None,
) -> DataFrame:
    """Inner join of all sources on ``key``. Repeated keys multiply, as in SQL.

    A non-key column that an earlier source already has gets the source name as suffix. Null keys match
    nothing, or each other with ``null_safe``. From ``min_skew_rows`` rows on, hot keys are salted. The sources are
    written first: what stands behind them runs once, the look for hot keys reads a column of what was written,
    and salts are the same when a task is run again. Say ``stored`` when they are read from storage anyway.
    """
    names = list(frames)
    for name in names:
        require_columns(frames[name], [key], name)
    frames = {n: frames[n] if stored else materialize(frames[n], f"source-{n}") for n in names}
    hot = hot_keys_of(frames, key, min_skew_rows, part_rows=part_rows)
    for i, name in enumerate(names):
        if hot[name]:
            frames[name] = draw_salt(frames[name], f"_salt_{name}", seed=i)
    merged, hot_merged = frames[names[0]], hot[names[0]]
    salts = [c for c in merged.columns if c.startswith("_salt_")]
    for name in names[1:]:
        right = frames[name]
        clashes = {c: f"{c}_{name}" for c in right.columns if c != key and c in merged.columns}
        right_salt = F.col(f"_salt_{name}") if hot[name] else None
        merged = skew_join(
            merged,
            right.withColumnsRenamed(clashes),
            key,
            hot_left=hot_merged,
            hot_right=hot[name],
            null_safe=null_safe,
            left_salt=F.xxhash64(*salts) if hot_merged else None,
            right_salt=right_salt,
        )
        # A key that was hot on either side is hot in the result.
        hot_merged = {
            k: hot_merged.get(k, 1) * hot[name].get(k, 1)
            for k in {**hot_merged, **hot[name]}
        }
        salts = [c for c in merged.columns if c.startswith("_salt_")]
    return merged.drop(*salts)


def merge_sql(tables: list[str], key: str, schema: str | None = None) -> str:
    """The merge as SQL text: the statement to run, to keep as a trace, or to hand to a database."""
    prefix = f"{schema}." if schema else ""
    joins = "\n".join(f"INNER JOIN {prefix}{t} USING ({key})" for t in tables[1:])
    return f"SELECT *\nFROM {prefix}{tables[0]}\n{joins}"


def check_merge(frames: Mapping[str, DataFrame], merged: DataFrame, key: str) -> DataFrame:
    """Refuse an empty source, a source without key and an empty result, each with its own message."""
    for name, df in frames.items():
        require_columns(df, [key], name)
        if df.isEmpty():
            raise InputError(f"{name}: the table is empty or could not be read")
    if merged.isEmpty():
        raise InputError("no row is left after the inner join of the sources")
    return merged
