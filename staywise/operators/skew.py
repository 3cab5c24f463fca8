"""Joins that stay balanced when one key holds a large share of the rows.

Hot keys are counted over all rows by mergeable counters: each task keeps some counters and takes from all of them alike
when they run out, so a key's count is too low by a known bound in rows, however many keys there are. What is found
only decides how rows are spread: the result of a salted join is the same as that of the plain one, with
all its rows, for any choice of hot keys.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MIN_ROWS = 5_000_000  # below this a plain join needs no help
PART_ROWS = 2_000_000  # rows of a hot key that one task gets
LEAST_PART = 10
LEAST_COUNTERS = 1_000  # of a task
MOST_COUNTERS = 1_000_000

HotKeys = Mapping[object, int]


def hot_keys(
    df: DataFrame,
    key: str,
    min_rows: int = MIN_ROWS,
    share: float = 0.0,
    rows: int | None = None,
    part_rows: int | None = None,
) -> dict[object, int]:
    """Hot keys of ``df`` with the number of parts each is to be split into; null is a key too.

    A part has some ``part_rows`` rows, whatever the size of the table, and every key with more rows than that is found. No
    more than 2 x rows / ``part_rows`` keys reach the driver. Keys below a ``share`` of the rows can be left whole. Give
    ``rows`` where the size of the table is known already.
    """
    n = df.count() if rows is None else rows
    part_rows = part_rows or _part_rows(min_rows)
    return _counted_hot_keys(df, key, n, share, part_rows) if n >= max(min_rows, 1) else {}


def hot_keys_of(
    frames: Mapping[str, DataFrame],
    key: str,
    min_rows: int = MIN_ROWS,
    share: float = 0.0,
    part_rows: int | None = None,
) -> dict[str, dict[object, int]]:
    """Hot keys of several tables that share a key column.

    One count over all of them rules out tables below ``min_rows``.
    """
    named = [df.select(F.lit(name).alias("_name")) for name, df in frames.items()]
    sizes = reduce(DataFrame.unionAll, named).groupBy("_name").agg(F.count(F.lit(1)).alias("n"))
    rows = {r["_name"]: r["n"] for r in sizes.collect()}
    part_rows = part_rows or _part_rows(min_rows)
    hot: dict[str, dict[object, int]] = {}
    for name, df in frames.items():
        n = rows.get(name, 0)
        hot[name] = _counted_hot_keys(df, key, n, share, part_rows) if n >= max(min_rows, 1) else {}
    return hot


def _part_rows(min_rows: int) -> int:
    """A part is never larger than a table that needs no help."""
    return max(LEAST_PART, min(PART_ROWS, min_rows))


def _kept_counts(counters: int):
    """(key, n) of each task's most frequent keys: too low by 1 / ``counters`` of its rows at most."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            found = pc.value_counts(batch.column(0))
            for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                held[value] += n
            if len(held) > 2 * counters:
                # what the first key beyond the counters has is taken from all
                less = sorted(held.values(), reverse=True)[counters]
                held = Counter({k: n - less for k, n in held.items() if n > less})
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(list(held.values()), pa.int64())], ["key", "n"])

    return rows


def heavy_keys(df: DataFrame, key: str, rows: int, least: int) -> DataFrame:
    """(key, n) of all keys with ``least`` or more of the ``rows`` rows, and some with half of that; n is too low by half of ``least`` at most."""
    counters = min(MOST_COUNTERS, max(LEAST_COUNTERS, math.ceil(2 * rows / least)))
    schema = StructType([StructField("key", df.schema[key].dataType), StructField("n", LongType())])
    counted = df.select(key).mapInArrow(_kept_counts(counters), schema).groupBy("key").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= max(1, least - math.ceil(rows / counters)))


def _counted_hot_keys(
    df: DataFrame, key: str, rows: int, share: float, part_rows: int
) -> dict[object, int]:
    least = max(part_rows, math.ceil(rows * share), 1)
    found = heavy_keys(df, key, rows, least).collect()
    parts = {r["key"]: math.ceil(r["n"] / part_rows) for r in sorted(found, key=lambda r: -r["n"])}
    return {value: n for value, n in parts.items() if n > 1}


def _parts(key: Column, hot: HotKeys) -> Column:
    """Number of parts for a key: a CASE over the hot keys, hottest first, for those of the rows that have one."""
    if not hot:
        return F.lit(1)
    cases = F
    for value, n in hot.items():
        cases = cases.when(key.isNull() if value is None else key == F.lit(value), F.lit(n))
    known = [v for v in hot if v is not None]
    is_hot = key.isin(known) if known else F.lit(False)
    if None in hot:
        is_hot = is_hot | key.isNull()
    return F.when(is_hot, cases.otherwise(F.lit(1))).otherwise(F.lit(1))


def draw_salt(df: DataFrame, column: str = "_salt", seed: int = 7) -> DataFrame:
    """Add a random bigint per row. Call it right above a scan (or a written table): rows then come in the
    same order when a task is run again, and so do their salts.
    """
    return df.withColumn(column, F.floor(F.rand(seed) * F.lit(2**40)).cast("bigint"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
    null_safe: bool = False,
    left_salt: Column | None = None,
    right_salt: Column | None = None,
) -> DataFrame:
    """Equi-join on ``key``; rows of a hot key are spread over parts, the other side is repeated per part.

    Without hot keys this is the plain join, left to the optimiser. ``how`` is inner, left or left_semi;
    for the last two only the left side may be hot. The salts are bigint columns that differ between the
    rows of one key and come out the same when a task is run again: see ``draw_salt``, or hash a unique id.
    """
    hot_left, hot_right = dict(hot_left or {}), dict(hot_right or {})
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    if how != "inner":
        hot_right = {}
    if not null_safe:
        # Null keys never match: they need no copies on the other side, and an inner join drops them.
        hot_right.pop(None, None)
    if not hot_left and not hot_right:
        return _join(left, right, [key], how, null_safe)

    if (hot_left and left_salt is None) or (hot_right and right_salt is None):
        raise ValueError("a side with hot keys needs a salt")
    left_parts, right_parts = _parts(F.col(key), hot_left), _parts(F.col(key), hot_right)
    salted_left = left.withColumn("_part_l", _part_of(left_salt, left_parts)).withColumn(
        "_part_r", F.explode(F.sequence(F.lit(0), right_parts - 1))
    )
    salted_right = right.withColumn("_part_r", _part_of(right_salt, right_parts)).withColumn(
        "_part_l", F.explode(F.sequence(F.lit(0), left_parts - 1))
    )
    joined = _join(salted_left, salted_right, [key, "_part_l", "_part_r"], how, null_safe)
    return joined.drop("_part_l", "_part_r")


def _part_of(salt: Column | None, parts: Column) -> Column:
    return F.lit(0) if salt is None else F.pmod(salt, parts).cast("int")


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])
