"""Ranks, running totals and exact quantiles without a single-task window.

A window with ``orderBy`` over a whole table, or over one of two classes, sorts in one task. Here the order
is cut into buckets first, the totals of the few buckets are accumulated, and each bucket is
windowed on its own. Small inputs (by count) are one bucket; both ways give the same numbers. NaN is a value like any
other, the largest one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 16_384  # limits that are estimated at once; a bucket beyond its size is sorted with spilling
SAMPLED_PER_BUCKET = 500  # rows that a bucket limit is estimated from
PICK_BUCKETS = 1_024


def seeded_hash(seed: int | str, *ids: str | Column) -> Column:
    """Order-free pseudo-random text per row: md5 of the seed and the ids."""
    columns = [F.col(i) if isinstance(i, str) else i for i in ids]
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def hash_fraction(text: Column) -> Column:
    """First 32 bits of an md5 text as a number in [0, 1)."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_rank(
    df: DataFrame,
    id_col: str,
    seed: int | str,
    by: Sequence[str] = (),
    output: str = "rank",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """0-based position of each row in md5 order, inside each ``by`` group. ``id_col`` must be unique.

    Buckets are equal parts of the md5's range, which are uniform whatever the ids and groups look like.
    """
    by = list(by)
    keyed = df.withColumn("_hash", seeded_hash(seed, id_col))
    buckets = math.ceil(df.count() / rows_per_bucket)
    order = [F.col("_hash"), F.col(id_col)]
    if buckets <= 1:
        position = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
        return keyed.withColumn(output, position.cast("bigint")).drop("_hash")

    head = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    keyed = keyed.withColumn("_bucket", F.shiftright(head * F.lit(buckets).cast("bigint"), 32))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, "_bucket"]
    starts = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(k).alias(f"_s_{k}") for k in keys],
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        )
    )
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]  # a null group is a group
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    ranked = keyed.join(starts, same).withColumn(output, (inside + F.col("_start")).cast("bigint"))
    return ranked.select(*df.columns, output)


def order_splits(
    source: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> list[float]:
    """Bucket limits for ``running_totals``: approximate quantiles, empty when ``source`` is small.

    At most ``MAX_BUCKETS`` numbers come back. They need not be exact, since they only say where to cut.
    """
    return order_splits_of(source, [column], rows_per_bucket)[column]


def order_splits_of(
    source: DataFrame,
    columns: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
) -> dict[str, list[float]]:
    """Bucket limits of several columns, in one pass over these columns only.

    They are taken from a sample of bounded size, so the sketches that meet in the last task stay small.
    Give ``rows`` where the size of the table is known already.
    """
    needed = source.select(*columns)
    n = needed.count() if rows is None else rows
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket))
    if buckets <= 1:
        return {c: [] for c in columns}
    shares = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 10 * buckets)
    fraction = SAMPLED_PER_BUCKET * buckets / n
    sample = needed.sample(fraction, seed=11) if fraction < 1 else needed
    numbers = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    cuts = sample.agg(
        *[F.percentile_approx(x, shares, accuracy).alias(c) for c, x in numbers.items()]
    ).first()
    return {c: sorted(set(cuts[c] or [])) for c in columns}


def running_totals(
    grouped: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    splits: Sequence[float] = (),
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive) and ``total_<c>`` for each summed column, along ``order`` inside ``by``.

    ``grouped`` holds one row per (``by``, ``order``), both non-null, so that a value carried by a third
    of all rows is one row here. ``splits`` come from ``order_splits``.
    """
    by = list(by)
    direction = F.desc if descending else F.asc
    if not splits:
        running = (
            Window.partitionBy(*by).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
        )
        whole = Window.partitionBy(*by)
        return grouped.select(
            "*",
            *[F.sum(c).over(running).alias(f"cum_{c}") for c in sums],
            *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
        )

    limits = [float("-inf"), *splits, float("inf")]
    # what is no number has the last bucket to itself, as it comes last in the plain order
    cutter = Bucketizer(splits=limits, inputCol="_order", outputCol="_bucket", handleInvalid="keep")
    bucketed = cutter.transform(grouped.withColumn("_order", F.col(order).cast("double"))).drop("_order")
    before = (
        Window.partitionBy(*by).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*by)
    starts = (
        bucketed.groupBy(*by, "_bucket")
        .agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
        .select(
            *by,
            "_bucket",
            *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_start_{c}") for c in sums],
            *[F.sum(f"_s_{c}").over(whole).alias(f"total_{c}") for c in sums],
        )
    )
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        bucketed.join(starts, [*by, "_bucket"])
        .select(
            *grouped.columns,
            *[(F.sum(c).over(inside) + F.col(f"_start_{c}")).alias(f"cum_{c}") for c in sums],
            *[f"total_{c}" for c in sums],
        )
    )


def melt(df: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (``by``, feature, value) of numeric columns; null and NaN values are left out."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(f"_v_{c}") for c in values])
    long = wide.unpivot([*by], [f"_v_{c}" for c in values], "feature", "value")
    named = long.withColumn("feature", F.expr("substring(feature, 4)"))
    return named.where(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantiles(
    df: DataFrame,
    values: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact interpolated quantiles: one row per (``by``, feature) with ``quantiles`` array<double>, and ``n``.

    Rows are counted per bucket of a column's order first; the counts tell which buckets hold the asked positions,
    and only their values are shuffled, counted and ranked. That is a fixed number of passes for any number of columns:
    the size, the bucket limits (of a sample, for large tables), the counts, and the values. A small table is one
    bucket per column; the interpolation is the same expression for every size.
    """
    by, shares = list(by), [float(p) for p in probabilities]
    n = df.count()
    # Fine buckets, as only those that hold a position are looked into.
    size = min(rows_per_bucket, math.ceil(n / PICK_BUCKETS)) if n > rows_per_bucket else max(n, 1)
    long = _bucketed(df, values, by, order_splits_of(df, values, size, n))

    keys = [*by, "feature", "_bucket"]
    group = Window.partitionBy(*by, "feature")
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        long.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *keys,
            "n",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"),
            F.sum("n").over(group).alias("_total"),
        )
    )
    targets = [(F.col("_total") - 1) * F.lit(p) for p in shares]
    positions = [rounded(t) for t in targets for rounded in (F.floor, F.ceil)]
    asked = [(F.col("_start") <= at) & (at < F.col("_start") + F.col("n")) for at in positions]
    wanted = placed.where(reduce(or_, asked)).select(*keys, "_start", "_total")
    wanted = wanted.withColumnsRenamed({k: f"_w_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]
    counted = (
        long.join(wanted, same)
        .groupBy(*keys, "_start", "_total", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    inside = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_end", F.col("_start") + F.sum("n").over(inside))

    def value_at(position: Column) -> Column:
        holds = (F.col("_end") - F.col("n") <= position) & (position < F.col("_end"))
        return F.max(F.when(holds, F.col("value")))

    picked = ranked.groupBy(*by, "feature").agg(
        *[value_at(at).alias(f"_v{i}") for i, at in enumerate(positions)], F.max("_total").alias("_total")
    )
    interpolated = [
        F.col(f"_v{2 * i}") + (F.col(f"_v{2 * i + 1}") - F.col(f"_v{2 * i}")) * (t - F.floor(t))
        for i, t in enumerate(targets)
    ]
    return picked.select(
        *by, "feature", F.array(*interpolated).alias("quantiles"), F.col("_total").alias("n")
    )


def _bucketed(
    df: DataFrame, values: Sequence[str], by: list[str], splits: dict[str, list[float]]
) -> DataFrame:
    """(``by``, feature, value, _bucket) of numeric columns; null and NaN values are left out."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(f"_v_{c}") for c in values])
    cut = [c for c in values if splits[c]]
    if cut:
        cutter = Bucketizer(
            splitsArray=[[float("-inf"), *splits[c], float("inf")] for c in cut],
            inputCols=[f"_v_{c}" for c in cut],
            outputCols=[f"_b_{c}" for c in cut],
            handleInvalid="keep",
        )
        wide = cutter.transform(wide)
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_v_{c}").alias("value"),
            (F.col(f"_b_{c}") if splits[c] else F.lit(0.0)).alias("_bucket"),
        )
        for c in values
    ]
    long = wide.select(*by, F.inline(F.array(*cells)))
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))
