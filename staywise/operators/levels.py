"""Category levels as a distributed dictionary, for columns with more levels than a driver should hold.

``prep`` learns levels as a part of a model, which the driver holds. Here a level's index is its place among the sorted levels
of its column, counted by range-sorted parts and the sums of the parts before: the driver holds nothing, and no task sorts
more than its part. Rows get their indices by joins, and are encoded as the sparse form of a one-hot row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staywise.operators.prep import count_levels, level_text
from staywise.session import materialize


def index_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level, n, index): every level of the columns, its rows, and its place from 0 on in the order of its column."""
    counted = count_levels(level_text(df, columns), columns)
    ordered = counted.repartitionByRange("feature", "level").sortWithinPartitions("feature", "level")
    placed = materialize(ordered.withColumn("part", F.spark_partition_id()), "levels")
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("feature", "part").agg(F.count(F.lit(1)).alias("n"))  # a row per feature and part
    starts = sizes.select(F.col("feature").alias("_f"), F.col("part").alias("_p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("feature", "part").orderBy("level")) - 1
    found = placed.withColumn("_inside", inside).join(starts, (F.col("feature") == F.col("_f")) & (F.col("part") == F.col("_p")))
    return found.select("feature", "level", "n", (F.col("_start") + F.col("_inside")).cast("bigint").alias("index"))


def encode_levels(df: DataFrame, columns: Sequence[str], levels: DataFrame | None = None) -> DataFrame:
    """``df`` with ``positions``: where a one-hot row over all columns, in their order, holds a 1, ascending.

    A null or a level that is not in ``levels`` (from ``index_levels``, of other rows perhaps) holds none. ``width``, the
    length of the whole row, is the same in every row.
    """
    levels = materialize(index_levels(df, columns) if levels is None else levels, "level-index")
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    sizes = levels.groupBy("feature").agg(F.count(F.lit(1)).alias("size")).withColumn("_order", order)
    before = Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)  # over a row per column
    starts = sizes.select(F.col("feature").alias("_f"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_start"))
    placed = levels.join(F.broadcast(starts), F.col("feature") == F.col("_f"))
    placed = placed.select("feature", "level", (F.col("_start") + F.col("index")).alias("_position"))
    copies = df.withColumns({f"_text_{i}": F.col(f"`{c}`") for i, c in enumerate(columns)})
    given = level_text(copies, [f"_text_{i}" for i in range(len(columns))])

    def joined(rows: DataFrame, i: int) -> DataFrame:
        own = placed.where(F.col("feature") == columns[i]).select(F.col("level").alias(f"_level_{i}"), F.col("_position").alias(f"_at_{i}"))
        return rows.join(own, F.col(f"_text_{i}") == F.col(f"_level_{i}"), "left").drop(f"_level_{i}", f"_text_{i}")

    rows = reduce(joined, range(len(columns)), given)
    positions = F.array_compact(F.array(*[F.col(f"_at_{i}") for i in range(len(columns))]))
    width = levels.agg(F.count(F.lit(1)).alias("width"))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], positions.alias("positions"), width.scalar().alias("width"))

