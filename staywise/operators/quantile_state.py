"""Quantiles and drift from a stored state instead of from the log: counts of logarithmic bins per period and column.

A bin holds the values between two powers of (1 + accuracy) / (1 - accuracy), so any value stands for its bin with a
relative error of ``accuracy`` at most. States of periods add up, hence any two periods are compared without reading
the log again. A column has no more bins than the range of doubles has powers (some 75,000 of either sign at 1 %,
a few hundred in practice), whatever the number of rows.

Nulls and NaN are not counted; zero has a bin of its own; infinities lie in the outermost bins. Equal values are one
row after the map-side combine, so a value that a third of all rows hold is no hot key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staywise.operators.ordering import melt

ACCURACY = 0.01
#: Added to the power, so that the sign of a bin is the sign of its values.
OFFSET = 1 << 40
STATE = "feature string, bin bigint, n bigint"


def log_base(accuracy: float = ACCURACY) -> float:
    """Logarithm of the ratio between the limits of a bin."""
    return math.log((1 + accuracy) / (1 - accuracy))


def bin_of(value: str | Column, accuracy: float = ACCURACY) -> Column:
    """Number of a value's bin; larger values have no smaller number."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    power = F.ln(F.abs(v)) / F.lit(log_base(accuracy))
    power = F.greatest(F.least(power, F.lit(float(OFFSET - 1))), F.lit(float(1 - OFFSET)))
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("bigint") * (F.ceil(power) + F.lit(OFFSET)))


def bin_value(number: str | Column, accuracy: float = ACCURACY) -> Column:
    """The value that is within ``accuracy`` of every value of the bin."""
    b = F.col(number) if isinstance(number, str) else number
    ratio = math.exp(log_base(accuracy))
    size = F.exp((F.abs(b) - F.lit(OFFSET)) * F.lit(log_base(accuracy))) * F.lit(2 / (ratio + 1))
    return F.when(b == 0, F.lit(0.0)).otherwise(F.signum(b.cast("double")) * size)


def bin_counts(df: DataFrame, values: Sequence[str], period: str, accuracy: float = ACCURACY) -> DataFrame:
    """(period, feature, bin, n): rows per period, column and bin, in one scan."""
    counted = melt(df, values, [period]).groupBy(F.col(period).alias("period"), "feature", bin_of("value", accuracy).alias("bin"))
    return counted.agg(F.count(F.lit(1)).alias("n"))


def store_state(counts: DataFrame, path: str) -> None:
    """Put the periods of ``counts`` in place of those with the same name at ``path``; others stay.

    A period that is written again changes nothing, so a failed run is simply repeated. A period must be complete:
    what arrives later for it needs the whole period again.
    """
    one_file = counts.select(*[c for c in counts.columns if c != "period"], "period").repartition("period")
    writer = one_file.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("period").parquet(path)


def state_between(spark: SparkSession, path: str, first: object, last: object, kind: str = "date") -> DataFrame:
    """(feature, bin, n) summed up over the periods from ``first`` to ``last``; no other folder is read."""
    stored = spark.read.schema(f"{STATE}, period {kind}").parquet(path)
    chosen = stored.where(F.col("period").between(F.lit(first).cast(kind), F.lit(last).cast(kind)))
    return chosen.groupBy("feature", "bin").agg(F.sum("n").alias("n"))


def _bins_at(state: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(feature, n, bins): per column the bin of the value with the rank floor(p * (n - 1)), for each p.

    The window runs over the bins of a column, whose number has a bound.
    """
    upto = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("feature")
    cumulated = state.select("feature", "bin", F.sum("n").over(upto).alias("cum"), F.sum("n").over(whole).alias("total"))
    reached = [F.min(F.when(F.col("cum") > F.floor((F.col("total") - 1) * F.lit(p)), F.col("bin"))) for p in probabilities]
    return cumulated.groupBy("feature").agg(F.max("total").alias("n"), F.array(*reached).alias("bins"))


def state_quantiles(state: DataFrame, probabilities: Sequence[float], accuracy: float = ACCURACY) -> DataFrame:
    """(feature, n, quantiles): each within ``accuracy`` of the value that has the rank floor(p * (n - 1))."""
    found = _bins_at(state, probabilities)
    return found.select("feature", "n", F.transform("bins", lambda b: bin_value(b, accuracy)).alias("quantiles"))


def drift_from_states(base: DataFrame, current: DataFrame, bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """(feature, n_bins, psi): stability index of all columns between two states, on quantile bins of ``base``.

    The limits are those of logarithmic bins, hence within the accuracy of the quantiles, and the counts between them
    are exact. Empty bins count as a share of ``floor``. Columns without a row in one of the states are left out.
    """
    edges = _bins_at(base, [i / bins for i in range(1, bins)]).select("feature", F.array_distinct("bins").alias("edges"))
    both = base.select("*", F.lit(True).alias("old")).unionByName(current.select("*", F.lit(False).alias("old")))
    number = F.size(F.filter("edges", lambda e: e < F.col("bin")))
    rows = both.join(edges, "feature").groupBy("feature", number.alias("number"))
    counted = rows.agg(F.sum(F.when(F.col("old"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(F.col("old"), 0).otherwise(F.col("n"))).alias("c"))
    whole = Window.partitionBy("feature")  # at most ``bins`` rows
    share_b = F.greatest(F.try_divide("b", F.sum("b").over(whole)), F.lit(floor))
    share_c = F.greatest(F.try_divide("c", F.sum("c").over(whole)), F.lit(floor))
    shares = counted.select("feature", share_b.alias("b"), share_c.alias("c"), F.sum("c").over(whole).alias("rows"))
    psi = F.sum((F.col("c") - F.col("b")) * F.ln(F.col("c") / F.col("b")))
    return shares.where("rows > 0").groupBy("feature").agg(F.count(F.lit(1)).alias("n_bins"), psi.alias("psi"))
