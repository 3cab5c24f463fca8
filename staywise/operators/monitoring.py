"""The prediction log, and the reports on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.operators.ordering import ROWS_PER_BUCKET, exact_quantiles, order_splits, running_totals
from staywise.values import DECISION, KEY, PROBABILITY

# Layout of a line of a run log.
LOG_LINE = r"^(\d{4}-\d{2}-\d{2}) \d{2}:\d{2}:\d{2}[.,]?\d* \| (\w+) *\| (.*)$"


def payload_json(row: Column) -> Column:
    """An input row (a struct) as JSON text; null fields stay in it, accents stay as they are."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def build_log(
    scored: DataFrame,
    source: str,
    threshold: float,
    payload: Column,
    key: str = KEY,
) -> DataFrame:
    """Log rows of scored rows, without the two columns that the sink fills in.

    ``payload`` is the input row as a struct, carried along through scoring.
    """
    logged_key = F.col(key).try_cast("bigint") if key in scored.columns else F.lit(None).cast("bigint")
    return scored.select(
        logged_key.alias("id_employee"),
        F.lit(source).alias("source"),
        F.coalesce(F.col(PROBABILITY), F.lit(0.0)).alias("probability"),
        F.coalesce(F.col(DECISION), F.lit(0)).cast("int").alias("decision"),
        F.lit(float(threshold)).alias("threshold"),
        payload_json(payload).alias("payload"),
    )


def log_volume(log: DataFrame, source: str = "source") -> DataFrame:
    return log.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def score_histogram(log: DataFrame, score: str, threshold: str, bins: int = 10) -> DataFrame:
    """Rows per score bin, and how many of them reach their threshold; a score of 1 is in the last bin."""
    number = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return (
        log.where(F.col(score).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(score) >= F.col(threshold)).alias("n_above"),
        )
    )


def decision_trend(log: DataFrame, at: str, decision: str, every: str = "1 day") -> DataFrame:
    """Rows and share of positive decisions per period."""
    return log.groupBy(F.window(at, every).alias("_w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(decision).alias("rate")
    ).select(F.col("_w.start").alias("period"), "n", "rate")


def daily_usage(log: DataFrame, at: str, source: str, every: str = "1 day") -> DataFrame:
    """Rows per period and source."""
    return log.groupBy(F.window(at, every).alias("_w"), source).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.col("_w.start").alias("period"), source, "n")


def drill_down(log: DataFrame, attributes: Sequence[str], schema: str, decision: str) -> DataFrame:
    """Rows and positive rate per value of payload attributes, with subtotals.

    The payload is parsed for the asked attributes only. ``level`` is the grouping id: 0 is the finest.
    """
    parsed = log.withColumn("_p", F.from_json("payload", schema)).select(
        *[F.col(f"_p.{a}").cast("string").alias(a) for a in attributes], decision
    )
    return parsed.cube(*attributes).agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("n"),
        F.avg(decision).alias("rate"),
    )


def drift_psi(
    df: DataFrame,
    column: str,
    period: str,
    base: object,
    current: object,
    bins: int = 10,
    floor: float = 1e-6,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Population stability index between two periods, on quantile bins of the base period.

    Empty bins count as a share of ``floor``.
    """
    of_base = df.where(F.col(period) == F.lit(base))
    shares = [i / bins for i in range(1, bins)]
    row = exact_quantiles(of_base, [column], shares, rows_per_bucket=rows_per_bucket).first()
    edges = sorted(set(row["quantiles"])) if row else []
    number = F.lit(0)
    for edge in edges:
        number = number + (F.col(column) > F.lit(edge)).cast("int")
    counted = (
        df.where(F.col(period).isin(base, current) & F.col(column).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(
            F.count_if(F.col(period) == F.lit(base)).alias("n_base"),
            F.count_if(F.col(period) == F.lit(current)).alias("n_current"),
        )
    )
    return _psi(counted, column, floor)


def drift_psi_category(
    df: DataFrame, column: str, period: str, base: object, current: object, floor: float = 1e-6
) -> DataFrame:
    """The same index for a categorical column, one bin per category."""
    counted = (
        df.where(F.col(period).isin(base, current) & F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            F.count_if(F.col(period) == F.lit(base)).alias("n_base"),
            F.count_if(F.col(period) == F.lit(current)).alias("n_current"),
        )
    )
    return _psi(counted, column, floor)


def _psi(counted: DataFrame, column: str, floor: float) -> DataFrame:
    totals = counted.agg(F.struct(F.sum("n_base").alias("b"), F.sum("n_current").alias("c"))).scalar()
    base = F.greatest(F.try_divide(F.col("n_base"), totals["b"]), F.lit(floor))
    current = F.greatest(F.try_divide(F.col("n_current"), totals["c"]), F.lit(floor))
    return counted.agg(
        F.lit(column).alias("feature"),
        F.count(F.lit(1)).alias("n_bins"),
        F.sum((current - base) * F.ln(current / base)).alias("psi"),
    )


def drift_ks(
    df: DataFrame,
    column: str,
    period: str,
    base: object,
    current: object,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Kolmogorov-Smirnov distance between two periods: the largest gap of the two running shares."""
    both = df.where(F.col(period).isin(base, current) & F.col(column).isNotNull())
    counted = both.groupBy(F.col(column).cast("double").alias("value")).agg(
        F.count_if(F.col(period) == F.lit(base)).alias("b"),
        F.count_if(F.col(period) == F.lit(current)).alias("c"),
    )
    cumulated = running_totals(
        counted, "value", ["b", "c"], splits=order_splits(both, column, rows_per_bucket)
    )
    gap = F.abs(
        F.try_divide(F.col("cum_b"), F.col("total_b")) - F.try_divide(F.col("cum_c"), F.col("total_c"))
    )
    return cumulated.agg(
        F.lit(column).alias("feature"),
        F.max("total_b").alias("n_base"),
        F.max("total_c").alias("n_current"),
        F.max(gap).alias("ks"),
    )


def latency(
    log: DataFrame,
    requested_at: str,
    created_at: str,
    probabilities: Sequence[float] = (0.5, 0.95, 0.99),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Quantiles of the seconds between request and log entry, as one row."""
    seconds = (
        F.unix_micros(F.col(created_at)) - F.unix_micros(F.col(requested_at))
    ) / F.lit(1e6)
    timed = log.select(seconds.alias("seconds"))
    found = exact_quantiles(timed, ["seconds"], probabilities, rows_per_bucket=rows_per_bucket)
    return found.select(
        "n", *[F.col("quantiles")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probabilities)]
    )


def parse_log_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Day, level and message of the lines that have the layout of a run log."""
    c = F.col(column)
    return lines.where(c.rlike(LOG_LINE)).select(
        F.regexp_extract(c, LOG_LINE, 1).alias("day"),
        F.regexp_extract(c, LOG_LINE, 2).alias("level"),
        F.regexp_extract(c, LOG_LINE, 3).alias("message"),
    )


def error_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines per day and level."""
    return parse_log_lines(lines, column).groupBy("day", "level").agg(F.count(F.lit(1)).alias("n"))
