"""Exact classification metrics from a score column.

Scores are counted per distinct value before anything is ordered, and the order is cut into buckets
(see ``ordering``), so neither ties nor the number of distinct scores ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.operators.ordering import ROWS_PER_BUCKET, order_splits, running_totals
from staywise.values import DEFAULT_THRESHOLD, F1_EPSILON


def _cumulated(df: DataFrame, score: str, label: str, rows_per_bucket: int) -> DataFrame:
    known = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    grouped = known.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")
    )
    splits = order_splits(known, score, rows_per_bucket)
    return running_totals(grouped, "threshold", ["n", "pos"], descending=True, splits=splits)


def pr_curve(
    df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Precision and recall at each distinct score, taken as threshold (score >= threshold is positive)."""
    return _cumulated(df, score, label, rows_per_bucket).select(
        "threshold",
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        F.try_divide(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )


def _best() -> Column:
    """Aggregate that picks the cumulated row with the highest F1, the lowest threshold on ties."""
    p, r = F.col("cum_pos") / F.col("cum_n"), F.try_divide(F.col("cum_pos"), F.col("total_pos"))
    f1 = 2 * p * r / (p + r + F1_EPSILON)
    row = F.struct("threshold", f1.alias("f1"), "cum_n", "cum_pos", "total_pos")
    return F.max_by(F.when(f1.isNotNull(), row), F.when(f1.isNotNull(), F.struct(f1, -F.col("threshold"))))


def _pair_share() -> Column:
    """Aggregate that sums the share of (positive, negative) pairs in order, ties counting half."""
    neg, total_neg = F.col("n") - F.col("pos"), F.col("total_n") - F.col("total_pos")
    above = F.col("cum_pos") - F.col("pos") / 2
    return F.sum(F.try_divide(neg, total_neg) * F.try_divide(above, F.col("total_pos")))


def best_threshold(
    df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """The threshold of the highest F1, the lowest one on ties; one half when there are no scores.

    Always one row: the pick is an aggregate, so it is combined on the map side.
    """
    picked = _cumulated(df, score, label, rows_per_bucket).agg(_best().alias("best"))
    return picked.select(
        F.coalesce(F.col("best.threshold"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.col("best.f1").alias("f1"),
    )


def roc_auc(
    df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs in order, ties counting half."""
    return _cumulated(df, score, label, rows_per_bucket).agg(_pair_share().alias("roc_auc"))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, decision: str, label: str) -> DataFrame:
    """tp, fp, fn and tn in one pass."""
    d, y = F.col(decision), F.col(label)
    return df.agg(
        F.count_if((d == 1) & (y == 1)).alias("tp"),
        F.count_if((d == 1) & (y == 0)).alias("fp"),
        F.count_if((d == 0) & (y == 1)).alias("fn"),
        F.count_if((d == 0) & (y == 0)).alias("tn"),
    )


def class_metrics(df: DataFrame, score: str, label: str, threshold: float | None = None) -> DataFrame:
    """Precision, recall and F1 of class 1; 0 where the divisor is 0.

    ``score`` is compared with ``threshold``, or is a 0/1 decision already when that is None.
    """
    decided = df
    if threshold is not None:
        decided = df.withColumn("_decision", (F.col(score) >= F.lit(threshold)).cast("int"))
    counts = confusion(decided, score if threshold is None else "_decision", label)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """The most frequent class, the lowest on ties."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max_by(label, F.struct("n", -F.col(label))).alias("majority_class"))


def dummy_baseline(df: DataFrame, label: str) -> DataFrame:
    """Metrics of always predicting the majority class; its AUC is one half by definition.

    All of it follows from one count per class.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(
        F.max_by(label, F.struct("n", -F.col(label))).alias("majority_class"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("n"))), F.lit(0)).alias("ones"),
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("n"))), F.lit(0)).alias("zeros"),
    )
    said = F.coalesce(F.col("majority_class") == 1, F.lit(False))
    tp, fp = F.when(said, F.col("ones")).otherwise(0), F.when(said, F.col("zeros")).otherwise(0)
    fn = F.when(said, 0).otherwise(F.col("ones"))
    return found.select(
        F.lit("most_frequent").alias("strategy"),
        "majority_class",
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _share(tp, tp + fn).alias("recall"),
        _share(tp, tp + fp).alias("precision"),
        F.lit(0.5).alias("roc_auc"),
    )


def model_report(
    df: DataFrame, score: str, label: str, name: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Best threshold of a scored table, with F1, recall, precision at it, and the AUC.

    The cumulated row of the threshold holds the counts that the metrics need, so one pass gives it all.
    """
    found = _cumulated(df, score, label, rows_per_bucket).agg(
        _best().alias("best"), _pair_share().alias("roc_auc")
    )
    tp, chosen, positive = (F.col(f"best.{c}") for c in ("cum_pos", "cum_n", "total_pos"))
    return found.select(
        F.lit(name).alias("model"),
        F.coalesce(F.col("best.threshold"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        _share(2 * tp, chosen + positive).alias("f1"),
        _share(tp, positive).alias("recall"),
        _share(tp, chosen).alias("precision"),
        "roc_auc",
    )


def select_best(reports: DataFrame, metric: str = "f1") -> DataFrame:
    """The report with the highest metric; the first model name on ties."""
    cells = F.struct(*reports.columns)
    order = F.struct(-F.col(metric), F.col("model"))
    return reports.agg(F.min_by(cells, order).alias("best")).select("best.*")
