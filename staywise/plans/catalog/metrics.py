"""Classification metrics on a score column of the events."""

from pyspark.sql import functions as F

from staywise.operators import metrics
from staywise.plans.catalog.registry import SCORED_SQL, query, scored_events

CURVE_SQL = f"""SELECT score AS threshold, sum(pos) OVER w / sum(n) OVER w AS precision,
    sum(pos) OVER w / sum(pos) OVER () AS recall
    FROM (SELECT score, count(*) AS n, sum(label) AS pos FROM ({SCORED_SQL}) GROUP BY score)
    WINDOW w AS (ORDER BY score DESC)"""
F1_SQL = f"SELECT threshold, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM ({CURVE_SQL})"
BEST_SQL = f"SELECT threshold, f1 FROM ({F1_SQL}) ORDER BY f1 DESC, threshold LIMIT 1"
AUC_SQL = f"""SELECT sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
    SELECT pos, n - pos AS neg, coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0) AS above
    FROM (SELECT score, count(*) AS n, sum(label) AS pos FROM ({SCORED_SQL}) GROUP BY score))"""


def class_metrics_sql(source: str, condition: str) -> str:
    return f"""SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM (SELECT
        count(*) FILTER ({condition} AND label = 1) AS tp, count(*) FILTER ({condition} AND label = 0) AS fp,
        count(*) FILTER (NOT ({condition}) AND label = 1) AS fn,
        count(*) FILTER (NOT ({condition}) AND label = 0) AS tn FROM {source})"""


@query("pr_curve", f"SELECT threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM ({CURVE_SQL})")
def pr_curve(spark, sf_dir):
    curve = metrics.pr_curve(scored_events(spark, sf_dir), "score", "label")
    return curve.withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@query("best_threshold", f"SELECT threshold, round(f1, 9) AS f1 FROM ({BEST_SQL})")
def best_threshold(spark, sf_dir):
    best = metrics.best_threshold(scored_events(spark, sf_dir), "score", "label")
    return best.withColumn("f1", F.round("f1", 9))


@query("roc_auc", f"SELECT round(roc_auc, 9) AS roc_auc FROM ({AUC_SQL})")
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(scored_events(spark, sf_dir), "score", "label").select(
        F.round("roc_auc", 9).alias("roc_auc")
    )


@query(
    "class_metrics",
    f"""SELECT tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1
        FROM ({class_metrics_sql(f"({SCORED_SQL})", "score >= 0.5")})""",
)
def class_metrics(spark, sf_dir):
    found = metrics.class_metrics(scored_events(spark, sf_dir), "score", "label", 0.5)
    return found.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(
    "dummy_baseline",
    f"""WITH m AS (SELECT label AS majority FROM ({SCORED_SQL}) GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
        SELECT 'most_frequent' AS strategy, majority AS majority_class, f1, recall, precision,
        cast(0.5 AS double) AS roc_auc
        FROM ({class_metrics_sql(f"({SCORED_SQL}), m", "majority = 1")}), m""",
)
def dummy_baseline(spark, sf_dir):
    return metrics.dummy_baseline(scored_events(spark, sf_dir), "label")


REPORT_SQL = f"""SELECT 'events' AS model, threshold, c.f1, c.recall, c.precision, a.roc_auc
    FROM ({BEST_SQL}) b, ({AUC_SQL}) a,
    ({class_metrics_sql(f"({SCORED_SQL}), (SELECT threshold FROM ({BEST_SQL}))", "score >= threshold")}) c"""
_FIGURES = ("f1", "recall", "precision", "roc_auc")


@query(
    "model_report",
    f"SELECT model, threshold, {', '.join(f'round({c}, 9) AS {c}' for c in _FIGURES)} FROM ({REPORT_SQL})",
)
def model_report(spark, sf_dir):
    report = metrics.model_report(scored_events(spark, sf_dir), "score", "label", "events")
    return report.withColumns({c: F.round(c, 9) for c in _FIGURES})


@query(
    "select_best",
    f"""SELECT model, round(f1, 9) AS f1 FROM (
        SELECT 'half' AS model, f1 FROM ({class_metrics_sql(f"({SCORED_SQL})", "score >= 0.5")})
        UNION ALL SELECT 'third', f1 FROM ({class_metrics_sql(f"({SCORED_SQL})", "score >= 0.3")})
        UNION ALL SELECT 'all', f1 FROM ({class_metrics_sql(f"({SCORED_SQL})", "score >= 0.0")}))
        ORDER BY f1 DESC, model LIMIT 1""",
)
def select_best(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    reports = None
    for name, threshold in (("half", 0.5), ("third", 0.3), ("all", 0.0)):
        row = metrics.class_metrics(scored, "score", "label", threshold).select(
            F.lit(name).alias("model"), F.round("f1", 9).alias("f1")
        )
        reports = row if reports is None else reports.unionByName(row)
    return metrics.select_best(reports)
