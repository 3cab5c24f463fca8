"""Scoring with fixed coefficients, and explanation of the scores."""

from pyspark.sql import functions as F

from staywise.operators import explain, scoring
from staywise.plans.catalog.registry import query, table

WEIGHTS = {"l_quantity": 0.04, "l_discount": -9.0, "l_tax": 12.0, "l_extendedprice": 0.00001}
INTERCEPT = -1.2
THRESHOLD = 0.55
TERM_SQL = f"{INTERCEPT} + " + " + ".join(f"({w}) * {c}" for c, w in WEIGHTS.items())
ITEM_ID = "l_orderkey * 8 + l_linenumber"
PHI_SQL = ", ".join(
    f"(coalesce({c}, 0) - (SELECT avg({c}) FROM lineitem)) * ({w}) AS {c}" for c, w in WEIGHTS.items()
)
LONG_SQL = " UNION ALL ".join(f"SELECT id, '{c}' AS feature, {c} AS phi FROM p" for c in WEIGHTS)


def items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.expr(ITEM_ID).alias("id"), *WEIGHTS)


@query(
    "score_linear",
    f"""SELECT prediction, count(*) AS n, round(avg(p), 9) AS mean_score, round(min(p), 9) AS lowest, round(max(p), 9) AS highest
        FROM (SELECT p, cast(p >= {THRESHOLD} AS int) AS prediction FROM (
        SELECT 1 / (1 + exp(-({TERM_SQL}))) AS p FROM lineitem)) GROUP BY prediction""",
)
def score_linear(spark, sf_dir):
    scored = scoring.score_linear(items(spark, sf_dir), WEIGHTS, INTERCEPT, THRESHOLD)
    return scored.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("proba_depart"), 9).alias("mean_score"),
        F.round(F.min("proba_depart"), 9).alias("lowest"),
        F.round(F.max("proba_depart"), 9).alias("highest"),
    )


@query(
    "form_answer",
    f"""SELECT probability, decision, cast({THRESHOLD} AS double) AS threshold, count(*) AS n FROM (
        SELECT round(p, 4) AS probability, CASE WHEN p >= {THRESHOLD} THEN 'Risque de départ' ELSE 'Reste probable' END AS decision
        FROM (SELECT 1 / (1 + exp(-({TERM_SQL}))) AS p FROM lineitem)) GROUP BY ALL""",
)
def form_answer(spark, sf_dir):
    scored = scoring.score_linear(items(spark, sf_dir), WEIGHTS, INTERCEPT, THRESHOLD)
    answers = scoring.form_answer(scored, THRESHOLD)
    return answers.groupBy(*answers.columns).agg(F.count(F.lit(1)).alias("n"))


def contributions(spark, sf_dir):
    return explain.linear_contributions(items(spark, sf_dir), "id", WEIGHTS)


@query(
    "shap_linear",
    f"""WITH p AS (SELECT {ITEM_ID} AS id, {PHI_SQL} FROM lineitem)
        SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi FROM ({LONG_SQL}) GROUP BY feature""",
)
def shap_linear(spark, sf_dir):
    summary = explain.mean_abs_contribution(contributions(spark, sf_dir), list(WEIGHTS))
    return summary.withColumn("mean_abs_phi", F.round("mean_abs_phi", 6))


@query(
    "shap_topk",
    f"""WITH p AS (SELECT row_number() OVER () AS id, {PHI_SQL} FROM lineitem),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(phi) DESC, feature) - 1 AS pos FROM ({LONG_SQL})),
        t AS (SELECT id, cast(pos AS int) AS position, feature, phi FROM r WHERE pos < 2
            UNION ALL SELECT id, 2, 'other', sum(phi) FROM r WHERE pos >= 2 GROUP BY id)
        SELECT position, feature, count(*) AS n, round(sum(phi), 4) AS phi FROM t GROUP BY ALL""",
)
def shap_topk(spark, sf_dir):
    top = explain.top_contributions(contributions(spark, sf_dir), "id", list(WEIGHTS), 2)
    return top.groupBy("position", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("phi"), 4).alias("phi")
    )


@query(
    "explain_cases",
    f"""WITH p AS (SELECT {ITEM_ID} AS id, {PHI_SQL} FROM lineitem),
        s AS (SELECT id, round({' + '.join(f'abs({c})' for c in WEIGHTS)}, 9) AS impact FROM p),
        q AS (SELECT {ITEM_ID} AS id, round(1 / (1 + exp(-({TERM_SQL}))), 9) AS score FROM lineitem)
        SELECT 'highest_impact' AS "case", (SELECT id FROM s ORDER BY impact DESC, id LIMIT 1) AS id
        UNION ALL SELECT 'highest_score', (SELECT id FROM q ORDER BY score DESC, id LIMIT 1)
        UNION ALL SELECT 'lowest_score', (SELECT id FROM q ORDER BY score, id LIMIT 1)""",
)
def explain_cases(spark, sf_dir):
    scored = scoring.score_linear(items(spark, sf_dir), WEIGHTS, INTERCEPT, THRESHOLD)
    means = scored.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first().asDict()
    # The score of a row is a function of its own columns, so both figures come from one projection.
    impact = sum((F.abs((F.col(c) - means[c]) * w) for c, w in WEIGHTS.items()), F.lit(0.0))
    rows = scored.select("id", F.round(impact, 9).alias("impact"), F.round("proba_depart", 9).alias("score"))
    return explain.explain_cases(rows, "id", "impact", "score")
