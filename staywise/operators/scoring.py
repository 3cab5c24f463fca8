"""Scoring: align the columns, apply the model, decide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from staywise.operators.cleaning import align_features
from staywise.operators.prep import level_text
from staywise.values import DECISION, DECISION_TEXT, PROBABILITY


def decide(df: DataFrame, threshold: float, score: str = PROBABILITY, output: str = DECISION) -> DataFrame:
    """1 from the threshold on, else 0."""
    return df.withColumn(output, (F.col(score) >= F.lit(threshold)).cast("int"))


def decision_text(decision: Column) -> Column:
    return F.when(decision == 1, DECISION_TEXT[1]).otherwise(DECISION_TEXT[0])


def run_inference(
    df: DataFrame,
    model: Transformer,
    threshold: float,
    features: Mapping[str, DataType | str],
    drop: Sequence[str] = (),
) -> DataFrame:
    """All input columns, plus probability of class 1 and decision.

    The input row travels as one struct past the model, which sees exactly the expected columns; so no join
    is needed afterwards and no column of the input can clash with one of the model. Scores of an earlier run
    are replaced.
    """
    fresh = df.drop(PROBABILITY, DECISION)
    carried = fresh.withColumn("_input", F.struct(*fresh.columns)).drop(*drop)
    aligned = align_features(carried, {**features, "_input": "string"})
    text = [c for c, t in features.items() if t in ("string",)]
    scored = model.transform(level_text(aligned, text))
    with_score = scored.select("_input.*", vector_to_array("probability")[1].alias(PROBABILITY))
    return decide(with_score, threshold)


def linear_term(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Intercept plus weighted sum of columns; null when any of them is."""
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def logistic(term: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-term))


def score_linear(
    df: DataFrame, weights: Mapping[str, float], intercept: float, threshold: float
) -> DataFrame:
    """Logistic score from fixed coefficients as a plain expression, with the decision."""
    scored = df.withColumn(PROBABILITY, logistic(linear_term(weights, intercept)))
    return decide(scored, threshold)


def form_answer(scored: DataFrame, threshold: float) -> DataFrame:
    """Rounded probability, decision in words and threshold, as shown to a person."""
    return scored.select(
        F.round(PROBABILITY, 4).alias("probability"),
        decision_text(F.col(DECISION)).alias("decision"),
        F.lit(threshold).alias("threshold"),
    )
