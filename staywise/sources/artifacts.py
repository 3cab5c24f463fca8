"""Feature schema, model metadata and models, on any file system Spark can reach."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from staywise.config import Settings
from staywise.operators.features import FeatureSpec
from staywise.operators.selection import Selection
from staywise.values import DEFAULT_THRESHOLD

# Layout of the model metadata document.
METADATA_SCHEMA = """
    best_model string, best_threshold double, best_params string,
    metrics struct<f1 double, recall double, precision double, roc_auc double>,
    all_results array<struct<model string, best_threshold double, best_params string,
        metrics struct<f1 double, recall double, precision double, roc_auc double>>>,
    baseline struct<strategy string, majority_class int, f1 double, recall double, precision double,
        roc_auc double>,
    features struct<numerical array<string>, categorical array<string>>,
    target string
"""


def write_document(spark: SparkSession, document: Mapping, path: str) -> None:
    """A JSON document as a one-line text table: the same call for local and shared storage."""
    text = json.dumps(document, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))


def feature_schema(settings: Settings) -> dict:
    return {
        "target": settings.target,
        "col_id": settings.key,
        "numerical_features": list(settings.numeric),
        "categorical_features": list(settings.categorical),
        "satisfaction_features": list(settings.satisfaction),
        "generated_at": datetime.now(timezone.utc).replace(tzinfo=None).isoformat(),
    }


def model_metadata(
    selection: Selection,
    baseline: Mapping,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str,
    derivation: Mapping | None = None,
) -> dict:
    """What scoring needs of a trained model; ``derivation`` names the columns that features are derived from."""

    def figures(report: Mapping) -> dict:
        return {m: float(report[m]) for m in ("f1", "recall", "precision", "roc_auc")}

    best = next(r for r in selection.reports if r["model"] == selection.best.model)
    return {
        "best_model": selection.best.model,
        "best_threshold": float(selection.threshold),
        "best_params": selection.best.name,
        "metrics": figures(best),
        "all_results": [
            {
                "model": r["model"],
                "best_threshold": float(r["threshold"]),
                "best_params": r["params"],
                "metrics": figures(r),
            }
            for r in selection.reports
        ],
        "baseline": dict(baseline),
        "features": {"numerical": list(numeric), "categorical": list(categorical)},
        "target": target,
        "derivation": dict(derivation or {}),
    }


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The metadata document as a typed one-row table."""
    return spark.read.schema(METADATA_SCHEMA).json(path)


def threshold_of(metadata: Mapping) -> float:
    return float(metadata.get("best_threshold", DEFAULT_THRESHOLD))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_order(
    schema: Mapping | None = None, metadata: Mapping | None = None, fitted: Sequence[str] = ()
) -> list[str]:
    """Feature names in model order: from the schema, else from the metadata, else from the fitted model."""
    schema, features = schema or {}, (metadata or {}).get("features") or {}
    for numeric, categorical in (
        (schema.get("numerical_features"), schema.get("categorical_features")),
        (features.get("numerical"), features.get("categorical")),
    ):
        if numeric or categorical:
            return [*(numeric or []), *(categorical or [])]
    return list(fitted)


def input_features(order: Sequence[str], spec: FeatureSpec = FeatureSpec()) -> list[str]:
    """The features a person has to supply: all but the derived ones."""
    asked = [c for c in order if c not in spec.derived]
    return asked or list(order)
