"""The workflow from raw files to a logged prediction, as functions to call in order."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise import values
from staywise.config import Settings
from staywise.operators import explain, metrics
from staywise.operators.cleaning import (
    feature_columns,
    normalize_target,
    prepare_source,
    require_columns,
)
from staywise.operators.features import FeatureSpec, derive_features
from staywise.operators.forest import ForestModel
from staywise.operators.merging import check_merge, id_diagnostics, merge_sources
from staywise.operators.monitoring import build_log
from staywise.operators.prep import Preparation
from staywise.operators.quality import domain_checks
from staywise.operators.scoring import form_answer, run_inference
from staywise.operators.selection import (
    Candidate,
    Selection,
    TrainingTable,
    fit_final,
    seeded_sample,
    select_model,
)
from staywise.operators.tree_shap import forest_contributions
from staywise.session import materialize
from staywise.sources import artifacts, csv, tables

log = logging.getLogger(__name__)

SOURCE_KEYS = {"sirh": None, "evaluation": values.EVALUATION_KEY, "sond": values.SURVEY_KEY}


def read_sources(spark: SparkSession, settings: Settings, strict: bool = False) -> dict[str, DataFrame]:
    """The three raw sources, cleaned and keyed."""
    found = {}
    for name, path in settings.raw_paths.items():
        raw = csv.read_supplied_csv(spark, path, name) if strict else csv.safe_read_csv(spark, path)
        found[name] = prepare_source(raw, settings.key, SOURCE_KEYS[name])
    return found


def build_dataset(spark: SparkSession, settings: Settings) -> DataFrame:
    """Raw files to merged table.

    The cleaned sources are written to the shared folder first: text files are then parsed once, and the
    look for hot keys reads one Parquet column.
    """
    frames = read_sources(spark, settings)
    for name, df in frames.items():
        require_columns(df, [settings.key], name)
    staged = {name: materialize(df, f"staged-{name}") for name, df in frames.items()}
    for row in id_diagnostics(staged, settings.key).collect():
        log.info("%s: %s rows, %s distinct keys, %s duplicates", *row)
    return merge_sources(staged, settings.key, stored=True)


def merge_tables(spark: SparkSession, settings: Settings, database: str) -> DataFrame:
    """The same from the typed tables, by the SQL statement that is kept as a trace."""
    names = list(settings.raw_paths)
    return tables.run_merge_statement(spark, names, settings.key, database, settings.sql_file)


def feature_spec(settings: Settings) -> FeatureSpec:
    """The derivation that the settings name; training and scoring share it."""
    return FeatureSpec.of(settings.numeric, settings.satisfaction)


def build_features(merged: DataFrame, settings: Settings) -> DataFrame:
    """Merged table to feature table with a 0/1 target."""
    return derive_features(normalize_target(merged, settings.target), feature_spec(settings))


def domain_faults(features: DataFrame) -> dict[str, int]:
    """Rows with a value outside its stated domain, per column that has any; one pass, and a line in the log each."""
    rules = {**values.CATEGORY_DOMAINS, **{c: values.SCORE_RANGE for c in values.SCORE_COLUMNS}}
    present = {c: rule for c, rule in rules.items() if c in features.columns}
    if not present:
        return {}
    faults = {r["column"]: r["n_bad"] for r in domain_checks(features, present).collect() if r["n_bad"]}
    for column, n in faults.items():
        log.warning("%s: %s rows outside the stated domain", column, n)
    return faults


def initialize_tables(
    spark: SparkSession, settings: Settings, database: str, location: str | None = None
) -> None:
    """Declare the typed tables and load the cleaned sources."""
    frames = read_sources(spark, settings, strict=True)
    tables.load_sources(spark, frames, database, location)


def training_table(features: DataFrame, settings: Settings) -> TrainingTable:
    """Feature table with the declared columns that are present."""
    exclude = [settings.target, settings.key]
    numeric, categorical = feature_columns(features, settings.numeric, settings.categorical, exclude)
    return TrainingTable(
        features,
        settings.key,
        settings.target,
        numeric,
        categorical,
        settings.random_state,
        fit_fraction=settings.fit_fraction,
    )


def train(
    table: TrainingTable,
    candidates: Sequence[Candidate] | None = None,
    folds: int = values.FOLDS,
    spec: FeatureSpec = FeatureSpec(),
) -> tuple[Transformer, Selection, dict, Preparation]:
    """Search, final fit, metadata, and the preparation of the final fit."""
    selection = select_model(table, candidates, folds)
    baseline = metrics.dummy_baseline(table.df, table.label).first().asDict()
    log.info("baseline %s", baseline)
    model, prep = fit_final(table, selection.best)
    metadata = artifacts.model_metadata(
        selection,
        baseline,
        [p.name for p in prep.numeric],
        [p.name for p in prep.categorical],
        table.label,
        {"numerical": list(spec.numeric), "mean_of": list(spec.mean_of)},
    )
    return model, selection, metadata, prep


def explain_model(
    table: TrainingTable, model: Transformer, prep: Preparation, rows: int = values.EXPLAIN_SAMPLE
) -> tuple[DataFrame, DataFrame]:
    """Contributions of the saved model on a seeded sample, and their mean size per feature.

    ``prep`` is the preparation that the model was fitted with. Exact for a linear classifier and for a forest, sampled
    permutations for any other.
    """
    encoded = table.encode(table.df, prep)
    names, classifier = prep.feature_names, model.stages[-1]
    if hasattr(classifier, "coefficients"):
        sample = seeded_sample(encoded, table.id_col, rows, table.seed)
        found = sample.agg(*[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(len(names))]).first()
        means = [found[f"m{i}"] for i in range(len(names))]
        weights = classifier.coefficients.toArray().tolist()
        parts = explain.vector_contributions(sample, table.id_col, "vec", names, weights, means)
    elif isinstance(classifier, ForestModel):
        sample = seeded_sample(encoded, table.id_col, rows, table.seed)
        parts = forest_contributions(sample, table.id_col, "vec", names, classifier.forest)
    else:
        parts = explain.sampled_shapley(encoded, table.id_col, "vec", names, classifier, rows=rows)
    return parts, explain.mean_abs_contribution(parts, names)


def local_explanations(
    parts: DataFrame, scored: DataFrame, key: str, features: Sequence[str], k: int = values.TOP_FEATURES
) -> DataFrame:
    """The largest contributions of the three rows worth a look: (case, key, position, feature, phi).

    ``parts`` come from ``explain_model``, ``scored`` has the key and the probability.
    """
    judged = explain.total_impact(parts).join(scored.select(key, values.PROBABILITY), key)
    cases = explain.explain_cases(judged, key, "impact", values.PROBABILITY)
    chosen = parts.join(F.broadcast(cases.select(key)), key, "left_semi")  # three rows at most
    top = explain.top_contributions(chosen, key, features, k)
    return cases.join(top, key).select("case", key, "position", "feature", "phi")


class Scorer:
    """A loaded model with its threshold, features and derivation; every route scores through it.

    With ``database`` each route appends its log rows to the log table there. A log that cannot be written is
    reported and does not keep the scores back.
    """

    def __init__(
        self,
        model: Transformer,
        metadata: Mapping,
        key: str = values.KEY,
        spec: FeatureSpec | None = None,
        database: str | None = None,
    ):
        features = metadata["features"]
        named = metadata.get("derivation") or {}
        if spec is None:
            spec = FeatureSpec.of(named["numerical"], named["mean_of"]) if named else FeatureSpec()
        self.database = database
        self.model = model
        self.threshold = artifacts.threshold_of(metadata)
        self.target = metadata.get("target")
        self.key = key
        self.spec = spec
        self.features = {c: "double" for c in features.get("numerical") or []}
        self.features.update({c: "string" for c in features.get("categorical") or []})

    def score_features(self, df: DataFrame) -> DataFrame:
        """Score a table that has the derived features already."""
        drop = [self.target] if self.target else []
        return run_inference(df, self.model, self.threshold, self.features, drop)

    def score(self, raw: DataFrame) -> DataFrame:
        """Derive, then score."""
        return self.score_features(derive_features(raw, self.spec))

    def score_rows(
        self, spark: SparkSession, rows: object, headers: Sequence[str] = ()
    ) -> tuple[DataFrame, DataFrame]:
        return self._both(csv.rows_to_table(spark, rows, headers), "interactive_table")

    def score_csv(self, spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
        return self._both(csv.read_supplied_csv(spark, path, "CSV"), "csv_file")

    def score_raw_files(self, spark: SparkSession, paths: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
        """Merge the three raw files, then score; an empty source or merge is refused.

        The files are parsed once and the join runs once: both are written before they are looked at.
        """
        frames = {
            name: prepare_source(csv.read_supplied_csv(spark, paths.get(name), name), self.key, source_key)
            for name, source_key in SOURCE_KEYS.items()
        }
        merged = materialize(merge_sources(frames, self.key), "merged")
        return self._both(check_merge(frames, merged, self.key), "raw_files")

    def score_form(
        self, spark: SparkSession, features: Sequence[str], entered: Sequence[object]
    ) -> tuple[DataFrame, DataFrame]:
        """Answer for one filled-in form, and its log row."""
        scored, entry = self._both(csv.form_to_table(spark, features, entered), "form")
        return form_answer(scored, self.threshold), entry

    def _both(self, raw: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
        """Scored rows and log rows, from one run of the model; the payload is the raw row, carried along."""
        raw = raw.drop(values.PROBABILITY, values.DECISION)
        scored = materialize(self.score(raw.withColumn("_raw", F.struct(*raw.columns))), "scored")
        entries = build_log(scored, source, self.threshold, F.col("_raw"), self.key)
        if self.database:
            try:
                tables.append_log(entries, self.database)
            except (PySparkException, Py4JJavaError) as error:
                log.error("the log rows of %s could not be written: %s", source, error)
        return scored.drop("_raw"), entries


def run(
    spark: SparkSession,
    settings: Settings,
    output: str,
    database: str | None = None,
    candidates: Sequence[Candidate] | None = None,
) -> dict | None:
    """All stages below ``output``; skipped when a raw file is missing. Returns the model metadata."""
    if csv.missing_paths(spark, list(settings.raw_paths.values())):
        log.warning("raw data not found, nothing is run")
        return None
    merged_path, features_path = f"{output}/merged", f"{output}/features"
    if database:
        initialize_tables(spark, settings, database)
        merged = merge_tables(spark, settings, database)
    else:
        merged = build_dataset(spark, settings)
    merged.write.mode("overwrite").parquet(merged_path)
    merged = spark.read.parquet(merged_path)
    build_features(merged, settings).write.mode("overwrite").parquet(features_path)
    artifacts.write_document(spark, artifacts.feature_schema(settings), f"{output}/schema")
    features = spark.read.parquet(features_path)
    log.info("%s rows dropped for their target", merged.count() - features.count())
    domain_faults(features)
    table = training_table(features, settings)
    model, _, metadata, prep = train(table, candidates, spec=feature_spec(settings))
    artifacts.save_model(model, f"{output}/model")
    artifacts.write_document(spark, metadata, f"{output}/metadata")
    parts, summary = explain_model(table, model, prep)
    csv.write_csv(summary, f"{output}/contributions")
    scored = Scorer(model, metadata, settings.key).score_features(table.df)
    names = [r["feature"] for r in summary.select("feature").collect()]
    cases = local_explanations(parts, scored, settings.key, names)
    cases.write.mode("overwrite").parquet(f"{output}/cases")
    return metadata


def predict(spark: SparkSession, output: str, key: str = values.KEY) -> DataFrame:
    """Batch scoring of the stored feature table with the stored model; written next to them."""
    metadata = artifacts.read_document(spark, f"{output}/metadata")
    scorer = Scorer(artifacts.load_model(f"{output}/model"), metadata, key)
    scored = scorer.score_features(spark.read.parquet(f"{output}/features"))
    scored.write.mode("overwrite").parquet(f"{output}/predictions")
    return spark.read.parquet(f"{output}/predictions")
