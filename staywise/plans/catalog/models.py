"""Training, search, scoring and explanation of fitted models, on labelled documents.

An iterative fit has no SQL form. Where SQL can state what must hold of its result (rows, folds, sums), the query
returns that; the others are checked by properties in the tests.
"""

import uuid

import numpy as np
from pyspark.sql import functions as F

from staywise.operators import explain, metrics
from staywise.operators.cleaning import prepare_source
from staywise.operators.scoring import run_inference
from staywise.operators.selection import (
    FOREST,
    LOGISTIC,
    Candidate,
    TrainingTable,
    candidate_grid,
    fit_final,
    fold_forests,
    grid_search,
    make_folds,
    out_of_fold,
    select_model,
)
from staywise.operators.tree_shap import forest_contributions
from staywise.plans.catalog.registry import EVALUATION_SQL, HR_SQL, SURVEY_SQL, query, raw_sources, table
from staywise.plans.workflow import Scorer, explain_model
from staywise.session import materialize, work_dir
from staywise.sources import artifacts, csv, tables

NUMERIC = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share", "mean_word"]
CATEGORICAL = ["lang", "source"]
LABEL = "low_quality"


def document_features(spark, sf_dir):
    """Measures of the whole text of each labelled document, and whether its quality is low."""
    text = F.col("text")
    words = F.size(F.split(text, r"\s+"))
    measures = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        words.alias("n_words"),
        (F.regexp_count(text, F.lit("\n")) + 1).alias("n_lines"),
        F.try_divide(F.regexp_count(text, F.lit("[0-9]")), F.length(text)).alias("digit_share"),
        F.try_divide(F.regexp_count(text, F.lit(r"\p{Lu}")), F.length(text)).alias("upper_share"),
        F.try_divide(F.length(text), words).alias("mean_word"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias(LABEL))
    return measures.join(labels, "doc_id")


def training_table(spark, sf_dir):
    """The features are written once: training reads them many times, the texts only once."""
    rows = materialize(document_features(spark, sf_dir), "document-features")
    return TrainingTable(rows, "doc_id", LABEL, NUMERIC, CATEGORICAL)


@query(
    "training_rows",
    """SELECT lang, 1 - quality AS low_quality, count(*) AS n, cast(sum(n_chars) AS bigint) AS n_chars,
        cast(sum(len(regexp_extract_all(text, '[0-9]'))) AS bigint) AS n_digits
        FROM documents JOIN labels USING (doc_id) GROUP BY lang, 1 - quality""",
)
def training_rows(spark, sf_dir):
    """What the model queries train on, by language and class."""
    rows = document_features(spark, sf_dir).withColumn(
        "digits", F.round(F.col("digit_share") * F.col("n_chars")).cast("bigint")
    )
    return rows.groupBy("lang", LABEL).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"), F.sum("digits").alias("n_digits")
    )


def _fitted(spark, sf_dir, candidate):
    data = training_table(spark, sf_dir)
    model, prep = fit_final(data, candidate)
    features = {c: "double" for c in NUMERIC} | {c: "string" for c in CATEGORICAL}
    return data, model, prep, features


LOGISTIC_POINT = Candidate(LOGISTIC, {"C": 0.1, "penalty": "l2"})
FOREST_POINT = Candidate(FOREST, {"trees": 300, "depth": 8, "split": 10, "leaf": 5})
LABELLED_SQL = "SELECT doc_id, 1 - quality AS low_quality FROM documents JOIN labels USING (doc_id)"


@query("train_logreg")
def train_logreg(spark, sf_dir):
    """Coefficients of the logistic model that is fitted to the oversampled table."""
    _, model, prep, _ = _fitted(spark, sf_dir, LOGISTIC_POINT)
    classifier = model.stages[-1]
    rows = list(zip(prep.feature_names, classifier.coefficients.toArray().tolist()))
    return spark.createDataFrame([("(intercept)", float(classifier.intercept)), *rows], "feature string, weight double")


@query("train_forest")
def train_forest(spark, sf_dir):
    """Feature importances of the forest."""
    _, model, prep, _ = _fitted(spark, sf_dir, FOREST_POINT)
    importances = model.stages[-1].importances.tolist()
    return spark.createDataFrame(list(zip(prep.feature_names, importances)), "feature string, importance double")


GRID_SQL = """SELECT 'LogReg_balanced' AS model, 'C=' || c || ',penalty=' || p AS params
        FROM (VALUES ('0.1'), ('1.0'), ('10.0')) a(c), (VALUES ('l1'), ('l2')) b(p)
        UNION ALL SELECT 'RF_balanced', 'trees=' || t || ',depth=' || d || ',split=' || s || ',leaf=' || l
        FROM (VALUES (200), (300), (500)) a(t), (VALUES (6), (8), (10)) b(d), (VALUES (5), (10), (15)) c(s), (VALUES (2), (5), (8)) e(l)"""


@query(
    "grid_search",
    f"""SELECT model, params, 5 AS folds, n AS held_out, true AS is_score
        FROM ({GRID_SQL}), (SELECT count(*) AS n FROM ({LABELLED_SQL}))""",
)
def search(spark, sf_dir):
    """Each of the 87 points of the grid, with the folds and held-out rows that its mean F1 comes from; its value is no SQL's."""
    data = training_table(spark, sf_dir)
    found = grid_search(data, make_folds(data), candidate_grid())
    rows = [(r["model"], r["params"], r["folds"], r["rows"], 0.0 <= r["mean_f1"] <= found[0]["mean_f1"] <= 1.0) for r in found]
    return spark.createDataFrame(rows, "model string, params string, folds int, held_out long, is_score boolean")


@query("oof_report")
def oof_report(spark, sf_dir):
    """Report on out-of-fold scores of one point."""
    data = training_table(spark, sf_dir)
    scores = out_of_fold(data, make_folds(data), LOGISTIC_POINT)
    return metrics.model_report(scores, "probability", LABEL, LOGISTIC)


@query(
    "oof_scores",
    f"""SELECT doc_id, low_quality, cast((row_number() OVER (PARTITION BY low_quality ORDER BY md5(concat('42-', doc_id)),
        doc_id) - 1) % 5 AS int) AS fold, true AS is_probability FROM ({LABELLED_SQL})""",
)
def oof_scores(spark, sf_dir):
    """Every row is scored once, by the model of the fold that it is held out of."""
    data = training_table(spark, sf_dir)
    scores = out_of_fold(data, make_folds(data), LOGISTIC_POINT)
    return scores.select("doc_id", LABEL, "fold", F.col("probability").between(0.0, 1.0).alias("is_probability"))


@query("select_model")
def chosen_model(spark, sf_dir):
    """Reports of the best of all points of each family; the threshold is tuned on the out-of-fold scores."""
    chosen = select_model(training_table(spark, sf_dir), candidate_grid())
    rows = [
        (r["model"], r["params"], r["threshold"], r["f1"], r["recall"], r["precision"], r["roc_auc"],
         r["model"] == chosen.best.model)
        for r in chosen.reports
    ]
    return spark.createDataFrame(
        rows,
        "model string, params string, threshold double, f1 double, recall double, precision double, "
        "roc_auc double, best boolean",
    )


@query("final_model", f"SELECT doc_id, low_quality, true AS decided FROM ({LABELLED_SQL})")
def final_model(spark, sf_dir):
    """Score every labelled document with the final model; the decision is the score against the threshold."""
    data, model, _, features = _fitted(spark, sf_dir, LOGISTIC_POINT)
    scored = run_inference(data.df, model, 0.5, features, [LABEL])
    decided = (F.col("prediction") == 1) == (F.col("proba_depart") >= 0.5)
    return scored.select("doc_id", LABEL, decided.alias("decided"))


@query("rescore", f"SELECT count(*) AS n, cast(0 AS bigint) AS n_different FROM ({LABELLED_SQL})")
def rescore(spark, sf_dir):
    """A table that holds scores already is scored again, to the same result."""
    data, model, _, features = _fitted(spark, sf_dir, LOGISTIC_POINT)
    once = run_inference(data.df, model, 0.5, features, [LABEL])
    stale = once.withColumn("before", F.col("proba_depart")).withColumn("proba_depart", F.lit(-1.0))
    twice = run_inference(stale, model, 0.5, features, [LABEL])
    return twice.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("before") - F.col("proba_depart")) > 1e-12).alias("n_different")
    )


@query(
    "model_roundtrip",
    "SELECT count(*) AS n, cast(0 AS bigint) AS n_different FROM documents JOIN labels USING (doc_id)",
)
def model_roundtrip(spark, sf_dir):
    """Save the model and its metadata, load both, and count rows that they score differently."""
    data, model, _, features = _fitted(spark, sf_dir, LOGISTIC_POINT)
    path = work_dir(spark, "model")
    artifacts.save_model(model, path)
    artifacts.write_document(spark, {"best_threshold": 0.5, "target": LABEL}, f"{path}-metadata")
    metadata = artifacts.read_metadata(spark, f"{path}-metadata").first()
    loaded = artifacts.load_model(path)
    before = run_inference(data.df, model, 0.5, features, [LABEL])
    after = run_inference(data.df, loaded, metadata["best_threshold"], features, [metadata["target"]])
    both = before.select("doc_id", F.col("proba_depart").alias("p"), F.col("prediction").alias("d")).join(
        after.select("doc_id", "proba_depart", "prediction"), "doc_id"
    )
    different = (F.abs(F.col("p") - F.col("proba_depart")) > 1e-12) | (F.col("d") != F.col("prediction"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(different).alias("n_different"))


MERGED_SQL = f"""({HR_SQL}) h JOIN ({EVALUATION_SQL}) e ON e.id_employee = h.id_employee
        JOIN ({SURVEY_SQL}) s ON s.id_employee = h.id_employee"""


@query(
    "score_routes",
    f"""SELECT 'raw_files' AS source, count(*) AS n FROM {MERGED_SQL}
        UNION ALL SELECT 'csv_file', count(*) FROM customer
        UNION ALL SELECT 'interactive_table', count(id_employee) FROM ({HR_SQL})
        UNION ALL SELECT 'form', 1""",
)
def score_routes(spark, sf_dir):
    """Log rows by source, after a model has scored files, a table and a form by the four routes."""
    hr = raw_sources(spark, sf_dir)["sirh"]
    label = F.when(F.col("income") > 5000, 1).otherwise(0).alias("rich")
    customers = prepare_source(hr, "id_employee").where("id_employee IS NOT NULL").select("*", label)
    data = TrainingTable(materialize(customers, "customers"), "id_employee", "rich", ["income", "nation"], ["segment"])
    model, _ = fit_final(data, LOGISTIC_POINT)
    metadata = {
        "features": {"numerical": ["income", "nation"], "categorical": ["segment"]},
        "best_threshold": 0.5,
        "target": "rich",
        "derivation": {"numerical": ["income", "nation"], "mean_of": []},
    }
    database = f"routes_{uuid.uuid4().hex}"
    tables.create_tables(spark, database)
    scorer = Scorer(model, metadata, database=database)
    paths = {}
    for name, df in raw_sources(spark, sf_dir).items():
        paths[name] = work_dir(spark, name)
        csv.write_csv(df, paths[name])
    scorer.score_raw_files(spark, paths)
    scorer.score_csv(spark, paths["sirh"])
    scorer.score_rows(spark, customers.drop("rich"))
    entered = customers.drop("rich").orderBy("id_employee").first().asDict()
    scorer.score_form(spark, list(entered), list(entered.values()))
    logged = spark.table(f"`{database}`.{tables.LOG_TABLE}").groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return spark.createDataFrame([(r.source, r.n) for r in logged], "source string, n bigint")  # one row per route


@query("explain_logreg")
def explain_logreg(spark, sf_dir):
    """Mean size of the contributions to the logit of the fitted logistic model, per encoded feature."""
    data, model, prep, _ = _fitted(spark, sf_dir, LOGISTIC_POINT)
    return explain_model(data, model, prep)[1]


@query("shap_forest", f"SELECT doc_id, true AS sums_up, true AS one_base, true AS is_score FROM ({LABELLED_SQL})")
def shap_forest(spark, sf_dir):
    """Exact contributions for every labelled document; per row they sum up to the model's score minus the one base."""
    data, model, prep, features = _fitted(spark, sf_dir, FOREST_POINT)
    trees = model.stages[-1].forest
    parts = forest_contributions(data.encode(data.df, prep), "doc_id", "vec", prep.feature_names, trees)
    parts = materialize(parts, "contributions")
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["phi"])
    bases = parts.agg((F.max("base") - F.min("base")).alias("spread"))
    gap = F.abs(F.col("score") - F.col("base") - total)
    scored = run_inference(data.df, model, 0.5, features, [LABEL]).select("doc_id", "proba_depart")
    checked = parts.select("doc_id", "score", (gap < 1e-9).alias("sums_up"), (bases.scalar() < 1e-9).alias("one_base"))
    same = (F.abs(F.col("score") - F.col("proba_depart")) < 1e-9).alias("is_score")
    return checked.join(scored, "doc_id").select("doc_id", "sums_up", "one_base", same)


@query(
    "forest_search",
    """SELECT grp AS fold, leaf, true AS is_prefix, true AS is_pruned FROM range(5) a(grp), (VALUES (2), (5), (8)) b(leaf)""",
)
def forest_search(spark, sf_dir):
    """Per fold and minimum leaf: fewer trees are the first trees, and cutting nodes off never adds any."""
    data = training_table(spark, sf_dir)
    folds = make_folds(data)
    large = fold_forests(data, folds, 60, 8, 5, [2, 5, 8])
    small = fold_forests(data, folds, 20, 6, 15, [2, 5, 8])
    rows = []
    for key, trees in large.items():
        few = small[key]
        first = trees.part(np.arange(20))
        same = bool((few.rows[few.root] == first.rows[first.root]).all() and np.allclose(few.value[few.root], first.value[first.root]))
        rows.append((*key, same, bool(len(few.feature) <= len(first.feature))))
    return spark.createDataFrame(rows, "fold long, leaf int, is_prefix boolean, is_pruned boolean")


@query(
    "shapley_sampled",
    f"""SELECT doc_id, true AS sums_up, true AS one_base FROM ({LABELLED_SQL})
        ORDER BY md5(concat('42-', doc_id)), doc_id LIMIT 500""",
)
def shapley_sampled(spark, sf_dir):
    """Shapley values of a seeded sample for the forest; per row they sum up to score minus the one base."""
    data, model, prep, _ = _fitted(spark, sf_dir, FOREST_POINT)
    encoded = data.encode(data.df, prep)
    parts = explain.sampled_shapley(encoded, "doc_id", "vec", prep.feature_names, model.stages[-1])
    parts = materialize(parts, "contributions")
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["phi"])
    bases = parts.agg((F.max("base") - F.min("base")).alias("spread"))
    gap = F.abs(F.col("score") - F.col("base") - total)
    return parts.select("doc_id", (gap < 1e-9).alias("sums_up"), (bases.scalar() < 1e-9).alias("one_base"))
