import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staywise.operators import explain, metrics, prep, selection
from staywise.operators.scoring import form_answer, run_inference, score_linear
from staywise.operators.selection import FOREST, LOGISTIC, Candidate, TrainingTable, candidate_grid
from staywise.sources import artifacts

POINT = Candidate(LOGISTIC, {"C": 1.0, "penalty": "l2"})


def staff(spark, n=260, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        overtime = rnd.random() < 0.3
        age = rnd.gauss(40, 9)
        p = 1 / (1 + math.exp(-(-2.2 + 2.2 * overtime - 0.08 * (age - 40))))
        rows.append((i, None if i % 9 == 0 else age, rnd.choice("abc") if i % 7 else None, "Oui" if overtime else "Non", int(rnd.random() < p)))
    return spark.createDataFrame(rows, "id bigint, age double, team string, overtime string, left int").cache()


@pytest.fixture(scope="module")
def data(spark):
    return TrainingTable(staff(spark), "id", "left", ["age"], ["team", "overtime"])


@pytest.fixture(scope="module")
def fitted(data):
    return selection.fit_final(data, POINT)


def test_preparation_learns_exact_parameters(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "b"), (10.0, "a"), (None, None)], "x double, c string")
    learned = prep.learn_preparation(df, ["x"], ["c"])
    x = learned.numeric[0]
    assert x.median == 2.5  # the midpoint, not an element
    filled = [1.0, 2.0, 3.0, 10.0, 2.5]
    mean = sum(filled) / 5
    assert x.mean == pytest.approx(mean)
    assert x.deviation == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in filled) / 5))
    assert learned.categorical[0].mode == "a"  # the smaller one on a tie
    assert learned.feature_names == ["num__x", "cat__c_a", "cat__c_b"]


def test_columns_without_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0, None, "a")], "x double, gone double, c string")
    learned = prep.learn_preparation(df, ["x", "gone"], ["c"])
    assert learned.inputs == ["x", "c"]
    assert df.select(*learned.encoded()).first()["num__x"] == 0.0  # constant column


def test_unseen_level_is_all_zeros_and_missing_takes_the_mode(spark, data):
    learned = data.prepare()
    rows = spark.createDataFrame([(40.0, "zz", None)], "age double, team string, overtime string")
    found = rows.select(*learned.encoded()).first().asDict()
    assert [found[f"cat__team_{c}"] for c in "abc"] == [0.0, 0.0, 0.0]
    assert found["cat__overtime_Non"] == 1.0


def test_stages_encode_as_the_expressions_do(spark, data):
    from pyspark.ml import PipelineModel

    learned = data.prepare()
    staged = PipelineModel(learned.stages()).transform(data.df)
    both = staged.select(vector_to_array("features").alias("a"), learned.vector().alias("b")).collect()
    for r in both:
        assert r.a == pytest.approx(r.b, abs=1e-12)


def test_integer_levels_have_no_decimals(spark):
    df = spark.createDataFrame([(1.0, 2), (2.5, 3)], "a double, b int")
    assert [tuple(r) for r in prep.level_text(df, ["a", "b"]).collect()] == [("1", "2"), ("2.5", "3")]


def test_approximate_medians_are_close(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert prep.learn_medians(df, ["x"], exact=False).first().median == 500.0
    assert prep.learn_medians(df, ["x"], rows_per_bucket=100).first().median == 500.0


def test_grids():
    grid = candidate_grid()
    assert sum(c.model == LOGISTIC for c in grid) == 6
    assert sum(c.model == FOREST for c in grid) == 81


def test_folds_hold_out_every_row_once_and_balance_training(spark, data):
    folds = selection.make_folds(data, 3)
    seen = [r.id for f in folds for r in f.held_out.select("id").collect()]
    assert sorted(seen) == sorted(r.id for r in data.df.select("id").collect())
    for f in folds:
        counts = {r["left"]: r["count"] for r in f.train.groupBy("left").count().collect()}
        assert counts[0] == counts[1]
        held = {r.id for r in f.held_out.select("id").collect()}
        assert not held & {r.id for r in f.train.select("id").collect()}
        assert f.train.agg(F.min("weight"), F.max("weight")).first() == (1.0, 1.0)


def test_selection_reports_each_family(spark, data):
    points = [POINT, Candidate(FOREST, {"trees": 10, "depth": 4, "leaf": 5})]
    found = selection.select_model(data, points, folds=3)
    assert {r["model"] for r in found.reports} == {LOGISTIC, FOREST}
    assert found.best.model == max(found.reports, key=lambda r: r["f1"])["model"]
    logistic = next(r for r in found.reports if r["model"] == LOGISTIC)
    assert logistic["roc_auc"] > 0.65
    assert logistic["f1"] > metrics.dummy_baseline(data.df, "left").first().f1


def test_regularisation_matches_the_sum_of_losses(spark, data):
    """At the solution the gradient of |w|^2/2 + C * sum of losses is zero."""
    learned = data.prepare()
    train = data.weigh(data.encode(data.df, learned).select("id", "left", F.col("vec"))).withColumn("weight", F.lit(1.0))
    from pyspark.ml.functions import array_to_vector

    rows = train.withColumn("features", array_to_vector("vec"))
    model = selection._fit(POINT, rows, rows.count(), "left", 42)
    w, b = model.coefficients.toArray(), model.intercept
    gradient = w.copy()
    for r in rows.select("vec", "left").collect():
        p = 1 / (1 + math.exp(-(sum(a * c for a, c in zip(w, r.vec)) + b)))
        gradient += [(p - r.left) * a for a in r.vec]
    assert max(abs(g) for g in gradient) < 0.02


def test_saved_model_has_no_sampler_and_scores_alike(spark, data, fitted, tmp_path):
    model, _ = fitted
    artifacts.save_model(model, str(tmp_path / "model"))
    loaded = artifacts.load_model(str(tmp_path / "model"))
    features = {"age": "double", "team": "string", "overtime": "string"}
    a = run_inference(data.df, model, 0.5, features, ["left"]).orderBy("id").collect()
    b = run_inference(data.df, loaded, 0.5, features, ["left"]).orderBy("id").collect()
    assert [r.proba_depart for r in a] == pytest.approx([r.proba_depart for r in b])
    assert a[0].__fields__ == ["id", "age", "team", "overtime", "left", "proba_depart", "prediction"]


def test_missing_features_are_imputed_when_scoring(spark, fitted):
    model, _ = fitted
    rows = spark.createDataFrame([("Oui", "kept")], "overtime string, extra string")
    features = {"age": "double", "team": "string", "overtime": "string"}
    found = run_inference(rows, model, 0.0, features).first()
    assert 0 < found.proba_depart < 1 and found.prediction == 1 and found.extra == "kept"


def test_linear_contributions_sum_to_the_logit(spark, data, fitted):
    model, learned = fitted
    encoded = data.encode(data.df, learned)
    w, b = model.stages[-1].coefficients.toArray().tolist(), model.stages[-1].intercept
    n = len(w)
    means = list(encoded.agg(*[F.avg(F.col("vec")[i]) for i in range(n)]).first())
    base = b + sum(a * m for a, m in zip(w, means))
    parts = explain.vector_contributions(encoded, "id", "vec", learned.feature_names, w, means)
    features = {"age": "double", "team": "string", "overtime": "string"}
    score = {r.id: r.proba_depart for r in run_inference(data.df, model, 0.5, features).collect()}
    for r in parts.collect():
        logit = base + sum(c.phi for c in r.contributions)
        assert 1 / (1 + math.exp(-logit)) == pytest.approx(score[r.id], abs=1e-9)


def test_sampled_shapley_is_efficient_and_finds_the_driver(spark, data):
    model, learned = selection.fit_final(data, Candidate(FOREST, {"trees": 15, "depth": 5, "leaf": 3}))
    encoded = data.encode(data.df, learned)
    parts = explain.sampled_shapley(
        encoded, "id", "vec", learned.feature_names, model.stages[-1], rows=20, permutations=4, background=10
    )
    rows = parts.collect()
    assert len(rows) == 20
    for r in rows:
        assert sum(c.phi for c in r.contributions) == pytest.approx(r.score - r.base, abs=1e-9)
    summary = explain.mean_abs_contribution(parts, learned.feature_names).collect()
    assert summary[0].feature in ("num__age", "cat__overtime_Oui", "cat__overtime_Non")


def test_top_contributions_keep_the_sum(spark):
    df = spark.createDataFrame([(1, 5.0, -9.0, 1.0, 2.0)], "id int, a double, b double, c double, d double")
    weights = dict.fromkeys("abcd", 1.0)
    parts = explain.linear_contributions(df, "id", weights, dict.fromkeys("abcd", 0.0))
    top = [(r.position, r.feature, r.phi) for r in explain.top_contributions(parts, "id", "abcd", 2).collect()]
    assert top == [(0, "b", -9.0), (1, "a", 5.0), (2, "other", 3.0)]
    assert len(explain.top_contributions(parts, "id", "abcd", 4).collect()) == 4
    assert explain.total_impact(parts).first().impact == 17.0


def test_cases_take_the_smallest_id_on_ties(spark):
    df = spark.createDataFrame([(3, 1.0, 0.9), (1, 1.0, 0.9), (2, 0.5, 0.1), (4, 0.2, 0.1)], "id int, i double, s double")
    found = {r.case: r.id for r in explain.explain_cases(df, "id", "i", "s").collect()}
    assert found == {"highest_impact": 1, "highest_score": 1, "lowest_score": 2}


def test_linear_score_and_answer(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    scored = score_linear(df, {"x": 2.0}, 0.0, 0.5)
    assert [r.prediction for r in scored.collect()] == [1, 0, None]
    answer = form_answer(scored.limit(1), 0.5).first()
    assert (answer.probability, answer.decision, answer.threshold) == (0.8808, "Risque de départ", 0.5)


def test_best_of_reports(spark):
    reports = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "model string, f1 double")
    assert metrics.select_best(reports).first() == ("a", 0.5)


def test_a_search_leaves_no_folder_behind(spark, data):
    from pathlib import Path

    from staywise.session import scratch, work_dir, work_root

    def files():
        root = Path(work_root(spark).removeprefix("file://"))
        return {str(f) for f in root.rglob("*.parquet")} if root.exists() else set()

    before = files()
    selection.select_model(data, [POINT], folds=2)
    selection.fit_final(data, POINT)
    assert files() - before == set()
    with scratch(spark):
        inside = work_dir(spark, "x")
        spark.range(3).write.parquet(inside)
        assert spark.read.parquet(inside).count() == 3
    assert not Path(inside.removeprefix("file://")).exists()


def test_all_explained_rows_share_one_base(data, fitted):
    model, learned = fitted
    parts = explain.sampled_shapley(
        data.encode(data.df, learned), data.id_col, "vec", learned.feature_names, model.stages[-1], rows=15, permutations=6, background=4
    )
    assert parts.select("base").collect() and len({round(r.base, 12) for r in parts.collect()}) == 1


def test_shared_search_scores_what_separate_fits_score(data):
    """Points of both families, fitted together and one by one."""
    points = [Candidate(LOGISTIC, {"C": c, "penalty": p}) for c, p in ((0.1, "l1"), (10.0, "l2"))]
    forests = [(8, 3, 2, 2), (5, 2, 12, 6)]
    points += [Candidate(FOREST, dict(zip(("trees", "depth", "split", "leaf"), p))) for p in forests]
    folds = selection.make_folds(data, 2)
    together = {r["params"]: r for r in selection.grid_search(data, folds, points)}
    apart = {r["params"]: r for r in selection.grid_search(data, folds, points, shared=False)}
    assert set(together) == set(apart) == {c.name for c in points}
    for name, row in together.items():
        assert row["folds"] == 2 and row["rows"] == data.df.count() == apart[name]["rows"]
        assert row["mean_f1"] == pytest.approx(apart[name]["mean_f1"], abs=0.02 if name.startswith("C=") else 1e-12)


def test_registered_searches_run_the_whole_grid(monkeypatch):
    """87 points, 6 logistic and 81 forest ones; the fits themselves are left to test_queries."""
    from staywise.plans.catalog import models

    seen = []

    class Stop(Exception):
        pass

    def note(*args):
        seen.append(list(args[-1]))
        raise Stop

    for name in ("grid_search", "select_model"):
        monkeypatch.setattr(models, name, note)
    monkeypatch.setattr(models, "training_table", lambda spark, sf_dir: None)
    monkeypatch.setattr(models, "make_folds", lambda data: [])
    for run in (models.search, models.chosen_model):
        with pytest.raises(Stop):
            run(None, None)
    assert seen == [selection.candidate_grid()] * 2 and len(seen[0]) == 87


def test_reports_come_from_the_fits_of_the_search(spark, data, monkeypatch):
    """No point is fitted again for its report, which is that of separate fits."""
    points = [POINT, Candidate(FOREST, {"trees": 10, "depth": 4, "leaf": 5})]
    apart = selection.out_of_fold
    monkeypatch.setattr(selection, "out_of_fold", lambda *a: pytest.fail("fitted again"))
    found = selection.select_model(data, points, folds=2)
    folds = selection.make_folds(data, 2)
    for point, report in zip(points, found.reports):
        want = metrics.model_report(apart(data, folds, point), "probability", "left", point.model).first()
        for figure in ("f1", "recall", "precision", "roc_auc", "threshold"):
            assert report[figure] == pytest.approx(want[figure], abs=1e-9 if point.model == FOREST else 1e-3)
