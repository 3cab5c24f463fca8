"""Sources, tables, configuration, the workflow end to end, and the streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from staywise import values
from staywise.config import SETTINGS_VARIABLE, Settings, load_settings
from staywise.operators import cleaning, monitoring, quality
from staywise.operators.selection import LOGISTIC, Candidate
from staywise.plans import workflow
from staywise.session import work_dir
from staywise.sources import artifacts, csv, tables
from staywise.streaming import jobs


def write_lines(path, header, rows):
    lines = [",".join(header), *[",".join("" if v is None else str(v) for v in r) for r in rows]]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Three raw files of 90 employees, with dirty keys and values."""
    folder = tmp_path_factory.mktemp("raw")
    rnd = random.Random(4)
    staff, grades, answers = [], [], []
    for i in range(1, 91):
        extra = rnd.random() < 0.35
        left = rnd.random() < (0.6 if extra else 0.1)
        staff.append((i, rnd.randint(22, 60), rnd.choice(["F", "M"]), rnd.randint(1500, 9000), rnd.choice(["Consulting", "Commercial", "Unknown"]), rnd.randint(0, 20), rnd.randint(0, 6)))
        grades.append((f"E_{i}", rnd.randint(1, 4), rnd.randint(1, 4), rnd.randint(1, 4), rnd.randint(1, 4), "Oui" if extra else "Non", f"{rnd.randint(1, 25)} %"))
        answers.append((i, "Oui" if left else "Non", rnd.randint(0, 6), rnd.choice([None, 1, 2]), rnd.randint(0, 10)))
    return Settings(
        path_hr=write_lines(folder / "hr.csv", ["id_employee", "age", "genre", "revenu_mensuel", "departement", "annee_experience_totale", "annees_dans_le_poste_actuel"], staff),
        path_evaluation=write_lines(folder / "eval.csv", ["eval_number", "note_evaluation_actuelle", "note_evaluation_precedente", "satisfaction_employee_equipe", "satisfaction_employee_environnement", "heure_supplementaires", "augementation_salaire_precedente"], grades),
        path_survey=write_lines(folder / "survey.csv", ["code_sondage", "a_quitte_l_entreprise", "nb_formations_suivies", "niveau_education", "annees_depuis_la_derniere_promotion"], answers),
        sql_file=str(folder / "merge.sql"),
    )


def test_merge_keeps_all_rows_and_integer_keys(spark, raw):
    merged = workflow.build_dataset(spark, raw)
    assert merged.count() == 90
    checks = {r.rule: r.n_bad for r in quality.integrity_checks(merged, "id_employee", raw.target, ["Oui", "Non", "0", "1"], 90).collect()}
    assert checks == {"key_null": 0, "key_not_integer": 0, "target_outside": 0, "row_count_kept": 0}
    assert dict(merged.dtypes)["id_employee"] == "bigint"
    assert merged.where("departement = 'Unknown'").isEmpty()


def test_workflow_end_to_end(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    metadata = workflow.run(spark, raw, out, candidates=[Candidate(LOGISTIC, {"C": 1.0, "penalty": "l2"})])
    assert metadata["best_model"] == LOGISTIC and 0 <= metadata["best_threshold"] <= 1
    assert metadata["target"] == raw.target
    typed = artifacts.read_metadata(spark, f"{out}/metadata").first()
    assert typed.best_threshold == metadata["best_threshold"]
    assert typed.all_results[0].metrics.f1 == pytest.approx(metadata["metrics"]["f1"])
    schema = artifacts.read_document(spark, f"{out}/schema")
    assert schema["numerical_features"] == list(values.NUMERIC_COLUMNS)
    scored = workflow.predict(spark, out)
    assert scored.count() == 90
    assert {"proba_depart", "prediction", raw.target} <= set(scored.columns)
    importance = csv.read_csv(spark, f"{out}/contributions")
    assert importance.columns == ["feature", "mean_abs_phi"] and importance.count() > 5

    cases = spark.read.parquet(f"{out}/cases")
    assert {r.case for r in cases.collect()} == {"highest_impact", "highest_score", "lowest_score"}
    assert cases.groupBy("case").count().agg(F.max("count")).first()[0] == values.TOP_FEATURES + 1

    # The other routes give the same scores as the stored feature table, and each appends to the log.
    database = "route_log"
    tables.create_tables(spark, database)
    scorer = workflow.Scorer(artifacts.load_model(f"{out}/model"), metadata, database=database)
    want = {r.id_employee: r.proba_depart for r in scored.collect()}
    from_files, log_rows = scorer.score_raw_files(spark, raw.raw_paths)
    got = {r.id_employee: r.proba_depart for r in from_files.collect()}
    assert got == pytest.approx(want)
    entry = log_rows.orderBy("id_employee").first()
    assert entry.source == "raw_files" and entry.probability == pytest.approx(want[1])
    payload = json.loads(entry.payload)
    assert payload["id_employee"] == 1 and payload["augementation_salaire_precedente"].endswith("%")

    first = {r.id_employee: r for r in workflow.build_dataset(spark, raw).collect()}[1].asDict()
    answer, entry = scorer.score_form(spark, list(first), list(first.values()))
    assert answer.first().probability == pytest.approx(want[1], abs=6e-5)
    assert entry.first().source == "form"
    rows, entry = scorer.score_rows(spark, [first, {"id_employee": None}])
    assert rows.count() == 1 and entry.first().source == "interactive_table"
    path = str(tmp_path / "one.csv")
    csv.write_csv(workflow.build_dataset(spark, raw), path)
    rows, entry = scorer.score_csv(spark, path)
    assert {int(r.id_employee): r.proba_depart for r in rows.collect()} == pytest.approx(want)
    assert entry.select("source").distinct().first().source == "csv_file"
    logged = {r.source: r["count"] for r in spark.table(f"{database}.prediction_logs").groupBy("source").count().collect()}
    assert logged == {"raw_files": 90, "form": 1, "interactive_table": 1, "csv_file": 90}
    again = {r.id_employee: r.proba_depart for r in scorer.score_features(scored).collect()}  # scored before
    assert again == pytest.approx(want)
    scorer.database = "no_such_database"
    rows, _ = scorer.score_rows(spark, [first])
    assert rows.count() == 1


def test_settings_steer_the_derivation_and_the_fit(spark, tmp_path):
    file = tmp_path / "run.json"
    file.write_text('{"sat_cols": ["a", "b"], "num_cols": ["a", "b"], "subsample_frac": 0.5, "fit_fraction": 0.5}')
    settings = load_settings(file)
    merged = spark.createDataFrame([(1, "1", "3", "Oui")], f"id_employee bigint, a string, b string, {values.TARGET} string")
    assert workflow.build_features(merged, settings).first()[values.MEAN_OUTPUT] == 2.0
    features = spark.range(400).selectExpr("id AS id_employee", "cast(id AS double) AS a", "1.0D AS b", f"cast(id % 2 AS int) AS {values.TARGET}")
    table = workflow.training_table(features, settings)
    assert table.df.count() == 400
    assert 150 < table.oversample(table.encode(table.df, table.prepare())).count() < 250


def test_workflow_by_way_of_typed_tables(spark, raw, tmp_path):
    out, database = str(tmp_path / "out"), "flow_test"
    point = Candidate(LOGISTIC, {"C": 1.0, "penalty": "l2"})
    metadata = workflow.run(spark, raw, out, database, [point])
    assert metadata["best_model"] == LOGISTIC
    assert spark.read.parquet(f"{out}/merged").count() == 90
    with open(raw.sql_file, encoding="utf-8") as f:
        assert "INNER JOIN flow_test.sond USING (id_employee)" in f.read()

    # A stream of merged rows is scored as the batch is.
    scorer = workflow.Scorer(artifacts.load_model(f"{out}/model"), metadata)
    merged = spark.read.parquet(f"{out}/merged")
    streamed = jobs.score_stream(
        spark, f"{out}/merged", merged.schema, lambda s: s, scorer.score, str(tmp_path / "streamed")
    )
    want = {r.id_employee: r.proba_depart for r in scorer.score(merged).collect()}
    assert {r.id_employee: r.proba_depart for r in streamed.collect()} == pytest.approx(want)


def test_workflow_is_skipped_without_raw_files(spark, raw, tmp_path):
    gone = Settings(path_hr=str(tmp_path / "gone.csv"), path_evaluation=raw.path_evaluation, path_survey=raw.path_survey)
    assert workflow.run(spark, gone, str(tmp_path / "nothing")) is None
    assert csv.missing_paths(spark, list(gone.raw_paths.values())) == [gone.path_hr]


def test_typed_tables(spark, raw):
    database = "staff_test"
    workflow.initialize_tables(spark, raw, database)
    names = {t.name for t in spark.catalog.listTables(database)}
    assert {"sirh", "evaluation", "sond", "prediction_logs"} <= names
    hr = spark.table(f"{database}.sirh")
    assert {"id_employee", "age", "revenu_mensuel", "poste"} <= set(hr.columns)
    assert hr.count() == 90 and hr.where("age IS NULL").count() == 0
    merged = tables.run_merge_statement(spark, ["sirh", "evaluation", "sond"], "id_employee", database, raw.sql_file)
    assert merged.count() == 90
    with open(raw.sql_file, encoding="utf-8") as f:
        assert f.read().startswith("SELECT *\nFROM staff_test.sirh\nINNER JOIN")
    remote = f"file://{raw.sql_file}.trace"
    tables.run_merge_statement(spark, ["sirh", "sond"], "id_employee", database, remote)
    assert spark.read.text(remote).first().value.endswith("INNER JOIN staff_test.sond USING (id_employee);")
    with pytest.raises(ValueError, match="in the table already"):
        tables.append_table(spark.createDataFrame([(1, "x")], "id_employee bigint, genre string"), database, "sirh")
    assert spark.table(f"{database}.sirh").count() == 90
    with pytest.raises(ValueError, match="null or repeated"):
        again = spark.createDataFrame([(1000, "x"), (1000, "y")], "id_employee bigint, genre string")
        tables.append_table(again, database, "sirh")
    with pytest.raises(ValueError, match="not in the table"):
        tables.append_table(spark.createDataFrame([(1, 2)], "id_employee bigint, odd int"), database, "sirh")
    tables.replace_table(spark.createDataFrame([(1, "z")], "id_employee bigint, odd string"), database, "sond")
    assert spark.table(f"{database}.sond").columns == ["id_employee", "odd"]


def test_log_append(spark):
    database = "log_test"
    tables.create_tables(spark, database)
    raw_row = F.struct(F.lit(9999).alias("id_employee"), F.lit(None).cast("int").alias("age"), F.lit("é").alias("nom"))
    scored = spark.createDataFrame([(9999, 0.42, 1)], "id_employee bigint, proba_depart double, prediction int")
    entry = monitoring.build_log(scored, "pytest", 0.4, raw_row)
    tables.append_log(entry, database)
    tables.append_log(entry, database)
    found = spark.table(f"{database}.prediction_logs").where("source = 'pytest'").collect()
    assert len(found) == 2 and len({r.log_id for r in found}) == 2
    assert found[0].payload == '{"id_employee":9999,"age":null,"nom":"é"}'
    assert found[0].created_at is not None and found[0].decision == 1


def test_csv_spellings_of_missing(spark, tmp_path):
    path = write_lines(tmp_path / "a.csv", ["a", "b"], [["NA", "x"], ["", "NAN"], ["n/a", "Unknown"], [" ", "none"]])
    rows = [tuple(r) for r in csv.read_csv(spark, path).collect()]
    assert rows == [(None, "x"), (None, "NAN"), (None, "Unknown"), (" ", "none")]


def test_csv_errors(spark, tmp_path):
    missing = str(tmp_path / "missing.csv")
    assert csv.safe_read_csv(spark, missing, ["a"]).count() == 0
    with pytest.raises(FileNotFoundError):
        csv.read_csv(spark, missing)
    with pytest.raises(ValueError, match="supply the file survey"):
        csv.read_supplied_csv(spark, None, "survey")
    with pytest.raises(ValueError, match="cannot read the file survey"):
        csv.read_supplied_csv(spark, missing, "survey")
    short = tmp_path / "short.csv"
    short.write_text('a,b\n1,2,3\n')
    with pytest.raises(ValueError, match="cannot read the file survey"):
        csv.read_supplied_csv(spark, str(short), "survey")
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2,3\n4,5\n")
    with pytest.raises(Exception, match="MALFORMED"):
        csv.read_csv(spark, str(bad), ["a", "b"]).collect()
    assert csv.safe_read_csv(spark, str(bad), ["a", "b"]).count() == 2


def test_csv_columns_go_by_name_and_texts_may_hold_line_breaks(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text('age,id_employee,note\n30,1,"a\nb"\n40,2,"say ""x"", y"\n')
    for read in (csv.read_csv, csv.safe_read_csv):
        found = [tuple(r) for r in read(spark, str(file), ["id_employee", "age", "note", "absent"]).collect()]
        assert found == [("1", "30", "a\nb", None), ("2", "40", 'say "x", y', None)]
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n")
    (folder / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header"):
        csv.read_csv(spark, str(folder), ["a", "b"]).collect()


def test_rows_in_memory(spark):
    import pandas as pd

    frame = pd.DataFrame({"a": [1, None], "b": ["x", None]})
    assert [tuple(r) for r in csv.rows_to_table(spark, frame).collect()] == [("1.0", "x")]
    assert csv.rows_to_table(spark, [[1, None], [None, None]], ["a", "b"]).count() == 1
    with pytest.raises(ValueError, match="complete row"):
        csv.rows_to_table(spark, None, ["a"])
    with pytest.raises(ValueError, match="headers"):
        csv.rows_to_table(spark, [[1]])


def test_settings(tmp_path, monkeypatch):
    file = tmp_path / "run.yml"
    file.write_text("random_state: 7\nnum_cols: [a, b]\npaths:\n  sirh: 'x/hr.csv'\n  sondage: s3a://bucket/s.csv\ndatabase:\n  schema: public\n")
    found = load_settings(file)
    assert (found.random_state, found.numeric, found.database) == (7, ("a", "b"), "public")
    assert found.path_hr == str(tmp_path / "x/hr.csv") and found.path_survey == "s3a://bucket/s.csv"
    assert found.categorical == values.CATEGORICAL_COLUMNS
    monkeypatch.setenv(SETTINGS_VARIABLE, str(file))
    assert load_settings().random_state == 7
    other = tmp_path / "run.json"
    other.write_text('{"cat_cols": "genre"}')
    with pytest.raises(TypeError, match="list"):
        load_settings(other)
    other.write_text("[]")
    with pytest.raises(ValueError, match="mapping"):
        load_settings(other)
    with pytest.raises(FileNotFoundError):
        load_settings(tmp_path / "none.yml")


def test_feature_order():
    schema = {"numerical_features": ["a"], "categorical_features": ["b"]}
    metadata = {"features": {"numerical": ["c", "evolution_note"], "categorical": []}}
    assert artifacts.feature_order(schema, metadata) == ["a", "b"]
    assert artifacts.feature_order({}, metadata) == ["c", "evolution_note"]
    assert artifacts.feature_order(None, None, ["z"]) == ["z"]
    assert artifacts.input_features(["c", "evolution_note"]) == ["c"]
    assert artifacts.input_features(["evolution_note"]) == ["evolution_note"]


def test_domains_and_quarantine(spark):
    rows = [("F", 3.0), ("X", 9.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "genre string, note_evaluation_actuelle double")
    rules = {**values.CATEGORY_DOMAINS, **{c: values.SCORE_RANGE for c in values.SCORE_COLUMNS}}
    found = {r.column: (r.n_checked, r.n_null, r.n_bad) for r in quality.domain_checks(df, rules).collect()}
    assert found == {"genre": (2, 1, 1), "note_evaluation_actuelle": (3, 0, 1)}
    assert workflow.domain_faults(df) == {"genre": 1, "note_evaluation_actuelle": 1}
    good, bad = quality.quarantine(df, rules)
    assert good.count() == 2 and bad.first().faults == ["genre", "note_evaluation_actuelle"]


def test_work_dir_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)


LOG_SCHEMA = "created_at timestamp, source string, decision int"


def log_rows(spark, days, path, start=1):
    rows = [(f"2024-01-{start + d:02d} 12:00:00", "form", d % 2) for d in range(days)]
    df = spark.createDataFrame(rows, "t string, source string, decision int")
    df.select(F.to_timestamp("t").alias("created_at"), "source", "decision").coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_dropped_by_the_stream_only(spark, tmp_path):
    folder, out = str(tmp_path / "log"), str(tmp_path / "out")
    schema = spark.createDataFrame([], LOG_SCHEMA).schema

    def daily():
        stream = jobs.with_event_time(jobs.read_stream(spark, folder, schema), "created_at", "1 day")
        return monitoring.daily_usage(stream, "created_at", "source")

    log_rows(spark, 10, folder)
    jobs.run_available(daily(), out, "append")
    jobs.run_available(daily(), out, "append")  # nothing new: closes what the watermark allows
    log_rows(spark, 1, folder, start=2)  # far behind the watermark
    jobs.run_available(daily(), out, "append")
    found = {str(r.period)[:10]: r.n for r in spark.read.parquet(out).collect()}
    assert found["2024-01-02"] == 1 and max(found.values()) == 1
    assert "2024-01-10" not in found
    batch = monitoring.daily_usage(spark.read.parquet(folder), "created_at", "source")
    assert batch.where("period = '2024-01-02'").first().n == 2


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "scored")
    schema = spark.createDataFrame([], LOG_SCHEMA).schema

    def score():
        return jobs.score_stream(spark, folder, schema, lambda s: s, lambda s: s.withColumn("score", F.col("decision") * 2), out)

    log_rows(spark, 5, folder)
    assert score().count() == 5
    log_rows(spark, 3, folder, start=20)
    assert score().count() == 8
    assert score().count() == 8
    with pytest.raises(ValueError, match="mode"):
        jobs.run_available(jobs.read_stream(spark, folder, schema), out, "update")


def test_log_line_layout(spark):
    lines = [("2024-01-02 03:04:05.678 | ERROR    | a:b:1 - broken",), ("  File x",), ("2024-01-02 03:04:06 | INFO | ok",)]
    found = monitoring.parse_log_lines(spark.createDataFrame(lines, "value string")).collect()
    assert [(r.day, r.level, r.message) for r in found] == [
        ("2024-01-02", "ERROR", "a:b:1 - broken"),
        ("2024-01-02", "INFO", "ok"),
    ]


@pytest.mark.parametrize("rows_per_bucket", [10**6, 60])
def test_no_drift_between_equal_periods(spark, rows_per_bucket):
    df = spark.range(400).select((F.col("id") % 200).cast("double").alias("x"), F.when(F.col("id") < 200, "a").otherwise("b").alias("p"))
    assert monitoring.drift_psi(df, "x", "p", "a", "b", rows_per_bucket=rows_per_bucket).first().psi == 0.0
    assert monitoring.drift_ks(df, "x", "p", "a", "b", rows_per_bucket).first().ks == 0.0
    shifted = df.withColumn("x", F.when(F.col("p") == "b", F.col("x") + 1000).otherwise(F.col("x")))
    assert monitoring.drift_ks(shifted, "x", "p", "a", "b", rows_per_bucket).first().ks == 1.0


def test_prepare_source_gives_the_same_key_either_way(spark):
    df = spark.createDataFrame([(" E-7 ", "nan"), ("Unknown", "x")], "eval_number string, t string")
    found = [tuple(r) for r in cleaning.prepare_source(df, "id_employee", "eval_number").collect()]
    assert found == [(7, None), (None, "x")]
