"""Sources and sinks: typed tables, CSV, documents, the log table."""

import uuid

from pyspark.sql import functions as F

from staywise.config import Settings
from staywise.operators import cleaning
from staywise.plans.catalog.cleaning import EMPLOYEE, ORDERS_SQL, raw_employees
from staywise.plans.catalog.registry import DIRTY_VALUE, query, sql_list, table
from staywise.session import work_dir
from staywise.sources import artifacts, csv, tables
from staywise.values import CSV_NULL_TOKENS

HR_COLUMNS = ["id_employee", "genre", "departement", "revenu_mensuel", "annee_experience_totale"]
EVALUATION_COLUMNS = ["id_employee", "note_evaluation_actuelle", "augementation_salaire_precedente"]
SURVEY_COLUMNS = ["id_employee", "nb_formations_suivies", "annees_depuis_la_derniere_promotion"]


def _loaded(column: str, name: str) -> str:
    return f"""SELECT '{name}' AS source, count(*) AS n_rows, count(DISTINCT id_employee) AS n_keys,
        count(x) AS n_values, round(sum(x), 2) AS total FROM (SELECT id_employee, try_cast({column} AS double) AS x
        FROM raw) GROUP BY ALL"""


@query(
    "typed_load",
    f"""WITH raw AS (SELECT {', '.join(f'{e} AS {c}' for c, e in EMPLOYEE.items())} FROM customer
        JOIN ({ORDERS_SQL}) ON o_custkey = c_custkey)
        {_loaded('revenu_mensuel', 'sirh')} UNION ALL {_loaded('note_evaluation_actuelle', 'evaluation')}
        UNION ALL {_loaded('nb_formations_suivies', 'sond')}""",
)
def typed_load(spark, sf_dir):
    """Declare the typed tables, load three sources into theirs, and read them back."""
    raw = raw_employees(spark, sf_dir)
    frames = {"sirh": HR_COLUMNS, "evaluation": EVALUATION_COLUMNS, "sond": SURVEY_COLUMNS}
    database = f"load_{uuid.uuid4().hex[:12]}"
    prepared = {
        name: cleaning.prepare_source(raw.select(columns), "id_employee") for name, columns in frames.items()
    }
    tables.load_sources(spark, prepared, database, work_dir(spark, database))
    result = None
    for name, measure in (
        ("sirh", "revenu_mensuel"),
        ("evaluation", "note_evaluation_actuelle"),
        ("sond", "nb_formations_suivies"),
    ):
        part = spark.table(f"{database}.{name}").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct("id_employee").alias("n_keys"),
            F.count(measure).alias("n_values"),
            F.round(F.sum(measure), 2).alias("total"),
        )
        part = part.select(F.lit(name).alias("source"), "*")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "csv_roundtrip",
    f"""SELECT event_type, count(*) AS n, count(note) AS n_notes, count(value) AS n_values,
        round(sum(value), 2) AS total FROM (SELECT event_type, value, CASE WHEN note NOT IN ({sql_list(CSV_NULL_TOKENS)})
        THEN note END AS note FROM (SELECT event_type, value, {DIRTY_VALUE} AS note FROM events)) GROUP BY event_type""",
)
def csv_roundtrip(spark, sf_dir):
    """Write CSV, read it back as text with missing-value spellings nulled, and type it."""
    path = work_dir(spark, "csv")
    events = table(spark, sf_dir, "events")
    csv.write_csv(events.select("event_type", "value", F.expr(DIRTY_VALUE).alias("note")), path)
    back = csv.safe_read_csv(spark, path, ["event_type", "value", "note"])
    return (
        cleaning.to_numbers(back, ["value"])
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("note").alias("n_notes"),
            F.count("value").alias("n_values"),
            F.round(F.sum("value"), 2).alias("total"),
        )
    )


@query(
    "csv_quoted_text",
    """SELECT count(*) AS n, cast(sum(length(text)) AS bigint) AS n_chars, count(DISTINCT md5(text)) AS n_distinct
        FROM documents""",
)
def csv_quoted_text(spark, sf_dir):
    """Whole texts with quotes, commas and line breaks survive the way through CSV."""
    path = work_dir(spark, "texts")
    csv.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    back = csv.safe_read_csv(spark, path, ["doc_id", "text"])
    return back.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("n_chars"),
        F.countDistinct(F.md5("text")).alias("n_distinct"),
    )


@query(
    "csv_reordered",
    """SELECT c_custkey, c_mktsegment, cast(NULL AS varchar) AS absent FROM customer""",
)
def csv_reordered(spark, sf_dir):
    """Columns are found by name: the file has them in another order, has one more, and lacks one."""
    path = work_dir(spark, "reordered")
    csv.write_csv(table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_custkey"), path)
    back = csv.safe_read_csv(spark, path, ["c_custkey", "c_mktsegment", "absent"])
    return back.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "schema_document",
    """SELECT n.name AS feature, count(*) AS n_rows FROM customer, (SELECT unnest(['income', 'nation']) AS name) n
        GROUP BY 1""",
)
def schema_document(spark, sf_dir):
    """Write the feature schema, read it back, and count the rows of the table per numeric feature in it."""
    path = work_dir(spark, "schema")
    settings = Settings(numeric=("income", "nation"), categorical=("segment",))
    artifacts.write_document(spark, artifacts.feature_schema(settings), path)
    order = artifacts.feature_order(artifacts.read_document(spark, path))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("income"), F.col("c_nationkey").alias("nation")
    )
    present = [c for c in order if c in rows.columns]
    counts = rows.agg(*[F.count(c).alias(c) for c in present])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_rows")) for c in present]
    return counts.select(F.inline(F.array(*cells)))
