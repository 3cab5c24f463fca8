"""Typed tables: declaration, append, replacement, the log sink and the merge statement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from staywise.errors import InputError
from staywise.operators.merging import merge_sql
from staywise.values import KEY

# Tables, their columns in order, and the kind of each column.
TABLE_COLUMNS = {
    "sirh": {
        "id_employee": "key",
        "age": "number",
        "genre": "text",
        "revenu_mensuel": "number",
        "statut_marital": "text",
        "departement": "text",
        "poste": "text",
        "nombre_experiences_precedentes": "number",
        "nombre_heures_travailless": "number",
        "annee_experience_totale": "number",
        "annees_dans_l_entreprise": "number",
        "annees_dans_le_poste_actuel": "number",
    },
    "evaluation": {
        "id_employee": "key",
        "satisfaction_employee_environnement": "number",
        "note_evaluation_precedente": "number",
        "niveau_hierarchique_poste": "number",
        "satisfaction_employee_nature_travail": "number",
        "satisfaction_employee_equipe": "number",
        "satisfaction_employee_equilibre_pro_perso": "number",
        "note_evaluation_actuelle": "number",
        "heure_supplementaires": "text",
        "augementation_salaire_precedente": "text",
    },
    "sond": {
        "id_employee": "key",
        "a_quitte_l_entreprise": "text",
        "nombre_participation_pee": "number",
        "nb_formations_suivies": "number",
        "nombre_employee_sous_responsabilite": "number",
        "distance_domicile_travail": "number",
        "niveau_education": "number",
        "domaine_etude": "text",
        "ayant_enfants": "text",
        "frequence_deplacement": "text",
        "annees_depuis_la_derniere_promotion": "number",
        "annes_sous_responsable_actuel": "number",
    },
    "prediction_logs": {
        "log_id": "text",
        "created_at": "time",
        "id_employee": "key",
        "source": "text",
        "probability": "number",
        "decision": "flag",
        "threshold": "number",
        "payload": "text",
    },
}
_KINDS = {
    "key": LongType(),
    "number": DoubleType(),
    "text": StringType(),
    "time": TimestampType(),
    "flag": IntegerType(),
}
LOG_TABLE = "prediction_logs"
LOG_DAY = "created_on"


def table_schema(columns: Mapping[str, str]) -> StructType:
    return StructType([StructField(c, _KINDS[kind]) for c, kind in columns.items()])


TABLE_SCHEMAS = {name: table_schema(columns) for name, columns in TABLE_COLUMNS.items()}


def create_tables(
    spark: SparkSession,
    database: str,
    location: str | None = None,
    schemas: Mapping[str, StructType] = TABLE_SCHEMAS,
) -> None:
    """Create the database where needed, drop the tables and declare them anew, empty.

    The log is partitioned by day, so that reports on a period read that period only.
    """
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    for name, schema in schemas.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        if name == LOG_TABLE:
            columns, layout = f"{columns}, {LOG_DAY} date", f" PARTITIONED BY ({LOG_DAY})"
        else:
            layout = ""
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet{layout}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the declared table in its order and types; an absent one is null, an unknown one refused."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise InputError(f"columns not in the table: {', '.join(unknown)}")
    values = {f.name: F.col(f.name) if f.name in df.columns else F.lit(None) for f in schema.fields}
    return df.select(*[values[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])


def append_table(
    df: DataFrame,
    database: str,
    name: str,
    schema: StructType | None = None,
    key: str | None = KEY,
    ignore: Sequence[str] = (),
) -> None:
    """Cast to the declared types and append. The key must be present and unique in the whole table, as a primary key is."""
    typed = conform(df.drop(*ignore), schema or TABLE_SCHEMAS[name])
    spark = df.sparkSession
    if key and spark.catalog.tableExists(f"`{database}`.`{name}`"):
        stored = spark.table(f"`{database}`.`{name}`").select(key)
        known = typed.select(key).join(stored, key, "left_semi").count()
        if known:
            raise InputError(f"{name}: {key} of {known} row(s) is in the table already")
    if key:
        found = typed.agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("k"), F.count(key).alias("present")
        ).first()
        if found["present"] < found["n"] or found["k"] < found["n"]:
            raise InputError(f"{name}: {key} is null or repeated in {found['n'] - found['k']} row(s)")
    typed.write.mode("append").format("parquet").saveAsTable(f"`{database}`.`{name}`")


def replace_table(df: DataFrame, database: str, name: str) -> None:
    """Write anew, with whatever columns and types ``df`` has."""
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")


def load_sources(
    spark: SparkSession, frames: Mapping[str, DataFrame], database: str, location: str | None = None
) -> None:
    """Declare all tables, then clean-load the given sources into theirs."""
    create_tables(spark, database, location)
    for name, df in frames.items():
        append_table(df, database, name)


def append_log(entries: DataFrame, database: str, name: str = LOG_TABLE) -> None:
    """Append log rows; id and time are filled in here, and the day to partition by."""
    stamped = entries.select(
        F.uuid().alias("log_id"), F.current_timestamp().alias("created_at"), "*"
    ).withColumn(LOG_DAY, F.to_date("created_at"))
    columns = [*TABLE_SCHEMAS[LOG_TABLE].names, LOG_DAY]
    stamped.select(*columns).write.mode("append").format("parquet").partitionBy(LOG_DAY).saveAsTable(
        f"`{database}`.`{name}`"
    )


def run_merge_statement(
    spark: SparkSession,
    tables: Sequence[str],
    key: str,
    database: str | None = None,
    trace: str | None = None,
) -> DataFrame:
    """Run the merge as SQL over tables or views. With ``trace`` the statement is kept there, as a file
    or, below a URL, as a one-line text table."""
    statement = merge_sql(list(tables), key, database)
    if trace and "://" in trace:
        text = spark.createDataFrame([(statement.replace("\n", " ") + ";",)], "value string")
        text.coalesce(1).write.mode("overwrite").text(trace)
    elif trace:
        file = Path(trace)
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(statement + ";\n", encoding="utf-8")
    return spark.sql(statement)
