"""Registration of queries, and the tables and made-dirty columns they share.

The given tables have no missing-value tokens, dirty keys or null measures. Where an operator needs them they are
put in by expressions that both engines evaluate to the same value; no row is left out for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the statement that must give the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_list(texts) -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in texts)


# Expressions that mean the same in both engines.
DIRTY_TYPE = """CASE event_id % 17
    WHEN 0 THEN 'Unknown' WHEN 1 THEN ' Unknown ' WHEN 2 THEN '' WHEN 3 THEN 'nan' WHEN 4 THEN '     '
    WHEN 5 THEN 'JE ne sais pas' WHEN 6 THEN concat('  ', event_type, ' ') WHEN 7 THEN 'unknown'
    ELSE event_type END"""
DIRTY_NAME = "CASE WHEN c_custkey % 13 = 0 THEN 'missing' ELSE c_name END"
DIRTY_VALUE = """CASE event_id % 11
    WHEN 0 THEN 'x' WHEN 1 THEN 'nan' WHEN 2 THEN '1,5' WHEN 3 THEN '12d' WHEN 4 THEN ' 7 ' WHEN 5 THEN '1e3'
    WHEN 6 THEN '-.5' WHEN 7 THEN '5%' WHEN 8 THEN '' ELSE cast(event_id AS varchar(20)) END"""
# 0/1 target, and a score that carries some signal about it.
IS_PURCHASE = "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END"
PROPS_K = "cast(regexp_extract(props, '([0-9]+)', 1) AS int)"
SCORE = f"""(0.7 * value / (value + 50.0)
    + CASE WHEN event_type = 'purchase' AND {PROPS_K} > 33 THEN 0.25 ELSE 0.0 END)"""
IS_FINISHED = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"
IS_RETURNED = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"

# The three sources of an employee table, as SQL and as DataFrames.
HR_SQL = f"""SELECT try_cast(nullif(regexp_extract({DIRTY_NAME}, '([0-9]+)', 1), '') AS bigint) AS id_employee,
    c_acctbal AS income, c_mktsegment AS segment, c_nationkey AS nation FROM customer"""
EVALUATION_SQL = """SELECT o_custkey AS id_employee, count(*) AS n, round(sum(o_totalprice), 2) / count(*) AS mean_price
    FROM orders GROUP BY o_custkey"""
SURVEY_SQL = f"""SELECT user_id AS id_employee, count(*) AS n, round(sum(value), 2) / count(*) AS mean_value,
    max({IS_PURCHASE}) AS bought FROM events GROUP BY user_id"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, score) of the events: the one projection that the metric queries read."""
    return table(spark, sf_dir, "events").select(
        F.expr(IS_PURCHASE).alias("label"), F.expr(SCORE).alias("score")
    )


SCORED_SQL = f"SELECT {IS_PURCHASE} AS label, {SCORE} AS score FROM events"


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three sources with dirty text keys under three names, as they come from their owners."""
    hr = table(spark, sf_dir, "customer").select(
        F.expr(DIRTY_NAME).alias("id_employee"),
        F.col("c_acctbal").alias("income"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    evaluation = (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat(F.lit("E-"), F.col("o_custkey")).alias("eval_number"))
        .agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1))).alias("mean_price"))
    )
    survey = (
        table(spark, sf_dir, "events")
        .groupBy(F.concat(F.lit("S"), F.col("user_id"), F.lit("-24")).alias("code_sondage"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.round(F.sum("value"), 2) / F.count(F.lit(1))).alias("mean_value"),
            F.max(F.expr(IS_PURCHASE)).alias("bought"),
        )
    )
    return {"sirh": hr, "evaluation": evaluation, "sond": survey}
