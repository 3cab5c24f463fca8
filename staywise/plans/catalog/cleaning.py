"""Cleaning, keys, merge and feature derivation on the given tables."""

from pyspark.sql import functions as F

from staywise import functions as fn
from staywise import values
from staywise.operators import cleaning, features, merging, quality
from staywise.plans.catalog.registry import (
    DIRTY_NAME,
    DIRTY_TYPE,
    DIRTY_VALUE,
    EVALUATION_SQL,
    HR_SQL,
    SURVEY_SQL,
    query,
    raw_sources,
    sql_list,
    table,
)
from staywise.sources.tables import run_merge_statement

BLANKS = "concat(' ', chr(9), chr(10), chr(13))"
TOKENS = sql_list(values.NULL_TOKENS)


@query(
    "clean_text",
    f"""SELECT event_type, count(*) AS n FROM (
        SELECT CASE WHEN raw IN ({TOKENS}) THEN NULL ELSE trim(raw, {BLANKS}) END AS event_type
        FROM (SELECT {DIRTY_TYPE} AS raw FROM events)) GROUP BY event_type""",
)
def clean_text(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.expr(DIRTY_TYPE).alias("event_type"))
    return cleaning.clean_text(raw).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_text_strict",
    f"""SELECT event_type, count(*) AS n FROM (
        SELECT CASE WHEN trim(raw, {BLANKS}) IN ({TOKENS}) THEN NULL ELSE trim(raw, {BLANKS}) END AS event_type
        FROM (SELECT {DIRTY_TYPE} AS raw FROM events)) GROUP BY event_type""",
)
def clean_text_strict(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.expr(DIRTY_TYPE).alias("event_type"))
    cleaned = cleaning.clean_text(raw, "strict")
    return cleaned.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_documents",
    f"""SELECT lang, count(*) AS n, cast(sum(length(cleaned)) AS bigint) AS n_chars,
        count(DISTINCT cleaned) AS n_distinct FROM (
        SELECT lang, CASE WHEN text IN ({TOKENS}) THEN NULL ELSE trim(text, {BLANKS}) END AS cleaned
        FROM documents) GROUP BY lang""",
)
def clean_documents(spark, sf_dir):
    """Whole texts through the same cleaning; distinct texts are counted by md5, so none is shuffled."""
    cleaned = cleaning.clean_text(table(spark, sf_dir, "documents").select("lang", "text"), columns=["text"])
    return cleaned.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("n_chars"),
        F.countDistinct(F.md5("text")).alias("n_distinct"),
    )


@query(
    "harmonize_id",
    f"""SELECT c_custkey, try_cast(nullif(regexp_extract({DIRTY_NAME}, '([0-9]+)', 1), '') AS bigint)
        AS id_employee FROM customer""",
)
def harmonize_id(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.expr(DIRTY_NAME).alias("raw_key"))
    renamed = cleaning.rename_column(raw, "raw_key", "id_employee")
    return cleaning.harmonize_id(renamed, "id_employee")


@query(
    "id_diagnostics",
    f"""SELECT source, count(*) AS n_rows, count(DISTINCT id_employee) AS n_distinct,
        count(*) - count(DISTINCT id_employee) AS n_duplicates FROM (
        SELECT 'sirh' AS source, id_employee FROM ({HR_SQL})
        UNION ALL SELECT 'evaluation', o_custkey FROM orders
        UNION ALL SELECT 'sond', id_employee FROM ({SURVEY_SQL})) GROUP BY source""",
)
def id_diagnostics(spark, sf_dir):
    sources = raw_sources(spark, sf_dir)
    frames = {
        "sirh": cleaning.prepare_source(sources["sirh"].select("id_employee")),
        "evaluation": table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id_employee")),
        "sond": cleaning.prepare_source(
            sources["sond"].select("code_sondage"), "id_employee", "code_sondage"
        ),
    }
    return merging.id_diagnostics(frames, "id_employee")


TARGET_TEXT = """CASE event_type WHEN 'purchase' THEN ' Oui ' WHEN 'view' THEN 'NON' WHEN 'click' THEN 'false'
    WHEN 'signup' THEN '1.0' ELSE 'perhaps' END"""


@query(
    "normalize_target",
    """SELECT left_company, count(*) AS n FROM (SELECT CASE event_type WHEN 'purchase' THEN 1
        WHEN 'view' THEN 0 WHEN 'click' THEN 0 END AS left_company FROM events)
        WHERE left_company IS NOT NULL GROUP BY left_company""",
)
def normalize_target(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.expr(TARGET_TEXT).alias("left_company"))
    kept = cleaning.normalize_target(raw, "left_company")
    return kept.groupBy("left_company").agg(F.count(F.lit(1)).alias("n"))


@query(
    "invalid_targets",
    """SELECT count(*) AS n_rows, count(*) FILTER (event_type NOT IN ('purchase', 'view', 'click')) AS n_dropped
        FROM events""",
)
def invalid_targets(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.expr(TARGET_TEXT).alias("left_company"))
    return cleaning.invalid_targets(raw, "left_company")


SEGMENT_SYNONYMS = {
    "automobile": "Industry",
    "machinery": "Industry",
    "building": "Construction",
    "furniture": "Home",
}


@query(
    "normalize_category",
    """SELECT segment, count(*) AS n FROM (SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Industry'
        WHEN 'MACHINERY' THEN 'Industry' WHEN 'BUILDING' THEN 'Construction' WHEN 'FURNITURE' THEN 'Home'
        ELSE c_mktsegment END AS segment FROM customer) GROUP BY segment""",
)
def normalize_category(spark, sf_dir):
    padded = "CASE WHEN c_custkey % 2 = 0 THEN concat('  ', c_mktsegment, ' ') ELSE c_mktsegment END"
    raw = table(spark, sf_dir, "customer").select(F.expr(padded).alias("segment"))
    spelled = cleaning.normalize_categories(raw, {"segment": SEGMENT_SYNONYMS})
    return spelled.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "extract_code",
    """SELECT o_orderpriority, cast(substr(o_orderpriority, 1, 1) AS double) AS code, count(*) AS n
        FROM orders GROUP BY o_orderpriority""",
)
def extract_code(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority")
    coded = orders.withColumn("code", fn.extract_code(F.col("o_orderpriority")))
    return coded.groupBy("o_orderpriority", "code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "parse_percent",
    """SELECT l_returnflag, count(*) AS n, round(sum(round(l_discount * 100) / 100.0), 4) AS total,
        round(max(round(l_discount * 100) / 100.0), 4) AS highest FROM lineitem GROUP BY l_returnflag""",
)
def parse_percent(spark, sf_dir):
    digits = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    text = F.when(F.col("l_linenumber") % 2 == 0, F.concat(digits, F.lit(",0 %"))).otherwise(
        F.concat(digits, F.lit("%"))
    )
    parsed = table(spark, sf_dir, "lineitem").select("l_returnflag", fn.parse_percent(text).alias("raise"))
    return parsed.groupBy("l_returnflag").agg(
        F.count("raise").alias("n"),
        F.round(F.sum("raise"), 4).alias("total"),
        F.round(F.max("raise"), 4).alias("highest"),
    )


NUMBER_SQL = """CASE event_id % 11 WHEN 4 THEN 7.0 WHEN 5 THEN 1000.0 WHEN 6 THEN -0.5 WHEN 9 THEN event_id
    WHEN 10 THEN event_id END"""


@query(
    "to_number",
    f"""SELECT event_type, count(*) AS n, count(x) AS n_numbers, cast(sum(coalesce(x, 0)) AS double) AS total
        FROM (SELECT event_type, cast({NUMBER_SQL} AS double) AS x FROM events) GROUP BY event_type""",
)
def to_number(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_type", F.expr(DIRTY_VALUE).alias("x"))
    numbers = cleaning.to_numbers(raw, ["x", "absent"])
    return numbers.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("x").alias("n_numbers"),
        F.sum(fn.zero_if_missing(F.col("x"))).alias("total"),
    )


@query(
    "drop_all_null",
    """SELECT count(*) AS n, count(a) AS n_a, count(b) AS n_b FROM (
        SELECT CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS a,
        CASE WHEN value < 20 THEN NULL ELSE value END AS b FROM events) WHERE a IS NOT NULL OR b IS NOT NULL""",
)
def drop_all_null(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("a"),
        F.when(F.col("value") >= 20, F.col("value")).alias("b"),
    )
    kept = cleaning.drop_empty_rows(rows)
    return kept.agg(F.count(F.lit(1)).alias("n"), F.count("a").alias("n_a"), F.count("b").alias("n_b"))


def prepared(spark, sf_dir):
    keys = {"sirh": None, "evaluation": "eval_number", "sond": "code_sondage"}
    return {
        name: cleaning.prepare_source(df, "id_employee", keys[name])
        for name, df in raw_sources(spark, sf_dir).items()
    }


MERGED_SQL = f"""SELECT h.id_employee, h.income, h.segment, h.nation, e.n, e.mean_price, s.n AS n_sond,
    s.mean_value, s.bought FROM ({HR_SQL}) h JOIN ({EVALUATION_SQL}) e USING (id_employee)
    JOIN ({SURVEY_SQL}) s USING (id_employee)"""


@query("merge_sources", MERGED_SQL)
def merge_sources(spark, sf_dir):
    return merging.merge_sources(prepared(spark, sf_dir), "id_employee")


@query("merge_sql", MERGED_SQL)
def merge_sql(spark, sf_dir):
    """The merge as a SQL statement over registered tables."""
    frames = prepared(spark, sf_dir)
    frames["sond"] = frames["sond"].withColumnRenamed("n", "n_sond")
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return run_merge_statement(spark, list(frames), "id_employee")


@query(
    "merge_null_safe",
    """SELECT (k IS NULL) AS no_key, count(*) AS n, round(sum(income), 2) AS income, cast(sum(orders) AS bigint) AS orders
        FROM (SELECT nullif(c_nationkey, 7) AS k, c_acctbal AS income FROM customer) h
        JOIN (SELECT nullif(c_nationkey, 7) AS k, count(*) AS orders FROM orders
            JOIN customer ON o_custkey = c_custkey GROUP BY 1) e USING (k) GROUP BY 1
        UNION ALL
        SELECT true, count(*), round(sum(c_acctbal), 2), cast(sum(o.n) AS bigint) FROM customer,
        (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7) o
        WHERE c_nationkey = 7""",
)
def merge_null_safe(spark, sf_dir):
    """Null keys match each other, as in the merge of data frames; one null group on the small side."""
    customer = table(spark, sf_dir, "customer")
    key = F.nullif(F.col("c_nationkey"), F.lit(7)).alias("k")
    staff = customer.select(key, F.col("c_acctbal").alias("income"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    per_key = (
        orders.join(customer.select("c_custkey", key), "c_custkey")
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    merged = merging.merge_sources({"staff": staff, "orders": per_key}, "k", null_safe=True)
    return merged.groupBy(F.col("k").isNull().alias("no_key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("income"), 2).alias("income"),
        F.sum("orders").alias("orders"),
    )


@query(
    "ratio_features",
    """SELECT l_discount, l_tax, round(l_tax / nullif(l_discount, 0), 6) AS tax_by_discount,
        round(l_discount / nullif(l_tax, 0), 6) AS discount_by_tax, count(*) AS n
        FROM lineitem GROUP BY l_discount, l_tax""",
)
def ratio_features(spark, sf_dir):
    ratios = [
        ("tax_by_discount", "l_tax", "l_discount"),
        ("discount_by_tax", "l_discount", "l_tax"),
        ("skipped", "l_tax", "absent"),
    ]
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_discount", "l_tax").agg(F.count(F.lit(1)).alias("n"))
    made = features.add_ratios(pairs, ratios)
    return made.withColumns({c: F.round(c, 6) for c in ("tax_by_discount", "discount_by_tax")})


NULLABLE = {
    "a": "CASE WHEN l_linenumber < 5 THEN l_quantity END",
    "b": "CASE WHEN l_returnflag <> 'R' THEN l_discount * 100 END",
    "c": "CASE WHEN l_linestatus = 'O' THEN l_tax * 100 END",
}


@query(
    "row_mean",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS n, count(m) AS n_means, round(avg(m), 6) AS mean_of_means
        FROM (SELECT l_returnflag, l_linestatus, (coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif(
            (a IS NOT NULL)::int + (b IS NOT NULL)::int + (c IS NOT NULL)::int, 0) AS m
        FROM (SELECT l_returnflag, l_linestatus, {', '.join(f'{e} AS {c}' for c, e in NULLABLE.items())}
        FROM lineitem)) GROUP BY l_returnflag, l_linestatus""",
)
def row_mean(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", *[F.expr(e).alias(c) for c, e in NULLABLE.items()]
    )
    made = features.add_row_mean(rows, ["a", "b", "c", "absent"], "m")
    return made.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("m").alias("n_means"),
        F.round(F.avg("m"), 6).alias("mean_of_means"),
    )


@query(
    "score_delta",
    """SELECT p_brand, count(*) AS n, round(avg(p_retailprice - p_size), 6) AS mean_change FROM part GROUP BY p_brand""",
)
def score_delta(spark, sf_dir):
    made = features.add_deltas(table(spark, sf_dir, "part"), [("change", "p_retailprice", "p_size")])
    return made.groupBy("p_brand").agg(
        F.count("change").alias("n"), F.round(F.avg("change"), 6).alias("mean_change")
    )


# A raw employee table with the contract's own column names, made from customers and their orders.
EMPLOYEE = {
    "id_employee": "c_custkey",
    "genre": "CASE WHEN c_nationkey < 12 THEN ' Femme' ELSE 'homme ' END",
    "departement": "lower(c_mktsegment)",
    "niveau_hierarchique_poste": "CASE WHEN c_nationkey > 20 THEN 'Senior' ELSE concat(c_nationkey, ', junior') END",
    "revenu_mensuel": "cast(c_acctbal AS varchar(30))",
    "augementation_salaire_precedente": "concat(cast(c_nationkey AS varchar(10)), CASE WHEN c_nationkey > 9 THEN '%' ELSE ',5 %' END)",
    "annee_experience_totale": "cast(n AS varchar(20))",
    "annees_dans_le_poste_actuel": "cast(n_open AS varchar(20))",
    "nb_formations_suivies": "CASE WHEN n_open > 4 THEN 'x' ELSE cast(n_open AS varchar(20)) END",
    "annees_depuis_la_derniere_promotion": "cast(n_urgent AS varchar(20))",
    "satisfaction_employee_environnement": "cast(n_urgent AS varchar(20))",
    "satisfaction_employee_equipe": "CASE WHEN n_urgent > 2 THEN NULL ELSE '4' END",
    "note_evaluation_actuelle": "cast(n_open AS varchar(20))",
    "note_evaluation_precedente": "cast(n_urgent AS varchar(20))",
}
ORDER_COUNTS = {
    "n": "count(*)",
    "n_open": "sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)",
    "n_urgent": "sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)",
}
ORDERS_SQL = f"SELECT o_custkey, {', '.join(f'{e} AS {c}' for c, e in ORDER_COUNTS.items())} FROM orders GROUP BY o_custkey"


def raw_employees(spark, sf_dir):
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(*[F.expr(e).alias(c) for c, e in ORDER_COUNTS.items()])
    )
    customers = table(spark, sf_dir, "customer").join(counts, "c_custkey")
    return customers.select(*[F.expr(e).alias(c) for c, e in EMPLOYEE.items()])


@query(
    "derive_features",
    f"""WITH e AS (SELECT c.*, o.*, CASE WHEN c_nationkey > 9 THEN c_nationkey ELSE c_nationkey + 0.5 END / 100.0 AS raise
        FROM customer c JOIN ({ORDERS_SQL}) o ON o_custkey = c_custkey)
    SELECT c_custkey AS id_employee, CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS genre,
        lower(c_mktsegment) AS departement,
        CASE WHEN c_nationkey <= 20 THEN cast(c_nationkey AS double) END AS niveau_hierarchique_poste,
        round(raise, 6) AS augementation_salaire_precedente,
        round(raise / nullif(c_acctbal, 0), 9) AS augmentation_par_revenu,
        round(n_open / nullif(n, 0), 6) AS annee_sur_poste_par_experience,
        round(CASE WHEN n_open <= 4 THEN n_open END / nullif(n, 0), 6) AS nb_formation_par_experience,
        round(n_urgent / nullif(n, 0), 6) AS dern_promo_par_experience,
        round(CASE WHEN n_urgent > 2 THEN n_urgent ELSE (n_urgent + 4) / 2.0 END, 6) AS score_moyen_satisfaction,
        cast(n_open - n_urgent AS double) AS evolution_note FROM e""",
)
def derive_features(spark, sf_dir):
    made = features.derive_features(raw_employees(spark, sf_dir))
    rounded = {
        "augementation_salaire_precedente": 6,
        "augmentation_par_revenu": 9,
        "annee_sur_poste_par_experience": 6,
        "nb_formation_par_experience": 6,
        "dern_promo_par_experience": 6,
        "score_moyen_satisfaction": 6,
    }
    kept = ["id_employee", "genre", "departement", "niveau_hierarchique_poste", "evolution_note"]
    return made.select(*kept, *[F.round(c, digits).alias(c) for c, digits in rounded.items()])


@query(
    "dq_checks",
    """SELECT rule, n_checked, n_bad FROM (
        SELECT 'key_null' AS rule, count(*) AS n_checked, count(*) FILTER (id IS NULL) AS n_bad FROM
            (SELECT nullif(o_custkey, 5) AS id FROM orders)
        UNION ALL SELECT 'key_not_integer', count(*), 0 FROM orders
        UNION ALL SELECT 'target_outside', count(*), count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders
        UNION ALL SELECT 'row_count_kept', count(*), abs(count(*) - (SELECT count(*) FROM customer)) FROM orders)""",
)
def dq_checks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_custkey"), F.lit(5)).alias("id"), "o_orderstatus"
    )
    expected = table(spark, sf_dir, "customer").count()
    return quality.integrity_checks(orders, "id", "o_orderstatus", ["O", "F"], expected)


DOMAIN_RULES = {"p_type": ("ECONOMY", "SMALL", "LARGE"), "p_size": (5.0, 40.0), "p_brand": ("Brand#1", "Brand#2")}


@query(
    "dq_domain",
    """SELECT 'p_type' AS "column", count(t) AS n_checked, count(*) - count(t) AS n_null,
            count(*) FILTER (t NOT IN ('ECONOMY', 'SMALL', 'LARGE')) AS n_bad
            FROM (SELECT nullif(p_type, 'MEDIUM') AS t FROM part)
        UNION ALL SELECT 'p_size', count(p_size), 0, count(*) FILTER (p_size < 5 OR p_size > 40) FROM part
        UNION ALL SELECT 'p_brand', count(p_brand), 0, count(*) FILTER (p_brand NOT IN ('Brand#1', 'Brand#2')) FROM part""",
)
def dq_domain(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("p_type", F.nullif(F.col("p_type"), F.lit("MEDIUM")))
    return quality.domain_checks(part, DOMAIN_RULES)


@query(
    "dq_quarantine",
    """SELECT n_faults, count(*) AS n FROM (SELECT
        (p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE'))::int + (p_size < 5 OR p_size > 40)::int
        + (p_brand NOT IN ('Brand#1', 'Brand#2'))::int AS n_faults FROM part) GROUP BY n_faults""",
)
def dq_quarantine(spark, sf_dir):
    good, bad = quality.quarantine(table(spark, sf_dir, "part"), DOMAIN_RULES)
    faults = good.select(F.lit(0).alias("n_faults")).unionByName(
        bad.select(F.size("faults").alias("n_faults"))
    )
    return faults.groupBy("n_faults").agg(F.count(F.lit(1)).alias("n"))


@query(
    "align_features",
    """SELECT l_tax, cast(NULL AS double) AS absent, l_quantity, cast(NULL AS varchar) AS absent_text, count(*) AS n
        FROM lineitem GROUP BY l_tax, l_quantity""",
)
def align_features(spark, sf_dir):
    """Model order: two columns that exist, two that do not; target and key are dropped on the way."""
    expected = {"l_tax": "double", "absent": "double", "l_quantity": "double", "absent_text": "string"}
    lineitem = table(spark, sf_dir, "lineitem").drop("l_returnflag", "not_there")
    aligned = cleaning.align_features(lineitem, expected)
    return aligned.groupBy(*expected).agg(F.count(F.lit(1)).alias("n"))


@query(
    "rate_by_segment",
    f"""SELECT segment, count(*) AS n, round(avg(bought) * 100, 6) AS rate_pct,
        round(avg(price_by_income), 6) AS mean_price_by_income
        FROM (SELECT segment, bought, mean_price / nullif(income, 0) AS price_by_income FROM ({MERGED_SQL}))
        GROUP BY segment""",
)
def flagship(spark, sf_dir):
    """Three dirty sources to a rate per group: clean, key, merge, ratio, aggregate, in one plan."""
    merged = merging.merge_sources(prepared(spark, sf_dir), "id_employee")
    made = features.add_ratios(merged, [("price_by_income", "mean_price", "income")])
    return (
        made.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("bought") * 100, 6).alias("rate_pct"),
            F.round(F.avg("price_by_income"), 6).alias("mean_price_by_income"),
        )
        .orderBy(F.desc("rate_pct"), "segment")
    )
