"""Exploratory statistics on the given tables."""

from pyspark.sql import functions as F

from staywise.operators import stats
from staywise.plans.catalog.registry import IS_FINISHED, IS_PURCHASE, IS_RETURNED, query, table


def finished_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("finished", F.expr(IS_FINISHED))


def purchases(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("bought", F.expr(IS_PURCHASE))


def returned_items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("returned", F.expr(IS_RETURNED))


@query(
    "global_stats",
    f"""SELECT count(*) AS n, round(avg(o_totalprice), 1) AS mean_o_totalprice,
        round(avg({IS_FINISHED}) * 100, 1) AS rate_pct FROM orders""",
)
def global_stats(spark, sf_dir):
    return stats.global_stats(finished_orders(spark, sf_dir), ["o_totalprice"], "finished")


@query(
    "class_balance",
    f"""SELECT bought, n, round(n * 100.0 / sum(n) OVER (), 2) AS share_pct
        FROM (SELECT {IS_PURCHASE} AS bought, count(*) AS n FROM events GROUP BY 1)""",
)
def class_balance(spark, sf_dir):
    return stats.class_balance(purchases(spark, sf_dir), "bought")


@query(
    "group_rate",
    f"""SELECT o_orderpriority, count(*) AS n, avg({IS_FINISHED}) * 100 AS rate_pct
        FROM orders GROUP BY o_orderpriority""",
)
def group_rate(spark, sf_dir):
    return stats.group_rate(finished_orders(spark, sf_dir), "o_orderpriority", "finished")


CROSSTAB_SQL = f"""SELECT o_orderpriority, count(*) FILTER ({IS_FINISHED} = 0) AS n_0,
    count(*) FILTER ({IS_FINISHED} = 1) AS n_1 FROM orders GROUP BY o_orderpriority"""


@query("crosstab", CROSSTAB_SQL)
def crosstab(spark, sf_dir):
    return stats.crosstab(finished_orders(spark, sf_dir), "o_orderpriority", "finished")


@query("crosstab_head", f"{CROSSTAB_SQL} ORDER BY o_orderpriority LIMIT 3")
def crosstab_head(spark, sf_dir):
    """The first rows of the table by category, as a report prints them."""
    return stats.crosstab(finished_orders(spark, sf_dir), "o_orderpriority", "finished", limit=3)


def _chi2_sql(source: str, category: str, target: str) -> str:
    """χ² with Yates' correction for two categories; for four degrees of freedom the p-value is elementary."""
    return f"""WITH ct AS (SELECT {category} AS c, {target} AS t, count(*) AS o FROM {source}
            WHERE {category} IS NOT NULL GROUP BY 1, 2),
        grid AS (SELECT r.c, s.t, coalesce(ct.o, 0) AS o, r.n * s.n / (SELECT sum(o) FROM ct) AS e
            FROM (SELECT c, sum(o) AS n FROM ct GROUP BY c) r
            CROSS JOIN (SELECT t, sum(o) AS n FROM ct GROUP BY t) s LEFT JOIN ct ON ct.c = r.c AND ct.t = s.t),
        k AS (SELECT count(DISTINCT c) AS k FROM ct)
        SELECT '{category}' AS category, round(sum(power(CASE WHEN k = 2 THEN greatest(abs(o - e) - 0.5, 0)
            ELSE abs(o - e) END, 2) / e), 6) AS chi2, cast(max(k) - 1 AS int) AS dof,
            cast(sum(o) AS bigint) AS n FROM grid, k"""


@query(
    "chi2",
    f"""SELECT *, CASE WHEN dof = 4 THEN round(exp(-chi2 / 2) * (1 + chi2 / 2), 6) END AS p_value FROM (
        {_chi2_sql("orders", "o_orderpriority", IS_FINISHED)})""",
)
def chi2(spark, sf_dir):
    found = stats.chi2_test(finished_orders(spark, sf_dir), "o_orderpriority", "finished")
    return found.withColumns({"chi2": F.round("chi2", 6), "p_value": F.round("p_value", 6)})


@query("chi2_two_by_two", _chi2_sql("lineitem", "l_linestatus", IS_RETURNED))
def chi2_two_by_two(spark, sf_dir):
    items = returned_items(spark, sf_dir).na.drop(subset=["l_linestatus"])
    found = stats.chi2_test(items, "l_linestatus", "returned", p_value=False)
    return found.withColumn("chi2", F.round("chi2", 6))


@query(
    "anova",
    f"""WITH x AS (SELECT {IS_PURCHASE} AS t, nullif(value, 1.0) AS v FROM events WHERE value <> 1.0),
        g AS (SELECT t, count(*) AS n, avg(v) AS m, var_pop(v) AS s FROM x GROUP BY t),
        a AS (SELECT sum(n) AS n, sum(n * m) / sum(n) AS m FROM g)
        SELECT 'v' AS feature, round(sum(g.n * power(g.m - a.m, 2)) / (sum(g.n * g.s) / (max(a.n) - 2)), 6) AS f_stat,
        1 AS df_between, cast(max(a.n) - 2 AS bigint) AS df_within FROM g, a""",
)
def anova(spark, sf_dir):
    rows = purchases(spark, sf_dir).withColumn("v", F.nullif(F.col("value"), F.lit(1.0)))
    found = stats.anova_test(rows, "v", "bought", p_value=False)
    return found.withColumn("f_stat", F.round("f_stat", 6))


# Upper tail of F(1, d): an integral of a power of the cosine, here by Simpson's rule.
TAIL_SQL = """SELECT feature, f_stat, df_between, df_within, round(2 * exp(lgamma((d + 1) / 2) - lgamma(d / 2))
        / sqrt(pi()) * sum(w * exp((d - 1) * ln(cos(a + i * h)))) * h / 3, 6) AS p_value
    FROM (SELECT *, df_within::DOUBLE AS d, atan(sqrt(f_stat / df_within)) AS a,
        (pi() / 2 - 1e-9 - atan(sqrt(f_stat / df_within))) / 200000 AS h FROM f),
        (SELECT i, CASE WHEN i IN (0, 200000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
        FROM (SELECT unnest(range(200001)) AS i)) GROUP BY feature, f_stat, df_between, df_within, d, h"""


@query(
    "anova_p_value",
    f"""WITH g AS (SELECT l_linestatus = 'O' AS t, count(*) AS n, avg(l_quantity) AS m, var_pop(l_quantity) AS s
            FROM lineitem GROUP BY 1),
        a AS (SELECT sum(n) AS n, sum(n * m) / sum(n) AS m FROM g),
        f AS (SELECT 'l_quantity' AS feature, round(sum(g.n * power(g.m - a.m, 2)) / (sum(g.n * g.s) / (max(a.n) - 2)), 9) AS f_stat,
            1 AS df_between, cast(max(a.n) - 2 AS bigint) AS df_within FROM g, a)
        {TAIL_SQL}""",
)
def anova_p_value(spark, sf_dir):
    """The test with its p-value, the upper tail of the F distribution."""
    items = table(spark, sf_dir, "lineitem").withColumn("open", F.expr("int(l_linestatus = 'O')"))
    found = stats.anova_test(items, "l_quantity", "open")
    return found.withColumns({"f_stat": F.round("f_stat", 9), "p_value": F.round("p_value", 6)})


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SPARSE_TAX = "CASE WHEN l_returnflag <> 'R' THEN l_tax END"


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r "
        f"FROM (SELECT * REPLACE ({SPARSE_TAX} AS l_tax) FROM lineitem)"
        for a in MEASURES
        for b in MEASURES
    ),
)
def corr_matrix(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.expr(SPARSE_TAX))
    return stats.correlation_matrix(items, MEASURES).withColumn("r", F.round("r", 6))


@query(
    "spearman",
    """WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
            rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b
            FROM lineitem)
        SELECT 'l_quantity' AS feature_a, 'l_extendedprice' AS feature_b, count(*) AS n, round(corr(a, b), 6) AS rho FROM r""",
)
def spearman(spark, sf_dir):
    found = stats.spearman(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return found.withColumn("rho", F.round("rho", 6))


def _box_sql(source: str, target: str, name: str, columns: list[str]) -> str:
    parts = [
        f"""SELECT t AS {name}, '{c}' AS feature, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
            count(*) AS n,
            round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
            round(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
            count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
            FROM (SELECT {target} AS t, {c} AS v FROM {source}) JOIN (SELECT {target} AS t,
            quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3
            FROM {source} GROUP BY 1) USING (t) WHERE v IS NOT NULL GROUP BY t, q1, q2, q3"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


BOX_FIGURES = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query("box_stats", _box_sql("events", IS_PURCHASE, "bought", ["value"]))
def box_stats(spark, sf_dir):
    found = stats.box_stats(purchases(spark, sf_dir), ["value"], "bought")
    return found.withColumns({c: F.round(c, 6) for c in BOX_FIGURES})


def _kde_sql(source: str, target: str, name: str, column: str, points: int, digits: int = 9) -> str:
    return f"""WITH d AS (SELECT {target} AS t, {column} AS v FROM {source}),
        p AS (SELECT t, count(*) AS n, power(count(*), -0.2) * stddev_samp(v) AS bw, min(v) AS lo, max(v) AS hi
            FROM d GROUP BY t),
        g AS (SELECT t, n, bw, i, lo - 3 * bw + i * ((hi + 3 * bw) - (lo - 3 * bw)) / {points - 1} AS x
            FROM p, (SELECT unnest(range({points})) AS i))
        SELECT t AS {name}, cast(i AS int) AS point, round(x, 6) AS x,
            round(sum(exp(-0.5 * power((x - v) / bw, 2))) / (max(n) * max(bw) * sqrt(2 * pi())), {digits}) AS density
        FROM g JOIN d USING (t) GROUP BY t, i, x"""


@query("kde", _kde_sql("events", IS_PURCHASE, "bought", "value", 64))
def kde(spark, sf_dir):
    curve = stats.kernel_density(purchases(spark, sf_dir), "value", "bought")
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query("kde_binned", _kde_sql("events", IS_PURCHASE, "bought", "value", 64, digits=7))
def kde_binned(spark, sf_dir):
    """The same curves from bins, equal to those from the rows in all digits given."""
    curve = stats.kernel_density(purchases(spark, sf_dir), "value", "bought", nodes=2048)
    return curve.withColumns({"x": F.round("x", 6), "density": F.round("density", 7)})


@query("violin_stats", _box_sql("lineitem", IS_RETURNED, "returned", MEASURES))
def violin_stats(spark, sf_dir):
    boxes = stats.box_stats(returned_items(spark, sf_dir), MEASURES, "returned")
    return boxes.withColumns({c: F.round(c, 6) for c in BOX_FIGURES})


@query(
    "violin_curves",
    " UNION ALL ".join(
        f"SELECT *, '{c}' AS feature FROM ({_kde_sql('lineitem', IS_RETURNED, 'returned', c, 32)})"
        for c in MEASURES
    ),
)
def violin_curves(spark, sf_dir):
    curves = stats.density_curves(returned_items(spark, sf_dir), MEASURES, "returned")
    return curves.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query(
    "scatter_bins",
    f"""SELECT cast(floor(l_quantity / 5) AS bigint) AS x_bin, cast(floor(l_extendedprice / 10000) AS bigint) AS y_bin,
        {IS_RETURNED} AS returned, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def scatter_bins(spark, sf_dir):
    return stats.scatter_bins(
        returned_items(spark, sf_dir), "l_quantity", "l_extendedprice", "returned", 5.0, 10000.0
    )
