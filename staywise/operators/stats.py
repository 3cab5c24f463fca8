"""Exploratory statistics of a table with a 0/1 target.

The target has two classes, so per-class figures are conditional aggregates or a grouping by the class after a
map-side combine: no row of data is shuffled by class.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise.functions.tails import chi2_p_value, f_p_value
from staywise.operators.ordering import (
    ROWS_PER_BUCKET,
    exact_quantiles,
    melt,
    order_splits_of,
    running_totals,
)
from staywise.operators.skew import MIN_ROWS, draw_salt, hot_keys, skew_join
from staywise.session import materialize


def global_stats(df: DataFrame, means: Sequence[str], target: str) -> DataFrame:
    """Rounded means and the overall rate in percent, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(c), 1).alias(f"mean_{c}") for c in means],
        F.round(F.avg(target) * 100, 1).alias("rate_pct"),
    )


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows and percent share per class, by class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per class
    return counts.withColumn("share_pct", F.round(F.col("n") * 100.0 / total, 2)).orderBy(target)


def group_rate(df: DataFrame, group: str, target: str) -> DataFrame:
    """Percent of the target per group, highest first."""
    return (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), (F.avg(target) * 100).alias("rate_pct"))
        .orderBy(F.desc("rate_pct"), F.asc(group))
    )


def crosstab(df: DataFrame, category: str, target: str, limit: int | None = None) -> DataFrame:
    """Rows per category and class (``n_0``, ``n_1``); rows with a null in either are left out."""
    table = (
        df.where(F.col(category).isNotNull() & F.col(target).isNotNull())
        .groupBy(category)
        .agg(
            F.count_if(F.col(target) == 0).alias("n_0"),
            F.count_if(F.col(target) == 1).alias("n_1"),
        )
    )
    return table.orderBy(category).limit(limit) if limit else table


def chi2_test(df: DataFrame, category: str, target: str, p_value: bool = True) -> DataFrame:
    """χ² test of independence between a category and a 0/1 target; Yates' correction for a 2×2 table.

    One aggregate over the contingency table, whose class totals are a scalar subquery on the same
    shuffle: it holds for any number of categories.
    """
    table = crosstab(df, category, target)
    totals = table.agg(
        F.struct(F.sum("n_0").alias("c0"), F.sum("n_1").alias("c1"), F.count(F.lit(1)).alias("k"))
    ).scalar()
    c0, c1, k = totals["c0"], totals["c1"], totals["k"]
    row = F.col("n_0") + F.col("n_1")
    expected = [row * c / (c0 + c1) for c in (c0, c1)]
    gaps = [F.abs(o - e) for o, e in zip((F.col("n_0"), F.col("n_1")), expected)]
    corrected = [F.when(k == 2, F.greatest(g - 0.5, F.lit(0.0))).otherwise(g) for g in gaps]
    cells = [F.try_divide(g * g, e) for g, e in zip(corrected, expected)]
    result = table.agg(
        F.lit(category).alias("category"),
        F.sum(cells[0] + cells[1]).alias("chi2"),
        (F.count(F.lit(1)) - 1).cast("int").alias("dof"),
        F.sum(row).alias("n"),
    )
    return result.withColumn("p_value", chi2_p_value("chi2", "dof")) if p_value else result


def anova_test(df: DataFrame, value: str, target: str, p_value: bool = True) -> DataFrame:
    """One-way ANOVA of a numeric between the two classes; null values are left out."""
    x = F.col(value).cast("double")
    parts = []
    for k in (0, 1):
        of_class = F.when((F.col(target) == k) & x.isNotNull(), x)
        parts += [
            F.count(of_class).alias(f"n{k}"),
            F.avg(of_class).alias(f"m{k}"),
            F.var_pop(of_class).alias(f"v{k}"),
        ]
    n0, n1 = F.col("n0"), F.col("n1")
    between = n0 * n1 / (n0 + n1) * F.pow(F.col("m0") - F.col("m1"), 2)
    within = n0 * F.col("v0") + n1 * F.col("v1")
    result = df.agg(*parts).select(
        F.lit(value).alias("feature"),
        F.try_divide(between * (n0 + n1 - 2), within).alias("f_stat"),
        F.lit(1).alias("df_between"),
        (n0 + n1 - 2).alias("df_within"),
    )
    if not p_value:
        return result
    return result.withColumn("p_value", f_p_value("f_stat", "df_between", "df_within"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all pairs in long form, pairwise complete, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), F.col(f"{a}|{b}").alias("r")
                )
            )
    return row.select(F.inline(F.array(*cells)))


def spearman(
    df: DataFrame,
    x: str,
    y: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    min_skew_rows: int = MIN_ROWS,
) -> DataFrame:
    """Spearman rank correlation with mid-ranks for ties, over rows where both are present.

    Ranks come from bucketed running totals over the counts per value, and are joined back by value: a
    short list of values is broadcast, a long one is shuffled with hot values salted. Ranks are centred,
    so their products do not cancel.
    """
    complete = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    )
    rows = complete.count()
    hot = {c: hot_keys(complete, c, min_skew_rows, rows=rows) for c in ("x", "y")}
    splits = order_splits_of(complete, ["x", "y"], rows_per_bucket, rows)
    ranked = complete
    if any(hot.values()):  # written first, so that the salts are the same when a task is run again
        ranked = draw_salt(materialize(complete, "rank-pairs"))
    for c in ("x", "y"):
        counted = complete.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        totals = running_totals(counted, c, ["n"], splits=splits[c])
        centred = F.col("cum_n") - (F.col("n") - 1) / 2 - (F.col("total_n") + 1) / 2
        ranks = totals.select(c, centred.alias(f"r_{c}"))
        salt = F.col("_salt") if hot[c] else None
        ranked = skew_join(ranked, ranks, c, hot_left=hot[c], left_salt=salt)
    sums = ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("r_x") * F.col("r_y")).alias("xy"),
        F.sum(F.col("r_x") * F.col("r_x")).alias("xx"),
        F.sum(F.col("r_y") * F.col("r_y")).alias("yy"),
    )
    return sums.select(
        F.lit(x).alias("feature_a"),
        F.lit(y).alias("feature_b"),
        "n",
        F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))).alias("rho"),
    )


def box_stats(
    df: DataFrame, values: Sequence[str], by: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR) and outliers per class and numeric column.

    The quartiles are written first, so the planner knows their size: those of a class column are broadcast and no
    data row is shuffled; those of a column of many values are joined like any table.
    """
    quartiles = exact_quantiles(df, values, (0.25, 0.5, 0.75), [by], rows_per_bucket).select(
        by,
        "feature",
        *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))],
    )
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        "*", (F.col("q1") - 1.5 * spread).alias("_low"), (F.col("q3") + 1.5 * spread).alias("_high")
    )
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return (
        melt(df, values, [by])
        .join(materialize(fences, "fences"), [by, "feature"])
        .groupBy(by, "feature", "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def kernel_density(
    df: DataFrame,
    value: str,
    target: str,
    grid_size: int = 64,
    cut: float = 3.0,
    classes: Sequence[int] = (0, 1),
    nodes: int | None = None,
) -> DataFrame:
    """Gaussian kernel density per class on its own grid, each class normalised on its own.

    Scott bandwidth (n^-1/5 times the sample deviation); the grid reaches ``cut`` bandwidths beyond the
    data. One row of class figures comes back first; the densities are ``grid_size`` conditional sums
    in one pass, combined on the map side: no row is repeated per grid point or shuffled.

    With ``nodes`` per bandwidth the rows are binned linearly first, and only the bins meet the grid: the work is rows
    plus bins times grid, and a class has at most (range / bandwidth + 2 ``cut``) x ``nodes`` bins. Linear binning replaces the kernel
    by its interpolation between nodes, so a density is off by ``binning_error`` at most.
    """
    return density_curves(df, [value], target, grid_size, cut, classes, nodes).drop("feature")


def binning_error(nodes: int, bandwidth: float) -> float:
    """Bound of the error of a binned density: an eighth of the squared spacing times the largest second derivative."""
    return 1 / (8 * nodes * nodes * bandwidth * math.sqrt(2 * math.pi))


def density_curves(
    df: DataFrame,
    values: Sequence[str],
    target: str,
    grid_size: int = 32,
    cut: float = 3.0,
    classes: Sequence[int] = (0, 1),
    nodes: int | None = None,
) -> DataFrame:
    """``kernel_density`` of several columns, with the name of the column as ``feature``: two scans for all of them."""
    return _densities(df, target, grid_size, cut, _figures(df, values, target, classes), nodes)


Figures = dict[int, tuple[int, float, float, float]]


def _figures(
    df: DataFrame, values: Sequence[str], target: str, classes: Sequence[int]
) -> dict[str, Figures]:
    """Count, minimum, maximum and deviation per column and class, as one row of one pass.

    A class with fewer than two different values has no density and is left out.
    """
    cells = []
    for c in values:
        for k in classes:
            x = F.when(F.col(target) == k, F.col(c).cast("double"))
            cells.append(F.struct(F.count(x), F.min(x), F.max(x), F.stddev_samp(x)).alias(f"{c}|{k}"))
    row = df.agg(*cells).first()
    found: dict[str, Figures] = {c: {} for c in values}
    for c in values:
        for k in classes:
            n, low, high, deviation = row[f"{c}|{k}"]
            if n > 1 and deviation > 0:
                found[c][k] = (n, low, high, deviation)
    return found


def _binned(scaled: DataFrame, by: Sequence[str], nodes: int) -> DataFrame:
    """Weights on nodes that are 1 / ``nodes`` bandwidths apart, in place of rows.

    A bin keeps its rows and the sum of their distances from its lower node, which is all that both its nodes' weights
    need; a value that a third of all rows hold is one row after the map-side combine.
    """
    at = F.col("_z") * F.lit(-nodes)
    bins = scaled.groupBy(*by, F.floor(at).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(at - F.floor(at)).alias("_upper")
    )
    ends = [
        F.struct((F.col("_bin") / F.lit(-nodes)).alias("_z"), (F.col("_rows") - F.col("_upper")).alias("_w")),
        F.struct(((F.col("_bin") + 1) / F.lit(-nodes)).alias("_z"), F.col("_upper").alias("_w")),
    ]
    return bins.select(*by, "_rows", F.posexplode(F.array(*ends)).alias("_end", "_node")).select(
        *by, "_node.*", F.when(F.col("_end") == 0, F.col("_rows")).otherwise(0).alias("_rows")
    )


def _densities(
    df: DataFrame,
    target: str,
    grid_size: int,
    cut: float,
    figures: Mapping[str, Figures],
    nodes: int | None = None,
) -> DataFrame:
    figures = {c: found for c, found in figures.items() if found}
    if not figures:
        schema = f"{target} int, point int, x double, density double, feature string"
        return df.sparkSession.createDataFrame([], schema)
    cells = []
    for c, found in figures.items():
        grids: dict[int, tuple[float, float, float]] = {}
        for k, (n, low, high, deviation) in found.items():
            width = n**-0.2 * deviation
            start = low - cut * width
            grids[k] = (start, (high + cut * width - start) / (grid_size - 1), width)

        def pick(part: int, grids: Mapping[int, tuple[float, float, float]] = grids) -> Column:
            cases = F
            for k, numbers in grids.items():
                cases = cases.when(F.col(target) == k, F.lit(numbers[part]))
            return cases.otherwise(F.lit(None))

        cells.append(
            F.struct(
                F.lit(c).alias("feature"),
                ((pick(0) - F.col(c).cast("double")) / pick(2)).alias("_z"),
                (pick(1) / pick(2)).alias("_step"),
                pick(0).alias("_start"),
                pick(1).alias("_dx"),
                pick(2).alias("_bw"),
            )
        )
    scaled = df.select(target, F.inline(F.array(*cells))).where(F.col("_z").isNotNull())
    offsets = [F.col("_z") + F.col("_step") * i for i in range(grid_size)]
    weight, rows = F.lit(1.0), F.count(F.lit(1))
    if nodes:
        scaled = _binned(scaled, [target, "feature", "_step", "_start", "_dx", "_bw"], nodes)
        weight, rows = F.col("_w"), F.sum("_rows")
    bumps = [F.sum(F.exp(d * d * -0.5) * weight).alias(f"g{i}") for i, d in enumerate(offsets)]
    summed = scaled.groupBy(target, "feature").agg(
        rows.alias("_n"),
        F.first("_start").alias("_start"),
        F.first("_dx").alias("_dx"),
        F.first("_bw").alias("_bw"),
        *bumps,
    )
    norm = F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi)
    points = [
        F.struct(
            F.lit(i).alias("point"),
            (F.col("_start") + F.col("_dx") * i).alias("x"),
            (F.col(f"g{i}") / norm).alias("density"),
        )
        for i in range(grid_size)
    ]
    found = summed.select(target, "feature", F.inline(F.array(*points)))
    return found.select(target, "point", "x", "density", "feature")


def violin_stats(
    df: DataFrame, values: Sequence[str], target: str, grid_size: int = 32
) -> tuple[DataFrame, DataFrame]:
    """What a violin plot shows: box figures and density curves, per class and numeric column."""
    return box_stats(df, values, target), density_curves(df, values, target, grid_size)


def scatter_bins(
    df: DataFrame, x: str, y: str, target: str, x_width: float, y_width: float
) -> DataFrame:
    """Rows per two-dimensional bin and class: a scatter plot that does not grow with the data."""
    return df.groupBy(
        F.floor(F.col(x) / x_width).alias("x_bin"), F.floor(F.col(y) / y_width).alias("y_bin"), target
    ).agg(F.count(F.lit(1)).alias("n"))


