"""The bucketed ways must give what the plain windows give."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from staywise.operators import metrics, monitoring, ordering, stats
from staywise.operators.selection import seeded_sample, stratified_folds


def scores(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.2)
        # A third of all rows share one score; the rest is spread out.
        s = 0.3 if i % 3 == 0 else round(min(1.0, max(0.0, rnd.gauss(0.35 + 0.2 * y, 0.2))), 3)
        rows.append((i, y, s))
    return rows, spark.createDataFrame(rows, "id bigint, y int, s double")


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_do_not_depend_on_the_buckets(spark, descending):
    _, df = scores(spark)
    grouped = df.groupBy("y", "s").agg(F.count(F.lit(1)).alias("n"))
    splits = ordering.order_splits(df, "s", 200)
    assert len(splits) > 3
    args = ("s", ["n"], ["y"], descending)
    plain = sorted(ordering.running_totals(grouped, *args).collect())
    cut = sorted(ordering.running_totals(grouped, *args, splits=splits).collect())
    assert plain == cut


def test_hash_rank_is_the_md5_order(spark):
    df = spark.range(700).withColumn("c", (F.col("id") % 2).cast("int"))
    want = {}
    for c in (0, 1):
        ids = [i for i in range(700) if i % 2 == c]
        ids.sort(key=lambda i: hashlib.md5(f"5-{i}".encode()).hexdigest())
        want.update({i: r for r, i in enumerate(ids)})
    for bucket_rows in (10_000, 50, 2):
        found = ordering.hash_rank(df, "id", 5, ["c"], rows_per_bucket=bucket_rows)
        assert {r["id"]: r["rank"] for r in found.collect()} == want


def test_rows_of_a_null_group_are_ranked_both_ways(spark):
    df = spark.range(120).withColumn("c", F.when(F.col("id") % 3 != 0, F.col("id") % 3))
    a = sorted(map(str, ordering.hash_rank(df, "id", 1, ["c"]).collect()))
    b = sorted(map(str, ordering.hash_rank(df, "id", 1, ["c"], rows_per_bucket=9).collect()))
    assert a == b and len(a) == 120


@pytest.mark.parametrize("rows_per_bucket", [10_000, 300, 40])
def test_folds_are_balanced_and_complete(spark, rows_per_bucket):
    rows, df = scores(spark, 1003)
    found = stratified_folds(df, "id", "y", 5, 42, rows_per_bucket).collect()
    assert sorted(r.id for r in found) == list(range(1003))
    for c in (0, 1):
        sizes = [sum(r.fold == f and r.y == c for r in found) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_folds_ignore_the_partitioning(spark):
    _, df = scores(spark, 500)
    a = {r.id: r.fold for r in stratified_folds(df.repartition(7), "id", "y").collect()}
    b = {r.id: r.fold for r in stratified_folds(df.coalesce(1), "id", "y").collect()}
    assert a == b


def interpolated(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 150])
def test_exact_quantiles(spark, rows_per_bucket):
    rows, df = scores(spark, 1500)
    df = df.withColumn("t", F.when(F.col("id") % 5 != 0, F.col("s") * 10))
    found = ordering.exact_quantiles(df, ["s", "t"], [0.0, 0.25, 0.5, 0.9, 1.0], ["y"], rows_per_bucket)
    for r in found.collect():
        values = [
            s * (10 if r.feature == "t" else 1)
            for i, y, s in rows
            if y == r.y and (r.feature == "s" or i % 5 != 0)
        ]
        assert r.n == len(values)
        want = [interpolated(values, p) for p in (0.0, 0.25, 0.5, 0.9, 1.0)]
        assert list(r.quantiles) == pytest.approx(want, abs=1e-12)
    plain = ordering.exact_quantiles(df, ["s", "t"], [0.1, 0.37, 0.5], ["y"]).collect()
    cut = ordering.exact_quantiles(df, ["s", "t"], [0.1, 0.37, 0.5], ["y"], rows_per_bucket).collect()
    assert sorted(plain) == sorted(cut)


def test_quantiles_take_a_fixed_number_of_jobs(spark):
    _, df = scores(spark, 900)
    wide = df.select(*[(F.col("s") * i).alias(f"c{i}") for i in range(1, 13)])

    def jobs(columns):
        group = f"quantiles-{len(columns)}"
        spark.sparkContext.setJobGroup(group, group)
        ordering.exact_quantiles(wide, columns, [0.5], rows_per_bucket=50).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(wide.columns) <= jobs(["c1"]) + 1


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 5])
def test_nan_is_the_largest_value_on_both_paths(spark, rows_per_bucket):
    rows = [(float(i % 13), i % 2) for i in range(40)] + [(float("nan"), 1)]
    df = spark.createDataFrame(rows, "s double, y int").withColumn("p", F.when(F.col("y") == 1, "a").otherwise("b"))
    ranked = [(50.0 if s != s else s, y) for s, y in rows]
    pairs = [(a > b) + (a == b) / 2 for a, u in ranked if u for b, v in ranked if not v]
    assert metrics.roc_auc(df, "s", "y", rows_per_bucket).first()[0] == pytest.approx(sum(pairs) / len(pairs))
    assert metrics.pr_curve(df, "s", "y", rows_per_bucket).count() == 14
    plain = monitoring.drift_ks(df, "s", "p", "a", "b").first()
    assert monitoring.drift_ks(df, "s", "p", "a", "b", rows_per_bucket).first() == plain


def test_quantiles_of_a_null_group_and_of_many_groups(spark):
    _, df = scores(spark, 900)
    df = df.withColumn("g", F.when(F.col("id") % 4 != 0, F.col("id") % 4))
    plain = ordering.exact_quantiles(df, ["s"], [0.1, 0.5], ["g"]).collect()
    cut = ordering.exact_quantiles(df, ["s"], [0.1, 0.5], ["g"], rows_per_bucket=50).collect()
    assert {r.g: (r.n, r.quantiles) for r in cut} == {r.g: (r.n, r.quantiles) for r in plain}


def f1_at(rows, t):
    tp = sum(y for _, y, s in rows if s >= t)
    n = sum(s >= t for _, y, s in rows)
    p, r = tp / n, tp / sum(y for _, y, _ in rows)
    return 2 * p * r / (p + r + 1e-8)


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 100])
def test_best_threshold_against_a_loop(spark, rows_per_bucket):
    rows, df = scores(spark, 1200)
    want = max(sorted({s for *_, s in rows}), key=lambda t: (f1_at(rows, t), -t))
    found = metrics.best_threshold(df, "s", "y", rows_per_bucket).first()
    assert found.threshold == want
    assert found.f1 == pytest.approx(f1_at(rows, want), abs=1e-12)
    assert found.f1 >= f1_at(rows, 0.5) - 1e-12


def test_ties_take_the_lowest_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6)], "y int, s double")
    # F1 is 2/3 both at 0.9 and at 0.6.
    assert metrics.best_threshold(df, "s", "y").first().threshold == pytest.approx(0.6)


def test_no_scores_give_the_default_threshold(spark):
    df = spark.createDataFrame([], "y int, s double")
    assert metrics.best_threshold(df, "s", "y").first().threshold == 0.5


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 100])
def test_auc_counts_pairs(spark, rows_per_bucket):
    rows, df = scores(spark, 600)
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    found = metrics.roc_auc(df, "s", "y", rows_per_bucket).first()[0]
    assert found == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_metrics_with_nothing_predicted_are_zero(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "y int, s double")
    found = metrics.class_metrics(df, "s", "y", 0.5).first()
    assert (found.precision, found.recall, found.f1) == (0.0, 0.0, 0.0)


def midranks(values):
    ordered = sorted(values)
    place = {}
    for i, v in enumerate(ordered):
        place.setdefault(v, []).append(i + 1)
    return [sum(place[v]) / len(place[v]) for v in values]


def pearson(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    cov = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    return cov / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))


@pytest.mark.parametrize("rows_per_bucket, min_skew_rows", [(1_000_000, 10**9), (100, 0)])
def test_spearman_with_a_hot_value(spark, rows_per_bucket, min_skew_rows):
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        x = 1.0 if i % 3 == 0 else float(rnd.randint(0, 40))
        rows.append((x, x * 0.5 + rnd.randint(0, 20)))
    df = spark.createDataFrame([*rows, (None, 1.0), (2.0, None)], "x double, y double")
    want = pearson(midranks([r[0] for r in rows]), midranks([r[1] for r in rows]))
    found = stats.spearman(df, "x", "y", rows_per_bucket, min_skew_rows).first()
    assert found.n == 900
    assert found.rho == pytest.approx(want, abs=1e-12)


def test_box_stats_both_ways(spark):
    _, df = scores(spark, 800)
    a = sorted(stats.box_stats(df, ["s"], "y").collect())
    b = sorted(stats.box_stats(df, ["s"], "y", rows_per_bucket=90).collect())
    assert [r.asDict() for r in a] == [pytest.approx(r.asDict()) for r in b]


def test_sample_is_reproducible_and_capped(spark):
    df = spark.range(50)
    first = [r.id for r in seeded_sample(df.repartition(5), "id", 10).collect()]
    assert first == [r.id for r in seeded_sample(df, "id", 10).collect()]
    assert len(set(first)) == 10
    assert seeded_sample(df, "id", 500).count() == 50


def test_density_integrates_to_one_per_class(spark):
    _, df = scores(spark, 600)
    points = stats.kernel_density(df, "s", "y", grid_size=200, cut=5.0).collect()
    for c in (0, 1):
        xs = sorted((r.x, r.density) for r in points if r.y == c)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(xs, xs[1:]))
        assert area == pytest.approx(1.0, abs=1e-3)


def test_violin_is_boxes_and_curves(spark):
    _, df = scores(spark, 300)
    df = df.withColumn("s2", F.col("s") * 2)
    boxes, curves = stats.violin_stats(df, ["s", "s2"], "y", grid_size=8)
    assert boxes.count() == 4 and curves.count() == 32
    alone = {(r.y, r.point): r.density for r in stats.kernel_density(df, "s2", "y", grid_size=8).collect()}
    both = {(r.y, r.point): r.density for r in curves.where("feature = 's2'").collect()}
    assert both == pytest.approx(alone)


def test_density_of_a_constant_class_is_left_out(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (1, 2.0)], "y int, s double")
    assert {r.y for r in stats.kernel_density(df, "s", "y").collect()} == {1}


def test_chi2_without_association_is_zero(spark):
    df = spark.createDataFrame([(c, t) for c in "abc" for t in (0, 1) for _ in range(5)], "c string, t int")
    found = stats.chi2_test(df, "c", "t").first()
    assert (found.chi2, found.dof, found.n, found.p_value) == (0.0, 2, 30, 1.0)


def test_anova_equals_the_squared_t(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    df = spark.createDataFrame([(0, v) for v in a] + [(1, v) for v in b] + [(1, None)], "t int, v double")
    ma, mb = sum(a) / 4, sum(b) / 3
    within = sum((v - ma) ** 2 for v in a) + sum((v - mb) ** 2 for v in b)
    t2 = (ma - mb) ** 2 / (within / 5 * (1 / 4 + 1 / 3))
    found = stats.anova_test(df, "v", "t").first()
    assert found.f_stat == pytest.approx(t2)
    assert found.df_within == 5 and 0 < found.p_value < 1
