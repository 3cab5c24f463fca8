"""Forests, their exact contributions and the joint logistic fits, held against plain computations on small tables."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from staywise.errors import InputError
from staywise.operators import forest, logistic, tree_shap

ROWS, FEATURES, SEED = 240, 5, 42


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(ROWS, FEATURES)).round(2)
    x[:, 4] = x[:, 4] > 0
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * rng.normal(size=ROWS) > 0).astype(int)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, drawn):
    x, y = drawn
    schema = "row long, grp int, label int, weight double, values array<double>"
    return spark.createDataFrame([(i, 0, int(y[i]), 1.0, x[i].tolist()) for i in range(ROWS)], schema).cache()


@pytest.fixture(scope="module")
def grown(rows):
    return forest.grow(rows, forest.Plan(12, 5, 5, (2, 6), seed=SEED))


def plain_tree(x, y, cuts, tree, leaf, depth, split):
    """One tree by recursion over its rows: (path, rows, share of class 1, split)."""
    times = forest.draws(SEED, np.array([tree]), np.arange(len(y)))[0]
    bins = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(x.shape[1])], axis=1)
    whole = np.array([times[y == c].sum() for c in (0, 1)], dtype=float)
    weight = whole.sum() / (2 * whole)

    def mass(part):
        return np.array([weight[c] * times[part & (y == c)].sum() for c in (0, 1)])

    def purity(part):
        m = mass(part)
        return (m * m).sum() / m.sum() if m.sum() else 0.0

    out = []

    def grow(part, path, level):
        best = None
        if level < depth and (level == 0 or part.sum() >= split) and (mass(part) > 0).all():
            for f in forest.tried_features(SEED, np.array([tree]), np.array([path]), x.shape[1], 2)[0]:
                for cut in range(forest.BINS - 1):
                    left, right = part & (bins[:, f] <= cut), part & (bins[:, f] > cut)
                    if min(left.sum(), right.sum()) >= leaf:
                        gain = round(purity(left) + purity(right) - purity(part), 9)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, int(f), cut, left, right)
        out.append((path, int(part.sum()), round(mass(part)[1] / mass(part).sum(), 9), best and best[1:3]))
        if best:
            grow(best[3], 2 * path, level + 1)
            grow(best[4], 2 * path + 1, level + 1)

    grow(times > 0, 1, 0)
    return sorted(out)


def listed(trees, tree, cuts):
    out = []

    def walk(node, path):
        f = int(trees.feature[node])
        split = None if f < 0 else (f, int(np.flatnonzero(cuts[f] == trees.threshold[node])[0]))
        out.append((path, int(trees.rows[node]), round(float(trees.value[node]), 9), split))
        if f >= 0:
            walk(int(trees.left[node]), 2 * path)
            walk(int(trees.left[node]) + 1, 2 * path + 1)

    walk(int(trees.root[tree]), 1)
    return sorted(out)


@pytest.mark.parametrize("leaf", [2, 6])
def test_trees_equal_a_plain_recursion(rows, drawn, grown, leaf):
    cuts = forest.feature_cuts(rows, [0], FEATURES)[0]
    for tree in (0, 5, 11):
        assert plain_tree(*drawn, cuts, tree, leaf, 5, 5) == listed(grown[0, leaf], tree, cuts)


def test_many_passes_give_the_same_trees(rows, grown, monkeypatch):
    monkeypatch.setattr(forest, "CELLS", 7 * 2 * forest.BINS * 3)
    again = forest.grow(rows, forest.Plan(12, 5, 5, (2, 6), seed=SEED))
    for key, trees in grown.items():
        for name, values in vars(trees).items():
            assert np.array_equal(values, getattr(again[key], name)), name


def test_points_read_off_a_large_forest_equal_forests_of_their_own(rows, drawn, grown, monkeypatch):
    points = [(5, 5, 12), (3, 5, 7), (5, 15, 9), (2, 20, 12)]
    small = {p: forest.grow(rows, forest.Plan(p[2], p[0], p[1], (2, 6), seed=SEED)) for p in points}
    for nodes in (forest.NODES, 150):  # in one and in several packs of trees
        monkeypatch.setattr(forest, "NODES", nodes)
        found = forest.point_votes(rows, grown, points).toPandas()
        assert len(found) == ROWS * 2 * len(points)
        for (leaf, point), part in found.groupby(["leaf", "point"]):
            want = small[points[point]][0, leaf].scores(drawn[0])
            assert np.allclose(part.sort_values("row")["probability"], want)


def test_groups_are_grown_on_their_own_rows(spark, rows, grown):
    twice = rows.unionByName(rows.withColumn("grp", F.lit(3)).withColumn("label", 1 - F.col("label")))
    both = forest.grow(twice, forest.Plan(12, 5, 5, (2, 6), (0, 3), SEED))
    assert np.array_equal(both[0, 2].value, grown[0, 2].value)
    assert np.allclose(both[3, 2].value[both[3, 2].root], 1 - grown[0, 2].value[grown[0, 2].root])


def test_no_rows_and_one_class(spark, rows):
    with pytest.raises(InputError):
        forest.grow(rows.limit(0), forest.Plan(2, 2, 2, (1,)))
    one = forest.grow(rows.withColumn("label", F.lit(1)), forest.Plan(3, 4, 2, (1,)))[0, 1]
    assert (one.feature == -1).all() and (one.value == 1.0).all()


def test_model_scores_like_its_trees_and_comes_back_from_storage(spark, rows, drawn, grown, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import array_to_vector, vector_to_array

    model = PipelineModel([forest.ForestModel(grown[0, 2], FEATURES)])
    model.save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    table = rows.select("row", array_to_vector("values").alias("features"))
    for m in (model, loaded):
        scored = m.transform(table).select("row", vector_to_array("probability")[1].alias("p"), "prediction").orderBy("row").toPandas()
        assert np.allclose(scored["p"], grown[0, 2].scores(drawn[0]))
        assert ((scored["p"] > 0.5) == (scored["prediction"] == 1)).all()
    importances = loaded.stages[0].importances
    assert importances.sum() == pytest.approx(1.0) and importances.argmax() in (0, 1, 2)


def conditional(trees, node, x, known):
    """Score of a tree where only the features in ``known`` decide."""
    f = int(trees.feature[node])
    if f < 0:
        return trees.value[node]
    left = int(trees.left[node])
    if f in known:
        return conditional(trees, left + int(x[f] > trees.threshold[node]), x, known)
    parts = [trees.weight[c] * conditional(trees, c, x, known) for c in (left, left + 1)]
    return sum(parts) / trees.weight[node]


def test_contributions_equal_all_subsets(drawn, grown):
    trees, x = grown[0, 2], drawn[0][:6]
    phi, base = tree_shap.contributions(trees, x)
    assert np.allclose(phi.sum(axis=1), trees.scores(x) - base)

    def game(row, known):
        return np.mean([conditional(trees, int(r), row, known) for r in trees.root])

    for i, row in enumerate(x):
        assert game(row, set()) == pytest.approx(base)
        for j in range(FEATURES):
            rest = [k for k in range(FEATURES) if k != j]
            total = 0.0
            for size in range(FEATURES):
                share = math.factorial(size) * math.factorial(FEATURES - 1 - size) / math.factorial(FEATURES)
                total += sum(share * (game(row, {*s, j}) - game(row, set(s))) for s in itertools.combinations(rest, size))
            assert phi[i, j] == pytest.approx(total, abs=1e-9)


def test_contributions_as_a_table(rows, drawn, grown):
    names = [f"f{i}" for i in range(FEATURES)]
    found = tree_shap.forest_contributions(rows, "row", "values", names, grown[0, 2]).orderBy("row").collect()
    phi, base = tree_shap.contributions(grown[0, 2], drawn[0])
    assert np.allclose([[c.phi for c in r.contributions] for r in found], phi)
    assert all(r.base == pytest.approx(base) and [c.feature for c in r.contributions] == names for r in found)


def test_joint_logistic_fits_reach_their_optimum(spark, rows, drawn):
    x, y = drawn
    flipped = rows.withColumn("grp", F.lit(1)).withColumn("label", 1 - F.col("label")).withColumn("weight", F.lit(2.0))
    points = [(0.1, "l2"), (10.0, "l2"), (0.05, "l1"), (5.0, "l1")]
    found = logistic.fit_points(rows.unionByName(flipped), [0, 1], points)
    assert set(found) == {(g, i) for g in (0, 1) for i in range(4)}
    for (g, i), beta in found.items():
        c, penalty = points[i]
        label, weight = (1 - y, 2.0) if g else (y, 1.0)
        p = 1 / (1 + np.exp(-(x @ beta[:-1] + beta[-1])))
        slope = weight * (x.T @ (p - label))
        w = beta[:-1]
        if penalty == "l2":
            assert np.abs(slope + w / c).max() < 1e-3
        else:
            assert np.abs(slope[w != 0] + np.sign(w[w != 0]) / c).max(initial=0) < 1e-3
            assert np.abs(slope[w == 0]).max(initial=0) <= 1 / c + 1e-3
        assert abs(weight * (p - label).sum()) < 1e-3
    assert (found[0, 2][:-1] == 0).any()  # a strong absolute penalty drops features
    scored = logistic.point_scores(rows, found).where("point = 1").orderBy("row").toPandas()
    assert np.allclose(scored["probability"], 1 / (1 + np.exp(-(x @ found[0, 1][:-1] + found[0, 1][-1]))))


def test_trees_grown_in_one_task_equal_those_grown_by_levels(spark, rows, monkeypatch):
    """Two groups, two minimum leaves: rows sent to a task for some of the trees, or one pass over them per level."""
    both = rows.unionByName(rows.where("row % 3 > 0").withColumn("grp", F.lit(1)))
    plan = forest.Plan(7, 5, 4, (2, 6), (0, 1), seed=SEED)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 700)  # two trees at a time at most
    monkeypatch.setattr(forest, "LOCAL_CELLS", 300)
    here = forest.grow(both, plan)
    monkeypatch.setattr(forest, "LOCAL_BYTES", 0)
    levels = forest.grow(both, plan)
    assert here.keys() == levels.keys() and len(here) == 4
    for key, trees in here.items():
        for name, numbers in vars(levels[key]).items():
            assert (getattr(trees, name) == numbers).all(), name
    assert (forest.grow(both, plan)[1, 2].root == here[1, 2].root).all()


def test_contributions_by_tables_of_patterns_equal_those_by_the_rows_patterns(drawn, grown, monkeypatch):
    trees, x = grown[0, 2], drawn[0]
    by_table = tree_shap.contributions(trees, x)
    monkeypatch.setattr(tree_shap, "PATTERNS", 1)
    by_row = tree_shap.contributions(trees, x)
    assert np.allclose(by_table[0], by_row[0], atol=1e-12) and abs(by_table[1] - by_row[1]) < 1e-12
    assert np.allclose(by_table[0].sum(axis=1) + by_table[1], trees.scores(x), atol=1e-12)


def test_few_rows_are_explained_by_several_tasks(rows, drawn, grown):
    names = [f"f{i}" for i in range(FEATURES)]
    found = tree_shap.forest_contributions(rows.coalesce(1), "row", "values", names, grown[0, 2])
    tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1


def test_forests_of_several_minimum_leaves_count_common_rows_once(monkeypatch):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 32, (20_000, 9)).astype(np.uint8)
    label = (bins[:, 0] + bins[:, 4] + rng.integers(0, 30, len(bins)) > 45).astype(np.uint8)
    cuts = {0: [np.arange(31) + 0.5] * 9}
    counted, sums = [], forest._sums
    monkeypatch.setattr(forest, "_sums", lambda place, *rest: (counted.append(len(place)), sums(place, *rest))[1])
    grown, pairs = {}, {}
    for leaves in ((2, 5, 8), (2,), (5,), (8,)):
        plan = forest.Plan(2, 7, 5, leaves, seed=4)
        grown[leaves] = forest._grow_here(plan, 9, 0, np.arange(len(bins)), label, bins.ravel()).trees(cuts)
        pairs[leaves], counted[:] = sum(counted), []
    assert pairs[2, 5, 8] < 1.5 * max(pairs[(leaf,)] for leaf in (2, 5, 8))
    for leaf in (2, 5, 8):
        for name, values in vars(grown[2, 5, 8][0, leaf]).items():
            assert np.array_equal(values, getattr(grown[(leaf,)][0, leaf], name))


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 32, (400, 4)).astype(np.uint8)
    label = (bins[:, 0] > 15).astype(np.uint8)
    grown = forest._grow_here(forest.Plan(40, 4, 2, (1,)), 4, 0, np.arange(400), label, bins.ravel())
    trees = grown.trees({0: [np.arange(31) + 0.5] * 4})[0, 1]
    values = bins.astype(float)
    assert np.array_equal(trees.scores(values), np.concatenate([trees.scores(values[i : i + 1]) for i in range(400)]))
