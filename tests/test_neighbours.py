"""Neighbours and oversampling against brute force, with copies and with very many of them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from staywise.operators import neighbors
from staywise.operators.neighbors import nearest_neighbours
from staywise.operators.smote import smote


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    found = set()
    for i, v in rows:
        gaps = ((x - np.array(v)) ** 2).sum(axis=1)
        order = [j for j in sorted(range(len(rows)), key=lambda j: (gaps[j], ids[j])) if ids[j] != i]
        found |= {(i, p, int(ids[j]), round(float(gaps[j]), neighbors.DISTANCE_DIGITS)) for p, j in enumerate(order[:k])}
    return found


def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, vec array<double>")


def search(df, k, **options):
    found = nearest_neighbours(df, "id", "vec", k, **options).collect()
    return {(r.id, r.position, r.neighbour, r.distance) for r in found}


def clustered(n, dims, seed, copies=0):
    rnd = random.Random(seed)
    centres = [[round(rnd.uniform(-9, 9), 3) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        if i < copies:
            rows.append((i, [1.0] * dims))
        else:
            c = rnd.choice(centres)
            # Three decimals: squared distances then have six, and rounding them is never a toss-up.
            rows.append((i, [round(a + rnd.gauss(0, 0.7), 3) for a in c]))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_rows", [2048, 60, 17])
def test_neighbours_equal_brute_force(spark, block_rows):
    rows = clustered(260, 3, 1)
    assert search(table(spark, rows), 5, block_rows=block_rows) == brute(rows, 5)


@pytest.mark.parametrize("block_rows, min_skew_rows", [(2048, 10**9), (25, 1)])
def test_a_third_of_all_rows_are_copies(spark, block_rows, min_skew_rows):
    rows = clustered(240, 4, 2, copies=80)
    found = search(table(spark, rows), 5, block_rows=block_rows, min_skew_rows=min_skew_rows)
    assert found == brute(rows, 5)


def test_ties_on_a_grid_go_to_the_smaller_id(spark):
    rows = [(i, [float(i % 12), float(i // 12)]) for i in range(144)]
    assert search(table(spark, rows), 5, block_rows=20) == brute(rows, 5)


def test_only_some_candidates_are_sent_to_a_cell(spark):
    rows = clustered(600, 2, 3)
    df = table(spark, rows).withColumn("_copy", F.lit(1))
    _, offers = neighbors._assign_cells(df, df, 600, 5, 100)
    per_cell = offers.groupBy("task").count()
    assert per_cell.count() > 1
    assert offers.select("id", "task.cell").distinct().count() < 600 * offers.select("task.cell").distinct().count() * 0.7


def test_no_block_grows_beyond_its_size(spark):
    rows = clustered(400, 2, 4, copies=150)
    df = table(spark, rows).withColumn("_copy", F.lit(1))
    queries, offers = neighbors._assign_cells(df, df, 400, 5, 40)
    for side in (queries, offers):
        biggest = side.groupBy("task").count().agg(F.max("count")).first()[0]
        assert biggest <= 2 * 40


def test_fewer_rows_than_neighbours(spark):
    rows = [(1, [0.0]), (2, [1.0]), (3, [5.0])]
    assert search(table(spark, rows), 5) == brute(rows, 5)


def labelled(spark, n=120, rare=18, seed=5):
    rows = clustered(n, 3, seed)
    return rows, spark.createDataFrame(
        [(i, v, int(i < rare)) for i, v in rows], "id bigint, vec array<double>, y int"
    )


def test_oversampling_reaches_parity_and_keeps_real_rows(spark):
    _, df = labelled(spark)
    out = smote(df, "id", "vec", "y")
    counts = {(r.y, r.synthetic): r["count"] for r in out.groupBy("y", "synthetic").count().collect()}
    assert counts == {(0, False): 102, (1, False): 18, (1, True): 84}
    assert out.where("synthetic").agg(F.countDistinct("id"), F.max("id")).first() == (84, -1)
    same = out.where("NOT synthetic").select("id", "vec", "y").exceptAll(df.select("id", "vec", "y"))
    assert same.isEmpty()


def test_synthetic_rows_lie_between_a_row_and_its_neighbour(spark):
    rows, df = labelled(spark)
    rare = [(i, v) for i, v in rows if i < 18]
    near = brute(rare, 5)
    vec = dict(rare)
    segments = [(np.array(vec[i]), np.array(vec[n])) for i, _, n, _ in near]
    for r in smote(df, "id", "vec", "y").where("synthetic").collect():
        x = np.array(r.vec)
        gap = min(
            abs(np.linalg.norm(x - a) + np.linalg.norm(x - b) - np.linalg.norm(a - b)) for a, b in segments
        )
        assert gap < 1e-9


def test_every_minority_row_is_used_about_equally(spark):
    rows, df = labelled(spark, 60, 7)
    out = smote(df, "id", "vec", "y").where("synthetic")
    assert out.count() == 53 - 7


def test_balanced_and_one_sided_tables(spark):
    rows = [(i, [float(i)], i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>, y int")
    assert smote(df, "id", "vec", "y").count() == 10
    with pytest.raises(ValueError, match="both classes"):
        smote(df.where("y = 1"), "id", "vec", "y")
    with pytest.raises(ValueError, match="two rows"):
        smote(df.where("y = 0 OR id = 1"), "id", "vec", "y")


def test_oversampling_does_not_depend_on_the_partitioning(spark):
    _, df = labelled(spark)
    a = smote(df.repartition(9), "id", "vec", "y").where("synthetic").orderBy("id").collect()
    b = smote(df.coalesce(1), "id", "vec", "y").where("synthetic").orderBy("id").collect()
    assert a == b


def test_close_points_far_from_the_origin(spark):
    """Distances are compared unrounded, and neither small steps nor a large offset loses them."""
    for offset, step in ((0.0, 1e-4), (1e6, 0.01)):
        rows = [(i, [offset + (i * 7919 % 200) * step, 1.0]) for i in range(200)]
        for block_rows in (2048, 30):
            found = search(table(spark, rows), 2, block_rows=block_rows)
            want = {(i, p, j) for i, p, j, _ in brute(rows, 2)}
            assert {(i, p, j) for i, p, j, _ in found} == want


def random_vectors(n, dims=16, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims)) * 2
    return [(i, (centres[rng.integers(20)] + rng.normal(size=dims)).tolist()) for i in range(n)]


def test_probing_finds_nearly_all_neighbours(spark):
    rows = random_vectors(1500)
    df = table(spark, rows)
    exact = {(i, j) for i, _, j, _ in search(df, 5, block_rows=4096)}
    found = {(i, j) for i, _, j, _ in search(df, 5, block_rows=128, probes=8)}
    assert len(found & exact) >= 0.9 * len(exact)


def test_probing_sends_each_row_to_as_many_tasks_at_any_size(spark):
    copies = {}
    for n in (1000, 4000):
        df = table(spark, random_vectors(n, 32)).withColumn("_copy", F.lit(1))
        queries, offers = neighbors._probe_cells(df, df, n, 256, 4)
        copies[n] = (queries.count() / n, offers.count() / n)
    assert copies[4000][0] <= 1.3 * copies[1000][0] and copies[4000][1] <= 1.3 * copies[1000][1]


def test_oversampling_with_probes_reaches_parity(spark):
    rows = [(i, v, int(i < 400)) for i, v in random_vectors(1200, 8)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>, label int")
    counts = {r.label: r["count"] for r in smote(df, "id", "vec", "label", probes=3).groupBy("label").count().collect()}
    assert counts == {0: 800, 1: 800}


def test_cells_do_not_become_more_with_the_table(spark, monkeypatch):
    """Without structure every cell needs every vector, so what is sent is the table's size times the cells."""
    sent = []
    search_blocks = neighbors._search
    monkeypatch.setattr(neighbors, "_search", lambda q, o, k: (sent.append(o.count()), search_blocks(q, o, k))[1])
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 64)).round(2))]
    found = search(table(spark, rows), 2, block_rows=40)
    assert sent[0] <= 3 * 8 * 1500
    near = {(i, p, j) for i, p, j, _ in found}
    assert near == {(i, p, j) for i, p, j, _ in brute(rows, 2)}


def test_a_block_compares_near_boxes_alone(monkeypatch):
    pairs = []
    closer = neighbors._closer
    monkeypatch.setattr(neighbors, "_closer", lambda a, b, *rest: (pairs.append(len(a) * len(b)), closer(a, b, *rest))[1])
    x = np.random.default_rng(2).permutation(20_000).astype(float)[:, None] / 1e6
    ids = np.arange(len(x))
    query, neighbour, distance = neighbors._block(ids, x, ids, x, 2)
    assert sum(pairs) < 0.15 * len(x) ** 2
    other = query != neighbour
    assert other.sum() == len(x) and np.allclose(distance[other], 1e-12)


def test_a_short_list_stays_short_where_little_is_reached():
    """Rows whose first box was far off meet their near ones next; not every row in between is one of them."""
    x = np.arange(512, dtype=float)[:, None] / 1e6
    row, column, _ = neighbors._closer(x, x, np.full(512, 1.0), 2)
    assert len(row) <= 4 * len(x)
    assert {(int(r), int(r)) for r in range(512)} <= set(zip(row.tolist(), column.tolist()))


@pytest.mark.parametrize("copies", [1, 3, 9])
def test_rows_are_joined_to_lists_only_where_vectors_repeat(spark, monkeypatch, copies):
    joined = []
    join = neighbors.skew_join
    monkeypatch.setattr(neighbors, "skew_join", lambda *a, **o: (joined.append(1), join(*a, **o))[1])
    rows = clustered(120, 2, 6, copies=copies)
    assert search(table(spark, rows), 4, block_rows=40) == brute(rows, 4)
    assert bool(joined) == (copies > 4)


@pytest.mark.parametrize("options", [{}, {"block_rows": 30}])
def test_only_the_rows_asked_for_are_searched(spark, monkeypatch, options):
    rows = clustered(300, 4, 7, copies=40)
    df = table(spark, rows).withColumn("asked", F.col("id") % 5 == 0)
    queried = []
    searched = neighbors._search

    def counted(queries, offers, k):
        queried.append(queries.select("id").distinct().count())
        return searched(queries, offers, k)

    monkeypatch.setattr(neighbors, "_search", counted)
    found = {r for r in search(df, 5, asked="asked", **options) if r[0] % 5 == 0}
    assert found == {r for r in brute(rows, 5) if r[0] % 5 == 0}
    assert queried[0] < 120


def test_oversampling_searches_only_for_rows_that_are_taken(spark, monkeypatch):
    from staywise.operators import smote as module

    _, df = labelled(spark, n=120, rare=54)
    asked = []
    search_all = module.nearest_neighbours

    def spy(points, *args, **options):
        asked.append(points.where(options.get("asked") or "true").count())
        return search_all(points, *args, **options)

    monkeypatch.setattr(module, "nearest_neighbours", spy)
    made = {r.id: r.vec for r in smote(df, "id", "vec", "y").where("synthetic").collect()}
    assert asked == [12]
    monkeypatch.setattr(module, "nearest_neighbours", lambda *a, **o: search_all(*a, **(o | {"asked": None})))
    assert made == {r.id: r.vec for r in smote(df, "id", "vec", "y").where("synthetic").collect()}


def test_a_vector_is_offered_once_and_searched_for_where_its_reach_ends(spark):
    rows = clustered(600, 2, 3)
    df = table(spark, rows).withColumn("_copy", F.lit(1))
    queries, offers = neighbors._assign_cells(df, df, 600, 5, 100)
    assert offers.select("id", "task.cell").distinct().count() == 600
    visits = queries.select("id", "task.cell").distinct()
    assert visits.select("id").distinct().count() == 600
    assert visits.count() < 3 * 600
