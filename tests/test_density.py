"""Binned densities against the densities of the rows."""

import random

import pytest

from staywise.operators import stats


def curves(df, nodes=None):
    return {(r.feature, r.y, r.point): (r.x, r.density) for r in stats.density_curves(df, ["a", "b"], "y", 40, nodes=nodes).collect()}


def test_binned_densities_are_within_their_bound(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([7.0, rnd.gauss(0, 3), None]), rnd.expovariate(0.01), int(rnd.random() < 0.3)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    exact = curves(df)
    figures = stats._figures(df, ["a", "b"], "y", (0, 1))
    worst = {}
    for nodes in (4, 32, 256):
        binned = curves(df, nodes)
        assert binned.keys() == exact.keys() and len(exact) == 160
        for (feature, y, point), (x, density) in binned.items():
            n, _, _, deviation = figures[feature][y]
            want_x, want = exact[feature, y, point]
            error = abs(density - want)
            assert x == pytest.approx(want_x)
            assert error <= stats.binning_error(nodes, n**-0.2 * deviation) + 1e-12
            worst[nodes] = max(worst.get(nodes, 0), error)
    assert worst[4] > worst[32] > worst[256]


def test_bins_do_not_grow_with_the_rows(spark):
    def bins(rows):
        z = spark.range(rows).selectExpr("-(id * 7919 % 1000000) / 100000.0 AS _z", "1 AS y")
        out = stats._binned(z, ["y"], 16)
        return out.count(), out.agg({"_w": "sum", "_rows": "sum"}).first()

    small, large = bins(20_000), bins(80_000)
    assert small[0] == large[0] == 2 * 160
    assert large[1]["sum(_w)"] == pytest.approx(80_000) and large[1]["sum(_rows)"] == 80_000


def test_no_rows_and_single_values(spark):
    df = spark.createDataFrame([(1.0, None, 0), (1.0, 2.0, 0), (None, None, 1)], "a double, b double, y int")
    assert curves(df, 64) == {} and curves(df.where("false"), 64) == {}
