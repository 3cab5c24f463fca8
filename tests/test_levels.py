"""Level indices and sparse rows against a plain dictionary."""

import random

from pyspark.sql import functions as F

from staywise.operators import levels


def test_indices_are_places_in_the_order_of_each_column(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "é", "z", "a b", "", *map(str, range(200))]), float(rng.randrange(4)), rng.choice([None, 3, 11])) for i in range(2_000)]
    df = spark.createDataFrame(rows, "id int, a string, b double, level int")
    found = {}
    for r in levels.index_levels(df, ["a", "b", "level"]).collect():
        found.setdefault(r.feature, {})[r.level] = (r["index"], r.n)
    texts = {"a": [r[1] for r in rows], "b": [str(int(r[2])) for r in rows], "level": [None if r[3] is None else str(r[3]) for r in rows]}
    want = {}
    for name, values in texts.items():
        order = sorted({v for v in values if v is not None}, key=str.encode)
        want[name] = {v: (i, values.count(v)) for i, v in enumerate(order)}
    assert found == want
    start = {"a": 0, "b": len(want["a"]), "level": len(want["a"]) + len(want["b"])}
    encoded = levels.encode_levels(df, ["a", "b", "level"])
    assert encoded.columns == [*df.columns, "positions", "width"]
    for i, r in enumerate(encoded.orderBy("id").collect()):
        assert list(r.positions) == [start[c] + want[c][texts[c][i]][0] for c in texts if texts[c][i] is not None]
        assert r.width == sum(map(len, want.values()))


def test_unseen_levels_and_empty_tables(spark):
    known = levels.index_levels(spark.createDataFrame([("x",), ("y",)], "a string"), ["a"])
    rows = levels.encode_levels(spark.createDataFrame([("y",), ("new",), (None,)], "a string"), ["a"], known)
    assert sorted((r.a or "", list(r.positions), r.width) for r in rows.collect()) == [("", [], 2), ("new", [], 2), ("y", [1], 2)]
    none = levels.encode_levels(spark.createDataFrame([], "a string"), ["a"])
    assert none.count() == 0


def test_a_million_levels_bring_nothing_to_the_driver(spark):
    df = spark.range(1_000_000).select(F.md5(F.col("id").cast("string")).alias("a"))
    index = levels.index_levels(df, ["a"])
    found = index.agg(F.count("*"), F.min("index"), F.max("index"), F.count_distinct("index")).first()
    assert tuple(found) == (1_000_000, 0, 999_999, 1_000_000)
    high = index.where("index = 500000").first().level
    assert abs(int(high[:8], 16) / 2**32 - 0.5) < 0.01  # md5 texts are uniform, and sorted
