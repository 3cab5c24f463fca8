import random

import pytest
from pyspark.sql import functions as F

from staywise.operators import merging, skew
from staywise.operators.skew import draw_salt, hot_keys, skew_join


def keyed(spark, n, hot, name, seed):
    """Rows of which a third carry the key ``hot`` (None is a key too)."""
    rnd = random.Random(seed)
    rows = [(hot if i % 3 == 0 else rnd.randint(100, 160), f"{name}{i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, f"k bigint, {name} string")


def test_hot_keys_are_found_and_null_is_one(spark):
    _, df = keyed(spark, 300, 7, "a", 1)
    assert 7 in hot_keys(df, "k", min_rows=1, share=0.1)
    _, df = keyed(spark, 300, None, "a", 1)
    assert set(hot_keys(df, "k", min_rows=1, share=0.1)) == {None}
    assert hot_keys(df, "k") == {}  # too small to need help


@pytest.mark.parametrize("hot_a, hot_b", [(7, 7), (7, 8), (None, 120), (None, None)])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_the_nested_loop(spark, hot_a, hot_b, null_safe):
    rows_a, a = keyed(spark, 120, hot_a, "a", 1)
    rows_b, b = keyed(spark, 90, hot_b, "b", 2)
    joined = skew_join(
        draw_salt(a, "sa"),
        draw_salt(b, "sb"),
        "k",
        hot_left=hot_keys(a, "k", 1, 0.05),
        hot_right=hot_keys(b, "k", 1, 0.05),
        null_safe=null_safe,
        left_salt=F.col("sa"),
        right_salt=F.col("sb"),
    )
    found = sorted((r.a, r.b) for r in joined.collect())
    want = sorted(
        (x, y)
        for k, x in rows_a
        for m, y in rows_b
        if k == m and (null_safe or k is not None)
    )
    assert found == want
    if want:
        assert joined.columns.count("k") == 1


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_salted_outer_and_semi_join(spark, how):
    rows_a, a = keyed(spark, 120, 7, "a", 1)
    b = spark.createDataFrame([(k, f"b{k}") for k in range(100, 140)], "k bigint, b string")
    plain = a.join(b, "k", how)
    salted = skew_join(
        draw_salt(a, "s"), b, "k", how, hot_left=hot_keys(a, "k", 1, 0.05), left_salt=F.col("s")
    ).drop("s")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.select(*salted.columns).collect()))


def sources(spark):
    hr = spark.createDataFrame([(i % 40 if i % 3 else 5, f"h{i}", i) for i in range(120)], "id bigint, h string, x int")
    ev = spark.createDataFrame([(i, f"e{i}", -i) for i in range(40)] + [(5, "again", 0)], "id bigint, e string, x int")
    sv = spark.createDataFrame([(i, f"s{i}") for i in range(0, 40, 5)], "id bigint, s string")
    return {"hr": hr, "ev": ev, "sv": sv}


def test_merge_is_the_same_with_and_without_salts(spark):
    frames = sources(spark)
    plain = merging.merge_sources(frames, "id")
    salted = merging.merge_sources(frames, "id", min_skew_rows=1)
    assert plain.columns == salted.columns == ["id", "h", "x", "e", "x_ev", "s"]
    assert sorted(plain.collect()) == sorted(salted.collect())
    assert plain.where("e = 'again'").count() == plain.where("e = 'e5'").count() > 0


def test_null_keys_match_on_request(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, x string")
    b = spark.createDataFrame([(1, "c"), (None, "d")], "id bigint, y string")
    frames = {"a": a, "b": b}
    assert merging.merge_sources(frames, "id").count() == 1
    both = merging.merge_sources(frames, "id", null_safe=True)
    assert both.columns == ["id", "x", "y"]
    assert sorted(map(str, both.collect())) == sorted(
        ["Row(id=1, x='a', y='c')", "Row(id=None, x='b', y='d')"]
    )


def test_diagnostics_count_null_keys_as_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id bigint")
    row = merging.id_diagnostics({"a": df}, "id").first()
    assert (row.n_rows, row.n_distinct, row.n_duplicates) == (4, 2, 2)


def test_merge_refuses_a_source_without_key_or_result(spark):
    a = spark.createDataFrame([(1,)], "id bigint")
    b = spark.createDataFrame([(2,)], "id bigint")
    with pytest.raises(ValueError, match="missing column"):
        merging.merge_sources({"a": a, "b": b.withColumnRenamed("id", "z")}, "id")
    frames = {"a": a, "b": b}
    with pytest.raises(ValueError, match="no row is left"):
        merging.check_merge(frames, merging.merge_sources(frames, "id"), "id")
    with pytest.raises(ValueError, match="b: the table is empty"):
        merging.check_merge({"a": a, "b": b.limit(0)}, a, "id")


def test_statement_text():
    assert merging.merge_sql(["a", "b", "c"], "id", "public") == (
        "SELECT *\nFROM public.a\nINNER JOIN public.b USING (id)\nINNER JOIN public.c USING (id)"
    )


def test_hot_keys_from_counters_that_run_out(spark, monkeypatch):
    """Many more keys than counters: every key of more than a part is found, null too, and no count is too high."""
    monkeypatch.setattr(skew, "LEAST_COUNTERS", 20)
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") % 4 == 0, -1).when(F.col("id") % 10 == 1, None).when(F.col("id") % 50 == 3, 7).otherwise(F.col("id") + 100).alias("k"))
    exact = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    found = {r["key"]: r.n for r in skew.heavy_keys(df, "k", n, 700).collect()}
    assert {k for k, c in exact.items() if c >= 700} <= set(found) and {-1, None, 7} <= set(found)
    assert all(exact[k] - 350 <= c <= exact[k] for k, c in found.items())
    assert len(found) <= 2 * n / 700
    assert set(skew.hot_keys(df, "k", min_rows=1, part_rows=350)) == {-1, None, 7}
    assert skew.hot_keys(df, "k", min_rows=1, part_rows=4_000)[-1] in (2, 3)
    assert skew.hot_keys(df, "k", min_rows=1, part_rows=20_000) == {}


def test_a_key_of_a_small_share_is_split(spark):
    """0.05 per cent of the rows are one key: no part of it is larger than asked for."""
    n = 400_000
    a = spark.range(n).select(F.when(F.col("id") % 2_000 == 0, F.lit("hot")).otherwise(F.md5(F.col("id").cast("string"))).alias("k"), F.col("id").alias("a"))
    hot = skew.hot_keys(a, "k", min_rows=1, part_rows=50)
    assert set(hot) == {"hot"} and hot["hot"] >= 3
    b = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, b int")
    joined = skew_join(a, b, "k", hot_left=hot, left_salt=F.col("a"))
    assert joined.count() == n // 2_000
