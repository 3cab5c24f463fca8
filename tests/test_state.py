"""Stored states: logarithmic quantile bins, and the keyed result of update streams."""

import math
import random

import pytest
from pyspark.sql import functions as F

from staywise.operators import monitoring, quantile_state
from staywise.streaming import jobs


def numbers(seed, n, shift=0.0):
    rnd = random.Random(seed)
    special = [0.0, -0.0, 1e-300, -1e300, 1.0, None, float("nan")]
    return [rnd.choice(special) if rnd.random() < 0.1 else rnd.gauss(shift, 100) * 10 ** rnd.randint(-3, 3) for _ in range(n)]


def log_of(spark, values, day):
    return spark.createDataFrame([(day, v) for v in values], "day string, x double").withColumn("day", F.to_date("day"))


def kept(values):
    return sorted(v for v in values if v is not None and not math.isnan(v))


def test_quantiles_of_merged_states_are_within_the_accuracy(spark, tmp_path):
    path, days = str(tmp_path / "state"), ["2024-01-01", "2024-01-02", "2024-01-05"]
    values = {d: numbers(i, 700, 20.0 * i) for i, d in enumerate(days)}
    for d in days:
        quantile_state.store_state(quantile_state.bin_counts(log_of(spark, values[d], d), ["x"], "day"), path)
    # a day that is written again replaces itself
    again = quantile_state.bin_counts(log_of(spark, values[days[1]], days[1]), ["x"], "day")
    quantile_state.store_state(again, path)
    shares = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    for first, last in ((days[0], days[2]), (days[0], days[1]), (days[1], days[1])):
        row = quantile_state.state_quantiles(quantile_state.state_between(spark, path, first, last), shares).first()
        want = kept([v for d in days if first <= d <= last for v in values[d]])
        assert row.n == len(want)
        for p, got in zip(shares, row.quantiles):
            exact = want[math.floor(p * (len(want) - 1))]
            assert abs(got - exact) <= 0.0100001 * abs(exact)
    assert quantile_state.state_between(spark, path, "2023-01-01", "2023-12-31").count() == 0


def test_bins_keep_the_order_of_values(spark):
    values = sorted([float("-inf"), -1e308, -5.0, -1e-320, 0.0, 5e-324, 1e-5, 1.0, 1.0001, 7.0, 1e308, float("inf")])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bins = [r.b for r in df.orderBy("x").select(quantile_state.bin_of("x").alias("b")).collect()]
    assert bins == sorted(bins) and bins[0] < bins[1] and bins[-2] < bins[-1] and bins[4] == 0


def test_only_the_asked_periods_are_read(spark, tmp_path):
    path = str(tmp_path / "state")
    for d in ("2024-01-01", "2024-02-01"):
        quantile_state.store_state(quantile_state.bin_counts(log_of(spark, [1.0, 2.0], d), ["x"], "day"), path)
    state = quantile_state.state_between(spark, path, "2024-02-01", "2024-02-28")
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    assert state.agg(F.sum("n")).first()[0] == 2


def test_drift_of_states_is_that_of_the_rows_between_the_same_limits(spark):
    rnd = random.Random(1)
    old, new = [rnd.lognormvariate(3, 1) for _ in range(3000)], [rnd.lognormvariate(3.4, 1) for _ in range(2500)]
    base, current = (quantile_state.bin_counts(log_of(spark, v, d), ["x"], "day").drop("period") for v, d in ((old, "2024-01-01"), (new, "2024-01-02")))
    got = quantile_state.drift_from_states(base, current).first()
    both = log_of(spark, old, "2024-01-01").unionByName(log_of(spark, new, "2024-01-02"))
    exact = monitoring.drift_psi(both.withColumn("day", F.col("day").cast("string")), "x", "day", "2024-01-01", "2024-01-02").first()
    assert got.n_bins == exact.n_bins == 10
    assert got.psi == pytest.approx(exact.psi, rel=0.05)
    same = quantile_state.drift_from_states(base, base).first()
    assert same.psi == 0
    nothing = base.where("false")
    assert quantile_state.drift_from_states(base, nothing).count() == quantile_state.drift_from_states(nothing, base).count() == 0


def day_rows(spark, folder, days, source="form"):
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", source, d % 2) for d in days for h in (1, 13)]
    df = spark.createDataFrame(rows, "t string, source string, decision int")
    df.select(F.to_timestamp("t").alias("created_at"), "source", "decision").coalesce(1).write.mode("append").parquet(folder)


SCHEMA = "created_at timestamp, source string, decision int"
KEYS = ["period", "source"]


def test_update_stream_gives_the_batch_report_and_drops_closed_state(spark, tmp_path):
    folder, out = str(tmp_path / "log"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = jobs.with_event_time(jobs.read_stream(spark, folder, schema), "created_at", "1 day")
        report = monitoring.daily_usage(stream, "created_at", "source")
        query = jobs.run_available(report, out, "update", keys=KEYS, compact_every=2)
        return report.schema, query

    for days in ((1, 2, 3), (3, 4), (4, 5, 6, 7), (7, 8), (9,)):
        day_rows(spark, folder, days)
        day_rows(spark, folder, days[-1:], None)
        result, query = run()
    got = {(str(r.period), r.source): r.n for r in jobs.merged_table(spark, out, result, KEYS).collect()}
    batch = monitoring.daily_usage(spark.read.parquet(folder), "created_at", "source")
    assert got == {(str(r.period), r.source): r.n for r in batch.collect()}
    assert len(got) > 9
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6
    day_rows(spark, folder, [1])  # long closed: the row is dropped, the period keeps what it had
    run()
    after = {(str(r.period), r.source): r.n for r in jobs.merged_table(spark, out, result, KEYS).collect()}
    assert after == got
    # compaction leaves the last two bases and the changes since the older one
    assert len(jobs._complete(spark, f"{out}/base")) <= 2
    assert len(jobs._complete(spark, f"{out}/changes")) <= 4


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "keyed")
    schema = "k int, v string, n long"
    batches = [[(1, "a", 1), (None, "z", 1)], [(1, "b", 2), (2, "c", 1)], [(3, "d", 1)], [(None, None, 5)], [(2, "e", 9)]]
    want = {}
    for number, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, schema)
        want.update({r[0]: r for r in rows})
        for _ in range(2):
            jobs.write_changes(batch, number, path, ["k"], compact_every=2)
            found = jobs.merged_table(spark, path, batch.schema, ["k"]).collect()
            assert {r.k: tuple(r) for r in found} == want and len(found) == len(want)
    assert jobs.merged_table(spark, str(tmp_path / "none"), batch.schema, ["k"]).count() == 0
