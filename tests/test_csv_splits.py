"""CSV files cut into byte ranges against the same files read as one."""

import csv as plain
import io
import random

import pytest
from hypothesis import given
from hypothesis import settings as rules
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staywise.sources import csv, csv_splits

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k, None) for k in (SPLIT, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(before, (n, 0, 1))]
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(path, rows, end="\n"):
    text = io.StringIO(newline="")
    plain.writer(text, lineterminator=end).writerows(rows)
    path.write_bytes(text.getvalue().encode())
    return str(path)


def rows_of(rng, n):
    bits = ['"', "\n", ",", "a", "bc", " ", "é", '""', "\r\n", "x" * 30]
    return [[str(i), "".join(rng.choice(bits) for _ in range(rng.randrange(12))) + "z", rng.choice(["", "q", 'say "no"', 'five" wide'])] for i in range(n)]


@pytest.mark.parametrize("size", [150, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_gives_the_rows_of_the_whole_file(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    rows = rows_of(rng, 60)
    path = written(tmp_path / "a.csv", [["id", "text", "note"], *rows], end)
    small_splits(size)
    df = csv_splits.read_quoted(spark, path)
    got = {r.id: (r.text, r.note or "") for r in df.collect()}
    assert got == {a: (b, c) for a, b, c in rows}
    lines = spark.read.option("lineSep", "\n").text(path)
    assert size > 150 or lines.rdd.getNumPartitions() > 5


def test_a_quoted_text_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i}, "quoted"' for i in range(60))
    rows = [["1", "a"], ["2", long], ["3", "b\nc"], ["4", long], ["5", "d"]]
    for name in ("a.csv", "b.csv"):
        written(tmp_path / name, [["id", "text"], *rows])
    small_splits(100)
    got = sorted((r.id, r.text) for r in csv_splits.read_quoted(spark, str(tmp_path)).collect())
    assert got == sorted((a, b) for a, b in rows * 2)
    records = csv_splits.csv_records(spark, str(tmp_path))
    assert records.count() == 12 and records.where((F.col("start") == 0) & (F.col("number") == 0)).count() == 2


def test_headers_must_agree_and_blank_lines_are_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n\n")
    (tmp_path / "b.csv").write_text("a,b\n\n3,4")
    assert sorted(map(tuple, csv_splits.read_quoted(spark, str(tmp_path)).collect())) == [("1", "2"), ("3", "4")]
    (tmp_path / "c.csv").write_text("b,a\n5,6\n")
    with pytest.raises(Exception, match="header"):
        csv.read_csv(spark, str(tmp_path)).collect()


@given(st.lists(st.text(alphabet='ab",', max_size=12), max_size=8), st.booleans())
@rules(max_examples=200, deadline=None)
def test_state_of_lines_equals_a_reader_over_all_of_them(lines, inside):
    """Line by line, or the lines as one text: the same state at the end."""
    state = inside
    for line in lines:
        state = csv_splits.state_after(line, state)
    text, at, now, fresh = "\n".join(lines), 0, inside, not inside
    while at < len(text):
        c = text[at]
        if now:
            if c == '"' and text[at + 1 : at + 2] == '"':
                at += 1
            elif c == '"':
                now, fresh = False, False
        elif c == '"' and fresh:
            now = True
        else:
            fresh = c in ",\n"
        at += 1
    assert state == now
