"""CSV files with line breaks in quoted texts, read by as many tasks as they have splits.

Whether a line break ends a record depends on all quotes before it. So each task first reads the lines of its byte
ranges as if they began outside a quoted text and as if they began inside one; how a range ends under either assumption
is all that the next one needs. Following these two answers through the ranges of a file tells where each really begins, and a
second pass cuts the records. Pieces of records that go beyond a range, a few per range, are put together by file.

A quote opens a quoted text only at the start of a field, as in ``read_csv``; inside, two quotes are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staywise.session import materialize

OUTSIDE, INSIDE, AFTER = range(3)  # of a quoted text; right behind a quote that may close it
BLOCK = "file string, start long"


def state_after(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether the line break behind ``line`` is inside a quoted text, if the one before was ``inside``."""
    state, fresh = (INSIDE if inside else OUTSIDE), not inside
    at, n = 0, len(line)
    while at < n:
        if state == OUTSIDE:
            if fresh and line[at] == '"':
                state, fresh, at = INSIDE, False, at + 1
                continue
            end = line.find(delimiter, at)
            if end < 0:
                break
            fresh, at = True, end + 1
        else:
            quote = line.find('"', at)
            if quote < 0:
                break
            if line[quote + 1 : quote + 2] == '"':
                at = quote + 2
            else:
                state, at = OUTSIDE, quote + 1
    return state == INSIDE


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.Array]]:
    """(file, start of the byte range, whether its lines go on from before, lines)."""
    last = None
    for batch in batches:
        file, start = (batch.column(c).to_pylist() for c in ("file", "start"))
        at = 0
        while at < batch.num_rows:
            to = at
            while to < batch.num_rows and (file[to], start[to]) == (file[at], start[at]):
                to += 1
            yield file[at], start[at], (file[at], start[at]) == last, batch.column("value").slice(at, to - at)
            last = file[at], start[at]
            at = to


def _states(lines: pa.Array, inside: bool, delimiter: str) -> np.ndarray:
    """Before each line and behind the last one, whether it is inside a quoted text; only lines with quotes are looked into."""
    out = np.zeros(len(lines) + 1, bool)
    at = 0
    for i in np.flatnonzero(pc.match_substring(lines, '"').fill_null(False).to_numpy(zero_copy_only=False)):
        out[at : i + 1] = inside
        inside = state_after(lines[int(i)].as_py(), inside, delimiter)
        at = int(i) + 1
    out[at:] = inside
    return out


def _ends(delimiter: str):
    """(file, start, outside, inside): how a byte range ends if it begins outside, or inside, a quoted text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[bool, bool]] = {}
        for file, start, _, lines in _blocks(batches):
            outside, inside = found.get((file, start), (False, True))
            a = bool(_states(lines, outside, delimiter)[-1])
            b = a if outside == inside else bool(_states(lines, inside, delimiter)[-1])
            found[file, start] = (a, b)
        keys = list(found)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
        columns += [pa.array([found[k][i] for k in keys], pa.bool_()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "outside", "inside"])

    return rows


def _cut(open_blocks: set[tuple[str, int]], delimiter: str):
    """(file, start, number, place, text): records, place 0, and pieces of such as go on: 1 to the next range, 2 from the last one, 3 both."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        key: tuple[str, int] | None = None
        state = begun = False
        number = 0

        def piece(place: int) -> pa.RecordBatch:
            return _record_batch(key, number, place, ["\n".join(held)])

        for file, start, going_on, lines in _blocks(batches):
            if not going_on:
                if key and held:
                    yield piece(3 if begun else 1)
                key, held, number = (file, start), [], 0
                state = begun = key in open_blocks
            states = _states(lines, state, delimiter)
            texts = lines.to_pylist()
            firsts = np.flatnonzero(~states[:-1])
            head = int(firsts[0]) if len(firsts) else len(texts)
            if held or state:  # lines of the record that is open
                held.extend(texts[:head])
                if head < len(texts) or not states[-1]:
                    yield piece(2 if begun else 0)
                    number += 1
                    held, begun = [], False
            ends = np.append(firsts[1:], len(texts))
            done = ["\n".join(texts[a:b]) if b - a > 1 else texts[a] for a, b in zip(firsts, ends)]
            if states[-1] and len(done):
                held = texts[firsts[-1] :]
                done.pop()
            state = bool(states[-1])
            if done:
                yield _record_batch(key, number, 0, done)
                number += len(done)
        if key and held:
            yield piece(3 if begun else 1)

    return rows


def _record_batch(key: tuple[str, int], number: int, place: int, text: list[str]) -> pa.RecordBatch:
    n = len(text)
    columns = [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(np.arange(number, number + n))]
    columns += [pa.array([place] * n, pa.int32()), pa.array(text, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["file", "start", "number", "place", "text"])


def csv_records(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """(file, start, number, text): one row per record of the files below ``path``, with its line breaks.

    ``start`` is the byte range that it begins in and ``number`` its place there.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    ends = lines.mapInArrow(_ends(delimiter), f"{BLOCK}, outside boolean, inside boolean")
    ordered = F.array_sort(F.collect_list(F.struct("start", "outside", "inside")))  # the ranges of a file
    start = F.struct(F.lit(False).alias("state"), F.array().cast("array<bigint>").alias("found"))
    step = F.aggregate(
        ordered,
        start,
        lambda acc, b: F.struct(
            F.when(acc["state"], b["inside"]).otherwise(b["outside"]).alias("state"),
            F.when(acc["state"], F.array_append(acc["found"], b["start"])).otherwise(acc["found"]).alias("found"),
        ),
    )
    begins_inside = ends.groupBy("file").agg(step["found"].alias("found")).select("file", F.explode("found").alias("start"))
    # ranges that begin within a quoted text: a line break at just that place is rare
    open_blocks = {(r.file, r.start) for r in begins_inside.collect()}
    cut = lines.mapInArrow(_cut(open_blocks, delimiter), f"{BLOCK}, number long, place int, text string")
    if not open_blocks:
        return cut.drop("place")
    cut = materialize(cut, "csv-records")
    pieces = cut.where("place > 0")
    by_file = Window.partitionBy("file").orderBy("start", F.col("place") == 1)
    chained = pieces.withColumn("chain", F.sum((F.col("place") == 1).cast("int")).over(by_file))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"])
    first = F.min(F.struct("start", "number")).alias("first")
    whole = chained.groupBy("file", "chain").agg(first, F.array_join(texts, "\n").alias("text"))
    return cut.where("place = 0").drop("place").unionByName(whole.select("file", "first.start", "first.number", "text"))


def read_quoted(spark: SparkSession, path: str, strict: bool = True, delimiter: str = ",") -> DataFrame:
    """All columns as text, by the header that every file must begin with alike."""
    records = csv_records(spark, path, delimiter).withColumn("text", F.regexp_replace("text", "\r\\z", "")).where("text <> ''")
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": True}
    names = spark.read.options(**options, header=True).csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in names)
    parsed = records.select("start", "number", F.from_csv("text", F.lit(schema), {**options, "mode": "FAILFAST" if strict else "PERMISSIVE"}).alias("r"))
    header = (F.col("start") == 0) & (F.col("number") == 0)
    same = reduce(and_, [F.col("r")[n].eqNullSafe(F.lit(n)) for n in names])
    other = F.when(header & ~same, F.raise_error(F.lit(f"a file's header is not {', '.join(names)}")).cast("boolean")).otherwise(~header)
    return parsed.where(other).select("r.*")
