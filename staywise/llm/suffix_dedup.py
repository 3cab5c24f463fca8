"""Removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. Sorting every suffix would move
many times the corpus, so suffixes are sorted at anchors alone: in each window of ``length`` bytes the ``gram``-byte
string with the smallest hash. What the anchor of a window is depends on the window's bytes alone, so equal windows have
equal anchors at equal places, and no repeat is missed.

1. Anchors of all texts; grams that occur once are dropped (counted over all texts, combined before the shuffle).
2. The others' surroundings - the suffix up to ``length`` bytes, and the bytes before it that a window can reach - are
   sorted in each task, equal ones combined, and exchanged as front-coded runs, dealt by the gram.
3. Each group of runs is merged by a loser tree that goes on from known common prefixes. The prefixes shared by
   neighbours, of the suffixes and of the bytes before them, say for every place of the anchor in a window which
   surroundings share that window; a window shared by two, or by one that occurs twice, is repeated.
4. The repeated windows of an anchor form one span; the spans go to their documents, whose kept bytes are hashed.

Grams that occur more than ``group_rows`` times are not merged in one task: the windows of their surroundings become rows
that are counted by hash, with combining before the shuffle, which gives the same spans.

Inputs without a result of their own: an empty table gives no rows; a null text is empty, and texts shorter than
``length`` lose nothing; every row is a text of its own, so repeated rows repeat each other; a null doc_id is an id like any other;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.llm import prefilter, suffix_runs, words
from staywise.session import materialize

#: Production parameters.
LENGTH = 200
GRAM = 64
GROUP_ROWS = 100_000
BUCKET_ROWS = 50_000
RUN_ROWS = 100_000
SEGMENT_BYTES = 1 << 20


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes from each place on; doubling sums, so every hash depends on its bytes alone."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part = words._mix(data.astype(np.uint64) + np.uint64(1))
    width, power = 1, int(words.WORD_BASE)
    while 2 * width <= gram:
        part = part[:-width] + part[width:] * np.uint64(power)
        width, power = 2 * width, power * power % (1 << 64)
    rest = gram - width  # two overlapping halves cover any other length
    return words._mix(part[:n] + part[rest : rest + n] * np.uint64(power) if rest else part[:n])


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best() of each ``width`` neighbours."""
    out, done = values, 1
    while done * 2 <= width:
        out = best(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return best(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, gram hash) of the anchors of one text: grams that are the least of some window; ties all count."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) > SEGMENT_BYTES + length:  # the windows of a very long text, a segment of them at a time
        parts = [(a, anchors(data[a : a + SEGMENT_BYTES + length - 1], length, gram)) for a in range(0, len(data) - length + 1, SEGMENT_BYTES)]
        place, index = np.unique(np.concatenate([a + p for a, (p, _) in parts]), return_index=True)
        return place, np.concatenate([h for _, (_, h) in parts])[index]
    hashes = _gram_hashes(data, gram)
    rank = (hashes >> np.uint64(32)).astype(np.uint32)
    per = length - gram + 1
    least = _sliding(rank, per, np.minimum)
    # of all windows that hold a gram, one must have it as its least: the greatest least is the gram's own rank
    padded = np.concatenate([np.zeros(per - 1, np.uint32), least, np.zeros(per - 1, np.uint32)])
    place = np.flatnonzero(_sliding(padded, per, np.maximum) == rank)
    return place, hashes[place]


def _lists(arrays: list[np.ndarray], kind: type) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, kind)]).astype(kind)))


def _anchor_rows(length: int, gram: int):
    """(doc_id, grams, places) of texts that have any."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                data, limits = words.utf8(part.column("text"))
                each = [anchors(data[a:b], length, gram) for a, b in zip(limits[:-1], limits[1:], strict=True)]
                some = [i for i, (place, _) in enumerate(each) if len(place)]
                columns = [
                    part.column("doc_id").take(pa.array(some, pa.int64())),
                    _lists([each[i][1].view(np.int64) for i in some], np.int64),
                    _lists([each[i][0] for i in some], np.int32),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "grams", "places"])

    return rows


def _surroundings(batch: pa.RecordBatch, column: str, length: int, gram: int) -> Iterator[tuple[int, int, bytes, int]]:
    """(row, place, key, right): the suffix from each place on, and the bytes before it in reverse."""
    data, limits = words.utf8(batch.column("text"))
    held = data.tobytes()
    places = batch.column(column)
    first, flat = np.asarray(places.offsets), np.asarray(places.values)
    reach = length - gram
    for i in range(batch.num_rows):
        a, b = int(limits[i]), int(limits[i + 1])
        for place in flat[first[i] : first[i + 1]].tolist():
            x = a + place
            if x + gram > b:
                continue  # a place of another text with this id
            right = held[x : min(b, x + length)]
            left = held[max(a, x - reach) : x]
            yield i, place, right + left[::-1], len(right)


def _name(key: bytes, right: int) -> bytes:
    return hashlib.blake2b(key, digest_size=16, salt=right.to_bytes(2, "big")).digest()


def _bucket(key: bytes, gram: int, buckets: int) -> int:
    return int.from_bytes(hashlib.blake2b(key[:gram], digest_size=8).digest(), "big") % buckets


def _occurrence_rows(length: int, gram: int):
    """(doc_id, text_hash, places, names) of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                places: list[list[int]] = [[] for _ in range(part.num_rows)]
                names: list[list[bytes]] = [[] for _ in range(part.num_rows)]
                for i, place, key, right in _surroundings(part, "all_places", length, gram):
                    places[i].append(place)
                    names[i].append(_name(key, right))
                columns = [part.column("doc_id"), part.column("text_hash")]
                columns += [pa.array(places, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "places", "names"])

    return rows


RUN_SCHEMA = "bucket int, lcp binary, rest binary, right binary, count binary, rests binary"
RUN_COLUMNS = ["lcp", "rest", "right", "count", "rests"]


def _run_rows(length: int, gram: int, buckets: int):
    """Front-coded sorted runs, one per bucket and ``RUN_ROWS`` surroundings."""

    def flush(held: dict[int, dict[tuple[bytes, int], int]]) -> Iterator[pa.RecordBatch]:
        for bucket, entries in held.items():
            values = [bucket, *suffix_runs.encode(suffix_runs.sorted_run(entries))]
            kinds = [pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["bucket", *RUN_COLUMNS]
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[tuple[bytes, int], int]] = {}
        n = 0
        for batch in batches:
            for part in words.blocks(batch, "text"):
                for _, _, key, right in _surroundings(part, "places", length, gram):
                    entries = held.setdefault(_bucket(key, gram, buckets), {})
                    entries[key, right] = entries.get((key, right), 0) + 1
                    n += 1
                if n >= RUN_ROWS:
                    yield from flush(held)
                    held, n = {}, 0
        yield from flush(held)

    return rows


def _hot_rows(length: int, gram: int):
    """(name, key, right, count): surroundings of hot grams, each once per block of texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                entries: dict[tuple[bytes, int], int] = {}
                for _, _, key, right in _surroundings(part, "hot_places", length, gram):
                    entries[key, right] = entries.get((key, right), 0) + 1
                found = [(_name(key, right), key, right, n) for (key, right), n in entries.items()]
                kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int64())
                columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["name", "key", "right", "count"])

    return rows


def own_windows(key: bytes, right: int, length: int, gram: int) -> list[tuple[int, bytes]]:
    """(back, window) of the windows of a surrounding that have its gram as their anchor."""
    before = len(key) - right
    around = key[right:][::-1] + key[:right]
    if len(around) < length:
        return []
    rank = (_gram_hashes(np.frombuffer(around, np.uint8), gram) >> np.uint64(32)).astype(np.uint32)
    starts = np.flatnonzero(_sliding(rank, length - gram + 1, np.minimum) == rank[before])
    return [(before - a, around[a : a + length]) for a in starts.tolist() if a <= before <= a + length - gram]


def _window_rows(length: int, gram: int):
    """(window, name, back, count)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 5_000) for i in range(0, batch.num_rows, 5_000)):
                found = []
                for name, key, right, count in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    for back, window in own_windows(key, right, length, gram):
                        found.append((hashlib.blake2b(window, digest_size=16).digest(), name, back, count))
                kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int64())
                columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["window", "name", "back", "count"])

    return rows


def hot_repeats(some: DataFrame, length: int, gram: int) -> DataFrame:
    """(name, least, most) for surroundings of hot grams, by counting their windows.

    Equal surroundings are combined first, and each window is counted at its own anchors only.
    """
    each = some.where(F.size("hot_places") > 0).transform(
        words.map_texts, _hot_rows(length, gram), "name binary, key binary, right int, count long"
    )
    once = each.groupBy("name").agg(F.first("key").alias("key"), F.first("right").alias("right"), F.sum("count").alias("count"))
    once = materialize(once, "hot-surroundings")
    rows = once.transform(words.map_texts, _window_rows(length, gram), "window binary, name binary, back int, count long")
    rows = materialize(rows, "hot-windows")
    # a window can hold several anchors: it is compared at one anchor's place at a time
    again = rows.groupBy("window", "back").agg(F.sum("count").alias("held")).where("held > 1").select("window", "back")
    again = materialize(again, "hot-repeats")
    return rows.join(again, ["window", "back"]).groupBy("name").agg(F.min("back").alias("least"), F.max("back").alias("most"))


def repeated_places(
    lcp: np.ndarray, right: np.ndarray, left: list[bytes], count: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) bytes before the anchor at which a repeated window starts, per sorted entry; most < least: none.

    For windows that start ``back`` bytes before the anchor, entries share the window if they share length - back
    bytes of the suffix and back bytes before it: both are runs in one of two sorted orders.
    """
    n = len(lcp)
    order = sorted(range(n), key=left.__getitem__)
    left_lcp = np.array([0] + [suffix_runs.common_prefix(left[order[i - 1]], left[order[i]], 0) for i in range(1, n)])
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    before = np.array([len(x) for x in left])
    least, most = np.full(n, length), np.full(n, -1)
    for back in range(length - gram + 1):
        inside = np.flatnonzero((before >= back) & (right >= length - back))
        if not len(inside):
            continue
        by_right = np.cumsum(lcp < length - back)[inside]
        by_left = np.cumsum(left_lcp < back)[place[inside]]
        key = by_right * (n + 1) + by_left
        rank = np.argsort(key, kind="stable")
        sorted_key = key[rank]
        new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
        group = np.cumsum(new) - 1
        many = np.bincount(group, count[inside][rank])[group] > 1
        found = inside[rank[many]]
        least[found] = np.minimum(least[found], back)
        most[found] = back
    return least, most


def _merge_bucket(length: int, gram: int):
    """(name, least, most) of the surroundings of a bucket that have repeated windows."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        runs = [suffix_runs.decode(*r) for r in rows[RUN_COLUMNS].itertuples(index=False)]
        keys: list[bytes] = []
        lcps, rights, counts = [], [], []
        for key, lcp, right, count in suffix_runs.merge(runs):
            if keys and key == keys[-1] and right == rights[-1]:
                counts[-1] += count
                continue
            keys.append(key)
            lcps.append(lcp)
            rights.append(right)
            counts.append(count)
        lcp, right, count = np.array(lcps), np.array(rights), np.array(counts)
        # entries whose gram no other entry has matter only if they occur twice
        same = lcp >= gram
        group = np.cumsum(~same)
        keep = np.flatnonzero((np.bincount(group)[group] > 1) | (count > 1))
        if not len(keep):
            return pd.DataFrame({"name": [], "least": [], "most": []})
        # the prefix that a kept entry shares with the kept one before it is the least of all between
        limits = np.concatenate([[0], keep[:-1] + 1])
        shared = np.minimum.reduceat(lcp[: keep[-1] + 1], limits)
        left = [keys[i][rights[i] :] for i in keep]
        least, most = repeated_places(shared, right[keep], left, count[keep], length, gram)
        found = np.flatnonzero(most >= least)
        names = [_name(keys[keep[i]], rights[keep[i]]) for i in found]
        return pd.DataFrame({"name": names, "least": least[found], "most": most[found]})

    return merged


def _removed_rows(length: int):
    """(doc_id, text_hash, n_removed, n_spans, kept_sha256)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                data, limits = words.utf8(part.column("text"))
                spans = part.column("spans").to_pylist()
                removed, runs, sums = [], [], []
                for i, (a, b) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
                    change = np.zeros(b - a + 1, dtype=np.int64)
                    for s in spans[i]:
                        change[s["from"]] += 1
                        change[s["to"]] -= 1
                    gone = np.cumsum(change[:-1]) > 0
                    removed.append(int(gone.sum()))
                    runs.append(int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()))
                    sums.append(hashlib.sha256(data[a:b][~gone].tobytes()).hexdigest())
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(removed, pa.int64())]
                columns += [pa.array(runs, pa.int64()), pa.array(sums, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_removed", "n_spans", "kept_sha256"])

    return rows


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS, group_rows: int = GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Texts that may hold repeats (doc_id, text, text_hash), and (doc_id, text_hash, spans): byte ranges to remove."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), "text")
    marked = texts.transform(words.map_texts, _anchor_rows(length, gram), "doc_id long, grams array<long>, places array<int>")
    marked = materialize(marked, "anchors")
    rows = marked.select("doc_id", F.explode(F.arrays_zip("grams", "places")).alias("a"))
    rows = rows.select("doc_id", F.col("a.grams").alias("gram"), F.col("a.places").alias("place"))
    again = marked.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("held"))
    again = materialize(again.where("held > 1"), "repeated-grams")
    hot = F.col("held") > group_rows
    places = rows.join(again, "gram").groupBy("doc_id").agg(
        F.array_sort(F.collect_set("place")).alias("all_places"),
        F.array_sort(F.collect_set(F.when(~hot, F.col("place")))).alias("places"),
        F.array_sort(F.collect_set(F.when(hot, F.col("place")))).alias("hot_places"),
    )
    places = materialize(places, "places")

    n, n_hot = places.agg(*[F.coalesce(F.sum(F.size(c)), F.lit(0)) for c in ("places", "hot_places")]).first()
    buckets = max(1, math.ceil(n / bucket_rows))
    some = prefilter.likely(texts.where("text IS NOT NULL"), places, "doc_id").join(places, "doc_id")
    some = materialize(some.withColumn("text_hash", F.xxhash64("text")), "repeating-texts")
    listed = some.transform(words.map_texts, _occurrence_rows(length, gram), "doc_id long, text_hash long, places array<int>, names array<binary>")
    listed = listed.select("doc_id", "text_hash", F.explode(F.arrays_zip("places", "names")).alias("a"))
    listed = listed.select("doc_id", "text_hash", F.col("a.places").alias("place"), F.col("a.names").alias("of_name"))
    runs = some.transform(words.map_texts, _run_rows(length, gram, buckets), RUN_SCHEMA)
    found = runs.groupBy("bucket").applyInPandas(_merge_bucket(length, gram), "name binary, least int, most int")
    if n_hot:
        found = found.unionByName(hot_repeats(some, length, gram))
    found = materialize(found, "repeats")
    start, end = F.col("place") - F.col("most"), F.col("place") - F.col("least") + length
    spans = listed.join(found, F.col("of_name") == F.col("name")).select(
        "doc_id", "text_hash", F.struct(start.alias("from"), end.alias("to")).alias("span")
    )
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans"))  # bounded by the text
    return some.select("doc_id", "text", "text_hash"), materialize(spans, "spans")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes that stay)."""
    some, spans = repeated_spans(docs, length, gram, bucket_rows, group_rows)
    cut = prefilter.likely(some.dropDuplicates(["doc_id", "text_hash"]), spans, "text_hash").join(spans, ["doc_id", "text_hash"])
    cut = cut.transform(words.map_texts, _removed_rows(length), "doc_id long, text_hash long, n_removed long, n_spans long, kept_sha256 string")
    cut = materialize(cut, "cuts").toDF("cut_id", "cut_hash", "cut_removed", "cut_spans", "cut_sha256")
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64("text").alias("text_hash"),
        F.sha2(text.cast("binary"), 256).alias("whole_sha256"),
    )
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))
    joined = base.join(cut, (own == F.col("cut_id")) & (F.col("text_hash") == F.col("cut_hash")), "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("cut_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("cut_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
    )
