"""Resampling towards a target corpus by importance weights of hashed n-grams, drawn with Gumbel noise.

Every document gets the mean log-ratio of its features' buckets between the target and the raw corpus; Gumbel noise from
its id is added, and the highest scores are a weighted draw without replacement.

Features come from whole batches of texts: a batch's texts are joined with a separator that is in no word, one regex
pass finds all words, and a search of their places among the offsets of the documents tells which neighbours stand in
the same document; n-grams across two documents are masked before the buckets are counted. The words of a batch are
taken in chunks, so memory doesn't follow a very long text.

Counts of buckets are summed up in each task before they are shuffled; the driver holds ``BUCKETS`` pairs of numbers.
Ranks are counted per whole score, of which there are some ten thousands at most, and ordered inside each score.

Inputs without a result of their own: an empty table gives no rows; a null or empty text has no words, no features and
weight 0; an empty target gives the ratios of no target features; a null doc_id hashes as an empty text and comes first
among equal scores; repeated rows are scored and drawn each; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise.llm import words
from staywise.session import materialize

#: Production parameters.
LONGEST = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Between the texts of a batch; no byte of it is in a word.
SENTINEL = b"\n"
CHUNK = 1 << 17
#: Longer words are hashed one at a time.
LONG_WORD = 64

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def _fed(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC registers ``state`` after the bytes data[start[i]:end[i]] of each."""
    out = state.copy()
    length = end - start
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = np.uint32(zlib.crc32(data[start[i] : end[i]].tobytes(), int(out[i] ^ _ONES))) ^ _ONES
    rows = np.flatnonzero(length <= LONG_WORD)
    rows = rows[np.argsort(-length[rows], kind="stable")]
    sizes = length[rows]
    register, at = out[rows], start[rows]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, "left"))  # those longer than k
        register[:n] = _CRC[(register[:n] ^ data[at[:n] + k]) & 0xFF] ^ (register[:n] >> 8)
    out[rows] = register
    return out


def batch_features(texts: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, words, bucket): per chunk of a batch's words the document and bucket of each feature, and the document of each word."""
    joined = SENTINEL.join(texts).lower()  # of bytes: A-Z alone
    data = np.frombuffer(joined, np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) + len(SENTINEL) for t in texts])[:-1]])
    found = (m.span() for m in _WORD.finditer(joined))
    tail = np.zeros((0, 2), np.int64)
    space = np.uint32(0x20)
    while len(chunk := np.fromiter(chain.from_iterable(islice(found, CHUNK)), np.int64).reshape(-1, 2)):
        new = len(tail)
        span = np.concatenate([tail, chunk])
        document = np.searchsorted(offsets, span[:, 0], "right") - 1
        owners, kept = [], []
        register = _fed(np.full(len(span), _ONES), data, span[:, 0], span[:, 1])
        for size in range(1, longest + 1):
            if size > 1:  # each run of size - 1 words goes on with a space and the next word
                register = register[:-1]
                register = _CRC[(register ^ space) & 0xFF] ^ (register >> 8)
                register = _fed(register, data, span[size - 1 :, 0], span[size - 1 :, 1])
            if not len(register):
                break
            last = np.arange(size - 1, len(span))
            same = (document[size - 1 :] == document[: len(register)]) & (last >= new)
            owners.append(document[: len(register)][same])
            kept.append(((register ^ _ONES)[same] % np.uint32(buckets)).astype(np.int64))
        yield np.concatenate(owners), document[new:], np.concatenate(kept)
        tail = span[max(0, len(span) - longest + 1) :] if longest > 1 else span[:0]


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]


def _count_rows(longest: int, buckets: int):
    """(target, bucket, features): summed up over the whole task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in words.blocks(batch, "text"):
                target = np.asarray(part.column("target")).astype(np.int64)
                for document, _, bucket in batch_features(_texts(part), longest, buckets):
                    total += np.bincount(target[document] * buckets + bucket, minlength=2 * buckets).reshape(2, buckets)
        target, bucket = np.nonzero(total)
        columns = [pa.array(target), pa.array(bucket), pa.array(total[target, bucket])]
        yield pa.RecordBatch.from_arrays(columns, ["target", "bucket", "features"])

    return rows


def _weight_rows(gains: np.ndarray, longest: int):
    """(doc_id, n_words, n_features, weight)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                n_words, n_features, total = (np.zeros(part.num_rows, np.int64) for _ in range(3))
                for document, owner, bucket in batch_features(_texts(part), longest, len(gains)):
                    n_words += np.bincount(owner, minlength=part.num_rows)
                    n_features += np.bincount(document, minlength=part.num_rows)
                    order = np.concatenate([[0], np.cumsum(gains[bucket][np.argsort(document, kind="stable")])])
                    ends = np.cumsum(np.bincount(document, minlength=part.num_rows))
                    total += np.diff(order[np.concatenate([[0], ends])])
                weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
                columns = [part.column("doc_id"), *map(pa.array, (n_words, n_features, weight))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return rows


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket 1000 times the log-ratio of its smoothed shares in ``target`` and ``docs``, rounded down."""
    texts = docs.select("text", F.lit(0).alias("target")).unionByName(target.select("text", F.lit(1).alias("target")))
    counts = texts.transform(words.map_texts, _count_rows(longest, buckets), "target long, bucket long, features long")
    held = [[0] * buckets, [0] * buckets]
    for row in counts.groupBy("target", "bucket").agg(F.sum("features").alias("features")).collect():  # 2 x buckets at most
        held[row.target][row.bucket] = row.features
    raw, aim = sum(held[0]), sum(held[1])
    ratios = (float((t + 1) * (raw + buckets)) / float((s + 1) * (aim + buckets)) for s, t in zip(*held, strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel number from the hash of seed and id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (1, 2, ... of those drawn, else null)."""
    texts = docs.select("doc_id", "text")
    gains = bucket_gains(texts, target, longest, buckets)
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    rows = texts.transform(words.map_texts, _weight_rows(gains, longest), schema)
    able = (F.col("n_words") >= least_words).alias("able")
    rows = rows.select("doc_id", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"), able)
    rows = materialize(rows, "importance")

    # one row per whole score: how many documents have a higher one
    sizes = rows.where("able").groupBy("score").agg(F.count("*").alias("n"))
    higher = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before, total = F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total")
    sizes = sizes.select(F.col("score").alias("of_score"), before, total)
    drawn = F.expr(f"total * {percent} DIV 100")
    starts = sizes.where(F.col("before") < drawn).select("of_score", "before", drawn.alias("drawn"))

    inside = F.row_number().over(Window.partitionBy("able", "score").orderBy(F.col("doc_id").asc_nulls_first(), "n_features"))
    placed = rows.withColumn("place", inside).join(starts, F.col("able") & (F.col("score") == F.col("of_score")), "left")
    rank = F.col("before") + F.col("place")
    return placed.select("doc_id", "n_features", "weight", "score", F.when(rank <= F.col("drawn"), rank).cast("long").alias("rank"))
