"""Exact dedup by recipes of content-defined chunks.

A text's bytes are cut where a rolling hash of the last 31 bytes says so, so equal texts get equal cuts whatever stands
around them. A chunk's identifier is a hash that is verified: chunks are grouped by hash, with map-side combining, and
the smallest and largest bytes of a group must be the same; where they are not, the identifier also carries the rank
of its bytes. A text is then the ordered list of its identifiers (its recipe); equal recipes are equal texts, and only
recipes are grouped and joined: the bytes of a text are moved once, as chunks, and a chunk that many texts hold is
combined before it is moved.

Inputs without a result of their own: an empty table gives no rows; a null text counts as empty, whose recipe is the
empty list; rows with one doc_id and equal texts are kept or dropped together, and each counts; a null doc_id is never
the largest unless there is no other; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staywise.llm import words
from staywise.session import materialize

#: Production parameters: bytes of a chunk at least, about, and at most; bytes of a hash.
LEAST = 256
MEAN_BITS = 10
MOST = 8192
HASH_BYTES = 16
SEGMENT_BYTES = 1 << 20
GEAR = words._mix(np.arange(1, 257, dtype=np.uint64))
#: A cut's hash bits: they depend on the last 31 bytes at most, less than any chunk has.
CUT_MASK = np.uint64(((1 << MEAN_BITS) - 1) << 20)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places behind bytes where the rolling hash asks for a cut."""
    if len(data) > 2 * SEGMENT_BYTES:  # a segment of a very long text at a time, with the bytes that the hash looks back on
        parts = []
        for a in range(0, len(data), SEGMENT_BYTES):
            back = min(a, 31)
            places = cut_places(data[a - back : a + SEGMENT_BYTES])
            parts.append(places[places > back] + a - back)
        return np.concatenate(parts)
    rolled = GEAR[data]
    width = 1
    while width < 32:
        wider = rolled.copy()
        wider[width:] += rolled[:-width] << np.uint64(width)
        rolled, width = wider, width * 2
    return np.flatnonzero(rolled & CUT_MASK == 0) + 1


def chunk_limits(asked: np.ndarray, begin: int, end: int) -> list[int]:
    """Limits of the chunks of one text: the asked cuts within the allowed sizes."""
    limits = [begin]
    at, k = begin, int(np.searchsorted(asked, begin + LEAST))
    while at < end:
        while k < len(asked) and asked[k] < at + LEAST:
            k += 1
        cut = min(int(asked[k]) if k < len(asked) else end, at + MOST, end)
        limits.append(cut)
        at = cut
    return limits


def _chunks(part: pa.RecordBatch, hash_bytes: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(text, place in the recipe, hash, bytes)."""
    data, limits = words.utf8(part.column("text"))
    asked, held = cut_places(data), data.tobytes()
    for i in range(len(limits) - 1):
        ends = chunk_limits(asked, int(limits[i]), int(limits[i + 1]))
        for k in range(len(ends) - 1):
            chunk = held[ends[k] : ends[k + 1]]
            yield i, k, hashlib.blake2b(chunk, digest_size=hash_bytes).digest(), chunk


def _recipe_rows(hash_bytes: int):
    """(doc_id, text_sha256, recipe)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                recipes: list[list[bytes]] = [[] for _ in range(part.num_rows)]
                for i, _, digest, _ in _chunks(part, hash_bytes):
                    recipes[i].append(digest)
                data, limits = words.utf8(part.column("text"))
                held = data.tobytes()
                sums = [hashlib.sha256(held[a:b]).hexdigest() for a, b in zip(limits[:-1], limits[1:], strict=True)]
                columns = [part.column("doc_id"), pa.array(sums), pa.array(recipes, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_sha256", "recipe"])

    return rows


def _chunk_rows(hash_bytes: int):
    """(hash, bytes): each different chunk of a block of texts once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                own = {(digest, chunk) for _, _, digest, chunk in _chunks(part, hash_bytes)}
                columns = [pa.array([c[0] for c in own], pa.binary()), pa.array([c[1] for c in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "bytes"])

    return rows


def _text_chunk_rows(hash_bytes: int):
    """(text_sha256, place, hash, bytes) of every chunk."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                found = list(_chunks(part, hash_bytes))
                texts = part.column("text_sha256").take(pa.array([c[0] for c in found], pa.int64()))
                places = pa.array([c[1] for c in found], pa.int32())
                bodies = [pa.array([c[k] for c in found], pa.binary()) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays([texts, places, *bodies], ["text_sha256", "place", "hash", "bytes"])

    return rows


def recipes(docs: DataFrame, hash_bytes: int = HASH_BYTES) -> DataFrame:
    """(doc_id, text_sha256, recipe): ordered lists of verified chunk identifiers."""
    texts = docs.select("doc_id", "text")
    listed = texts.transform(words.map_texts, _recipe_rows(hash_bytes), "doc_id long, text_sha256 string, recipe array<binary>")
    listed = materialize(listed, "recipes")
    chunks = docs.select("text").transform(words.map_texts, _chunk_rows(hash_bytes), "hash binary, bytes binary")
    same = chunks.groupBy("hash").agg(F.min("bytes").alias("least"), F.max("bytes").alias("most"))
    doubtful = materialize(same.where("least <> most").select("hash"), "chunk-collisions")
    if doubtful.isEmpty():
        return listed
    # different chunks with one hash: the rank of the bytes goes into the identifier
    whole = docs.select("text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    schema = "text_sha256 string, place int, hash binary, bytes binary"
    rows = materialize(whole.transform(words.map_texts, _text_chunk_rows(hash_bytes), schema).join(doubtful, "hash"), "chunk-doubts")
    rank = F.row_number().over(Window.partitionBy("hash").orderBy("bytes"))
    ranked = rows.select("hash", "bytes").distinct().withColumn("rank", rank)
    # texts with one SHA-256 could differ, too: their chunks decide, so all of a text's ranks are kept as lists
    named = rows.join(ranked, ["hash", "bytes"]).select("text_sha256", "place", F.concat("hash", F.col("rank").cast("string").cast("binary")).alias("id"))
    places = named.groupBy("text_sha256").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("place", "id")))).alias("ids"))
    joined = listed.join(places, "text_sha256", "left")
    ranked_recipe = F.transform("recipe", lambda h, i: F.coalesce(F.try_element_at("ids", i), h))
    return materialize(joined.select("doc_id", "text_sha256", F.coalesce(ranked_recipe, "recipe").alias("recipe")), "recipes")


def exact_groups(docs: DataFrame, hash_bytes: int = HASH_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id (largest doc_id of the equal texts), group_size, kept, text_sha256, n_chunks."""
    listed = recipes(docs, hash_bytes)
    groups = listed.groupBy("recipe").agg(F.max("doc_id").alias("largest"), F.count("*").alias("rows"))
    groups = materialize(groups.where("rows > 1"), "equal-recipes").withColumnRenamed("recipe", "same")
    joined = listed.join(groups, F.col("recipe") == F.col("same"), "left")
    keep = F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("largest"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
