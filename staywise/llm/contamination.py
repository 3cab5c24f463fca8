"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``window`` words (an item with fewer words is one window). A window lies in a document
only if all its shingles do, so one shingle is a sufficient prefix: with shingles ordered by rarity (the number of
documents that hold them, counted over all documents), each window is joined by its rarest one alone. Where a document holds that
shingle at word p, the window can only start at p less the shingle's place in it (positional bound), and only if its
words fit between there and the document's end (length bound); what is left is verified word by word.

The benchmark is worked off in blocks of at most ``block_words`` words (and one item), each sent to the tasks as a
whole; documents pass by in place, without a shuffle, once for the counts and once for the join.

Inputs without a result of their own: an empty table of documents gives no rows, an empty benchmark no hits; null or
wordless documents have no words and aren't contaminated; null or wordless items have no windows; items with one id
count once, and items without an id are left out; repeated rows get a row each; other columns pass by.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.llm import words
from staywise.session import materialize

#: Production parameters.
WINDOW = 13
SHINGLE = 5
BLOCK_WORDS = 1_000_000
SHARE = 20
FILTER_BITS = 20
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass
class Block:
    """Items of a block: words (hashes and bytes), windows as (first word, length, item), and their shingles."""

    ids: list[str]
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each window
    length: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, ids: list[str], texts: list[str | None], window: int) -> Block:
        found = words.split_words(*words.utf8(pa.array(texts, pa.string())), words.ALNUM)
        first, length, item = [], [], []
        for i in range(len(ids)):
            a, b = int(found.first[i]), int(found.first[i + 1])
            n = min(window, b - a)
            if n:
                starts = np.arange(a, b - n + 1)
                first.append(starts)
                length.append(np.full(len(starts), n))
                item.append(np.full(len(starts), i))
        none = [np.zeros(0, np.int64)]
        parts = [np.concatenate(x or none) for x in (first, length, item)]
        return cls(ids, found.data, found.start, found.end, found.hash, *parts)

    def shingles(self, shingle: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle length: (hash, window, place in the window) of all shingles of all windows."""
        out = {}
        sizes = np.minimum(self.length, shingle)
        for size in np.unique(sizes):
            every = words.shingle_hashes(self.hash, int(size))
            window = np.flatnonzero(sizes == size)
            per = self.length[window] - size + 1
            of = np.repeat(window, per)
            place = np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)
            out[int(size)] = (every[self.first[of] + place], of, place)
        return out

    def word_bytes(self, first: int, length: int) -> list[bytes]:
        return [self.data[self.start[k] : self.end[k]].tobytes() for k in range(first, first + length)]


@dataclass
class Lookup:
    """Sorted hashes, with a table that rules most others out."""

    keys: np.ndarray
    likely: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> Lookup:
        likely = np.zeros(1 << FILTER_BITS, dtype=bool)
        likely[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        return cls(np.unique(hashes), likely)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``hashes``, place in ``keys``) of the hashes that are held."""
        at = np.flatnonzero(self.likely[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[key] == hashes[at]
        return at[same], key[same]


def _inside(found: words.Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, whether ``size`` words from ``at`` on lie in it)."""
    text = np.searchsorted(found.first, at, "right") - 1
    return text, at + size <= found.first[text + 1]


def _count_rows(lookups: dict[int, Lookup]):
    """(size, key, n): texts of a block that hold a shingle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                found = words.split_words(*words.utf8(part.column("text")), words.ALNUM)
                for size, lookup in lookups.items():
                    at, key = lookup.find(words.shingle_hashes(found.hash, size))
                    text, fits = _inside(found, at, size)
                    once = np.unique(text[fits] * len(lookup.keys) + key[fits]) % len(lookup.keys)
                    keys, n = np.unique(once, return_counts=True)
                    sizes = np.full(len(keys), size, dtype=np.int32)
                    columns = [pa.array(sizes), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["size", "key", "n"])

    return rows


@dataclass
class Prefix:
    """For shingles of one length: the lookup, and per key the windows that it is the prefix of, with its place in them."""

    size: int
    lookup: Lookup
    first: np.ndarray
    window: np.ndarray
    place: np.ndarray


def prefixes(block: Block, shingle: int, rarity: dict[int, np.ndarray], lookups: dict[int, Lookup]) -> list[Prefix]:
    """Each window's rarest shingle; of equally rare ones the one with the smallest hash, then the first."""
    out = []
    for size, (hashes, window, place) in block.shingles(shingle).items():
        held = rarity[size][np.searchsorted(lookups[size].keys, hashes)]
        order = np.lexsort((place, hashes, held, window))
        hashes, window, place, held = hashes[order], window[order], place[order], held[order]
        best = np.concatenate([[True], window[1:] != window[:-1]])
        hashes, window, place, held = hashes[best], window[best], place[best], held[best]
        there = held > 0  # a window whose rarest shingle no document holds is in none
        hashes, window, place = hashes[there], window[there], place[there]
        order = np.argsort(hashes, kind="stable")
        lookup = Lookup.of(hashes)
        first = np.searchsorted(hashes[order], lookup.keys)
        first = np.append(first, len(hashes))
        out.append(Prefix(size, lookup, first, window[order], place[order]))
    return [p for p in out if len(p.window)]


def _matches(found: words.Words, block: Block, prefix: Prefix) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of all verified windows in the texts."""
    at, key = prefix.lookup.find(words.shingle_hashes(found.hash, prefix.size))
    many = prefix.first[key + 1] - prefix.first[key]
    at = np.repeat(at, many)
    pick = np.repeat(prefix.first[key], many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    window = prefix.window[pick]
    start = at - prefix.place[pick]
    text, _ = _inside(found, at, 0)
    fits = (start >= found.first[text]) & (start + block.length[window] <= found.first[text + 1])
    start, window = start[fits], window[fits]
    same = np.ones(len(start), dtype=bool)
    for k in range(int(block.length.max())):
        inside = np.flatnonzero(same & (block.length[window] > k))
        same[inside] = found.hash[start[inside] + k] == block.hash[block.first[window[inside]] + k]
    start, window = start[same], window[same]
    known: dict[tuple[bytes, ...], bool] = {}
    exact = np.ones(len(start), dtype=bool)
    for i, (s, w) in enumerate(zip(start.tolist(), window.tolist(), strict=True)):
        n, f = int(block.length[w]), int(block.first[w])
        here = found.data[found.start[s] : found.end[s + n - 1]].tobytes()
        key = (here, w)
        if key not in known:
            own = [found.data[found.start[s + k] : found.end[s + k]].tobytes() for k in range(n)]
            known[key] = own == block.word_bytes(f, n)
        exact[i] = known[key]
    return start[exact], window[exact]


def _join_rows(block: Block, prefix: list[Prefix], names: list[str]):
    """The rows with their words counted and the block's hits added to those of earlier blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                found = words.split_words(*words.utf8(part.column("text")), words.ALNUM)
                pairs = [_matches(found, block, p) for p in prefix]
                start = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.int64)])
                window = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.int64)])
                change = np.zeros(len(found.hash) + 1, dtype=np.int64)
                np.add.at(change, start, 1)
                np.add.at(change, start + block.length[window], -1)
                text, _ = _inside(found, start, 0)
                own_items: dict[int, set[str]] = {}
                for t, w in zip(text.tolist(), window.tolist(), strict=True):
                    own_items.setdefault(t, set()).add(block.ids[int(block.item[w])])
                spans, items, n_hit = [], [], []
                old_spans, old_items = part.column("hit_spans"), part.column("hit_items")
                hit = np.cumsum(change[:-1]) > 0
                for i in range(part.num_rows):
                    a, b = int(found.first[i]), int(found.first[i + 1])
                    earlier = old_spans[i].as_py() or []
                    if i not in own_items and not earlier:
                        spans.append([])
                        items.append([])
                        n_hit.append(0)
                        continue
                    own = hit[a:b].copy()
                    for k in range(0, len(earlier), 2):
                        own[earlier[k] : earlier[k + 1]] = True
                    spans.append(np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))).tolist())
                    items.append(sorted(own_items.get(i, set()) | set(old_items[i].as_py() or [])))
                    n_hit.append(int(own.sum()))
                columns = [part.column(n) for n in names]
                columns += [
                    pa.array(np.diff(found.first).astype(np.int64)),
                    pa.array(n_hit, pa.int64()),
                    pa.array(spans, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_hit", "hit_spans", "hit_items"])

    return rows


def _blocks(items: DataFrame, window: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks by hash of the id; a block's size is bounded, whatever the benchmark's."""
    items = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("id"), "text")
    total = items.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(r"\S+"))), F.lit(0))).first()[0]
    n = max(1, math.ceil(2 * total / block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))
    for k in range(n):
        rows = dealt.where(F.col("block") == k).orderBy("id", "text").collect()
        yield Block.of([r.id for r in rows], [r.text for r in rows], window)


def contaminated_words(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans (word ranges: from, to, from, to, ...) and hit_items (ids as strings, sorted)."""
    names = [n for n in docs.columns if n not in ("n_words", "n_hit", "hit_spans", "hit_items")]
    fields = [docs.schema[n] for n in names]
    more = "n_words long, n_hit long, hit_spans array<long>, hit_items array<string>"
    schema = T.StructType([*fields, *T.StructType.fromDDL(more).fields])
    none = [F.array().cast("array<long>").alias("hit_spans"), F.array().cast("array<string>").alias("hit_items")]
    out = docs.select(*[F.col(f"`{n}`") for n in names], *none)
    for i, block in enumerate(_blocks(items, window, block_words)):
        lookups = {size: Lookup.of(s[0]) for size, s in block.shingles(shingle).items()}
        rarity = {size: np.zeros(len(x.keys), dtype=np.int64) for size, x in lookups.items()}
        if lookups:
            counts = docs.select("text").transform(words.map_texts, _count_rows(lookups), "size int, key long, n long")
            for size, key, n in counts.groupBy("size", "key").agg(F.sum("n")).collect():  # the block's shingles
                rarity[size][key] = n
        found = prefixes(block, shingle, rarity, lookups)
        if i:
            out = materialize(out, "contamination")
            out = out.drop("n_words", "n_hit")
        out = out.transform(words.map_texts, _join_rows(block, found, names), schema)
    return out


def summary(found: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def is_contaminated() -> Column:
    """Some word is hit, and at least one in SHARE."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    named = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(docs.columns)]
    back = [F.col(f"c{i}").alias(n) for i, n in enumerate(docs.columns)]
    found = contaminated_words(docs.select(*named, F.col("text")), items)
    return found.where(~is_contaminated()).select(*back)
