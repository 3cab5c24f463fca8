"""Words and word shingles of Arrow text columns as numpy arrays, without a Python loop over words.

Both kinds of words of this subpackage are decided byte by byte: all their separators are ASCII, and every byte of
a longer UTF-8 character is 0x80 or above. A word's hash is a polynomial in 64 bits of its lower-cased bytes, mixed;
a shingle's hash is the mixed sum of its words' hashes, each times a power of an odd number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Odd multipliers; any odd numbers would do.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
BLOCK_BYTES = 1 << 20
PIECE_BYTES = 1 << 20
#: Rows of an Arrow batch of whole texts: a batch is held several times over, by the task and by its Python worker.
BATCH_ROWS = 1_000
BATCH_OPTION = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_texts(rows: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` over rows with texts; lowers the session's batch size, where it is larger, to ``BATCH_ROWS``."""
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(BATCH_OPTION)) <= BATCH_ROWS:
        conf.set(BATCH_OPTION, str(BATCH_ROWS))
    return rows.mapInArrow(function, schema)


def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    alnum = np.zeros(256, dtype=bool)
    alnum[0x30:0x3A] = alnum[0x61:0x7B] = alnum[0x80:] = True
    visible = np.ones(256, dtype=bool)
    visible[0x20] = False
    visible[0x09:0x0E] = False
    return lower, alnum, visible


LOWER, ALNUM, VISIBLE = _kinds()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of some texts: byte ranges in ``data``, hashes, and for text i the words first[i] to first[i + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    prefixes: tuple[np.ndarray, ...] = ()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row limits of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    width = np.int64 if kind == pa.large_binary() else np.int32
    limits = np.frombuffer(column.buffers()[1], width, len(column) + 1, column.offset * np.dtype(width).itemsize)
    limits = limits.astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[limits[0] : limits[-1]], limits - limits[0]


def blocks(batch: pa.RecordBatch, text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` text bytes, so that memory doesn't follow the batch; texts stay whole."""
    _, limits = utf8(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(limits, limits[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def split_words(data: np.ndarray, limits: np.ndarray, kind: np.ndarray, prefixes: tuple[int, ...] = ()) -> Words:
    """All words of the texts data[limits[i]:limits[i + 1]]; ``kind`` says which (lower-cased) bytes are in words.

    ``prefixes`` asks for hashes of the words' first so many bytes too.
    """
    n = len(data)
    low = LOWER[data]
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = kind[low]
    change = np.diff(inside)
    # a word ends where its text ends, even if the next text starts with a word
    begins = change[:-1] == 1
    ends = change[1:] == -1
    cut = limits[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
    begins[both] = True
    ends[both - 1] = True
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, limits)
    if not len(start):
        none = np.zeros(0, np.uint64)
        return Words(low, start, end, none, first, tuple(none for _ in prefixes))
    stops = [end, *[np.minimum(end, start + p) for p in prefixes]]
    hashes = [np.empty(len(start), dtype=np.uint64) for _ in stops]
    at = 0
    while at < len(start):  # in pieces, so that memory doesn't follow a very long text
        to = max(at + 1, int(np.searchsorted(start, start[at] + PIECE_BYTES)))
        for found, piece in zip(hashes, _range_hashes(low, start[at:to], [x[at:to] for x in stops]), strict=True):
            found[at:to] = piece
        at = to
    heads = tuple(_mix(h + np.uint64(p)) for h, p in zip(hashes[1:], prefixes, strict=True))
    return Words(low, start, end, hashes[0], first, heads)


def _range_hashes(data: np.ndarray, start: np.ndarray, stops: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Hash of data[start[i]:stop[i]] for each list of stops; it depends on these bytes alone."""
    base, n = int(start[0]), int(stops[0][-1] - start[0])
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data[base : base + n].astype(np.uint64) + np.uint64(1)) * _powers(BYTE_BASE, n), out=total[1:])
    back = _powers(np.uint64(pow(int(BYTE_BASE), -1, 1 << 64)), n)[start - base]
    for stop in stops:
        yield _mix((total[stop - base] - total[start - base]) * back + (stop - start).astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; the last size - 1 places are cut off."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k, power in enumerate(_powers(WORD_BASE, size)[1:], 1):
        total += hashes[k : k + n] * power
    return _mix(total + np.uint64(size))


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Per text its distinct shingle hashes, sorted; a text with fewer words is one shingle, without words none."""
    every = shingle_hashes(words.hash, size)
    first = words.first
    for i in range(len(first) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        elif b > a:
            yield shingle_hashes(words.hash[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)
