"""A filter of bounded size that spares a shuffle most of the rows that a semi-join or anti-join has no match for.

It never takes a row with a match for one without. Its size is fixed, so with very many keys it lets more and more rows
through, and the join after it still gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.session import materialize

WORD_BITS = 32
WORDS = 1 << 18


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WORD_BITS * WORDS))


def _marked(rows: DataFrame, keys: DataFrame, key: str, mark: str) -> DataFrame:
    """``rows`` with a column ``mark``: false means that ``keys`` doesn't hold the row's key. Broadcasts WORDS rows at most."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % WORD_BITS).cast("int"))
    places = keys.select(_place(F.col(key)).alias("place"))
    word, bits = f"{mark}_word", f"{mark}_bits"
    held = places.groupBy((F.col("place") / WORD_BITS).cast("long").alias(word)).agg(F.bit_or(bit).alias(bits))
    held = F.broadcast(materialize(held, "key-bits"))
    place = _place(rows[key])
    found = F.call_function("shiftright", F.col(bits), (place % WORD_BITS).cast("int")).bitwiseAND(1) == 1
    marked = rows.join(held, (place / WORD_BITS).cast("long") == F.col(word), "left")
    return marked.withColumn(mark, F.coalesce(found, F.lit(False))).drop(word, bits)


def _mark(rows: DataFrame) -> str:
    """A name that no column has."""
    return "maybe" + "_" * max(map(len, rows.columns))


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows that may have a match in ``keys``."""
    mark = _mark(rows)
    return _marked(rows, keys, key, mark).where(F.col(mark)).drop(mark)


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without those whose key is among ``keys``; null keys stay. Only rows that may have a match are shuffled."""
    mark = _mark(rows)
    own, gone = f"{mark}_key", f"{mark}_gone"
    marked = _marked(rows.withColumnRenamed(key, own), keys.withColumnRenamed(key, own), own, mark)
    gone_keys = keys.select(F.col(key).alias(gone))
    maybe = marked.where(F.col(mark)).join(gone_keys, F.col(own) == F.col(gone), "left_anti")
    kept = marked.where(~F.col(mark)).unionByName(maybe).withColumnRenamed(own, key)
    return kept.select(*[F.col(f"`{c}`") for c in rows.columns])
