"""Consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``vnodes`` places on a ring of 64-bit hashes; they cut the ring into arcs, owned by the shard at the
arc's end (the next one clockwise). Rows with equal texts share one place, so copies stay together; a group of copies
that holds more than ``whole`` of a shard, or more rows than a cell, is spread by doc_id instead, and so no place
holds more than that.
Walking clockwise, a row goes to its arc's shard, or, where that is full, to the next one clockwise that is not.
A shard is full at ``1 + slack`` times the mean, which bounds all loads to that and one group of copies, and the
least one to ``1 - (shards - 1) * slack`` and one group.

Distributed: rows are summed up by cells (pieces of arcs), the arcs' totals (shards x vnodes rows, whatever the table)
are walked on the driver, and a row's place within its arc, from prefix sums over cells and inside a cell, says in
which of the arc's pieces its middle lies. Law: ``bytes``.

Inputs without a result of their own: an empty table gives no rows; a null text has size 8 and the place of an empty
one; a null doc_id is an id like any other; repeated rows get a slot each; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staywise.session import materialize

#: Production parameters.
SHARDS = 24
VNODES = 128
SLACK = 0.001
WHOLE = 0.05
ROWS_PER_CELL = 50_000
ROW_OVERHEAD = 8
RING = 1 << 63
RING_BITS = 12


def ring(shards: int, vnodes: int) -> tuple[list[int], list[int]]:
    """Places of all virtual nodes in order, and their shards; a shard's places don't depend on the other shards."""
    nodes = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.sha256(f"shard {shard} node {v}".encode()).digest()
            nodes.append((int.from_bytes(digest[:8], "big") % RING, shard))
    nodes.sort()
    return [p for p, _ in nodes], [s for _, s in nodes]


def walk(owners: list[int], loads: list[int], shards: int, limit: float) -> list[tuple[int, int, int]]:
    """(arc, from byte, shard): who takes the arc's bytes from there on. The sequential rule, over arcs' totals."""
    free = [limit] * shards
    pieces: list[tuple[int, int, int]] = []
    for arc, load in enumerate(loads):
        at, node = 0, arc
        while True:
            shard = owners[node % len(owners)]
            if free[shard] > 0 or node - arc > len(owners):
                pieces.append((arc, at, shard))
                take = min(load - at, free[shard]) if node - arc <= len(owners) else load - at
                free[shard] -= take
                at += math.ceil(take)
                if at >= load:
                    break
            node += 1
    return pieces


def _table(spark: SparkSession, values: list, schema: str) -> DataFrame:
    """A small table from driver values as one literal."""
    text = F.lit(json.dumps(values))
    return spark.range(1).select(F.inline(F.from_json(text, schema)))


def slim_rows(docs: DataFrame) -> DataFrame:
    """What sharding needs of each row, written once; texts are read a single time and never shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return materialize(
        docs.select(
            "doc_id",
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
            F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("place")).alias("own"),
        ),
        "shard-rows",
    )


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    vnodes: int = VNODES,
    slack: float = SLACK,
    whole: float = WHOLE,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (null)."""
    spark = docs.sparkSession
    rows = slim_rows(docs)
    n, load = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    limit = max(1.0, load / shards * (1 + slack))
    weights = rows.groupBy(F.col("group").alias("heavy")).agg(F.sum("size").alias("weight"), F.count("*").alias("rows"))
    heavy = weights.where((F.col("weight") > limit * whole) | (F.col("rows") > rows_per_cell)).select("heavy")
    heavy = materialize(heavy, "shard-heavy")
    place = F.when(F.col("heavy").isNull(), F.col("group")).otherwise(F.col("own"))
    placed = rows.join(heavy, F.col("group") == F.col("heavy"), "left").withColumn(
        "place", F.shiftrightunsigned(place, 1)
    )
    places, owners = ring(shards, vnodes)
    cells = max(1, math.ceil(n / rows_per_cell))
    # an arc's number is the count of nodes before the place: looked up in a slice of the ring, not searched from the start
    slices = 1 << RING_BITS
    per = RING // slices
    edges = [[bisect.bisect_left(places, i * per), [p for p in places if i * per <= p < (i + 1) * per]] for i in range(slices)]
    lookup = _table(
        spark, [{"part": i, "base": b, "inner": p} for i, (b, p) in enumerate(edges)], "array<struct<part:long,base:long,inner:array<long>>>"
    )
    placed = (
        placed.withColumn("part", F.shiftright("place", 63 - RING_BITS))
        .join(F.broadcast(lookup), "part")
        .withColumn("arc", (F.col("base") + F.size(F.filter("inner", lambda p: p < F.col("place")))) % len(owners))
        .withColumn("wraps", (F.col("place") > F.lit(places[-1])).cast("int"))
        .withColumn("cell", F.shiftright(F.shiftright("place", 31) * cells, 32))
        .select("doc_id", "size", "text_crc32", "group", "own", "place", "arc", "wraps", "cell")
    )
    # the first arc begins behind the last node and runs over the ring's end: its rows there come first
    totals = materialize(
        placed.groupBy("arc", "wraps", "cell").agg(F.sum("size").alias("cell_size")), "shard-cells"
    )
    loads = [0] * len(owners)
    for arc, size in totals.groupBy("arc").agg(F.sum("cell_size")).collect():  # shards x vnodes rows
        loads[arc] = size
    pieces: dict[int, list[dict]] = {}
    for arc, at, shard in walk(owners, loads, shards, limit):
        pieces.setdefault(arc, []).append({"at": at, "to": shard})
    taken = _table(
        spark, [{"arc": a, "pieces": p} for a, p in pieces.items()], "array<struct<arc:long,pieces:array<struct<at:long,to:int>>>>"
    )
    earlier = Window.partitionBy("arc").orderBy(F.col("wraps").desc(), "cell")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("arc", "wraps", "cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("start"))
    cell = ["arc", "wraps", "cell"]
    inside = Window.partitionBy(*cell).orderBy("place", "group", "own", "doc_id")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row goes where its middle lies; copies go together, where the middle of their group lies
    copies = Window.partitionBy(*cell, "place", "group")
    middle = F.min("offset").over(copies) + (F.sum("size").over(copies) / 2).cast("long")
    sharded = (
        placed.withColumn("ahead", ahead)
        .join(starts, cell)
        .withColumn("offset", F.col("start") + F.col("ahead"))
        .withColumn("offset", middle)
        .join(F.broadcast(taken), "arc")
        .withColumn("shard", F.element_at(F.filter("pieces", lambda p: p["at"] <= F.col("offset")), -1)["to"])
    )
    counts = sharded.groupBy("shard", *cell).agg(F.count("*").alias("rows"))
    order = Window.partitionBy("shard").orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    slots = counts.select("shard", *cell, F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("from_slot"))
    within = Window.partitionBy(*cell, "shard").orderBy("place", "group", "own", "doc_id")
    return (
        sharded.withColumn("nth", F.row_number().over(within) - 1)
        .join(slots, ["shard", *cell])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("from_slot") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
