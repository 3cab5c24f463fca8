"""Connected components of a table of edges, by hooking to smaller neighbours and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.session import materialize


def _ordered(edges: DataFrame, a: str, b: str) -> DataFrame:
    hi, lo = F.greatest(a, b), F.least(a, b)
    return edges.select(hi.alias("hi"), lo.alias("lo")).where("hi <> lo").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for each id on an edge; the component is its smallest id. Loops give no row.

    Each round hooks every node to its smallest smaller neighbour, jumps along two hooks, and contracts the edges, so
    chains shrink to a quarter or less and stars end in two rounds. What a round leaves is written, which cuts the lineage; joins on
    a node with very many edges are between two plain tables, which adaptive execution can split.
    """
    edge = materialize(_ordered(edges, a, b), "edges")
    ids = edge.select(F.explode(F.array("hi", "lo")).alias("id")).distinct()
    label = ids.select("id", F.col("id").alias("component"))
    while not edge.isEmpty():
        hook = materialize(edge.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("to")), "hooks")
        up = hook.select(F.col("node").alias("mid"), F.col("to").alias("far"))
        for _ in range(2):
            hook = hook.join(up, F.col("to") == F.col("mid"), "left")
            hook = hook.select("node", F.coalesce("far", "to").alias("to"))
        hook = materialize(hook, "hooks")
        high, low = hook.toDF("n1", "t1"), hook.toDF("n2", "t2")
        moved = edge.join(high, F.col("hi") == F.col("n1"), "left").join(low, F.col("lo") == F.col("n2"), "left")
        moved = moved.select(F.coalesce("t1", "hi").alias("x"), F.coalesce("t2", "lo").alias("y"))
        edge = materialize(_ordered(moved, "x", "y"), "edges")
        label = label.join(hook, F.col("component") == F.col("node"), "left")
        label = materialize(label.select("id", F.coalesce("to", "component").alias("component")), "labels")
    return label
