"""Random forests grown level by level on binned features, many at a time.

A group of rows whose bins are small, ``LOCAL_BYTES`` at most, is sent to a bounded number of tasks, each of which grows some
of its trees. Larger groups stay where they are. There, one pass over the rows counts the splits of all open nodes of one level, of all trees of all forests that are grown
together; the passes are as many as the trees are deep, not as many as there are trees. A task routes its rows down the
trees, sums up the classes by node, feature and bin, and sends only these sums. The driver holds the trees, and of
each open node its best split.

A tree draws its rows by itself: how often it takes a row is a Poisson number from the hash of tree and row, so nothing is
drawn twice or stored, and a task that runs again draws the same. Classes are weighted per tree to equal sums over the
rows that it has drawn. Minimum sizes of nodes and leaves count drawn rows once each.

Since a node's split depends on its rows alone, a tree of less depth, or of a larger minimum size of a split node, is the
same tree cut off earlier, and a forest of fewer trees is the beginning of a larger one. ``point_votes`` reads all of
these off one forest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.errors import InputError
from staywise.session import materialized

BINS = 32
#: Sums of a pass: nodes x features tried x bins x 3. More open nodes are counted in several passes.
CELLS = 6_000_000
#: Bins, numbers and labels of a group of rows that tasks may hold whole.
LOCAL_BYTES = 1 << 27
#: There: tasks per core, drawn rows that are grown together unless one tree has more, and cells counted at a time.
LOCAL_TASKS = 6
LOCAL_ROWS = 1 << 18
LOCAL_CELLS = 1 << 20
#: Drawn rows and rows are added up in one number: more than the rows of a group that a task holds, and exact in a double.
COUNT = 1 << 26
#: Pairs of row and tree that a task works on at a time.
PAIRS = 1 << 19
#: Nodes of the trees that rows are scored with at a time.
NODES = 2_000_000
_DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))  # Poisson with mean 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(seed: int, *parts) -> np.ndarray:
    out = _mixed(np.array([seed % (1 << 63) + 1], dtype=np.uint64))
    for part in parts:
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + np.asarray(part).astype(np.int64).view(np.uint64))
    return out


def draws(seed: int, tree: np.ndarray, row: np.ndarray) -> np.ndarray:
    """How often each tree takes each row: (trees, rows)."""
    share = (_hashed(seed, tree[:, None], row[None, :]) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_DRAWS, share, "right")


def tried_features(seed: int, tree: np.ndarray, path: np.ndarray, features: int, tried: int) -> np.ndarray:
    """The features that a node may split on, ascending; ``path`` numbers the nodes of a tree from the root, 1, on."""
    order = np.argsort(_hashed(seed + 1, tree[:, None], path[:, None], np.arange(features)[None, :]), axis=1, kind="stable")
    return np.sort(order[:, :tried], axis=1)


def running(votes: np.ndarray) -> np.ndarray:
    """Sums over the first trees, one tree after the other, so that equal rows tie whatever batch they come in."""
    return np.cumsum(votes, axis=0)


@dataclass
class Trees:
    """Trees one behind the other; a node's right child stands behind its left one, and a feature of -1 marks a leaf.

    ``rows`` counts the different rows of a node, ``weight`` is their weight, ``value`` the share of class 1 in it.
    """

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    weight: np.ndarray
    value: np.ndarray

    def to_json(self) -> str:
        return json.dumps({k: v.tolist() for k, v in vars(self).items()})

    @classmethod
    def from_json(cls, text: str) -> Trees:
        kinds = {"threshold": np.float64, "weight": np.float64, "value": np.float64}
        return cls(**{k: np.array(v, dtype=kinds.get(k, np.int64)) for k, v in json.loads(text).items()})

    def part(self, trees: np.ndarray) -> Trees:
        """Some of the trees."""
        ends = np.append(self.root[1:], len(self.feature))
        nodes = np.concatenate([np.arange(self.root[t], ends[t]) for t in trees]) if len(trees) else np.zeros(0, np.int64)
        moved = np.zeros(len(self.feature), np.int64)
        moved[nodes] = np.arange(len(nodes))
        left = np.where(self.feature[nodes] >= 0, moved[self.left[nodes]], 0)
        own = {k: getattr(self, k)[nodes] for k in ("feature", "threshold", "rows", "weight", "value")}
        return Trees(root=moved[self.root[trees]], left=left, **own)

    def step(self, at: np.ndarray, values: np.ndarray, least: int = 0) -> np.ndarray:
        """The nodes (trees, rows) one level further down; nodes of fewer than ``least`` rows are leaves."""
        feature = self.feature[at]
        inner = (feature >= 0) & (self.rows[at] >= least)
        right = values[np.arange(len(values))[None, :], np.where(inner, feature, 0)] > self.threshold[at]
        return np.where(inner, self.left[at] + right, at)

    def leaves(self, values: np.ndarray) -> np.ndarray:
        at = np.repeat(self.root[:, None], len(values), axis=1)
        while True:
            below = self.step(at, values)
            if (below == at).all():
                return at
            at = below

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Mean share of class 1 in the leaves of the rows."""
        out = np.zeros(len(values))
        for i in range(0, len(values), max(1, PAIRS // max(1, len(self.root)))):
            some = values[i : i + max(1, PAIRS // max(1, len(self.root)))]
            out[i : i + len(some)] = running(self.value[self.leaves(some)])[-1] / len(self.root)
        return out

    def importances(self, features: int) -> np.ndarray:
        """Mean decrease of weighted Gini impurity by feature, adding up to 1."""
        total = np.zeros(features)
        inner = np.flatnonzero(self.feature >= 0)
        impurity = 2 * self.value * (1 - self.value) * self.weight
        gain = impurity[inner] - impurity[self.left[inner]] - impurity[self.left[inner] + 1]
        tree = np.searchsorted(self.root, inner, "right") - 1
        share = gain / np.maximum(self.weight[self.root[tree]], 1e-300)
        sums = np.bincount(tree, share, len(self.root))
        np.add.at(total, self.feature[inner], share / np.where(sums[tree] > 0, sums[tree], 1.0))
        return total / total.sum() if total.sum() > 0 else total


@dataclass(frozen=True)
class Plan:
    """What is grown together: for each group of rows a forest for each minimum size of a leaf."""

    trees: int
    depth: int
    split: int
    leaves: tuple[int, ...]
    groups: tuple[int, ...] = (0,)
    seed: int = 0
    bins: int = BINS


def feature_cuts(rows: DataFrame, groups: Sequence[int], features: int, bins: int = BINS) -> dict[int, list[np.ndarray]]:
    """Per group and feature the values that a split may be at: quantiles, at most ``bins`` - 1."""
    shares = [i / bins for i in range(1, bins)]
    cuts: dict[int, list[np.ndarray]] = {g: [np.zeros(0)] * features for g in groups}
    each = [F.percentile_approx(F.col("values")[i], shares, 10_000).alias(f"c{i}") for i in range(features)]
    for found in rows.groupBy("grp").agg(*each).collect():  # a row per group
        cuts[found["grp"]] = [np.unique(np.array(found[f"c{i}"] or [], dtype=np.float64)) for i in range(features)]
    return cuts


def _binned_rows(cuts: dict[int, list[np.ndarray]]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.asarray(batch.column("grp"))
            values = _matrix(batch.column("values"), len(next(iter(cuts.values()))))
            out = np.zeros(values.shape, np.uint8)
            for g in np.unique(group):
                own = group == g
                for i, limits in enumerate(cuts[int(g)]):
                    out[own, i] = np.searchsorted(limits, values[own, i], "left")
            ends = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
            bins = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(ends), pa.py_buffer(out)])
            names = ["row", "grp", "label"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], bins], [*names, "bins"])

    return rows


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class _Growth:
    """The nodes of all trees while they grow: of group g, minimum leaf l and tree t the unit (g x leaves + l) x trees + t."""

    def __init__(self, plan: Plan, features: int, first: int = 0) -> None:
        self.plan = plan
        self.features = features
        self.first = first  # number of the first tree
        self.tried = max(1, int(np.sqrt(features)))
        units = len(plan.groups) * len(plan.leaves) * plan.trees
        self.unit = np.arange(units)
        self.path = np.ones(units, np.int64)
        self.feature = np.full(units, -1, np.int64)
        self.cut = np.zeros(units, np.int64)
        self.left = np.zeros(units, np.int64)
        self.rows = np.zeros(units, np.int64)
        self.classes = np.zeros((units, 2), np.int64)
        self.frontier = np.arange(units)

    @property
    def units(self) -> int:
        return len(self.plan.groups) * len(self.plan.leaves) * self.plan.trees

    def tree_of(self, unit: np.ndarray) -> np.ndarray:
        return self.first + unit % self.plan.trees

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        return np.array(self.plan.leaves)[unit // self.plan.trees % len(self.plan.leaves)]

    def class_weights(self, unit: np.ndarray) -> np.ndarray:
        """Weights by class that make the classes of a tree's drawn rows equal."""
        drawn = self.classes[unit].astype(np.float64)
        return np.where(drawn > 0, drawn.sum(axis=1, keepdims=True) / (2 * np.maximum(drawn, 1)), 0.0)

    def chunks(self) -> Iterator[np.ndarray]:
        at = max(1, CELLS // (self.tried * self.plan.bins * 3))
        for i in range(0, len(self.frontier), at):
            yield self.frontier[i : i + at]

    def grow(self, nodes: np.ndarray, found: pd.DataFrame, first: bool) -> None:
        """Take in the sums and best splits of open nodes."""
        place = nodes[found["slot"].to_numpy()]
        if first:
            self.rows[place] = found["rows"].to_numpy()
            self.classes[place] = found[["c0", "c1"]].to_numpy()
        split = found[found["feature"] >= 0]
        place = nodes[split["slot"].to_numpy()]
        self.feature[place], self.cut[place] = split["feature"].to_numpy(), split["cut"].to_numpy()
        n = len(place)
        self.left[place] = len(self.unit) + 2 * np.arange(n)
        small = split[["l_rows", "l_c0", "l_c1"]].to_numpy()
        whole = split[["rows", "c0", "c1"]].to_numpy()
        both = np.stack([small, whole - small], axis=1).reshape(-1, 3)
        self.unit = np.concatenate([self.unit, np.repeat(self.unit[place], 2)])
        self.path = np.concatenate([self.path, np.stack([2 * self.path[place], 2 * self.path[place] + 1], axis=1).ravel()])
        for name, fill in (("feature", -1), ("cut", 0), ("left", 0)):
            setattr(self, name, np.concatenate([getattr(self, name), np.full(2 * n, fill, np.int64)]))
        self.rows = np.concatenate([self.rows, both[:, 0]])
        self.classes = np.concatenate([self.classes, both[:, 1:]])

    def open_nodes(self, since: int) -> np.ndarray:
        """The new nodes that may be split, in order of their trees."""
        new = np.arange(since, len(self.unit))
        new = new[(self.rows[new] >= max(2, self.plan.split)) & (self.classes[new] > 0).all(axis=1)]
        return new[np.argsort(self.unit[new], kind="stable")]

    def trees(self, cuts: dict[int, list[np.ndarray]]) -> dict[tuple[int, int], Trees]:
        """The forests by group and minimum leaf."""
        out = {}
        order = np.argsort(self.unit, kind="stable")
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        weighted = self.classes * self.class_weights(self.unit)
        weight = weighted.sum(axis=1)
        value = np.where(weight > 0, weighted[:, 1] / np.where(weight > 0, weight, 1.0), 0.0)
        size = np.bincount(self.unit, minlength=self.units)
        start = np.concatenate([[0], np.cumsum(size)])
        for i, g in enumerate(self.plan.groups):
            widest = max([1, *map(len, cuts[g])])
            table = np.full((self.features, widest), np.inf)
            for f, limits in enumerate(cuts[g]):
                table[f, : len(limits)] = limits
            for j, leaf in enumerate(self.plan.leaves):
                first = (i * len(self.plan.leaves) + j) * self.plan.trees
                own = order[start[first] : start[first + self.plan.trees]]
                inner = self.feature[own] >= 0
                threshold = np.where(inner, table[np.maximum(self.feature[own], 0), np.minimum(self.cut[own], widest - 1)], 0.0)
                out[g, leaf] = Trees(
                    root=start[first : first + self.plan.trees] - start[first],
                    feature=self.feature[own],
                    threshold=threshold,
                    left=np.where(inner, moved[self.left[own]] - start[first], 0),
                    rows=self.rows[own],
                    weight=weight[own],
                    value=value[own],
                )
        return out


def _count_rows(growth: _Growth, nodes: np.ndarray, tried: np.ndarray, depth: int):
    """(cell, rows, c0, c1) of the open ``nodes``, summed up over the task. A cell is (node, feature tried, bin)."""
    plan, features = growth.plan, growth.features
    units = np.unique(growth.unit[nodes])
    used = np.flatnonzero(np.isin(growth.unit, units))
    moved = np.zeros(len(growth.unit), np.int64)
    moved[used] = np.arange(len(used))
    feature, cut, left = growth.feature[used], growth.cut[used], moved[growth.left[used]]
    slot = np.full(len(used), -1, np.int64)
    slot[moved[nodes]] = np.arange(len(nodes))
    group = np.array(plan.groups)[units // (plan.trees * len(plan.leaves))]
    tree, root = growth.tree_of(units), moved[units]
    width = tried.shape[1] * plan.bins
    seed = plan.seed

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(nodes) * width), np.int64)
        for batch in batches:
            ids, of = np.asarray(batch.column("row")), np.asarray(batch.column("grp"))
            label = np.asarray(batch.column("label"))
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
            for g in np.unique(of):
                mine = np.flatnonzero(group == g)
                if not len(mine):
                    continue
                have = np.flatnonzero(of == g)
                for i in range(0, len(have), max(1, PAIRS // len(mine))):
                    some = have[i : i + max(1, PAIRS // len(mine))]
                    taken = draws(seed, tree[mine], ids[some])
                    at = np.repeat(root[mine][:, None], len(some), axis=1)
                    for _ in range(depth):
                        f = feature[at]
                        right = bins[some[None, :], np.maximum(f, 0)] > cut[at]
                        at = np.where(f >= 0, left[at] + right, at)
                    unit, place = np.nonzero((slot[at] >= 0) & (taken > 0))
                    node, row, n = slot[at[unit, place]], some[place], taken[unit, place]
                    for k in range(tried.shape[1]):
                        cell = node * width + k * plan.bins + bins[row, tried[node, k]]
                        np.add.at(sums[0], cell, 1)
                        np.add.at(sums[1], cell, np.where(label[row] == 0, n, 0))
                        np.add.at(sums[2], cell, np.where(label[row] == 0, 0, n))
        cell = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(cell), *[pa.array(s[cell]) for s in sums]], ["cell", "rows", "c0", "c1"])

    return rows


def _best_splits(weights: np.ndarray | None, leaf: np.ndarray, tried: np.ndarray, bins: int):
    """Per node its sums and the split with the largest gain, ties to the smaller feature and cut; feature -1: none."""

    def best(cells: pd.DataFrame) -> pd.DataFrame:
        width = tried.shape[1] * bins
        slots, at = np.unique(cells["cell"].to_numpy() // width, return_inverse=True)
        sums = np.zeros((len(slots), width, 3), np.int64)
        sums[at, cells["cell"].to_numpy() % width] = cells[["rows", "c0", "c1"]].to_numpy()
        sums = sums.reshape(len(slots), tried.shape[1], bins, 3)
        return pd.DataFrame({"slot": slots, **_choose(sums, None if weights is None else weights[slots], leaf[slots], tried[slots])})

    return best


def _choose(sums: np.ndarray, weights: np.ndarray | None, leaf: np.ndarray, tried: np.ndarray) -> dict[str, np.ndarray]:
    """The best splits by the sums (nodes, features tried, bins, 3) of rows and drawn rows of each class."""
    bins = sums.shape[2]
    whole = sums[:, 0].sum(axis=1)
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = whole[:, None, None, :] - left
    if weights is None:
        drawn = whole[:, 1:].astype(float)
        weights = np.where(drawn > 0, drawn.sum(axis=1, keepdims=True) / (2 * np.maximum(drawn, 1)), 0.0)

    def purity(part: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Weighted squares of the classes' shares: the larger, the purer."""
        mass = part[..., 1:] * w
        total = mass.sum(axis=-1)
        return (mass * mass).sum(axis=-1) / np.where(total > 0, total, 1.0)

    spread = weights[:, None, None, :]
    gain = purity(left, spread) + purity(right, spread) - purity(whole, weights)[:, None, None]
    least = leaf[:, None, None]
    gain = np.where((left[..., 0] >= least) & (right[..., 0] >= least), gain, -1.0).reshape(len(sums), -1)
    gain = np.round(gain, 9)  # equal splits by different features tie
    choice = gain.argmax(axis=1)
    every = np.arange(len(sums))
    k, cut = choice // (bins - 1), choice % (bins - 1)
    good = gain[every, choice] > 0
    picked = left[every, k, cut]
    found = {
        "feature": np.where(good, tried[every, k], -1),
        "cut": cut,
        **{c: whole[:, i] for i, c in enumerate(("rows", "c0", "c1"))},
        **{c: picked[:, i] for i, c in enumerate(("l_rows", "l_c0", "l_c1"))},
    }
    return {c: x.astype(np.int64) for c, x in found.items()}


SPLITS = "slot long, feature long, cut long, rows long, c0 long, c1 long, l_rows long, l_c0 long, l_c1 long"


def grow(rows: DataFrame, plan: Plan) -> dict[tuple[int, int], Trees]:
    """Forests by (group, minimum leaf) from rows (row, grp, label, values): a number, its group, 0 or 1, features."""
    first = rows.select(F.size("values").alias("n")).first()
    if first is None:
        raise InputError("a forest needs rows")
    cuts = feature_cuts(rows, plan.groups, first.n, plan.bins)
    table = rows.select("row", "grp", F.col("label").cast("int").alias("label"), "values")
    binned_rows = table.mapInArrow(_binned_rows(cuts), "row long, grp int, label int, bins binary")
    with materialized(binned_rows, "binned", rebalance=True) as binned:
        largest = binned.groupBy("grp").count().agg(F.max("count")).first()[0]
        if largest * (first.n + 9) <= LOCAL_BYTES:
            return _grow_by_trees(binned, plan, first.n, cuts)
        return _grow_by_levels(binned, plan, first.n, cuts)


def _grow_by_levels(binned: DataFrame, plan: Plan, features: int, cuts: dict[int, list[np.ndarray]]) -> dict[tuple[int, int], Trees]:
    """A pass over the rows for each level of all trees."""
    growth = _Growth(plan, features)
    parts = int(binned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for depth in range(plan.depth):
        since = len(growth.unit)
        for nodes in growth.chunks():
            unit = growth.unit[nodes]
            tried = tried_features(plan.seed, growth.tree_of(unit), growth.path[nodes], features, growth.tried)
            counted = binned.mapInArrow(_count_rows(growth, nodes, tried, depth), "cell long, rows long, c0 long, c1 long")
            # one shuffle, by node, serves both the sums of cells and the choice of splits
            part = F.pmod(F.floor(F.col("cell") / (growth.tried * plan.bins)), F.lit(parts))
            cells = counted.withColumn("part", part).repartition("part").groupBy("part", "cell")
            cells = cells.agg(*[F.sum(c).alias(c) for c in ("rows", "c0", "c1")])
            weights = growth.class_weights(unit) if depth else None
            best = _best_splits(weights, growth.leaf_of(unit), tried, plan.bins)
            found = cells.groupBy("part").applyInPandas(best, SPLITS).toPandas()  # a row per open node
            growth.grow(nodes, found.sort_values("slot"), depth == 0)
        growth.frontier = growth.open_nodes(since)
        if not len(growth.frontier):
            break
    return growth.trees(cuts)


#: Types of the trees that tasks send.
KINDS = {"root": "int64", "feature": "int16", "threshold": "float64", "left": "int32", "rows": "int32", "weight": "float64", "value": "float64"}


def _grow_by_trees(binned: DataFrame, plan: Plan, features: int, cuts: dict[int, list[np.ndarray]]) -> dict[tuple[int, int], Trees]:
    """Each task gets the packed rows of one group and grows some of its trees, for all minimum leaves."""
    cores = binned.sparkSession.sparkContext.defaultParallelism
    packs = max(1, min(plan.trees, -(-LOCAL_TASKS * cores // len(plan.groups))))
    limits = np.linspace(0, plan.trees, packs + 1).astype(int)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.asarray(batch.column("grp"))
            for g in np.unique(group):
                own = batch.filter(pa.array(group == g))
                number, label = np.asarray(own.column("row")).astype(np.int64), np.asarray(own.column("label")).astype(np.uint8)
                packed = [number.tobytes(), label.tobytes(), b"".join(own.column("bins").to_pylist())]
                columns = [pa.array([int(g)], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]]
                yield pa.RecordBatch.from_arrays(columns, ["grp", "number", "label", "bins"])

    def trees(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        g, at = (k.as_py() for k in key)
        number, label, bins = (
            np.frombuffer(b"".join(rows.column(c).to_pylist()), t) for c, t in (("number", np.int64), ("label", np.uint8), ("bins", np.uint8))
        )
        out = []
        step = max(1, LOCAL_ROWS // (max(1, len(number)) * len(plan.leaves)))
        for first in range(limits[at], limits[at + 1], step):
            some = replace(plan, trees=min(step, limits[at + 1] - first), groups=(g,))
            for (_, leaf), found in _grow_here(some, features, first, number, label, bins).trees(cuts).items():
                out.append({"grp": g, "leaf": leaf, "first": int(first), **{c: getattr(found, c).astype(t).tobytes() for c, t in KINDS.items()}})
        kinds = [("grp", pa.int32()), ("leaf", pa.int32()), ("first", pa.int32()), *[(c, pa.binary()) for c in KINDS]]
        return pa.Table.from_pylist(out, pa.schema(kinds))

    packed = binned.mapInArrow(pack, "grp int, number binary, label binary, bins binary")
    sent = packed.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    sent = sent.repartition(4 * packs * len(plan.groups), "grp", "pack").groupBy("grp", "pack")
    grown = sent.applyInArrow(trees, "grp int, leaf int, first int, " + ", ".join(f"{c} binary" for c in KINDS)).collect()
    parts: dict[tuple[int, int], list] = {(g, leaf): [] for g in plan.groups for leaf in plan.leaves}
    for r in sorted(grown, key=lambda r: r["first"]):
        parts[r["grp"], r["leaf"]].append({c: np.frombuffer(r[c], t) for c, t in KINDS.items()})
    return {k: _joined(some) for k, some in parts.items()}


def _joined(parts: list[dict[str, np.ndarray]]) -> Trees:
    """Trees of several tasks one behind the other."""
    before = np.cumsum([0, *[len(p["feature"]) for p in parts]])
    moved = [{**p, "root": p["root"] + n, "left": np.where(p["feature"] >= 0, p["left"] + n, 0)} for p, n in zip(parts, before)]
    return Trees(**{c: np.concatenate([p[c] for p in moved]) if moved else np.zeros(0, t) for c, t in KINDS.items()})


def _grow_here(plan: Plan, features: int, first: int, number: np.ndarray, label: np.ndarray, bins: np.ndarray) -> _Growth:
    """Some trees of one group, from all its rows; ``bins`` has the features of a row one behind the other.

    The trees of a bootstrap split alike until a minimum leaf rules a split out: nodes of the same rows are one class,
    whose rows are held and counted once.
    """
    growth = _Growth(plan, features, first)
    taken = draws(plan.seed, first + np.arange(plan.trees), number)
    held, row = np.nonzero(taken > 0)  # the class of each pair of row and tree
    times, start, label = taken[held, row] * float(COUNT) + 1, row * features, label[row]
    of = growth.frontier % plan.trees  # the class of each open node
    at_once = max(1, LOCAL_CELLS // (growth.tried * plan.bins))
    for depth in range(plan.depth):
        since = len(growth.unit)
        nodes = growth.frontier
        classes, some_node = np.unique(of, return_index=True)  # 0, 1, 2...
        found = []
        for i in range(0, len(classes), at_once):
            mine = slice(None) if len(classes) <= at_once else np.flatnonzero((held >= i) & (held < i + at_once))
            lead = nodes[some_node[i : i + at_once]]
            tried = tried_features(plan.seed, growth.tree_of(growth.unit[lead]), growth.path[lead], features, growth.tried)
            sums = _sums(held[mine] - i, start[mine], times[mine], label[mine], bins, tried, plan.bins)
            members = np.flatnonzero((of >= i) & (of < i + at_once))
            for j in range(0, len(members), at_once):
                some = members[j : j + at_once]
                unit = growth.unit[nodes[some]]
                weights = growth.class_weights(unit) if depth else None
                found.append({"slot": some, **_choose(sums[of[some] - i], weights, growth.leaf_of(unit), tried[of[some] - i])})
        growth.grow(nodes, pd.DataFrame({c: np.concatenate([f[c] for f in found]) for c in found[0]}), depth == 0)
        growth.frontier = growth.open_nodes(since)
        if not len(growth.frontier) or depth == plan.depth - 1:
            break
        # Nodes of a class that split alike have the same children: a way of the class, to the left 2 x way, to the right + 1.
        parts = np.flatnonzero(growth.feature[nodes] >= 0)
        feature, cut = growth.feature[nodes[parts]], growth.cut[nodes[parts]]
        _, one, way = np.unique((of[parts] * features + feature) * plan.bins + cut, return_index=True, return_inverse=True)
        feature, cut, ways = feature[one], cut[one], np.bincount(of[parts][one], minlength=len(classes))
        child = np.full(len(growth.unit), -1, np.int64)
        child[growth.left[nodes[parts]]], child[growth.left[nodes[parts]] + 1] = 2 * way, 2 * way + 1
        going, of = np.unique(child[growth.frontier], return_inverse=True)
        moved = np.full(2 * len(one), -1, np.int64)
        moved[going] = np.arange(len(going))
        begin = np.cumsum(ways) - ways
        if (ways == 1).all():
            way = held
        else:
            many = ways[held]
            pair = np.repeat(np.arange(len(held)), many)
            way = begin[held[pair]] + np.arange(len(pair)) - (np.cumsum(many) - many)[pair]
            start, times, label = (x[pair] for x in (start, times, label))
        held = moved[2 * way + (bins[start + feature[way]] > cut[way])]
        if (held < 0).any():
            have = np.flatnonzero(held >= 0)
            held, start, times, label = (x[have] for x in (held, start, times, label))
    return growth


def _sums(
    place: np.ndarray, start: np.ndarray, times: np.ndarray, label: np.ndarray, bins: np.ndarray, tried: np.ndarray, width: int
) -> np.ndarray:
    """(nodes, features tried, bins, 3): rows and drawn rows of each class; ``times`` is COUNT per drawn row, plus one."""
    n = len(tried)
    out = np.empty((n, tried.shape[1], width, 3), np.int64)
    base = 2 * width * place + label
    for k in range(tried.shape[1]):
        cell = base + 2 * bins[start + tried[place, k]].astype(np.int64)
        both = np.bincount(cell, times, 2 * n * width).astype(np.int64).reshape(n, width, 2)
        out[:, k, :, 0] = (both % COUNT).sum(axis=2)
        out[:, k, :, 1:] = both // COUNT
    return out


def _vote_rows(forests: dict[int, list[tuple[int, Trees, np.ndarray]]], points: list[tuple[int, int, int]], width: int):
    """(row, label, grp, leaf, votes): per point (depth, split, trees) the sum of the votes of its trees."""
    depths = sorted({d for d, _, _ in points})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, values = np.asarray(batch.column("grp")), _matrix(batch.column("values"), width)
            ids, label = np.asarray(batch.column("row")), np.asarray(batch.column("label"))
            for g in np.unique(group):
                have = np.flatnonzero(group == g)
                for leaf, trees, number in forests.get(int(g), []):
                    step = max(1, PAIRS // max(1, len(number)))
                    for i in range(0, len(have), step):
                        some = have[i : i + step]
                        votes = np.zeros((len(some), len(points)))
                        for split in sorted({s for _, s, _ in points}):
                            at = np.repeat(trees.root[:, None], len(some), axis=1)
                            for depth in range(1, depths[-1] + 1):
                                at = trees.step(at, values[some], max(2, split))
                                read = [(k, np.searchsorted(number, n)) for k, (d, s, n) in enumerate(points) if d == depth and s == split]
                                sums = running(trees.value[at]) if read else at
                                for k, first in read:
                                    votes[:, k] = sums[first - 1] if first else 0.0
                        lists = pa.ListArray.from_arrays(
                            pa.array(np.arange(len(some) + 1, dtype=np.int32) * len(points)), pa.array(votes.ravel())
                        )
                        same = [pa.array(np.full(len(some), x)) for x in (int(g), leaf)]
                        columns = [pa.array(ids[some]), pa.array(label[some]), same[0].cast(pa.int32()), same[1].cast(pa.int32()), lists]
                        yield pa.RecordBatch.from_arrays(columns, ["row", "label", "grp", "leaf", "votes"])

    return rows


def point_votes(rows: DataFrame, forests: dict[tuple[int, int], Trees], points: Sequence[tuple[int, int, int]]) -> DataFrame:
    """(row, label, grp, leaf, point, probability) of rows (row, grp, label, values) by the forests of their group.

    A point (depth, split, trees) reads the forest as one of less depth, larger minimum split size and fewer trees.
    """
    points = list(points)
    width = rows.select(F.size("values").alias("n")).first().n
    packs: list[dict[int, list]] = [{}]
    held, split = 0, False
    for (g, leaf), trees in forests.items():
        every = np.arange(len(trees.root))
        size = max(1, int(NODES * len(every) / max(1, len(trees.feature))))
        split |= size < len(every)
        for i in range(0, len(every), size):
            part = trees.part(every[i : i + size]) if size < len(every) else trees
            if held and held + len(part.feature) > NODES:
                packs.append({})
                held = 0
            packs[-1].setdefault(g, []).append((leaf, part, every[i : i + size]))
            held += len(part.feature)
    schema = "row long, label int, grp int, leaf int, votes array<double>"
    table = rows.select("row", "grp", F.col("label").cast("int").alias("label"), "values")
    table = table.repartition(LOCAL_TASKS * rows.sparkSession.sparkContext.defaultParallelism, "row")  # few bytes, much work
    voted = [table.mapInArrow(_vote_rows(pack, points, width), schema) for pack in packs]
    each = reduce(DataFrame.unionByName, voted).select("row", "label", "grp", "leaf", F.posexplode("votes").alias("point", "votes"))
    if split:  # else all votes of a forest come from one pack
        each = each.groupBy("row", "label", "grp", "leaf", "point").agg(F.sum("votes").alias("votes"))
    trees = F.array(*[F.lit(float(n)) for _, _, n in points])
    return each.select("row", "label", "grp", "leaf", "point", (F.col("votes") / F.get(trees, F.col("point"))).alias("probability"))


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """A grown forest as a stage that scores vectors: ``probability`` (of 0 and 1) and ``prediction`` (1 above a half)."""

    trees = Param(Params._dummy(), "trees", "the trees as a JSON document", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    def __init__(self, forest: Trees | None = None, width: int = 0) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability")
        if forest is not None:
            self._set(trees=forest.to_json(), width=width)

    @property
    def forest(self) -> Trees:
        return Trees.from_json(self.getOrDefault("trees"))

    @property
    def importances(self) -> np.ndarray:
        return self.forest.importances(self.getOrDefault("width"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = self.forest

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(forest.scores(np.stack(batch.to_numpy())) if len(batch) else [], dtype="float64")

        p = score(vector_to_array(F.col(self.getFeaturesCol())))
        name = self.getProbabilityCol()
        scored = dataset.withColumn(name, p)
        scored = scored.withColumn(name, array_to_vector(F.array(1 - F.col(name), F.col(name))))
        return scored.withColumn(self.getPredictionCol(), (vector_to_array(F.col(name))[1] > 0.5).cast("double"))


class ForestGrower(Estimator, HasFeaturesCol, HasLabelCol):
    """Grows one forest; the row number column, ``rowCol``, is what rows are drawn by."""

    rowCol = Param(Params._dummy(), "rowCol", "column with a number of each row", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: int = 100, depth: int = 8, split: int = 2, leaf: int = 1, seed: int = 0) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", rowCol="row")
        self.plan = Plan(trees, depth, split, (leaf,), seed=seed)

    def setFeaturesCol(self, value: str) -> ForestGrower:
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str) -> ForestGrower:
        return self._set(labelCol=value)

    def setRowCol(self, value: str) -> ForestGrower:
        return self._set(rowCol=value)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        rows = training_rows(dataset, self.getOrDefault("rowCol"), self.getLabelCol(), self.getFeaturesCol())
        forest = grow(rows, self.plan)[0, self.plan.leaves[0]]
        return ForestModel(forest, rows.select(F.size("values").alias("n")).first().n)


def training_rows(df: DataFrame, row: str, label: str, features: str, group: int = 0) -> DataFrame:
    """(row, grp, label, weight, values) of a table with a vector column; rows without a column ``weight`` weigh 1."""
    number = F.col(row) if dict(df.dtypes)[row] in ("bigint", "int") else F.xxhash64(row)
    weight = F.col("weight") if "weight" in df.columns else F.lit(1.0)
    return df.select(
        number.cast("long").alias("row"),
        F.lit(group).alias("grp"),
        F.col(label).cast("int").alias("label"),
        weight.cast("double").alias("weight"),
        vector_to_array(F.col(features)).alias("values"),
    )
