"""Exact contributions of features to the score of a forest.

The score of a tree without the features outside a set S follows, at a split on one of these, both ways in proportion to the
rows that went there in training. The Shapley values of that game are sums over leaves: a leaf's part depends only on
which features of its path the row satisfies, and the sum over all subsets of them is a polynomial that is put
together, and divided by one feature's factor, in a number of steps quadratic in the depth. A path's rows are told apart by
the pattern of features that they satisfy: the parts of all patterns are worked out for all paths of one length
of a tree at once, and rows look theirs up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.operators.forest import Trees

ROWS = 65_536
#: Rows of a task; more would spread a table over fewer tasks than there are.
PART_ROWS = 16_384
#: Features of a path up to which all patterns are worked out; beyond, those that rows have.
PATTERNS = 10


def _leaf_parts(shares: np.ndarray, satisfied: np.ndarray) -> np.ndarray:
    """Contributions (paths, rows, features) of the paths' features to leaves of value 1.

    ``shares`` (paths, features) has the share of training rows that a feature's splits let through, ``satisfied``
    (rows, features) is 0 or 1.
    """
    n, d = satisfied.shape
    share = shares[:, None, :]
    product = np.zeros((len(shares), n, d + 1))
    product[..., 0] = 1.0
    for k in range(d):  # times (share + satisfied * t)
        product[..., 1 : k + 2] = product[..., 1 : k + 2] * share[..., [k]] + product[..., : k + 1] * satisfied[:, [k]]
        product[..., 0] *= share[..., k]
    weight = np.array([1.0 / (d * comb(d - 1, s)) for s in range(d)])
    plain = product[..., :d] @ weight
    out = np.empty((len(shares), n, d))
    for j in range(d):
        # the quotient by (share + t) where the feature is satisfied, else by share
        term = product[..., d]
        total = term * weight[d - 1]
        for s in range(d - 1, 0, -1):
            term = product[..., s] - share[..., j] * term
            total = total + term * weight[s - 1]
        chosen = np.where(satisfied[:, j] > 0, total, plain / share[..., j])
        out[..., j] = chosen * (satisfied[:, j] - share[..., j])
    return out


def _patterns(codes: np.ndarray, d: int) -> np.ndarray:
    return (codes[:, None] >> np.arange(d) & 1).astype(float)


def _paths(trees: Trees, root: int) -> Iterator[tuple[int, list[tuple[int, bool]]]]:
    """Leaves of a tree with the inner nodes above them, and whether the path goes right there."""
    stack: list[tuple[int, list[tuple[int, bool]]]] = [(root, [])]
    while stack:
        node, path = stack.pop()
        if trees.feature[node] < 0:
            yield node, path
        else:
            left = int(trees.left[node])
            stack.append((left, [*path, (node, False)]))
            stack.append((left + 1, [*path, (node, True)]))


def contributions(trees: Trees, values: np.ndarray) -> tuple[np.ndarray, float]:
    """(rows, features) contributions to the forest's score, and the score without any feature."""
    phi = np.zeros(values.shape[::-1])
    columns = np.ascontiguousarray(values.T)
    base = 0.0
    for root in trees.root:
        goes: dict[int, np.ndarray] = {}  # rows that go right, by node
        by_length: dict[int, list[tuple[float, list[float], list[int], np.ndarray]]] = {}
        for leaf, path in _paths(trees, int(root)):
            value = float(trees.value[leaf])
            shares: dict[int, float] = {}
            satisfied: dict[int, np.ndarray] = {}
            for node, right in path:
                feature = int(trees.feature[node])
                child = int(trees.left[node]) + right
                shares[feature] = shares.get(feature, 1.0) * trees.weight[child] / trees.weight[node]
                if node not in goes:
                    goes[node] = columns[feature] > trees.threshold[node]
                went = goes[node] if right else ~goes[node]
                satisfied[feature] = satisfied[feature] & went if feature in satisfied else went
            base += value * prod(shares.values())
            if not path or value == 0.0:
                continue
            code = np.zeros(len(values), np.uint16 if len(satisfied) <= PATTERNS else np.int64)
            for i, hit in enumerate(satisfied.values()):
                code += hit.astype(code.dtype) << code.dtype.type(i)
            by_length.setdefault(len(shares), []).append((value, list(shares.values()), list(shares), code))
        for d, paths in by_length.items():
            if d <= PATTERNS:
                tables = _leaf_parts(np.array([p[1] for p in paths]), _patterns(np.arange(1 << d), d))
            for i, (value, shares, features, code) in enumerate(paths):
                if d <= PATTERNS:
                    parts, at = value * tables[i].T, code
                else:
                    kinds, at = np.unique(code, return_inverse=True)
                    parts = value * _leaf_parts(np.array([shares]), _patterns(kinds, d))[0].T
                for feature, part in zip(features, parts):
                    phi[feature] += part.take(at)
    return phi.T / len(trees.root), base / len(trees.root)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of up to ``ROWS`` rows, since the patterns are worked out once for each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.num_rows for b in held) + batch.num_rows > ROWS:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def forest_contributions(df: DataFrame, id_col: str, vector: str, names: Sequence[str], trees: Trees) -> DataFrame:
    """(id, base, score, contributions) of every row; they add up to score minus base. ``vector`` is array<double>."""
    kind = df.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                values = part.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                phi, base = contributions(trees, values)
                limits = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * phi.shape[1])
                lists = pa.ListArray.from_arrays(limits, pa.array(phi.ravel()))
                columns = [part.column(id_col), pa.array(np.full(part.num_rows, base)), pa.array(trees.scores(values)), lists]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "base", "score", "phi"])

    narrow = df.select(id_col, vector)
    cores = df.sparkSession.sparkContext.defaultParallelism
    narrow = narrow.repartition(max(cores, -(-narrow.count() // PART_ROWS)), id_col)  # few bytes, much work
    found = narrow.mapInArrow(rows, f"`{id_col}` {kind}, base double, score double, phi array<double>")
    cells = [F.struct(F.lit(n).alias("feature"), F.col("phi")[i].alias("phi")) for i, n in enumerate(names)]
    return found.select(id_col, "base", "score", F.array(*cells).alias("contributions"))
