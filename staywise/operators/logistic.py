"""Logistic regressions for many points and folds at a time, by proximal Newton steps.

A pass over the rows gives loss, gradient and curvature of every fit that is still going on, so a whole regularisation
path over all folds takes as many passes as its slowest fit. Tasks send sums alone; the driver solves the small
problem of each step. The objective is the sum of the rows' losses plus 1 / C times half the squared weights (l2) or their
absolute values (l1); the intercept is not penalised.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 60
TOLERANCE = 1e-6  # of the steepest slope left, per row
RIDGE = 1e-7
SWEEPS = 300
ROWS = 4_096


@dataclass
class Fit:
    """One fit: where it stands, and what the last pass found there."""

    group: int
    point: int
    strength: float
    absolute: bool
    beta: np.ndarray
    rows: float = 0.0
    value: float = np.inf
    best: np.ndarray | None = None
    step: np.ndarray = field(default_factory=lambda: np.zeros(0))
    done: bool = False

    def penalty(self, beta: np.ndarray) -> float:
        w = beta[:-1]
        return self.strength * (np.abs(w).sum() if self.absolute else 0.5 * (w @ w))

    def slope(self, gradient: np.ndarray) -> float:
        """The largest part of the objective's least subgradient."""
        w, g = self.best[:-1], gradient[:-1]
        if self.absolute:
            at_zero = np.maximum(np.abs(g) - self.strength, 0.0)
            rest = np.where(w == 0, at_zero, np.abs(g + self.strength * np.sign(w)))
        else:
            rest = np.abs(g + self.strength * w)
        return max(rest.max(initial=0.0), abs(gradient[-1]))

    def take(self, rows: float, loss: float, gradient: np.ndarray, curve: np.ndarray) -> None:
        """Judge the place that was measured and go to the next one."""
        self.rows = rows
        value = loss + self.penalty(self.beta)
        if self.best is not None and value > self.value + 1e-12 * max(1.0, abs(self.value)):
            self.step = self.step / 2  # too far
            if np.abs(self.step).max(initial=0.0) < 1e-12:
                self.done = True
            self.beta = self.best + self.step
            return
        self.best, self.value = self.beta.copy(), value
        if self.slope(gradient) <= TOLERANCE * max(1.0, rows):
            self.done = True
            return
        curve = curve + RIDGE * max(1.0, rows) * np.eye(len(gradient))
        if self.absolute:
            self.step = _lasso_step(self.best, gradient, curve, self.strength) - self.best
        else:
            shrink = np.append(np.full(len(gradient) - 1, self.strength), 0.0)
            self.step = -np.linalg.solve(curve + np.diag(shrink), gradient + shrink * self.best)
        self.beta = self.best + self.step


def _lasso_step(beta: np.ndarray, gradient: np.ndarray, curve: np.ndarray, strength: float) -> np.ndarray:
    """The least point of the quadratic model with absolute penalty, one coordinate after the other."""
    at = beta.copy()
    slope = gradient.copy()  # of the model at ``at``
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(at)):
            bend = curve[j, j]
            aim = at[j] - slope[j] / bend
            new = aim if j == len(at) - 1 else np.sign(aim) * max(abs(aim) - strength / bend, 0.0)
            if new != at[j]:
                slope += curve[:, j] * (new - at[j])
                moved = max(moved, abs(new - at[j]))
                at[j] = new
        if moved < 1e-8:
            break
    return at


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _measure_rows(fits: list[tuple[int, int, np.ndarray]]):
    """(grp, point, sums): rows, loss, gradient and curvature of each fit, summed up over the task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            group, label = np.asarray(batch.column("grp")), np.asarray(batch.column("label")).astype(float)
            weight = np.asarray(batch.column("weight"))
            values = np.column_stack([_matrix(batch.column("values")), np.ones(batch.num_rows)])
            for g, point, beta in fits:
                have = np.flatnonzero(group == g)
                for i in range(0, len(have), ROWS):
                    x, y, w = (a[have[i : i + ROWS]] for a in (values, label, weight))
                    margin = x @ beta
                    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                    loss = w @ (np.logaddexp(0.0, margin) - y * margin)
                    curve = (x * (w * p * (1 - p))[:, None]).T @ x
                    found = np.concatenate([[w.sum(), loss], x.T @ (w * (p - y)), curve.ravel()])
                    total[g, point] = total.get((g, point), 0.0) + found
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([g for g, _ in total], pa.int32()),
                pa.array([p for _, p in total], pa.int32()),
                pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64())),
            ],
            ["grp", "point", "sums"],
        )

    return rows


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    """One row per fit from one row per task."""
    return pd.DataFrame({"grp": parts["grp"][:1], "point": parts["point"][:1], "sums": [np.sum(parts["sums"].to_list(), axis=0)]})


def fit_points(
    rows: DataFrame, groups: Sequence[int], points: Sequence[tuple[float, str]], rounds: int = ROUNDS
) -> dict[tuple[int, int], np.ndarray]:
    """Weights and intercept (last) by (group, point number) from rows (grp, label, weight, values); a point is (C, penalty)."""
    width = rows.select(F.size("values").alias("n")).first().n
    fits = {
        (g, i): Fit(g, i, 1.0 / c, penalty == "l1", np.zeros(width + 1))
        for g in groups
        for i, (c, penalty) in enumerate(points)
    }
    schema = "grp int, point int, sums array<double>"
    for _ in range(rounds):
        going = [(f.group, f.point, f.beta) for f in fits.values() if not f.done]
        if not going:
            break
        measured = rows.select("grp", "label", "weight", "values").mapInArrow(_measure_rows(going), schema)
        for found in measured.groupBy("grp", "point").applyInPandas(_added, schema).collect():  # a row per fit
            sums = np.array(found["sums"])
            gradient, curve = sums[2 : width + 3], sums[width + 3 :].reshape(width + 1, width + 1)
            fits[found["grp"], found["point"]].take(sums[0], sums[1], gradient, curve)
    return {k: f.beta if f.best is None else f.best for k, f in fits.items()}


def point_scores(rows: DataFrame, weights: dict[tuple[int, int], np.ndarray]) -> DataFrame:
    """(row, label, grp, point, probability) of rows (row, grp, label, values) by the fits of their group."""
    by_group: dict[int, dict[int, np.ndarray]] = {}
    for (g, i), beta in weights.items():
        by_group.setdefault(g, {})[i] = beta
    stacked = {g: np.stack([found[i] for i in sorted(found)]) for g, found in by_group.items()}
    some = next(iter(stacked.values()))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.asarray(batch.column("grp"))
            values = np.column_stack([_matrix(batch.column("values")), np.ones(batch.num_rows)])
            p = np.zeros((batch.num_rows, len(some)))
            for g in np.unique(group):
                own = group == g
                p[own] = 1 / (1 + np.exp(-np.clip(values[own] @ stacked[int(g)].T, -500, 500)))
            limits = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(some))
            names = ["row", "label", "grp"]
            columns = [*[batch.column(n) for n in names], pa.ListArray.from_arrays(limits, pa.array(p.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "p"])

    table = rows.select("row", F.col("label").cast("int").alias("label"), "grp", "values")
    each = table.select("row", "grp", "label", "values").mapInArrow(scored, "row long, label int, grp int, p array<double>")
    return each.select("row", "label", "grp", F.posexplode("p").alias("point", "probability"))
