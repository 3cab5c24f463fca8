"""Folds, grid search, out-of-fold scores and the final fit."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from staywise import values
from staywise.operators import forest, logistic, metrics
from staywise.operators.ordering import ROWS_PER_BUCKET, hash_fraction, hash_rank, seeded_hash
from staywise.operators.prep import Preparation, learn_preparation, level_text
from staywise.operators.smote import smote
from staywise.session import materialize, scratch

LOGISTIC = "LogReg_balanced"
FOREST = "RF_balanced"
PARALLELISM = values.FOLDS  # Spark jobs submitted at a time: no fold waits for the others, to end alone on an idle cluster


@dataclass(frozen=True)
class Candidate:
    """One point of a search grid."""

    model: str
    params: Mapping[str, object]

    @property
    def name(self) -> str:
        return ",".join(f"{k}={v}" for k, v in self.params.items())

    def estimator(self, rows: int, seed: int = values.RANDOM_STATE) -> Estimator:
        """The estimator for a training table of ``rows`` rows with unit mean weight."""
        if self.model not in ESTIMATORS:
            raise ValueError(f"unknown model {self.model!r}")
        return ESTIMATORS[self.model](self.params, rows, seed)


def _logistic(params: Mapping[str, object], rows: int, seed: int) -> Estimator:
    """An inverse regularisation strength C on the sum of losses is 1 / (C x rows) on their mean."""
    return LogisticRegression(
        regParam=1.0 / (params["C"] * rows),
        elasticNetParam=1.0 if params["penalty"] == "l1" else 0.0,
        standardization=False,
        maxIter=values.LOGISTIC_MAX_ITER,
        tol=1e-6,
        weightCol="weight",
    )


def _forest(params: Mapping[str, object], rows: int, seed: int) -> Estimator:
    return forest.ForestGrower(
        trees=params["trees"], depth=params["depth"], split=params.get("split", 2), leaf=params["leaf"], seed=seed
    )


# Model families by name; add an entry to search over another one.
ESTIMATORS: dict[str, Callable[[Mapping[str, object], int, int], Estimator]] = {
    LOGISTIC: _logistic,
    FOREST: _forest,
}


def candidate_grid(
    logistic: Mapping[str, Sequence] = values.LOGISTIC_GRID,
    forest: Mapping[str, Sequence] = values.FOREST_GRID,
) -> list[Candidate]:
    """All points of both grids: 6 logistic and 81 forest ones by default."""

    def points(model: str, grid: Mapping[str, Sequence]) -> list[Candidate]:
        if not grid:
            return []
        return [Candidate(model, dict(zip(grid, combo))) for combo in product(*grid.values())]

    return points(LOGISTIC, logistic) + points(FOREST, forest)


def stratified_folds(
    df: DataFrame,
    id_col: str,
    label: str,
    folds: int = values.FOLDS,
    seed: int = values.RANDOM_STATE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``fold``: every fold gets the same share of each class, up to one row."""
    ranked = hash_rank(df, id_col, seed, [label], "_rank", rows_per_bucket)
    return ranked.withColumn("fold", (F.col("_rank") % folds).cast("int")).drop("_rank")


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = values.RANDOM_STATE) -> DataFrame:
    """``n`` rows, the first in seeded md5 order: each task keeps n rows at most."""
    return df.orderBy(seeded_hash(seed, id_col), id_col).limit(n)


@dataclass(frozen=True)
class TrainingTable:
    """A feature table and the parts its columns play."""

    df: DataFrame
    id_col: str
    label: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    seed: int = values.RANDOM_STATE
    neighbours: int = values.SMOTE_NEIGHBOURS
    fit_fraction: float = 1.0
    probes: int | None = None  # cells that the neighbour search of the oversampling looks into; None: exact

    def prepare(self, rows: DataFrame | None = None) -> Preparation:
        return learn_preparation(self.df if rows is None else rows, self.numeric, self.categorical)

    def encode(self, rows: DataFrame, prep: Preparation) -> DataFrame:
        """(id, label, vec) of the given rows; one narrow projection over the needed columns."""
        text = level_text(rows, [p.name for p in prep.categorical])
        return text.select(self.id_col, self.label, prep.vector().alias("vec"))

    def oversample(self, encoded: DataFrame, purpose: str = "train") -> DataFrame:
        """Balanced (id, label, features, weight), written once: an iterative fit reads it many times."""
        balanced = smote(encoded, self.id_col, "vec", self.label, self.neighbours, self.seed, self.probes)
        rows = balanced.select(self.id_col, self.label, array_to_vector("vec").alias("features"))
        if self.fit_fraction < 1.0:
            rows = rows.where(hash_fraction(seeded_hash(f"fit{self.seed}", self.id_col)) < self.fit_fraction)
        return self.weigh(materialize(rows, purpose, rebalance=True))

    def weigh(self, df: DataFrame) -> DataFrame:
        """Balanced class weights as a column; 1 for both classes after oversampling to parity."""
        counts = df.groupBy(self.label).agg(F.count(F.lit(1)).alias("n")).collect()
        total = sum(r["n"] for r in counts)
        weight = F
        for r in counts:
            weight = weight.when(F.col(self.label) == r[self.label], total / (len(counts) * r["n"]))
        return df.withColumn("weight", weight.otherwise(F.lit(1.0)))


@dataclass(frozen=True)
class Fold:
    """Written tables of one fold: oversampled training rows and untouched held-out rows."""

    number: int
    train: DataFrame
    held_out: DataFrame
    train_rows: int


def _in_parallel(spark: SparkSession, run, tasks: Sequence, parallelism: int) -> list:
    """Run driver-side steps in a few threads: each submits its own Spark jobs, in order of ``tasks``."""
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), tasks, chunksize=1)


def make_folds(table: TrainingTable, folds: int = values.FOLDS, parallelism: int = PARALLELISM) -> list[Fold]:
    """Preprocessing and oversampling are learned on the training part of each fold only.

    The tables are written once to the shared folder; every candidate reads them from there.
    """
    assigned = materialize(
        stratified_folds(table.df, table.id_col, table.label, folds, table.seed), "folds"
    )

    def make(i: int) -> Fold:
        train_rows = assigned.where(F.col("fold") != i)
        prep = table.prepare(train_rows)
        train = table.oversample(table.encode(train_rows, prep), f"fold{i}-train")
        held_out = table.encode(assigned.where(F.col("fold") == i), prep).select(
            table.id_col, table.label, array_to_vector("vec").alias("features")
        )
        return Fold(i, train, materialize(held_out, f"fold{i}-test"), train.count())

    return _in_parallel(table.df.sparkSession, make, range(folds), parallelism)


def _fit(candidate: Candidate, train: DataFrame, rows: int, label: str, seed: int, id_col: str | None = None) -> Transformer:
    estimator = candidate.estimator(rows, seed).setFeaturesCol("features").setLabelCol(label)
    if id_col and isinstance(estimator, forest.ForestGrower):
        estimator.setRowCol(id_col)  # rows are drawn by their number
    return estimator.fit(train)


def _fold_rows(table: TrainingTable, folds: Sequence[Fold], part: str) -> DataFrame:
    """(row, grp, label, weight, values) of all folds' training or held-out rows, with the fold as group."""
    parts = [forest.training_rows(getattr(f, part), table.id_col, table.label, "features", f.number) for f in folds]
    return reduce(DataFrame.unionByName, parts)


def _counted(scored: DataFrame, *by: str) -> dict[tuple, tuple[int, float]]:
    """Rows and F1 of class 1 by key; a row per fold and point."""
    d = (F.col("probability") > values.DEFAULT_THRESHOLD).cast("int")
    decided = scored.select(*by, F.struct(d.alias("d"), F.col("label").alias("y")).alias("r"))
    hits = [("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1)]
    counts = [F.count_if((F.col("r.d") == a) & (F.col("r.y") == b)).alias(n) for n, a, b in hits]
    found = decided.groupBy(*by).agg(*counts, F.count(F.lit(1)).alias("n")).collect()
    return {tuple(r[k] for k in by): (r.n, 2 * r.tp / (2 * r.tp + r.fp + r.fn) if r.tp else 0.0) for r in found}


def fold_forests(
    table: TrainingTable, folds: Sequence[Fold], trees: int, depth: int, split: int, leaves: Sequence[int]
) -> dict[tuple[int, int], forest.Trees]:
    """Forests by (fold, minimum leaf), all grown together: one pass over the folds' rows per level."""
    plan = forest.Plan(trees, depth, split, tuple(sorted(set(leaves))), tuple(f.number for f in folds), table.seed)
    return forest.grow(_fold_rows(table, folds, "train"), plan)


#: By (point, fold) the held-out rows and F1; and what gives the held-out scores (label, probability, fold) of a point.
Found = tuple[dict[tuple[str, int], tuple[int, float]], Callable[[Candidate], DataFrame]]


def _held_out(table: TrainingTable, scores: DataFrame) -> DataFrame:
    return scores.select(F.col("label").alias(table.label), "probability", F.col("grp").alias("fold"))


def _search_forests(table: TrainingTable, folds: Sequence[Fold], candidates: Sequence[Candidate]) -> Found:
    """Every forest point read off one forest per minimum leaf and fold."""
    points = list(dict.fromkeys((c.params["depth"], c.params.get("split", 2), c.params["trees"]) for c in candidates))
    grown = fold_forests(
        table,
        folds,
        max(n for _, _, n in points),
        max(d for d, _, _ in points),
        min(s for _, s, _ in points),
        [c.params["leaf"] for c in candidates],
    )
    held_out = _fold_rows(table, folds, "held_out")
    found = _counted(forest.point_votes(held_out, grown, points), "grp", "leaf", "point")
    out = {}
    for c in candidates:
        k = points.index((c.params["depth"], c.params.get("split", 2), c.params["trees"]))
        out |= {(c.name, f.number): found[f.number, c.params["leaf"], k] for f in folds}

    def scores(c: Candidate) -> DataFrame:
        own = {(g, leaf): trees for (g, leaf), trees in grown.items() if leaf == c.params["leaf"]}
        point = (c.params["depth"], c.params.get("split", 2), c.params["trees"])
        return _held_out(table, forest.point_votes(held_out, own, [point]))

    return out, scores


def _search_logistic(table: TrainingTable, folds: Sequence[Fold], candidates: Sequence[Candidate]) -> Found:
    """All logistic points of all folds fitted together."""
    points = [(c.params["C"], c.params["penalty"]) for c in candidates]
    weights = logistic.fit_points(_fold_rows(table, folds, "train"), [f.number for f in folds], points)
    held_out = _fold_rows(table, folds, "held_out")
    found = _counted(logistic.point_scores(held_out, weights), "grp", "point")

    def scores(c: Candidate) -> DataFrame:
        k = points.index((c.params["C"], c.params["penalty"]))
        return _held_out(table, logistic.point_scores(held_out, {key: w for key, w in weights.items() if key[1] == k}))

    return {(c.name, f.number): found[f.number, k] for k, c in enumerate(candidates) for f in folds}, scores


def _search_apart(
    table: TrainingTable, folds: Sequence[Fold], candidates: Sequence[Candidate], parallelism: int
) -> dict[tuple[str, int], tuple[int, float]]:
    """A fit for each point and fold, as parallel Spark jobs."""

    def run(task: tuple[Candidate, Fold]) -> tuple[int, float]:
        candidate, fold = task
        model = _fit(candidate, fold.train, fold.train_rows, table.label, table.seed, table.id_col)
        found = metrics.class_metrics(model.transform(fold.held_out), "prediction", table.label).first()
        return found.tp + found.fp + found.fn + found.tn, found.f1

    tasks = [(c, f) for c in candidates for f in folds]
    scores = _in_parallel(table.df.sparkSession, run, tasks, parallelism)
    return {(c.name, f.number): s for (c, f), s in zip(tasks, scores)}


#: Families whose points share their work; the others are fitted one by one.
SHARED = {FOREST: _search_forests, LOGISTIC: _search_logistic}


def grid_search(
    table: TrainingTable,
    folds: Sequence[Fold],
    candidates: Sequence[Candidate],
    parallelism: int = PARALLELISM,
    shared: bool = True,
    scorers: dict[str, Callable[[Candidate], DataFrame]] | None = None,
) -> list[dict]:
    """Mean F1 of class 1 over the folds, per candidate, best first; ``folds`` and ``rows`` tell what it is the mean of.

    Points of one family are fitted together where the family allows it; ``shared=False`` fits each on its own.
    ``scorers`` takes in what gives the held-out scores of a family's points by the fits of the search.
    """
    rows = []
    for family in dict.fromkeys(c.model for c in candidates):
        own = [c for c in candidates if c.model == family]
        if shared and family in SHARED:
            scores, scorer = SHARED[family](table, folds, own)
            if scorers is not None:
                scorers[family] = scorer
        else:
            scores = _search_apart(table, folds, own, parallelism)
        for c in own:
            found = [scores[c.name, f.number] for f in folds]
            mean = sum(f1 for _, f1 in found) / len(found)
            rows.append({"model": family, "params": c.name, "mean_f1": mean, "candidate": c, "folds": len(found), "rows": sum(n for n, _ in found)})
    return sorted(rows, key=lambda r: -r["mean_f1"])


def out_of_fold(
    table: TrainingTable, folds: Sequence[Fold], candidate: Candidate, parallelism: int = PARALLELISM
) -> DataFrame:
    """(id, label, probability, fold) of every row, from the model that has not seen it; written once."""

    grown: dict[tuple[int, int], forest.Trees] = {}
    if candidate.model == FOREST:  # all folds at once
        p = candidate.params
        grown = fold_forests(table, folds, p["trees"], p["depth"], p.get("split", 2), [p["leaf"]])

    def score(fold: Fold) -> DataFrame:
        if grown:
            trees = grown[fold.number, candidate.params["leaf"]]
            model: Transformer = forest.ForestModel(trees)
        else:
            model = _fit(candidate, fold.train, fold.train_rows, table.label, table.seed)
        return model.transform(fold.held_out).select(
            table.id_col,
            table.label,
            vector_to_array("probability")[1].alias("probability"),
            F.lit(fold.number).alias("fold"),
        )

    parts = _in_parallel(table.df.sparkSession, score, folds, parallelism)
    return materialize(reduce(DataFrame.unionByName, parts), "out-of-fold")


@dataclass
class Selection:
    """Outcome of a search: the chosen candidate, its threshold, and the report of every family."""

    best: Candidate
    threshold: float
    reports: list[dict] = field(default_factory=list)
    search: list[dict] = field(default_factory=list)


def select_model(
    table: TrainingTable,
    candidates: Sequence[Candidate] | None = None,
    folds: int = values.FOLDS,
    parallelism: int = PARALLELISM,
) -> Selection:
    """Best point per family by mean F1, its report on out-of-fold scores, and the best family by F1."""
    candidates = list(candidates or candidate_grid())
    reports, by_name = [], {}
    with scratch(table.df.sparkSession):  # the folds' tables go when the search ends
        parts = make_folds(table, folds, parallelism)
        scorers: dict[str, Callable[[Candidate], DataFrame]] = {}
        search = grid_search(table, parts, candidates, parallelism, scorers=scorers)
        for family in dict.fromkeys(c.model for c in candidates):
            winner = next(r["candidate"] for r in search if r["model"] == family)
            if family in scorers:  # the search has fitted the winner for every fold
                scores = materialize(scorers[family](winner), "out-of-fold")
            else:
                scores = out_of_fold(table, parts, winner, parallelism)
            found = metrics.model_report(scores, "probability", table.label, family).first().asDict()
            reports.append({**found, "params": winner.name})
            by_name[family] = winner
    top = max(reports, key=lambda r: r["f1"])
    return Selection(by_name[top["model"]], top["threshold"], reports, search)


def fit_final(table: TrainingTable, candidate: Candidate) -> tuple[PipelineModel, Preparation]:
    """Fit on all rows, oversampled; the returned model has the preprocessing but no sampler."""
    prep = table.prepare()
    with scratch(table.df.sparkSession):
        train = table.oversample(table.encode(table.df, prep), "final-train")
        classifier = _fit(candidate, train, train.count(), table.label, table.seed, table.id_col)
    return prep.model(classifier), prep
