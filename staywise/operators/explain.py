"""Contributions of features to a score: exact for linear models, sampled Shapley values for others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staywise.functions import zero_if_missing
from staywise.operators.ordering import seeded_hash
from staywise.operators.selection import seeded_sample
from staywise.session import materialize
from staywise.values import EXPLAIN_SAMPLE, RANDOM_STATE, TOP_FEATURES


def linear_contributions(
    df: DataFrame, id_col: str, weights: Mapping[str, float], means: Mapping[str, float] | None = None
) -> DataFrame:
    """Add ``contributions``: an array of (feature, phi), with phi = weight x (value - mean of the column).

    The means come from one aggregate over ``df`` unless given. A missing value contributes nothing.
    """
    if means is None:
        means = df.agg(*[F.avg(zero_if_missing(F.col(c))).alias(c) for c in weights]).first().asDict()
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            ((zero_if_missing(F.col(c)) - F.lit(float(means[c]))) * F.lit(float(w))).alias("phi"),
        )
        for c, w in weights.items()
    ]
    return df.select(id_col, F.array(*cells).alias("contributions"))


def vector_contributions(
    df: DataFrame,
    id_col: str,
    vector: str,
    names: Sequence[str],
    weights: Sequence[float],
    means: Sequence[float],
) -> DataFrame:
    """The same for an encoded array column and a fitted linear model."""
    cells = [
        F.struct(
            F.lit(n).alias("feature"),
            ((zero_if_missing(F.col(vector)[i]) - F.lit(float(m))) * F.lit(float(w))).alias("phi"),
        )
        for i, (n, w, m) in enumerate(zip(names, weights, means))
    ]
    return df.select(id_col, F.array(*cells).alias("contributions"))


def mean_abs_contribution(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, highest first: one aggregate, nothing is exploded."""
    row = contributions.agg(
        *[F.avg(F.abs(F.col("contributions")[i]["phi"])).alias(f) for i, f in enumerate(features)]
    )
    cells = [
        F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").alias("mean_abs_phi")) for f in features
    ]
    return row.select(F.inline(F.array(*cells))).orderBy(F.desc("mean_abs_phi"), "feature")


def top_contributions(
    contributions: DataFrame,
    id_col: str,
    features: Sequence[str],
    k: int = TOP_FEATURES,
    other: str = "other",
) -> DataFrame:
    """Per row the ``k`` largest contributions by size, and the rest as one: (id, position, feature, phi).

    The array of each row is sorted and cut by position, inside generated code and without a shuffle.
    """
    cells = [F.col("contributions")[i] for i in range(len(features))]
    by_size = [
        F.struct((-F.abs(c["phi"])).alias("size"), c["feature"].alias("feature"), c["phi"].alias("phi"))
        for c in cells
    ]
    ordered = [F.col("_ordered")[i] for i in range(len(features))]
    shown = [
        F.struct(F.lit(i).alias("position"), c["feature"].alias("feature"), c["phi"].alias("phi"))
        for i, c in enumerate(ordered[:k])
    ]
    if len(ordered) > k:
        rest = reduce(add, [c["phi"] for c in ordered[k:]])
        shown.append(F.struct(F.lit(k).alias("position"), F.lit(other).alias("feature"), rest.alias("phi")))
    return contributions.select(id_col, F.sort_array(F.array(*by_size)).alias("_ordered")).select(
        id_col, F.inline(F.array(*shown))
    )


def total_impact(contributions: DataFrame, output: str = "impact") -> DataFrame:
    """Sum of absolute contributions per row."""
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + F.abs(c["phi"]))
    return contributions.withColumn(output, total)


def explain_cases(df: DataFrame, id_col: str, impact: str, score: str) -> DataFrame:
    """The three rows worth a look: most explained, highest and lowest score; the smallest id on ties."""
    tie = -F.col(id_col)
    picks = df.agg(
        F.max_by(id_col, F.struct(F.col(impact), tie)).alias("highest_impact"),
        F.max_by(id_col, F.struct(F.col(score), tie)).alias("highest_score"),
        F.max_by(id_col, F.struct(-F.col(score), tie)).alias("lowest_score"),
    )
    cases = [F.struct(F.lit(c).alias("case"), F.col(c).alias(id_col)) for c in picks.columns]
    return picks.select(F.inline(F.array(*cases)))


def sampled_shapley(
    df: DataFrame,
    id_col: str,
    vector: str,
    names: Sequence[str],
    model: Transformer,
    rows: int = EXPLAIN_SAMPLE,
    permutations: int = 16,
    background: int = 100,
    seed: int = RANDOM_STATE,
) -> DataFrame:
    """Shapley values of a seeded sample by random permutations: (id, base, score, contributions).

    Each permutation starts at a background row and moves one feature after the other to the explained row;
    the changes of the score are the contributions. They sum up to score minus base, where base is the mean
    score of the drawn background rows: one per permutation, the same for all explained rows. All prefixes are scored by one ``model.transform``. ``vector`` is
    array<double>; the sample size is the cap the report asks for, not a limit on the input.
    """
    p = len(names)
    chosen = seeded_sample(df, id_col, rows, seed).select(F.col(id_col), F.col(vector).alias("_x"))
    pool = seeded_sample(df, id_col, background, f"{seed}-background").select(F.col(vector).alias("_z"))
    pool = materialize(pool, "background")  # at most ``background`` rows
    places = pool.select("_z", (F.row_number().over(Window.orderBy("_z")) - 1).cast("bigint").alias("_b"))
    pick = F.conv(F.substring(seeded_hash(seed, "_m"), 1, 8), 16, 10).cast("bigint")
    draws = df.sparkSession.range(1, permutations + 1).select(F.col("id").cast("int").alias("_m"))
    draws = draws.withColumn("_b", pick % max(1, pool.count())).join(places, "_b").select("_m", "_z")

    tried = chosen.withColumn("_m", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
    keyed = F.transform(
        F.sequence(F.lit(0), F.lit(p - 1)),
        lambda j: F.struct(
            seeded_hash(seed, id_col, "_m", j).alias("key"),
            j.alias("j"),
        ),
    )
    order = F.transform(F.array_sort(keyed), lambda s: s["j"])
    walks = tried.withColumn("_order", order).join(F.broadcast(draws), "_m")  # one row per permutation
    # Place of each feature in the order, 1-based.
    place = F.transform(
        F.sequence(F.lit(0), F.lit(p - 1)), lambda j: F.array_position("_order", j).cast("int")
    )
    steps = (
        walks.withColumn("_place", place)
        .withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(p))))
        .withColumn(
            "features",
            array_to_vector(
                F.transform(
                    F.arrays_zip("_place", "_x", "_z"),
                    lambda c: F.when(c["_place"] <= F.col("_t"), c["_x"]).otherwise(c["_z"]),
                )
            ),
        )
    )
    scored = model.transform(steps.select(id_col, "_m", "_place", "_t", "features")).select(
        id_col, "_m", "_place", "_t", vector_to_array("probability")[1].alias("_p")
    )
    path = F.transform(F.array_sort(F.collect_list(F.struct("_t", "_p"))), lambda s: s["_p"])
    walked = scored.groupBy(id_col, "_m").agg(path.alias("_path"), F.first("_place").alias("_place"))
    changes = [
        (
            F.element_at("_path", F.element_at("_place", i + 1) + 1)
            - F.element_at("_path", F.element_at("_place", i + 1))
        )
        for i in range(p)
    ]
    averaged = walked.groupBy(id_col).agg(
        F.avg(F.element_at("_path", 1)).alias("base"),
        F.avg(F.element_at("_path", -1)).alias("score"),
        *[F.avg(c).alias(f"_phi{i}") for i, c in enumerate(changes)],
    )
    cells = [
        F.struct(F.lit(n).alias("feature"), F.col(f"_phi{i}").alias("phi")) for i, n in enumerate(names)
    ]
    return averaged.select(id_col, "base", "score", F.array(*cells).alias("contributions"))
