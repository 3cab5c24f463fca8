"""Mix sources to target weights: hash-random order per source, distributed prefix sums, a cut at the exact budget.

Every row gets a hash-random key. Within a source, rows are dealt to slices of the key's range, sorted in their slice,
and their token counts summed up from the slice's start; the slices' totals, summed up per source, give each row the
tokens before it. A source's budget is split into whole epochs (every row once more) and a rest; rows before the
place where the rest ends are taken once more, and the row that holds that place in part.

Only functions of DataFrames. No step needs one task per source: a hot source has as many slices as its rows ask for.

Inputs without a result of their own: an empty table gives no rows; a null or empty text has size 0 and is taken 0
times; null sources are one source, which comes last; rows that are repeated count as often as they come; other
columns are not read. A null id is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
#: Production parameters.
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
ROWS_PER_SLICE = 10_000


def word_count(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: ``rank`` in code-point order, ``source_size``, ``rows``, ``target``, whole ``epochs`` and ``rest``.

    ``sizes`` has ``source`` and ``size``. The weights repeat along the ranks and share the total; a target stops at
    ``cap`` times its source, and what is over is shared again by weight. In the order of cap per weight, that is
    one running sum: a source is capped if its cap is below its share of what the sources before it leave.
    The windows here run over one row per source, after the rows are summed up.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_rank, every = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    choices = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        total.withColumn("rank", F.row_number().over(by_rank) - 1)
        .withColumn("weight", F.element_at(choices, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("most", (F.col("source_size") * cap).cast("double"))
        .withColumn("all_sizes", F.sum("source_size").over(every).cast("double"))
    )
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("all_sizes") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    capped = ranked.withColumn("capped", F.col("most") * weight_left <= left * F.col("weight"))
    held = F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(every)
    free = F.sum(F.when(~F.col("capped"), F.col("weight")).otherwise(0.0)).over(every)
    share = F.try_divide((F.col("all_sizes") - held) * F.col("weight"), free)
    budget = F.round("target").cast("long")
    return (
        capped.withColumn("target", F.when(F.col("capped"), F.col("most")).otherwise(share))
        .withColumn("epochs", F.coalesce(F.expr("try_divide(round(target), source_size)"), F.lit(0.0)).cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .select("source", "rank", "source_size", "rows", "target", "epochs", "rest")
    )


def prefix_sums(rows: DataFrame, targets: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``rows`` (source, key, doc_id, size) with their source's figures and ``before``, the tokens ahead of each row."""
    sources = targets.withColumnRenamed("source", "of_source")
    slices = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(rows_per_slice))).cast("long")
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    dealt = (
        rows.join(sources, F.col("source").eqNullSafe(F.col("of_source")))
        .drop("of_source")
        .withColumn("slice", F.shiftright(place * slices, 32))
    )
    totals = dealt.groupBy("rank", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("rank", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "slice").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["rank", "slice"])
        .withColumn("before", F.col("start") + F.col("ahead"))
        .drop("start", "ahead", "slice")
    )


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The slim rows that the sums need, written once: the texts are read a single time and never shuffled."""
    key = random_key(F.col("doc_id"), seed)
    slim = docs.select("doc_id", "source", key.alias("key"), word_count(F.col("text")).alias("size"))
    return materialize(slim, "mix-sizes")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, ``taken`` (words that the mix takes of it, repeats counted)."""
    rows = sized(docs, seed)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    taken = F.col("epochs") * F.col("size") + part
    summed = prefix_sums(rows, source_targets(rows, weights, cap), rows_per_slice)
    return summed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken; the one that holds a source's cut comes whole.

    The texts stay where they are: a source's cut is one (key, doc_id), and rows up to it come once more.
    """
    rows = sized(docs, seed)
    summed = prefix_sums(rows, source_targets(rows, weights, cap), rows_per_slice)
    last = F.struct("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    cuts = summed.groupBy("source").agg(
        F.max("epochs").alias("mix_epochs"),
        F.max(F.when((F.col("before") < F.col("rest")) & (F.col("size") > 0), last)).alias("mix_cut"),
    )
    cuts = materialize(cuts, "mix-cuts").withColumnRenamed("source", "mix_source")
    own = F.struct(
        random_key(docs["doc_id"], seed).alias("key"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id")
    )
    copies = F.col("mix_epochs") + F.coalesce((own <= F.col("mix_cut")).cast("long"), F.lit(0))
    kept = docs.join(cuts, docs["source"].eqNullSafe(cuts["mix_source"]))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    return (
        kept.withColumn("mix_copies", copies)
        .where("mix_copies > 0")
        .withColumn("mix_copy", each)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
