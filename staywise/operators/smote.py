"""SMOTE: synthetic rows of the rare class, up to parity with the frequent one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.errors import InputError
from staywise.operators.neighbors import nearest_neighbours
from staywise.operators.ordering import hash_fraction, hash_rank, seeded_hash
from staywise.session import materialize
from staywise.values import RANDOM_STATE, SMOTE_NEIGHBOURS


def smote(
    df: DataFrame,
    id_col: str,
    vector: str,
    label: str,
    k: int = SMOTE_NEIGHBOURS,
    seed: int = RANDOM_STATE,
    probes: int | None = None,
) -> DataFrame:
    """The rows of ``df`` plus synthetic ones: (id, vector, label, synthetic). Synthetic ids are negative.

    Synthetic row j lies on the segment from a minority row to one of its ``k`` nearest. The minority rows are
    taken in turn, in seeded order; neighbour and position on the segment come from md5 of j, so a
    task that runs again gives the same rows. The rows are generated by ``range``, in as many tasks as
    needed, and joined to the minority rows by their position. ``probes`` confines the search for neighbours, see
    ``neighbors``; a row then may have fewer than ``k``, and takes its neighbours in turn.
    """
    spark = df.sparkSession
    base = df.select(id_col, vector, F.col(label).cast("int").alias(label))
    sizes = base.where(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counts = {r[label]: r["n"] for r in sizes.collect()}
    if len(counts) < 2:
        raise InputError("oversampling needs rows of both classes")
    rare = min(counts, key=lambda c: (counts[c], c))
    missing = abs(counts[0] - counts[1])
    real = base.withColumn("synthetic", F.lit(False))
    if missing == 0:
        return real
    minority = materialize(base.where(F.col(label) == rare).select(id_col, vector), "minority")
    ranked = hash_rank(minority, id_col, seed, output="_base")
    asked = None
    if missing < counts[rare]:  # one synthetic row each for the first ones; only these need their neighbours
        ranked = materialize(ranked, "minority")
        minority, asked = ranked.withColumn("_taken", F.col("_base") < missing), "_taken"
    found = nearest_neighbours(minority, id_col, vector, k, probes=probes, asked=asked)
    width = min(k, counts[rare] - 1)
    if width < 1:
        raise InputError("oversampling needs at least two rows of the rare class")
    if probes:  # every slot is taken, whatever was found; by a copy of the row itself where nothing was
        near = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("position", "neighbour_vector"))).alias("_near"))
        own = minority.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("_own")).join(near, "id", "left")
        slot = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("position")
        each = own.select("id", "_own", "_near", slot)
        taken = F.get("_near", F.col("position") % F.size("_near"))["neighbour_vector"]
        found = each.select("id", "position", F.coalesce(taken, "_own").alias("neighbour_vector"))
    segments = ranked.join(found.withColumnRenamed("id", id_col), id_col).select(
        "_base",
        F.col("position").cast("bigint").alias("_slot"),
        F.col(vector).alias("_from"),
        F.col("neighbour_vector").alias("_to"),
    )
    text = seeded_hash(seed, "j")
    drawn = (
        spark.range(missing)
        .withColumnRenamed("id", "j")
        .select(
            "j",
            (F.col("j") % F.lit(counts[rare])).alias("_base"),
            (F.conv(F.substring(text, 9, 8), 16, 10).cast("bigint") % F.lit(width)).alias("_slot"),
            hash_fraction(text).alias("_u"),
        )
    )
    between = F.zip_with("_from", "_to", lambda a, b: a + F.col("_u") * (b - a))
    synthetic = drawn.join(segments, ["_base", "_slot"]).select(
        (-F.col("j") - 1).cast(dict(base.dtypes)[id_col]).alias(id_col),
        between.alias(vector),
        F.lit(rare).cast("int").alias(label),
        F.lit(True).alias("synthetic"),
    )
    return real.unionByName(synthetic)
