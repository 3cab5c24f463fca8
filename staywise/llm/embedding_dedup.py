"""Near duplicates of embeddings: iterative quantisation, multi-index Hamming tables, a rerank with the original vectors.

1. Codes. On a bounded sample the principal axes and several rotations are learned that keep the signs of the
   rotated coordinates balanced and close to the coordinates themselves (iterative quantisation). Every vector gets the
   signs as a binary code, cut into tables of ``key`` bits; the number of tables follows from the share of bits that two
   vectors at the threshold differ in, so that such a pair meets in a table with probability ``MEET``. The mean isn't taken off: cosines
   are angles at the origin, and codes around the mean would part a table that is mostly one tight group at random.
2. Balls. In each bucket of each table the vector with the least hash leads. Vectors within half the threshold's angle
   of a leader form its ball: all of them link with each other, without a pair being made.
3. Pairs of balls that share a bucket, and whose codes are near enough for their radii, are retrieved once each. The
   original leaders' angle and the radii decide: too far, or all members link, or the members are compared.
4. Members of undecided pairs are compared in blocks of bounded size; a block gives counts per vector, no pairs.
5. Components of the balls that hold a link.

Nothing but the sample (``FIT_ROWS`` vectors), the rotations and the counts of a few sizes comes to the driver. Every
vector is in every table and no bucket is cut: a bucket's rows are combined by ball before they are paired.

Inputs without a result of their own: an empty table gives no rows; vectors that are null, zero, hold null or
non-finite components, or have another length than most, link with nothing; a null vec_id takes part and names no
component; repeated rows are vectors of their own, with the same component; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.llm.graph import components
from staywise.session import materialize

#: Production parameters.
COSINE = 0.9
FIT_ROWS = 20_000
ROUNDS = 30
#: Probability that a pair at the threshold meets in a table.
MEET = 0.97
KEY_BITS = (8, 30)
#: Standard deviations of the number of differing bits that retrieval allows for.
SPREAD = 4.5
BLOCK = 512
SEED = 11
#: In radians; what lies nearer to a limit than this is compared by its vectors.
MARGIN = 1e-7
CODE = 64


@dataclass(frozen=True)
class Codes:
    """A learned map from vectors to binary codes: the signs of x @ axes."""

    axes: np.ndarray
    key: int
    tables: int

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.axes > 0


def table_count(key: int, cosine: float, meet: float = MEET) -> int:
    """How many tables of ``key`` bits a pair at the threshold needs to meet in one with probability ``meet``."""
    same = (1 - math.acos(cosine) / math.pi) ** key
    return math.ceil(math.log(1 - meet) / math.log(1 - same))


def learn_codes(sample: np.ndarray, rows: int, cosine: float = COSINE, rounds: int = ROUNDS, seed: int = SEED) -> Codes:
    """Rotations by iterative quantisation of ``sample``; keys of about log2(``rows``) bits."""
    key = min(max(math.ceil(math.log2(max(rows, 2))), KEY_BITS[0]), KEY_BITS[1])
    tables = table_count(key, cosine)
    bits = max(CODE, key * tables)
    unit = sample / np.sqrt((sample * sample).sum(axis=1, keepdims=True))
    _, principal = np.linalg.eigh(unit.T @ unit)
    projected = unit @ principal
    rng = np.random.default_rng(seed)
    dims = unit.shape[1]
    axes = []
    for block in range(math.ceil(bits / dims)):
        rotation, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
        # every other rotation stays as it was drawn: in few dimensions the learned ones may all end up as one
        for _ in range(rounds if block % 2 == 0 else 0):
            signs = np.where(projected @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ projected)
            rotation = (left @ right).T
        axes.append(principal @ rotation)
    return Codes(np.concatenate(axes, axis=1)[:, :bits], key, tables)


def _vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, dims) in double precision, and which rows can link: others are ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    usable = sizes == dims
    flat = column.filter(pa.array(usable)).flatten().cast(pa.float64())
    out = np.ones((len(sizes), dims))
    out[usable] = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)  # null components become NaN
    usable &= np.isfinite(out).all(axis=1) & (out != 0).any(axis=1)
    out[~usable] = 1.0
    return out, usable


def _code_rows(codes: Codes):
    """Adds ``code`` (64 bits) and ``keys`` (one per table) to vectors that can link, else nulls."""
    dims = len(codes.axes)
    weights = np.int64(1) << np.arange(codes.key, dtype=np.int64)
    code_weights = np.uint64(1) << np.arange(CODE, dtype=np.uint64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, usable = _vectors(batch.column("embedding"), dims)
            bits = codes.bits(vectors)
            # code bits from all over the axes, so that no single table decides
            spread = bits[:, np.linspace(0, bits.shape[1] - 1, CODE).astype(int)]
            code = (spread.astype(np.uint64) * code_weights).sum(axis=1).view(np.int64)
            keys = bits[:, : codes.key * codes.tables].reshape(-1, codes.tables, codes.key).astype(np.int64) @ weights
            limits = np.concatenate([[0], np.cumsum(np.where(usable, codes.tables, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(limits), pa.array(keys[usable].ravel()))
            columns = [batch.column("vec_id"), batch.column("embedding"), pa.array(code, mask=~usable), lists]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "code", "keys"])

    return rows


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
    return np.einsum("ij,ij->i", x, y) / length


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batch without its vectors x and y, and their cosine."""
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        dims = int(x.value_lengths()[0].as_py()) if batch.num_rows else 1
        found = pa.array(_cosines(_vectors(x, dims)[0], _vectors(y, dims)[0]))
        rest = [n for n in batch.schema.names if n not in ("x", "y")]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], found], [*rest, "cosine"])


def with_cosine(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the cosine of the vectors ``x`` and ``y`` in their place."""
    rest = pairs.drop("x", "y")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return pairs.mapInArrow(_pair_rows, f"{kept}, cosine double")


def _angle(cosine: str | Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col(cosine) if isinstance(cosine, str) else cosine)))


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _most_bits(angle: Column) -> Column:
    """How many bits of two codes differ at most, but for rare chance, if their vectors are ``angle`` apart."""
    share = F.least(angle / math.pi, F.lit(0.5))
    return CODE * share + SPREAD * F.sqrt(CODE * share * (1 - share))


def coded_rows(embeddings: DataFrame, cosine: float = COSINE, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(row, vec_id, embedding, code, keys), written once: ``row`` names a row from here on."""
    spark = embeddings.sparkSession
    given = embeddings.select("vec_id", "embedding")
    sizes = given.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n"))
    most = sizes.where("dims > 0").orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    codes = None
    if most:
        chosen = given.where(F.size("embedding") == most.dims).orderBy(F.xxhash64("vec_id", "embedding")).limit(fit_rows)
        table = pa.table({"embedding": chosen.select("embedding").toArrow().column(0)})
        vectors, usable = _vectors(table.column("embedding"), most.dims)
        if usable.any():
            codes = learn_codes(vectors[usable], most.n, cosine)
    named = f"vec_id {given.schema['vec_id'].dataType.simpleString()}, embedding {given.schema['embedding'].dataType.simpleString()}"
    if codes is None:
        rows = given.select("*", F.lit(None).cast("long").alias("code"), F.array().cast("array<long>").alias("keys"))
    else:
        rows = given.mapInArrow(_code_rows(codes), f"{named}, code long, keys array<long>")
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "coded")


def balls(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(row, ball, angle): every vector that can link, the leading row of its ball, and the angle between them."""
    half = math.acos(cosine) / 2 - MARGIN
    order = F.struct(F.xxhash64("row").alias("h"), "row", "code")
    buckets = rows.select("row", "code", F.posexplode("keys").alias("t", "key"))
    leaders = buckets.groupBy("t", "key").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    leaders = leaders.select("t", "key", F.col("first.row").alias("leader"), F.col("first.code").alias("leader_code"))
    leaders = materialize(leaders, "leaders")
    near = _differing(F.col("code"), F.col("leader_code")) <= _most_bits(F.lit(half))
    led = buckets.join(leaders, ["t", "key"]).where((F.col("row") != F.col("leader")) & near).select("row", "leader").distinct()
    x, y = rows.select("row", F.col("embedding").alias("x")), rows.select(F.col("row").alias("leader"), F.col("embedding").alias("y"))
    close = with_cosine(led.join(x, "row").join(y, "leader")).select("row", "leader", _angle("cosine").alias("angle"))
    close = materialize(close.where(F.col("angle") <= half), "led")
    # a vector that is led leads nobody
    free = close.join(close.select(F.col("row").alias("leader")).distinct(), "leader", "left_anti")
    best = F.min(F.struct(F.xxhash64("leader").alias("h"), "leader", "angle")).alias("best")
    joined = free.groupBy("row").agg(best).select("row", F.col("best.leader").alias("ball"), F.col("best.angle").alias("angle"))
    able = rows.where("code IS NOT NULL").select("row", "vec_id", "embedding", "code", "keys")
    member = able.join(joined, "row", "left").withColumn("ball", F.coalesce("ball", "row"))
    return materialize(member.withColumn("angle", F.coalesce("angle", F.lit(0.0))), "balls")


def ball_pairs(member: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """Sizes (ball, size, radius, code, lead), and retrieved pairs (a, b, sure): all members link, or it's undecided."""
    limit = math.acos(cosine)
    stats = member.groupBy("ball").agg(F.count("*").alias("size"), F.max("angle").alias("radius"), F.min("vec_id").alias("least_id"))
    lead = member.where("row = ball").select("ball", "code", F.col("embedding").alias("lead"))
    stats = materialize(stats.join(lead, "ball"), "ball-sizes")
    entries = member.select("ball", F.posexplode("keys").alias("t", "key")).distinct()
    entries = entries.join(stats.select("ball", "radius", "code"), "ball")
    entries = materialize(entries.select("t", "key", "ball", "radius", "code"), "entries")
    left, right = entries.toDF("t", "key", "a", "ra", "ca"), entries.toDF("t", "key", "b", "rb", "cb")
    near = _differing(F.col("ca"), F.col("cb")) <= _most_bits(limit + F.col("ra") + F.col("rb"))
    met = left.join(right, ["t", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    first = stats.select(F.col("ball").alias("a"), F.col("radius").alias("ra"), F.col("lead").alias("x"))
    second = stats.select(F.col("ball").alias("b"), F.col("radius").alias("rb"), F.col("lead").alias("y"))
    pairs = with_cosine(met.join(first, "a").join(second, "b"))
    angle, radii = _angle("cosine"), F.col("ra") + F.col("rb")
    alone = radii == 0  # equal vectors have the same cosines
    linked = F.when(alone & (F.col("cosine") >= cosine), True).when(~alone & (angle + radii <= limit - MARGIN), True)
    open_pair = ~alone & (angle - radii <= limit + MARGIN)
    pairs = pairs.select("a", "b", F.coalesce(linked, F.lit(False)).alias("sure"), open_pair.alias("open"))
    return stats, materialize(pairs.where("sure OR open").select("a", "b", "sure"), "ball-pairs")


def _compare(cosine: float):
    """(ball, row, links) of the two blocks of vectors."""

    def links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"row": [], "links": []}).astype("int64")
        x, y = (np.stack(side["embedding"].to_numpy()).astype(np.float64) for side in (left, right))
        dots = x @ y.T / np.outer(np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1)))
        for i, j in zip(*np.nonzero(np.abs(dots - cosine) < MARGIN)):  # close calls in the order of single pairs
            dots[i, j] = _cosines(x[i : i + 1], y[j : j + 1])[0]
        linked = dots >= cosine
        rows = np.concatenate([left["row"], right["row"]])
        n = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
        return pd.DataFrame({"row": rows[n > 0], "links": n[n > 0]}).astype("int64")

    return links


def block_links(member: DataFrame, stats: DataFrame, undecided: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(a, b, row, links): the links of each member of an undecided pair of balls with the other ball."""
    part = F.pmod(F.xxhash64("row", F.lit("block")), F.ceil(F.col("size") / F.lit(block)))
    sizes = stats.select("ball", "size")
    blocks = member.join(sizes, "ball").select("ball", "row", "embedding", part.alias("part"))
    counts = sizes.select("ball", F.ceil(F.col("size") / F.lit(block)).alias("parts"))
    split = undecided.join(counts.toDF("a", "na"), "a").join(counts.toDF("b", "nb"), "b")
    split = split.select("a", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("na") - 1)).alias("i"), "nb")
    split = split.select("a", "b", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("j"))
    keys = ["a", "b", "i", "j"]
    mine = blocks.toDF("ball", "row", "embedding", "part")
    left = split.join(mine, (F.col("a") == F.col("ball")) & (F.col("i") == F.col("part"))).select(*keys, "row", "embedding")
    right = split.join(mine, (F.col("b") == F.col("ball")) & (F.col("j") == F.col("part"))).select(*keys, "row", "embedding")
    right = right.toDF(*right.columns)  # new columns, else both sides have the same ones
    compare = _compare(cosine)

    def compared(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return compare(left, right).assign(a=key[0], b=key[1])[["a", "b", "row", "links"]]

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compared, "a long, b long, row long, links long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, fit_rows: int = FIT_ROWS, block: int = BLOCK) -> DataFrame:
    """Per row: vec_id, n_links (other vectors linked directly), component_id (least vec_id reachable), kept."""
    rows = coded_rows(embeddings, cosine, fit_rows)
    member = balls(rows, cosine)
    stats, pairs = ball_pairs(member, cosine)
    found = materialize(block_links(member, stats, pairs.where("NOT sure"), cosine, block), "block-links")
    sure = pairs.where("sure").select("a", "b")
    edges = sure.unionByName(found.select("a", "b").distinct())

    sizes = stats.select("ball", "size")
    ends = sure.select(F.col("a").alias("mine"), F.col("b").alias("ball")).unionByName(sure.select(F.col("b").alias("mine"), F.col("a").alias("ball")))
    whole = ends.join(sizes, "ball").groupBy(F.col("mine").alias("ball")).agg(F.sum("size").alias("whole"))
    single = found.groupBy("row").agg(F.sum("links").alias("single"))
    of = components(edges).select(F.col("id").alias("ball"), "component")
    named = stats.select("ball", "size", "least_id").join(of, "ball", "left").withColumn("component", F.coalesce("component", "ball"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").join(whole, "ball", "left")
    named = named.select("ball", (F.col("size") - 1 + F.coalesce("whole", F.lit(0))).alias("shared"), "component_id")
    linked = member.select("row", "ball").join(named, "ball").join(single, "row", "left")
    linked = linked.select("row", (F.col("shared") + F.coalesce("single", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("row", "vec_id", F.col("code").isNotNull().alias("able")).join(linked, "row", "left")
    component = F.when(F.col("able"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
