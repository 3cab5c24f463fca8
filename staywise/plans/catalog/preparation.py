"""Imputation, scaling, encoding, folds, sampling, neighbours and oversampling on the given tables."""

from pyspark.sql import functions as F

from staywise.operators import levels, prep, selection
from staywise.operators.neighbors import nearest_neighbours
from staywise.operators.smote import smote
from staywise.plans.catalog.registry import IS_PURCHASE, query, table

HOLED = {
    "l_quantity": "CASE WHEN l_linenumber <> 3 THEN cast(l_quantity + l_linenumber % 2 AS int) END",
    "l_extendedprice": "CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END",
}


def holed_items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag", *[F.expr(e).alias(c) for c, e in HOLED.items()]
    )


HOLED_SQL = f"SELECT l_returnflag, {', '.join(f'{e} AS {c}' for c, e in HOLED.items())} FROM lineitem"


@query(
    "impute_median",
    f"""SELECT l_returnflag, count(*) AS n, round(sum(coalesce(l_quantity, mq)), 2) AS quantity,
        round(sum(coalesce(l_extendedprice, mp)), 2) AS price, max(CASE WHEN l_quantity IS NULL THEN mq END) AS median_quantity,
        max(CASE WHEN l_extendedprice IS NULL THEN mp END) AS median_price
        FROM ({HOLED_SQL}), (SELECT median(l_quantity) AS mq, median(l_extendedprice) AS mp FROM ({HOLED_SQL}))
        GROUP BY l_returnflag""",
)
def impute_median(spark, sf_dir):
    """A whole-number column and one of decimals; what was filled in is their medians."""
    items = holed_items(spark, sf_dir).withColumns({f"was_{c}": F.col(c).isNull() for c in HOLED})
    filled = prep.impute_median(items, list(HOLED))
    return filled.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.max(F.when(F.col("was_l_quantity"), F.col("l_quantity"))).alias("median_quantity"),
        F.max(F.when(F.col("was_l_extendedprice"), F.col("l_extendedprice"))).alias("median_price"),
    )


@query(
    "impute_mode",
    """WITH d AS (SELECT nullif(c_mktsegment, 'MACHINERY') AS s FROM customer),
        m AS (SELECT s AS mode FROM d WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1)
        SELECT coalesce(s, mode) AS segment, count(*) AS n FROM d, m GROUP BY 1""",
)
def impute_mode(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment")
    )
    return prep.impute_mode(rows, ["segment"]).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "standardize",
    """WITH s AS (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS d FROM part)
        SELECT p_partkey, round((p_retailprice - m) / d, 6) AS p_retailprice, cast(0 AS double) AS constant FROM part, s""",
)
def standardize(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", F.lit(3.0).alias("constant"))
    return prep.standardize(part, ["p_retailprice", "constant"]).withColumn(
        "p_retailprice", F.round("p_retailprice", 6)
    )


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]  # one level is left out: it is unseen


@query(
    "one_hot",
    "SELECT "
    + ", ".join(f"cast(c_mktsegment = '{s}' AS int) AS \"segment_{s}\"" for s in SEGMENTS)
    + ", count(*) AS n FROM customer GROUP BY ALL",
)
def one_hot(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"))
    encoded = prep.one_hot(rows, "segment", SEGMENTS).drop("segment")
    return encoded.groupBy(*encoded.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "encode_table",
    """WITH s AS (SELECT median(nullif(c_nationkey, 0)) AS med FROM customer),
        i AS (SELECT c_custkey, c_mktsegment, coalesce(nullif(c_nationkey, 0), med) AS x FROM customer, s),
        z AS (SELECT avg(x) AS m, stddev_pop(x) AS d FROM i)
        SELECT c_custkey, round((x - m) / d, 6) AS num__nation, """
    + ", ".join(
        f"cast(c_mktsegment = '{s}' AS double) AS \"cat__segment_{s}\""
        for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    )
    + " FROM i, z",
)
def encode_table(spark, sf_dir):
    """The whole preprocessing: numeric block, then every level of the categories, other columns dropped."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        "c_name",
    )
    learned = prep.learn_preparation(rows, ["nation"], ["segment"])
    return rows.select("c_custkey", *learned.encoded()).withColumn("num__nation", F.round("num__nation", 6))


@query(
    "encode_levels",
    """WITH e AS (SELECT event_id, nullif(cast(user_id AS varchar), '7') AS u, event_type AS t FROM events),
        lu AS (SELECT u, row_number() OVER (ORDER BY u) - 1 AS i FROM (SELECT DISTINCT u FROM e WHERE u IS NOT NULL)),
        lt AS (SELECT t, row_number() OVER (ORDER BY t) - 1 + (SELECT count(*) FROM lu) AS j FROM (SELECT DISTINCT t FROM e))
        SELECT event_id, i AS user_position, j AS type_position, (SELECT count(*) FROM lu) + (SELECT count(*) FROM lt) AS width
        FROM e LEFT JOIN lu USING (u) LEFT JOIN lt USING (t)""",
)
def encode_levels(spark, sf_dir):
    """A category with as many levels as there are users, and one with few: where each event's one-hot row holds a 1."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("user_id").cast("string"), F.lit("7")).alias("user"), F.col("event_type").alias("type")
    )
    found = levels.encode_levels(rows, ["user", "type"])
    several = F.size("positions") > 1
    return found.select(
        "event_id",
        F.when(several, F.col("positions")[0]).alias("user_position"),
        F.when(several, F.col("positions")[1]).otherwise(F.col("positions")[0]).alias("type_position"),
        "width",
    )


@query(
    "class_weights",
    f"""SELECT label, n, sum(n) OVER () / (count(*) OVER () * n) AS weight
        FROM (SELECT {IS_PURCHASE} AS label, count(*) AS n FROM events GROUP BY 1)""",
)
def class_weights(spark, sf_dir):
    return prep.class_weights(table(spark, sf_dir, "events").select(F.expr(IS_PURCHASE).alias("label")), "label")


@query(
    "stratified_folds",
    f"""SELECT event_id, label, cast((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42-', event_id)),
        event_id) - 1) % 5 AS int) AS fold FROM (SELECT event_id, {IS_PURCHASE} AS label FROM events)""",
)
def stratified_folds(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(IS_PURCHASE).alias("label"))
    return selection.stratified_folds(rows, "event_id", "label")


@query(
    "seeded_sample",
    "SELECT event_id, event_type FROM events ORDER BY md5(concat('42-', event_id)), event_id LIMIT 400",
)
def seeded_sample(spark, sf_dir):
    return selection.seeded_sample(table(spark, sf_dir, "events"), "event_id", 400).select(
        "event_id", "event_type"
    )


def vectors(spark, sf_dir):
    """All embeddings as double vectors; class 1 is label 0 against the rest."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("vec"),
        (F.col("label") == 0).cast("int").alias("label"),
    )


VECTORS_SQL = "SELECT vec_id, embedding::DOUBLE[] AS vec, (label = 0)::int AS label FROM embeddings"
NEIGHBOURS_SQL = f"""SELECT vec_id, position, neighbour, round(distance, 6) AS distance FROM (
    SELECT *, cast(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) - 1 AS int) AS position FROM (
    SELECT a.vec_id, b.vec_id AS neighbour,
        list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
    FROM v a JOIN v b ON a.vec_id <> b.vec_id)) WHERE position < 5"""


@query(
    "knn_minority",
    f"WITH v AS (SELECT * FROM ({VECTORS_SQL}) WHERE label = 1) {NEIGHBOURS_SQL}",
)
def knn_minority(spark, sf_dir):
    minority = vectors(spark, sf_dir).where(F.col("label") == 1)
    return nearest_neighbours(minority, "vec_id", "vec", 5, vectors=False).select(
        F.col("id").alias("vec_id"), "position", "neighbour", "distance"
    )


@query("knn_all", f"WITH v AS ({VECTORS_SQL}) {NEIGHBOURS_SQL}")
def knn_all(spark, sf_dir):
    """Neighbours among all rows, cut into cells and blocks."""
    return nearest_neighbours(vectors(spark, sf_dir), "vec_id", "vec", 5, block_rows=256, vectors=False).select(
        F.col("id").alias("vec_id"), "position", "neighbour", "distance"
    )


@query(
    "knn_dense",
    """WITH p AS (SELECT DISTINCT cast(round(l_extendedprice * 100) AS bigint) AS vec_id FROM lineitem),
        n AS (SELECT vec_id, lag(vec_id) OVER w AS lower, lead(vec_id) OVER w AS upper,
                vec_id / 1e6 - lag(vec_id / 1e6) OVER w AS below, lead(vec_id / 1e6) OVER w - vec_id / 1e6 AS above
            FROM p WINDOW w AS (ORDER BY vec_id))
        SELECT vec_id, CASE WHEN lower IS NULL OR above * above < below * below THEN upper ELSE lower END AS neighbour
        FROM n""",
)
def knn_dense(spark, sf_dir):
    """The nearest neighbour among very close points: all different prices in cents, a millionth apart each."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("vec_id")
    points = table(spark, sf_dir, "lineitem").select(cents).distinct()
    points = points.select("vec_id", F.array(F.col("vec_id") / F.lit(1e6)).alias("vec"))
    return nearest_neighbours(points, "vec_id", "vec", 1, vectors=False).select(F.col("id").alias("vec_id"), "neighbour")


@query(
    "smote",
    f"""WITH a AS ({VECTORS_SQL}), v AS (SELECT * FROM a WHERE label = 1),
        near AS ({NEIGHBOURS_SQL}),
        base AS (SELECT vec_id, vec, row_number() OVER (ORDER BY md5(concat('42-', vec_id)), vec_id) - 1 AS pos FROM v),
        c AS (SELECT count(*) FILTER (label = 1) AS rare, count(*) FILTER (label = 0) AS frequent FROM a),
        j AS (SELECT j, rare, md5(concat('42-', j)) AS h FROM (SELECT unnest(range(frequent - rare)) AS j, rare FROM c)),
        d AS (SELECT j, j % rare AS pos, ('0x' || substr(h, 9, 8))::bigint % 5 AS slot,
            ('0x' || substr(h, 1, 8))::bigint / 4294967296.0 AS u FROM j),
        s AS (SELECT -d.j - 1 AS vec_id, d.u, x.vec AS p, y.vec AS q FROM d JOIN base x ON x.pos = d.pos
            JOIN near ON near.vec_id = x.vec_id AND near.position = d.slot JOIN v y ON y.vec_id = near.neighbour),
        r AS (SELECT vec_id, label, false AS synthetic, vec[1] AS first, vec[64] AS last, list_sum(vec) AS total FROM a
            UNION ALL SELECT vec_id, 1, true, p[1] + u * (q[1] - p[1]), p[64] + u * (q[64] - p[64]),
            list_sum(p) + u * (list_sum(q) - list_sum(p)) FROM s)
        SELECT vec_id, label, synthetic, round(first, 6) AS first, round(last, 6) AS last, round(total, 6) AS total FROM r""",
)
def smote_rows(spark, sf_dir):
    balanced = smote(vectors(spark, sf_dir), "vec_id", "vec", "label")
    return balanced.select(
        "vec_id",
        "label",
        "synthetic",
        F.round(F.col("vec")[0], 6).alias("first"),
        F.round(F.col("vec")[63], 6).alias("last"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x), 6).alias("total"),
    )
