"""Registered queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.llm import (
    chunk_dedup,
    contamination,
    embedding_dedup,
    importance,
    licenses,
    mixing,
    overlap_join,
    page_text,
    preferences,
    sharding,
    statements,
    suffix_dedup,
    toxicity,
    turn_repair,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda m: F.concat_ws("-", m["from"], m["to"])), ",").alias(mask)

    rows = preferences.preference_rows(table(spark, sf_dir, "conversations"), *preferences.neighbours())
    return rows.select("pair_id", "n_common", "prompt", "chosen", "rejected", listed("chosen_mask"), listed("rejected_mask"))


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_texts(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination.summary(contamination.contaminated_words(docs.select("doc_id", "text"), items))


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = licenses.license_matches(table(spark, sf_dir, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct("matches.template")), ",")
    return matches.select("doc_id", F.size("matches").cast("long").alias("n_matches"), names.alias("templates"))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.near_duplicate_components(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, sf_dir, "conversations"))


PREFERENCE_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id >> 1 AS pair_id, (conv_id & 1) = 1 AS side, turn,
         regexp_replace(coalesce(role, ''), '<\|(im_start|im_end)\|>', '< |\1| >', 'g') AS role,
         regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '< |\1| >', 'g') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (
  SELECT *, '<|im_start|>' || role || chr(10) AS head, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown,
         row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS nth FROM t),
p AS (
  SELECT coalesce(c.pair_id, d.pair_id) AS pair_id, coalesce(c.nth, d.nth) AS nth,
         coalesce(c.shown = d.shown AND c.role = d.role, false) AS same
  FROM (FROM r WHERE NOT side) c FULL JOIN (FROM r WHERE side) d ON c.pair_id = d.pair_id AND c.nth = d.nth),
n AS (SELECT pair_id, coalesce(min(nth) FILTER (NOT same) - 1, max(nth)) AS n_common FROM p GROUP BY pair_id),
s AS (
  SELECT r.*, n_common, nth > n_common AS after,
         coalesce(sum(CASE WHEN nth > n_common THEN length(shown) ELSE 0 END)
                  OVER (PARTITION BY pair_id, side ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM r JOIN n USING (pair_id))
SELECT pair_id, n_common::bigint AS n_common,
       coalesce(string_agg(shown, '' ORDER BY nth) FILTER (NOT side AND NOT after), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY nth) FILTER (NOT side AND after), '') AS chosen,
       coalesce(string_agg(shown, '' ORDER BY nth) FILTER (side AND after), '') AS rejected,
       coalesce(string_agg((start + length(head))::varchar || '-' || (start + length(shown) - 1)::varchar, ',' ORDER BY nth)
                FILTER (NOT side AND after AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((start + length(head))::varchar || '-' || (start + length(shown) - 1)::varchar, ',' ORDER BY nth)
                FILTER (side AND after AND role = 'assistant'), '') AS rejected_mask
FROM s GROUP BY pair_id, n_common
"""

CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
s AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS pos FROM i WHERE len(w) > 0),
x AS (SELECT DISTINCT item_id, n, array_to_string(w[pos:pos + n - 1], ' ') AS run FROM s),
p AS (
  SELECT doc_id, w, l.n, unnest(range(1, len(w) - l.n + 2)) AS pos
  FROM d, (SELECT DISTINCT n FROM x) l WHERE len(w) >= l.n),
h AS (
  SELECT doc_id, pos, p.n, item_id
  FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS run FROM p) p JOIN x ON x.n = p.n AND x.run = p.run),
c AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::varchar, ',' ORDER BY item_id::varchar) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::varchar, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::bigint AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::bigint]::double AS weight,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank
  FROM d GROUP BY source),
c AS (
  SELECT *, 3.0::double * source_size AS most, (sum(source_size) OVER ())::double AS total,
         coalesce(sum(3.0::double * source_size) OVER w, 0) AS held, (sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0) AS free
  FROM s WINDOW w AS (ORDER BY 3.0::double * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, most * free <= (total - held) * weight AS capped FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN most
              ELSE (total - sum(CASE WHEN capped THEN most ELSE 0 END) OVER ()) * weight
                   / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) END AS target
  FROM f),
b AS (
  SELECT *, round(target)::bigint AS budget,
         CASE WHEN source_size > 0 THEN round(target)::bigint // source_size ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::bigint AS taken
FROM p
"""

QUERIES = {
    "op1_preferences": op1_preferences,
    "op2_page_text": op2_page_text,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_ring_shards": op5_ring_shards,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_licenses": op7_licenses,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mix_sources": op10_mix_sources,
    "op11_importance_resample": op11_importance_resample,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_turn_repair": op13_turn_repair,
}
ORACLES = {
    "op1_preferences": PREFERENCE_SQL,
    "op4_decontaminate": CONTAMINATION_SQL,
    "op8_chunk_dedup": EXACT_SQL,
    "op10_mix_sources": MIX_SQL,
    "op11_importance_resample": statements.IMPORTANCE_SQL,
    "op12_embedding_dedup": statements.EMBEDDING_SQL,
    "op13_turn_repair": statements.REPAIR_SQL,
}
