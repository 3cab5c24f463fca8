"""The pipeline against its stages by hand, and the registered queries as a whole."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from staywise.llm import contamination, overlap_join, toxicity
from staywise.llm.catalog import QUERIES, table


def test_stages_keep_the_columns_and_what_they_should(spark, data_dir, tmp_path):
    docs = table(spark, data_dir, "documents")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data_dir).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns

    def ids(frame):
        return [r.doc_id for r in frame.select("doc_id").collect()]

    before, after = seen["toxicity"]
    scores = toxicity.toxicity(before, table(spark, data_dir, "labels"))
    assert sorted(ids(after)) == sorted(r.doc_id for r in scores.where("predicted = 0").collect())
    before, after = seen["jaccard_join"]
    classes = overlap_join.near_duplicate_components(before)
    assert sorted(ids(after)) == sorted({r.component_id for r in classes.collect()})
    before, after = seen["decontaminate"]
    found = contamination.summary(contamination.contaminated_words(before, table(spark, data_dir, "benchmark")))
    assert sorted(ids(after)) == sorted(r.doc_id for r in found.where("NOT contaminated").collect())
    before, after = seen["mix"]
    assert set(ids(after)) <= set(ids(before)) and max(ids(after).count(i) for i in set(ids(after))) <= 3
    before, after = seen["shard"]
    assert sorted(ids(after)) == sorted(ids(before))
    assert after.select("shard", "slot").distinct().count() == after.count() > 0


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", ["op3_toxicity", "op5_ring_shards", "op10_mix_sources"])
def test_reruns_agree(spark, data_dir, name):
    # the classifier adds up in the order that tasks end
    frames = [QUERIES[name](spark, data_dir) for _ in range(2)]
    frames = [f.withColumn("score", F.round("score", 6)) if "score" in f.columns else f for f in frames]
    a, b = (sorted(map(str, f.collect())) for f in frames)
    assert a == b and a
