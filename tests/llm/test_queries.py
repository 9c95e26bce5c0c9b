import corpus_pipeline
import __spark_entry__ as entry_point
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

import pytest

from conftest_llm import exact_targets
from tripmill.llm import jaccard, spans
from tripmill.llm.oracles import llm_oracles
from tripmill.llm.queries import llm_queries
from tripmill.plans.staging import staged


def test_all_are_registered():
    names = {n.split("_")[0] for n in llm_queries()}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert {"pipeline", *llm_queries()} <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, small, name):
    columns, rows = spark_rows(llm_queries()[name](spark, small))
    expected_columns, expected = duck_rows(connect(small), llm_oracles()[name])
    assert columns == expected_columns
    assert rows == expected


def test_pipeline_stage_by_stage(spark, small):
    names = spark.read.parquet(f"{small}/documents.parquet").columns
    docs = spark.read.parquet(f"{small}/documents.parquet")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, small))
        results[name] = (before, docs)
        if name != "encode":
            assert docs.columns == names
    labels = spark.read.parquet(f"{small}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    before, after = results["toxicity"]
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id").select("toxic").collect()
    assert sum(r["toxic"] for r in gone) >= 0.9 * len(gone) > 0
    before, after = results["near_copies"]
    assert {r["doc_id"] for r in after.collect()} == {r["component_id"] for r in jaccard.join(before).collect()}
    before, after = results["passages"]
    texts = {r["doc_id"]: r["text"] for r in spans.deduplicated(before).collect()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    before, after = results["mix"]
    size = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    sizes = {r["source"]: r["n"] for r in before.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    taken = {r["source"]: r["n"] for r in after.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    largest = before.agg(F.max(size)).first()[0]
    assert all(abs(taken.get(s, 0) - t) <= largest for s, t in exact_targets(sizes).items())
    assert after.join(before, names, "left_anti").count() == 0
    before, after = results["encode"]
    assert after.count() == before.count()
    run = corpus_pipeline.run(spark, small)
    assert sorted(r["ids_sha256"] for r in run.collect()) == sorted(r["ids_sha256"] for r in after.collect())
