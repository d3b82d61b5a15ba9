"""The pipeline on the smallest test tables: each stage's decision holds on what the one before kept."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from shelfscope.llm import decontam, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark, scratch):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mix_sources"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {"start": docs}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF)
        out.write.parquet(f"{scratch}/pipeline_{name}")
        docs = spark.read.parquet(f"{scratch}/pipeline_{name}")
        seen[name] = docs
        if name != "mix_sources":
            assert docs.columns == columns
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1 or quality = 0").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0 and quality = 1").collect()}
    kept = {r["doc_id"] for r in seen["quality_classifier"].collect()}
    assert len(kept & toxic) <= 0.1 * len(toxic) and len(good - kept) <= 0.1 * len(good)
    assert seen["line_dedup"].count() == len(kept)
    near = simhash.near_duplicates(seen["simhash_near_dedup"])
    assert near.count() == near.select("component_id").distinct().count()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontam.contaminated(seen["benchmark_decontamination"], bench).count() == 0
    assert 0 < seen["mix_sources"].count() <= seen["benchmark_decontamination"].count()
    assert corpus_pipeline.run(spark, SF).count() == seen["mix_sources"].count()
