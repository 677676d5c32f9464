import corpus_pipeline
from tallyspark.llm import byte_bpe, decontaminate, jaccard_join, quality

SF = "/root/testdata/sf0.001"


def test_pipeline_keeps_what_each_operator_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: bytes(r["decoded"]).decode() for r in corpus_pipeline.run(spark, SF).collect()}
    good = {r["doc_id"] for r in quality.scored(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("score >= 0.3").collect()}
    kept = docs.filter(docs["doc_id"].isin(list(good)))
    first = {r["doc_id"] for r in jaccard_join.near_duplicates(kept).filter("doc_id = component_id").collect()}
    bad = {r["doc_id"] for r in decontaminate.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
           .filter(decontaminate.is_contaminated()).collect()}
    assert set(got) == first - bad
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(got[i] == text[i] or "[SECRET]" in got[i] for i in got)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "byte_level_bpe"]
    assert byte_bpe.SCHEMA
