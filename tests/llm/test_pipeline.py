from collections import Counter

import corpus_pipeline as pipeline
from bidloom.llm import decontamination, mixing, quality, simhash

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_each_stage_does_what_its_operator_reports(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    stages = dict(pipeline.STAGES)
    assert [name for name, _ in pipeline.STAGES] == list(stages) and len(stages) == 5

    kept = stages["quality_rules"](spark, docs, SF_DIR)
    good = {r.doc_id for r in quality.quality_table(docs, labels).collect() if r.kept}
    assert rows_of(kept) == rows_of(docs.filter(docs.doc_id.isin(list(good))))

    single = stages["simhash_near_duplicates"](spark, kept, SF_DIR)
    heads = {r.component_id for r in simhash.component_table(kept).collect()}
    assert rows_of(single) == rows_of(kept.filter(kept.doc_id.isin(list(heads))))

    clean = stages["benchmark_decontamination"](spark, single, SF_DIR)
    leaked = {r.doc_id for r in decontamination.leak_table(single, items).collect()}
    assert leaked and rows_of(clean) == rows_of(single.filter(~single.doc_id.isin(list(leaked))))

    mix = stages["source_mixture"](spark, clean, SF_DIR)
    draws = Counter({r.doc_id: r.taken // r.size for r in mixing.mix_table(clean).collect() if r.size})
    assert Counter(r.doc_id for r in mix.collect()) == +draws

    out = stages["rendezvous_shards"](spark, mix, SF_DIR)
    assert rows_of(out.select(*docs.columns)) == rows_of(mix)
    assert {r.shard for r in out.collect()} <= set(range(pipeline.SHARDS))
    assert rows_of(pipeline.run(spark, SF_DIR)) == rows_of(out)


def test_stages_take_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in pipeline.STAGES:
        for given in (odd_docs, odd_docs.limit(0), docs):
            out = stage(spark, given, SF_DIR)
            out.collect()
            assert name == pipeline.STAGES[-1][0] or out.columns == odd_docs.columns
        docs = out
