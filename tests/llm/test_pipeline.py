from __future__ import annotations

import corpus_pipeline
from footfall.llm import bagminhash, decontam, line_rules
from tests.llm.frames import awkward, documents


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_run_equals_stage_by_stage_verdicts(spark, sf_dir):
    docs = documents(spark, sf_dir)
    docs = line_rules.judge(docs).where("kept").select("doc_id", "cleaned_text")
    docs = docs.withColumnRenamed("cleaned_text", "text")
    kept = {r.doc_id for r in bagminhash.classes(docs).where("doc_id = class_id").collect()}
    docs = docs.where(docs.doc_id.isin(*kept))
    found = decontam.match(docs, documents(spark, sf_dir, "benchmark"))
    kept &= {r.doc_id for r in found.where("size(hits) = 0").collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(kept)
    assert 0 < len(rows) < 1000


def test_empty_corpus(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        documents(spark, sf_dir, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
