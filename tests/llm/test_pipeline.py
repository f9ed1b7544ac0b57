"""The pipeline's stages against the operators' verdicts, and on odd tables."""

import re

import corpus_pipeline
from barlake.llm import decontamination, quality_rules, simhash
from barlake.llm.common import read, written

SMOKE = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_works_on_what_the_one_before_kept(scratch):
    docs = read(scratch, SMOKE, "documents")
    wants = [
        lambda d: [r.doc_id for r in quality_rules.quality_rules(d).collect() if r.kept],
        lambda d: sorted({r.component_id for r in simhash.simhash(d).collect()}),
        lambda d: [r.doc_id for r in decontamination.decontamination(d, read(scratch, SMOKE, "benchmark")).collect()
                   if not r.contaminated],
        ids, ids]
    for (name, stage), want in zip(corpus_pipeline.STAGES, wants, strict=True):
        out = written(stage(scratch, docs, SMOKE), "test-stage")
        assert ids(out) == sorted(want(docs)), name
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "pii":
            assert not any(re.search(r"@mail\d+\.example\.com", r.text) for r in out.collect())
        docs = out
    assert sorted(tuple(r) for r in docs.collect()) == sorted(tuple(r) for r in corpus_pipeline.run(scratch, SMOKE).collect())


def test_stages_on_nulls_and_empty_tables(docs, scratch):
    frame = docs([(None, None, None, None), (1, ""), (2, "w " * 80, None, "s"), (2, "w " * 80)])
    for table in (frame, frame.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(scratch, table, SMOKE)
            assert out.count() <= table.count(), name
