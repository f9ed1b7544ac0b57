"""Row numbers and chunks stay the same when a later scan is split differently."""

import pytest

import corpus_pipeline
from barlake.llm import common, decontamination, lm_scores, quality_rules, simhash, suffix_dedup

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture
def other_splits(scratch, monkeypatch):
    """A table, and a session whose file splits change once a table has been stored."""
    def store(df, name):
        out = common_written(df, name)
        scratch.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        return out
    common_written = common.written
    docs = common_written(common.read(scratch, SMOKE, "documents").repartition(7), "test-documents")
    for module in (common, quality_rules, simhash, decontamination):
        monkeypatch.setattr(module, "written", store)
    yield docs
    scratch.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stages_drop_what_was_judged(scratch, other_splits):
    for stage, verdicts in (
            (corpus_pipeline.keep_quality, lambda d: [r.doc_id for r in quality_rules.quality_rules(d).collect() if r.kept]),
            (corpus_pipeline.drop_contaminated,
             lambda d: [r.doc_id for r in decontamination.decontamination(
                 d, common.read(scratch, SMOKE, "benchmark")).collect() if not r.contaminated])):
        got = sorted(r.doc_id for r in stage(scratch, other_splits, SMOKE).select("doc_id").collect())
        scratch.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == sorted(verdicts(other_splits))
        scratch.conf.unset("spark.sql.files.maxPartitionBytes")


def test_blocks_of_the_benchmark_name_rows_alike(scratch, other_splits):
    benchmark = common.read(scratch, SMOKE, "benchmark")
    rows = [sorted(r[:7] for r in decontamination.decontamination(other_splits, benchmark, block_bytes=b).collect())
            for b in (8 << 20, 500)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("made", [suffix_dedup.suffix_dedup, lm_scores.lm_scores])
def test_chunks_are_cut_in_one_scan(scratch, other_splits, made, monkeypatch):
    plans = []
    monkeypatch.setattr(lm_scores, "written", lambda df, name: plans.append(df) or common.written(df, name))
    plans.append(made(other_splits))
    plans[0].collect()
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_a_users_columns_are_no_row_numbers(docs):
    from pyspark.sql import functions as F
    mine = docs([(1, "one two three four"), (2, "one two three four"), (3, "other words stand here")]).withColumns(
        {c: F.lit(5) for c in (common.ROW, "barlake_dropped", "uid", "kept")})
    rows = simhash.near_duplicates(mine).collect()
    assert len({r.uid for r in rows}) == 3 and {r.doc_id for r in rows if r.uid == r.first_uid} == {1, 3}
    kept = corpus_pipeline.drop_near_duplicates(None, mine, SMOKE)
    assert kept.columns == mine.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert kept.where(f"{common.ROW} = 5 and barlake_dropped = 5").count() == 2
    for stage in (corpus_pipeline.keep_quality, corpus_pipeline.replace_personal_data):
        assert stage(None, mine, SMOKE).columns == mine.columns


@pytest.mark.parametrize("made", [suffix_dedup.suffix_dedup, lm_scores.lm_scores])
def test_chunks_that_might_be_cut_twice_are_refused(scratch, docs, made):
    scratch.conf.set("spark.sql.exchange.reuse", "false")
    try:
        with pytest.raises(ValueError, match="exchange.reuse"):
            made(docs([(1, "one two three")]))
    finally:
        scratch.conf.unset("spark.sql.exchange.reuse")
