"""Corpus pipeline over ``documents``: quality rules, SimHash near-duplicates, benchmark
decontamination, personal data, SentencePiece.  Every stage works on all that the stage
before it kept, reads it as a written table, and returns the columns of ``documents``;
the last returns the encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import decontamination, pii, quality_rules, sentencepiece_codec, simhash
from barlake.llm.common import numbered, read, without_rows, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    docs = numbered(docs)
    return without_rows(docs, quality_rules.judged(docs).where(~F.col("kept")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id stays."""
    docs = numbered(docs)
    return without_rows(docs, simhash.near_duplicates(docs).where(F.col("uid") != F.col("first_uid")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an exact benchmark passage go."""
    docs = numbered(docs)
    found = decontamination.decontamination(docs, read(spark, sf_dir, "benchmark"))
    return without_rows(docs, found.where("contaminated"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to surrogates."""
    return pii.surrogate_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the decoded text as digests, per document."""
    return sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("sentencepiece", encode),
]

# the stages hold estimates, components and encodings that SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
