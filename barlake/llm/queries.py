"""Registered queries of the operators, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from barlake.llm import (clustering, decontamination, hard_negatives, lm_scores, pii, quality_rules, secrets,
                         sentencepiece_codec, simhash, suffix_dedup, token_counts, token_files, url_filters)
from barlake.llm.common import fresh_path, read
from barlake.llm.oracle_sql import ORACLE_SQL  # noqa: F401

# Fixed value: host labels of the listed sites.
LISTED_SITES = r"(?:^|\.)(?:casino-win|free-bets)\."


def op1_secrets(spark, d):
    return secrets.secret_scan(read(spark, d, "documents"))


def op2_suffix_dedup(spark, d):
    return suffix_dedup.suffix_dedup(read(spark, d, "documents"))


def op3_url_filters(spark, d):
    """The list: URLs of ``pages`` on gambling sites."""
    pages = read(spark, d, "pages").select("page_id", "url")
    host, _ = url_filters.url_parts(F.col("url"))
    return url_filters.url_filter(pages, pages.where(host.rlike(LISTED_SITES)).select("url"))


def op4_pii(spark, d):
    return pii.pii(read(spark, d, "documents"))


def op5_quality_rules(spark, d):
    return quality_rules.quality_rules(read(spark, d, "documents"))


def op6_simhash(spark, d):
    return simhash.simhash(read(spark, d, "documents"))


def op7_lm_scores(spark, d):
    scores = lm_scores.lm_scores(read(spark, d, "documents"))
    return scores.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_score")})


def op8_decontamination(spark, d):
    return decontamination.decontamination(read(spark, d, "documents"), read(spark, d, "benchmark")).drop("uid")


def op9_sentencepiece(spark, d):
    return sentencepiece_codec.encode_decode(
        read(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_token_counts(spark, d):
    return token_counts.token_counts(
        read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_centroid_clustering(spark, d):
    return clustering.cluster_vectors(read(spark, d, "embeddings"))


def op12_hard_negatives(spark, d):
    """Every 50th row is an anchor; every 7th row's label is shifted."""
    return hard_negatives.hard_negatives(hard_negatives.shifted_labels(read(spark, d, "embeddings")),
                                         F.col("vec_id") % hard_negatives.ANCHOR_EVERY == 0)


def op13_token_files(spark, d):
    path = fresh_path(spark, "token-files")
    token_files.write_token_ids(read(spark, d, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    return token_files.document_checksums(spark, path)


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_pii": op4_pii,
    "op5_quality_rules": op5_quality_rules,
    "op6_simhash": op6_simhash,
    "op7_lm_scores": op7_lm_scores,
    "op8_decontamination": op8_decontamination,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_token_counts": op10_token_counts,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_files": op13_token_files,
}

# Registered besides, by an earlier name.
FURTHER = {"op8_near_matches": op8_decontamination}
