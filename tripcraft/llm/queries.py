"""Registered queries of this subpackage: the numbered operators over the supplied tables."""

from __future__ import annotations

import os

from tripcraft.llm import (
    bpe, decontaminate, filter_audit, fm_index, jaccard_join, language, quality_rules, resampling, secrets, suffix_array,
    threshold_search, toxicity, whitening,
)
from tripcraft.llm.common import importable

#: Folder of the public tokenizer files, on every machine of the cluster.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
#: Splits text before the merges of the rank files (fixed value, from their description).
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_BPE = f"{TOKENIZERS}/word_bpe_49k.json"
BYTE_RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def _table(spark, sf, name):
    importable(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark, sf):
    return _table(spark, sf, "documents")


QUERIES = {
    "op1_threshold_search": lambda spark, sf: threshold_search.op1(_table(spark, sf, "embeddings")),
    "op2_importance_resampling": lambda spark, sf: resampling.op2(_documents(spark, sf), _table(spark, sf, "labels")),
    "op3_fm_index_dedup": lambda spark, sf: fm_index.op3(_documents(spark, sf)),
    "op4_bpe": lambda spark, sf: bpe.op4(_documents(spark, sf), WORD_BPE),
    "op5_toxicity": lambda spark, sf: toxicity.op5(_documents(spark, sf), _table(spark, sf, "labels")),
    "op6_jaccard_join": lambda spark, sf: jaccard_join.op6(_documents(spark, sf)),
    "op7_suffix_array_dedup": lambda spark, sf: suffix_array.op7(_documents(spark, sf)),
    "op8_secret_scan": lambda spark, sf: secrets.op8(_documents(spark, sf), BYTE_RANKS, RANK_PATTERN),
    "op9_language_id": lambda spark, sf: language.op9(_documents(spark, sf)),
    "op10_decontamination": lambda spark, sf: decontaminate.op10(
        _documents(spark, sf), _table(spark, sf, "benchmark")),
    "op11_whitening": lambda spark, sf: whitening.op11(_table(spark, sf, "embeddings")),
    "op12_quality_rules": lambda spark, sf: quality_rules.op12(_documents(spark, sf)),
    "op13_filter_audit": lambda spark, sf: filter_audit.op13(_documents(spark, sf), _table(spark, sf, "labels")),
}
ORACLES = {"op1_threshold_search": threshold_search.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
