"""Corpus pipeline over ``documents``: quality, near duplicates, benchmark text, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's docs; all but the last return the columns of
``documents``. Part of the training-data subpackage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.bpe import encode
from tripcraft.llm.common import importable, write_table
from tripcraft.llm.decontaminate import clean
from tripcraft.llm.jaccard_join import one_of_each
from tripcraft.llm.queries import BYTE_RANKS, RANK_PATTERN, WORD_BPE
from tripcraft.llm.resampling import Sampler
from tripcraft.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the importance sample stay; the others go."""
    importable(spark)
    return Sampler(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each Jaccard component stays."""
    importable(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold text of the benchmark go."""
    importable(spark)
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    importable(spark)
    return redact_secrets(docs, BYTE_RANKS, RANK_PATTERN).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded text."""
    importable(spark)
    return encode(docs, WORD_BPE)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]

#: No SQL form: n-gram models, alignment and tokenizer merges. Tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
