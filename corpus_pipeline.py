"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and, but for the
last, returns the columns of documents.  ``run`` writes each stage's result as Parquet and reads it
again for the next; a stage's intermediate data and its input go when its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.llm import decontam, packing, quality, secrets, simhash
from casemill.llm.common import MADE, discard, written
from casemill.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that are common on a host are cut from the others."""
    return quality.apply_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays."""
    return simhash.drop_near_copies(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return secrets.redact_secrets(docs, vocabulary=tokenizer_path("byte_bpe_50k.tiktoken"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' ids and their places in sequences of 2048."""
    return packing.pack(docs, tokenizer=tokenizer_path("byte_bpe_50k.json"), size=2048, end_id=0).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SimHash, tiktoken and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        before = set(MADE)
        docs = written(stage(spark, docs, sf_dir), name)
        result = MADE[-1]  # where written() has put it
        discard(spark, [p for p in MADE if p not in before and p != result] + last)
        last = [result]
    return docs
