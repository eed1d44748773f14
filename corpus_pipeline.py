"""The corpus pipeline: rules, near-duplicates, secrets, mixing and packing, each stage written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusmill.llm.common import cut, table
from locusmill.llm.mixing import mixed
from locusmill.llm.packing import packed
from locusmill.llm.quality import quality
from locusmill.llm.secrets import redact
from locusmill.llm.shingles import similar
from locusmill.llm.simhash import representatives


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality(docs, keep_text=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of those that share four fifths of their five-word shingles, found by SimHash pivots and MinHash bands."""
    return representatives(docs, similar)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind."""
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, so that the sources come near their targets."""
    return mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("mix sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]
#: The stages use fingerprints, random ranks and a tokenizer, which SQL cannot express; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
