"""A training corpus from ``documents``: filter, deduplicate, decontaminate, mix, tokenize.

Every stage takes the documents that the stage before it kept and returns those it keeps; the last
returns the token counts and checksums of the packed files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, packed, quality, simhash
from tidemark.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token files; a row per document read back from them."""
    return packed.read_packed(packed.write_packed(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("token ids", token_ids),
]

#: SQL has no XXH64 fingerprints and no tokenizer; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
