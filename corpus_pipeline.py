"""From raw documents to shards: toxicity, near duplicates, benchmark passages, the mix of sources, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. The first three drop rows, the fourth repeats some, and the last assigns rows to shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterfold.llm import op2_shard, op4_mix, op5_toxicity, op7_jaccard, op9_decontaminate
from quarterfold.llm.common import table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The classifier learns from the labels of documents that are there."""
    return op5_toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 of five-word shingles the document with the smallest doc_id stays."""
    return op7_jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return op9_decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; those of small sources are repeated, none more than twice."""
    return op4_mix.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row of the mix gets a shard of about equal bytes and a slot in it."""
    return op2_shard.shard(docs)


STAGES = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]

# Toxicity is a trained classifier, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
