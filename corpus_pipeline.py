"""A corpus pipeline: clean, deduplicate, decontaminate, mix and shard documents.

``STAGES`` lists (name, function); each function takes the session, the documents
its predecessor kept (a stored table) and the folder of the other tables.  All
but the last return the columns of ``documents``; the last one returns the shard
and slot of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablestats.llm import decontamination, jaccard_join, mixing, sharding, toxicity
from tablestats.llm.common import table, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shared word shingles.

    Five-word shingles at a similarity of 0.8."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The stages fit a model, follow links and draw by hash: no SQL states them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
