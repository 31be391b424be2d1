"""From documents to training shards, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept
and, but for the last, returns the columns of ``docs``. In ``run`` the stages
are chained through checkpoints in the shared folder, since each reads its
input more than once.

Extra columns, also those whose names clash, pass through all stages. Null,
blank and letterless texts go in the first stage; should a later one be given
such texts, near-dedup and decontamination keep them, the mix takes no words
of them and sharding places them. Rows that repeat are one group in
near-dedup, of which one row stays; in the other stages each counts on its
own. Ties are broken by id, and of rows that agree in id and text any one may
stand for the other. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontamination, language_id, mixing, near_dedup, sharding
from tidewatch.llm.common import cut, read


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go."""
    return language_id.keep_identified(docs, language_id.language_model(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the least id stays; rows go by id and text, so an id's other texts stay."""
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go; a null text holds none."""
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes their words."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix with its shard and its slot there."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: The stages are not expressible in SQL; tests/llm/test_pipeline.py holds each against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
