"""The corpus pipeline: documents to a mixed, sharded training set.

Every stage is (spark, docs, sf_dir) -> DataFrame over all rows its predecessor
kept. All but the last return the columns of ``documents``; the last adds
``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import decontam, mixing, setjoin, sharding, toxicity
from vigil.llm.common import store, table

#: The stages are fitted models and iterations, which SQL does not express.
ORACLE_SQL = None
#: Near-duplicates share 0.8 of their five-word shingles (op10 has a rule of its own).
NEAR = setjoin.Rule(shingle=5, num=80, den=100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near-duplicates one row of the least doc_id stays. Rows
    go by doc_id and text, so that every component keeps a row. Rows without a
    doc_id cannot be named and stay."""
    return setjoin.drop_near_copies(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into 24 shards: the columns of documents, shard and slot."""
    return sharding.assign_shards(docs, docs.columns, shards=24)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", one_per_group), ("benchmark_decontamination", decontaminate),
          ("source_mixing", mix_sources), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name)
    return STAGES[-1][1](spark, docs, sf_dir)
