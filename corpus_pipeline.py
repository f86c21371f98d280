"""Corpus pipeline: the documents through five stages, each written as Parquet and read again.

1. toxicity: documents that the weakly supervised classifier rejects go;
2. MinHash near-dedup: the document of least id stays of each group;
3. benchmark decontamination: documents that hold a benchmark item go;
4. mixing: every document is repeated as often as the mix takes it (0 to 2 times);
5. sharding: a shard for every row.

All stages but the last return the columns of their input. Null ids and texts
pass as the operators define; an empty table passes through as empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import decontaminate, mixing, near_dup, sharding, toxicity
from ledgerwatch.llm.queries import SHARDS, table
from ledgerwatch.llm.spread import shared_folder
from ledgerwatch.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept_documents(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, [1.0] * SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

ORACLE_SQL = None  # a fitted classifier and word-set similarity are not expressible; tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; intermediate tables go to the shared folder."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
