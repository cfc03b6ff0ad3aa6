"""A corpus pipeline over the table documents: each stage works on all that its predecessor kept.

1 quality_rules: documents that the rules reject go. 2 ngram_join: one document of each group of near duplicates stays
(five-word shingles, similarity 0.8). 3 decontamination: documents with a benchmark passage go. 4 mixing: each document
becomes the words that the mix takes of it, once for each time they are taken; documents that the mix leaves out go.
5 sharding: every row gets its shard and slot.

Defined cases: rows are judged one by one, whatever their ids: rows without id, or with one that repeats, go through all
stages like others; equal rows are one from stage 2 on; documents without words go in stage 1; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm import decontamination, mixing, ngram_join, quality_rules, sharding

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, ngram_join.Rule(words=5, num=80, den=100)).select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).select(*COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out, names = sharding.assign(docs.select(*COLUMNS))
    return out.select(*COLUMNS, F.col(names["shard"]).alias("shard"), F.col(names["slot"]).alias("slot"))


STAGES: list[tuple[str, Stage]] = [("quality_rules", good), ("ngram_join", distinct), ("decontamination", clean), ("mixing", mixed), ("sharding", sharded)]
#: The mix draws by hashes that SQL doesn't have.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the shared folder."""
    from loomspar.llm._lineage import stage_folder

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = stage_folder(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
