"""Corpus pipeline: a raw corpus without toxic, poor and repeated documents, mixed and packed.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return documents with the columns they had. `run` writes each stage's result to the shared folder
and reads it back, so that a lost executor costs a stage at most.
"""

from __future__ import annotations

from navloom.llm import jaccard_join, mixing, packing, quality, queries, toxicity
from navloom.llm.shared import keep, read
from pyspark.sql import DataFrame, SparkSession


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.accepted(docs, model)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    model = quality.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.accepted(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    return jaccard_join.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """In the order of the mixture: packing concatenates documents as they lie in the table's files."""
    return mixing.in_order(mixing.mixture(docs, queries.TARGET)).select("record.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ship(spark)
    tokens = packing.tokenized(docs, queries.tokenizer_path())
    return queries.pieces_digest(packing.pieces(tokens))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("jaccard_join", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: The classifiers and the tokenizer cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
