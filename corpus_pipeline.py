"""The corpus pipeline: documents through five filters and edits, each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, lines, minhash, queries, toxicity
from tidemark.llm.common import shared_folder


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(docs)


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contamination(docs, benchmark)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.pieces_and_back(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", lines_out),
    ("near dedup", copies_out),
    ("decontamination", benchmark_out),
    ("pieces", to_pieces),
]

# Compression, MinHash and tokenizing are not SQL: a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
