"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns the documents that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.steps import delete, new_folder, scratch
from .exact_dedup import drop_copies
from .mixing import apply_mix
from .near_dup import drop_near_duplicates
from .packing import pack
from .quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Nulls, empty and long texts, repeated rows, empty tables and further
    columns: see keep_good."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text. Nulls, empty and long texts, ties, repeated rows, empty tables and further columns: see drop_copies."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates. Odd rows and ties: see drop_near_duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none at all included. Odd rows and ties: see apply_mix."""
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences, a row a piece. Odd rows and ties: see pack."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's result is written to the shared checkpoint folder and read again, so a
    stage starts from files, and a lost executor repeats at most its own stage's tasks. What a stage has read is deleted when
    its result is written, and all checkpoints when the last one is.

    Null and empty texts, long ones, ties, repeated rows and further columns fare as each stage's operator says; an empty
    table of documents gives an empty result."""
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):  # checkpoints of the stages
        for i, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
            if i:
                delete(spark, f"{folder}/{i - 1}")
    return docs
