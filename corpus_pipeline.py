"""From raw documents to packed sequences: quality, line dedup, near duplicates, mixing, packing."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from portrisk.llm import jaccard, line_dedup, mixing, packing, quality  # noqa: E402
from portrisk.llm.queries import table, tokenizer_path  # noqa: E402
from portrisk.session import new_folder  # noqa: E402

# classifiers and packing have no SQL form; tests hold the operators against brute force
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rating is probably below "sound" go."""
    return quality.keep_good(docs, quality.graded(table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts, and documents with nothing else left go too."""
    left = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_deleted") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return left.where(~emptied).withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more on five-word shingles, the first stays."""
    return jaccard.keep_first(docs, k=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target weight asks, up to three times."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack_words(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
