"""From raw documents to packed sequences, as stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import linetree, minmax, packing, pu
from tidemark.llm.names import spare
from tidemark.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

ORACLE_SQL = None
"""None: neither a fitted classifier nor a tokenizer can be said in SQL."""


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, unchanged; it is fitted on these documents and the labels."""
    return pu.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that recur; one that consisted of nothing else goes. ``n_chars`` is counted again."""
    cleaned = linetree.drop_recurring(docs)
    left = F.coalesce(F.col("text").rlike("\\S"), F.lit(False))
    return cleaned.filter((F.col("n_dropped") == 0) | left).select(
        *[F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else c for c in docs.columns]
    )


def one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, and all that have none.

    Texts that share an id are documents of their own: each stays or goes by what its own text resembles, once
    per text. A document without an id cannot be named as the copy of another and stays.
    """
    (mark,) = spare(docs, "_mark")
    gone = minmax.near_duplicates(docs).filter("not chosen").select("doc_id", F.col("mark").alias(mark)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit(""))))
    left = marked.join(gone.hint("shuffle_hash"), ["doc_id", mark], "left_anti")
    return left.dropDuplicates(["doc_id", mark]).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, with their ids and their places in sequences of 1024 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", fresh_lines),
    ("near-duplicates", one_of_a_kind),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
