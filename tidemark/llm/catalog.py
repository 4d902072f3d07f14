"""The registered queries over the whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    audit, chat, codes, forest, linetree, minmax, nbest, packing, postings, pstable, pu, tagpaths, tokenfiles,
)
from tidemark.session import new_folder, store

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 1024 tokens, packed into sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed_documents(table(spark, sf_dir, "documents"), path, end_id=2, with_ids=False)


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links of all vectors within a label."""
    return forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return tagpaths.extracted(table(spark, sf_dir, "pages"))


def op4_chat_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted, stored and read back."""
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(store(chat.formatted(turns), "chat"))


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op6_multiprobe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one among all."""
    return pstable.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as files and indexed from what is read back."""
    path = new_folder(spark, "tokens")
    tokenfiles.write_tokens(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return tokenfiles.read_index(spark, path).drop("part")


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return pu.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of all documents, decoded again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return nbest.segmentations(table(spark, sf_dir, "documents"), path, with_ids=False)


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines whose templates recur across them."""
    return linetree.drop_recurring(table(spark, sf_dir, "documents"))


def op11_integer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as 16 entry numbers of codebooks fitted on all of them, with their errors."""
    return codes.coded_rows(table(spark, sf_dir, "embeddings"))


def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark windows of ten words."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return postings.contamination(docs, items, new_folder(spark, "postings")).drop("n_near")


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of all documents against each other and against their language."""
    return audit.divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_sum_of_squares_packing,
            op2_projection_forest,
            op3_tag_path_ratios,
            op4_chat_assembly,
            op5_minmax_dedup,
            op6_multiprobe_search,
            op7_token_files,
            op8_pu_quality,
            op9_nbest_pieces,
            op10_line_templates,
            op11_integer_codes,
            op12_positional_index,
            op13_source_audit,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op10_line_templates": linetree.SQL,
        "op11_integer_codes": codes.SQL,
        "op12_positional_index": postings.SQL,
        "op13_source_audit": audit.SQL,
    }
