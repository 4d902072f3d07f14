"""Documents to a long table of word instances."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import whitespace_words
from tidemark.session import explode_words, number_in_order, store

# Words left out of the topic model, as in the published runs.
STOPWORDS = [
    "@", "me", "my", "-", "the", "is", "it", "in", "just",
    "for", "was", "no", "when", "not", "that", "and", "take",
    "get", "i", "on", "of", "with", "at", "you", "all", "to",
    "i'm", "a", "don't", "are", "back", "be", "up", "go",
    "from", "about", "this", "do", "out", "have",
    "so", "will", "like", "&amp;", "but", "",
]
SERIAL_STOPWORDS = [*STOPWORDS[:-1], "w\\/"]  # those of the serial sampler
MIN_DF = 5


def lda_words(docs: DataFrame, edge_trim: bool = False, lower: bool = True) -> DataFrame:
    """``(doc_id, words)``: the white-space separated words of every document, in order.

    ``edge_trim`` takes the first character off the first word and, in documents
    of several words, the last one off the last word (left-over quote marks).
    """
    text = F.lower("text") if lower else F.col("text")
    words = docs.select("doc_id", whitespace_words(text).alias("words"))
    if not edge_trim:
        return words
    last = F.size("words") - 1

    def trimmed(word: Column, place: Column) -> Column:
        inner = F.length(word) - 1
        return (
            F.when(place == 0, F.substring(word, F.lit(2), F.length(word)))
            .when(place == last, F.substring(word, F.lit(1), inner))
            .otherwise(word)
        )

    return words.withColumn("words", F.transform("words", trimmed))


def lda_tokens(docs: DataFrame, edge_trim: bool = False, lower: bool = True) -> DataFrame:
    """``(doc_id, pos, word)``, one row per word of every document."""
    return explode_words(lda_words(docs, edge_trim, lower), ["doc_id"], F.col("words"), "pos")


def vocabulary(words: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """``(word, doc_freq)`` of the words found in at least ``min_df`` documents.

    Takes one row per document. A document names each of its words once, so plain
    counting is enough: a task sends one partial count per word, and a word found
    in every document costs no more than a rare one.
    """
    return (
        explode_words(words, [], F.array_distinct("words"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("doc_freq"))
        .filter(F.col("doc_freq") >= min_df)
    )


def drop_stopwords(tokens: DataFrame, stopwords: list[str] | DataFrame = STOPWORDS) -> DataFrame:
    """Rows whose ``word`` is not in the stop list, given inline or as a table of words."""
    if isinstance(stopwords, DataFrame):
        return tokens.join(stopwords, "word", "left_anti")
    return tokens.filter(~F.col("word").isin(stopwords))


def numbered_vocabulary(
    words: DataFrame, min_df: int = MIN_DF, stopwords: list[str] | DataFrame = STOPWORDS
) -> DataFrame:
    """``(word, doc_freq, word_id)``: the kept words, numbered densely in alphabetical order.

    Stored, as the corpus, the model size and the word names all come from it.
    """
    kept = drop_stopwords(vocabulary(words, min_df), stopwords)
    return store(number_in_order(kept, [F.col("word")], "word_id"), "vocabulary")


def corpus_long(
    tokens: DataFrame, vocab: DataFrame, stopwords: list[str] | DataFrame = STOPWORDS
) -> DataFrame:
    """``(doc_id, pos, word_id, word)`` of every kept word instance.

    Stop words, the most frequent of all, leave before the join, where they would be
    hot keys without a partner.
    """
    kept = drop_stopwords(tokens, stopwords)
    return kept.join(vocab.select("word", "word_id"), "word").select("doc_id", "pos", "word_id", "word")


def word_instances(corpus: DataFrame, vocab: DataFrame) -> DataFrame:
    """Instances and documents per word."""
    instances = corpus.groupBy("word_id").agg(F.count(F.lit(1)).alias("instances"))
    return instances.join(vocab, "word_id").select(
        "word_id", "word", "instances", F.col("doc_freq").alias("docs")
    )


def assign_parts(corpus: DataFrame, parts: int, key: Column | None = None) -> DataFrame:
    """Add ``part``: the document id (or another key) modulo the number of parts.

    Parts are cut by document, never by entity, so that a dominant entity is
    spread over all of them.
    """
    return corpus.withColumn("part", F.pmod(F.col("doc_id") if key is None else key, F.lit(parts)).cast("int"))


def token_positions(tokens: DataFrame, target: str) -> DataFrame:
    """Positions of a word in every document."""
    return tokens.filter(F.col("word") == target).select("doc_id", "pos")


def substring_positions(docs: DataFrame, target: str) -> DataFrame:
    """Zero-based character offsets of every, also overlapping, occurrence of ``target``.

    The text is cut in front of each occurrence and the pieces' lengths are exploded in
    order; a piece starts where the lengths before it add up to, which a running sum per
    row of ``docs`` gives in one pass over them.
    """
    pieces = F.split("text", f"(?={re.escape(target)})", -1)
    lengths = F.transform(pieces, lambda piece: F.length(piece).cast("long"))
    found = docs.filter(F.contains("text", F.lit(target))).select(
        "doc_id", F.monotonically_increasing_id().alias("_row"), F.startswith("text", F.lit(target)).alias("_at_once"), lengths.alias("_lengths")
    )
    cuts = found.select("doc_id", "_row", "_at_once", F.posexplode("_lengths").alias("_nth", "_length"))
    before = Window.partitionBy("_row").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = cuts.withColumn("pos", F.coalesce(F.sum("_length").over(before), F.lit(0).cast("long")))
    return starts.filter(F.col("_at_once") | (F.col("_nth") > 0)).select("doc_id", "pos")
