"""Batch readers: archives, term dictionaries, lexicons, delimited documents, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import number_in_order, spread_out

GENERAL = "general"


def scan_archive(spark: SparkSession, path_glob: str, min_parts: int = 48) -> DataFrame:
    """Lines of (possibly gzipped) JSON-lines files as one ``value`` column.

    A gzip file is one task however large it is, so the lines of a few files are
    spread out right after the read, before any parsing. An archive that already
    reads in ``min_parts`` pieces is not shuffled.
    """
    return spread_out(spark.read.text(path_glob), min_parts)


def flatten_terms(dictionaries: DataFrame, value: str = "value") -> DataFrame:
    """Rows ``(party, entity, entity_pos, term, term_pos)`` of JSON term dictionaries.

    ``entity_pos`` follows the order in which the dictionary names the entities.
    General terms come out with party and entity ``general`` and position -1.
    """
    parsed = dictionaries.select(
        *[c for c in dictionaries.columns if c != value],
        F.from_json(value, schemas.TERM_DICTIONARY).alias("dict"),
    )
    rest = [c for c in parsed.columns if c != "dict"]

    def entity_rows(party: Column) -> Column:
        return F.transform(
            F.map_entries(party["value"]),
            lambda entity: F.struct(
                party["key"].alias("party"), entity["key"].alias("entity"), entity["value"].alias("terms")
            ),
        )

    entities = parsed.select(
        *rest, F.posexplode(F.flatten(F.transform(F.map_entries("dict.candidates"), entity_rows)))
    ).select(*rest, "col.party", "col.entity", F.col("pos").alias("entity_pos"), "col.terms")
    general = parsed.select(
        *rest,
        F.lit(GENERAL).alias("party"),
        F.lit(GENERAL).alias("entity"),
        F.lit(-1).alias("entity_pos"),
        F.col("dict.general").alias("terms"),
    )
    return entities.unionByName(general).select(
        *rest, "party", "entity", "entity_pos", F.posexplode("terms").alias("term_pos", "term")
    )


def load_terms(spark: SparkSession, path: str) -> DataFrame:
    """Term dimension of a JSON dictionary file (one dictionary per line)."""
    return flatten_terms(spark.read.text(path))


def select_party(terms: DataFrame, party: str | None) -> DataFrame:
    """Terms of one party, or of every party, without the general ones."""
    named = terms.filter(F.col("entity") != GENERAL)
    return named if party is None else named.filter(F.col("party") == party)


def pool_terms(terms: DataFrame) -> DataFrame:
    """Every term, general and of all parties, as a single ``term`` column."""
    return terms.select("term")


def load_lexicon(
    spark: SparkSession, path: str, stopval: float = 1.0, lo: float = 1.0, hi: float = 9.0
) -> DataFrame:
    """``(word, score)`` of a tab-separated word list with a header line.

    The first column is the word, the third its score. Words closer to the
    neutral 5 than ``stopval`` and words outside ``[lo, hi]`` are left out.
    Words are expected once each.
    """
    table = spark.read.csv(path, sep="\t", header=True, quote='"')
    word, _, score, *_ = table.columns
    return neutral_removed(
        table.select(F.col(word).alias("word"), F.col(score).try_cast("double").alias("score")),
        stopval, lo, hi,
    )


def neutral_removed(
    lexicon: DataFrame, stopval: float = 1.0, lo: float = 1.0, hi: float = 9.0
) -> DataFrame:
    score = F.col("score")
    return lexicon.filter((F.abs(score - 5.0) >= stopval) & (score >= lo) & (score <= hi))


def scan_csv_terms(spark: SparkSession, path: str, view: str = "term_table") -> DataFrame:
    """CSV with header and inferred types, also registered as a temporary view."""
    table = spark.read.csv(path, header=True, inferSchema=True)
    table.createOrReplaceTempView(view)
    return table


def scan_delimited_docs(
    spark: SparkSession, path: str, sep: str = "&&&&&", trim: bool = True
) -> DataFrame:
    """Documents separated by a marker string, numbered densely in file order.

    Every document ends with the separator, also a blank one. What follows a file's
    last separator is no document: the last piece of a file is dropped where it is
    blank. ``trim`` takes one character off the end.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    pieces = spark.read.text(path, lineSep=sep).select(*place, F.monotonically_increasing_id().alias("row"), "value")
    blank = F.trim("value", F.lit(" \r\n\t")) == ""
    ends = pieces.select("file", "block", "row").groupBy("file").agg(F.max(F.struct("block", "row")).alias("end"))
    tail = (F.col("block") == F.col("end.block")) & (F.col("row") == F.col("end.row"))
    docs = pieces.join(ends, "file").filter(~(tail & blank)).drop("end")
    text = F.expr("substring(value, 1, length(value) - 1)") if trim else F.col("value")
    order = [F.col("file"), F.col("block"), F.col("row")]
    return number_in_order(docs, order, "doc_id").select("doc_id", text.alias("text"))


def scan_reduced(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Hourly reduced-post files as one frame with the five analysis columns."""
    return spark.read.schema(schemas.REDUCED_POST).json(paths)


def scan_results(spark: SparkSession, path: str) -> DataFrame:
    """The stored result items, all pages of them."""
    return spark.read.parquet(path)
