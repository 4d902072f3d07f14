"""Which sources of a language write differently, and with which words.

Words are counted per language and source, and a word's smoothed share in a group depends
on its count alone. The words of a group therefore fall into cells, one per pair of its
count there and its count in the language; the divergence is worked out once per cell,
cells of equal divergence are merged and ranked by how many words they hold, and only the
cells that reach the report are opened into words, in the order of their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices, utf8_view
from tidemark.llm.words import bytes_in_words, words_of
from tidemark.session import store

DOCUMENTS = 30
TOP = 50
SMOOTHING = 5
SHARE = 1_000_000_000
SLICE = 4 << 20
CELLS = 1 << 15
MOST_CELLS = 1 << 22
WORD_BYTES = bytes_in_words((0x41, 0x5A), (0x61, 0x7A))


def counted(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` of every term in every (``lang``, ``source``), and the documents ``docs`` with it.

    Terms are runs of letters and all characters beyond ASCII, A-Z lowered, in whole
    texts; a null text, language or source counts as empty. A task adds up its own texts
    first, so a frequent term or source costs each task one row per slice of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words, begins = words_of(*utf8_view(batch.column("text")), WORD_BYTES)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            size = len(coded.dictionary)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(begins))
            pairs, times = np.unique(doc * size + np.asarray(coded.indices), return_counts=True)
            group = _groups(batch)
            keys, where = np.unique(group[pairs // size] * size + pairs % size, return_inverse=True)
            in_docs = np.bincount(where)
            total = np.zeros(len(keys), dtype=np.int64)
            np.add.at(total, where, times)
            _, first = np.unique(group, return_index=True)
            of = pa.array(first[keys // size])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang").take(of),
                    batch.column("source").take(of),
                    coded.dictionary.take(pa.array(keys % size)),
                    pa.array(total),
                    pa.array(in_docs.astype(np.int64)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    texts = docs.select(*_group_columns(), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _group_columns() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def _groups(batch: pa.RecordBatch) -> np.ndarray:
    """A number per row, from 0, equal where language and source are."""
    codes = [np.asarray(batch.column(c).dictionary_encode().indices, dtype=np.int64) for c in ("lang", "source")]
    return np.unique(codes[0] * (codes[1].max() + 1) + codes[1], return_inverse=True)[1]


def kept_terms(counts: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """Terms in at least ``documents`` documents of their language: ``lang``, ``term``, ``total`` and ``sources``.

    ``sources`` lists (source, n) where the term occurs.
    """
    return (
        counts.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("sources"),
        )
        .filter(F.col("docs") >= documents)
        .drop("docs")
    )


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (``lang``, ``source``) of the documents with ``base``: kept occurrences and smoothing together.

    The language itself has ``lang_base``, and ``terms`` counts its kept terms; a group
    or language without kept terms has its smoothing alone.
    """
    groups = docs.select(*_group_columns()).distinct()
    inside = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source"))
    sums = inside.agg(F.sum("s.n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("total"))
    whole = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "terms", "total"])
    smoothing = F.col("terms") * SMOOTHING
    return whole.select(
        "lang", "source", "terms", (F.col("n") + smoothing).alias("base"), (F.col("total") + smoothing).alias("lang_base")
    )


def share(count: str, base: str) -> Column:
    """1 + floor(10**9 * (count + 5) / base) of two columns, exactly."""
    above = f"cast({count} + {SMOOTHING} as decimal(27,0)) * cast({SHARE} as decimal(10,0))"
    return F.expr(f"1 + cast(({above}) div cast(nullif({base}, 0) as decimal(20,0)) as long)")


def term_ranks(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` terms of each group by how far their share lies above the language's: ``lang``, ``source``, ``item``, ``value``, ``rank``.

    Only terms that occur in the group and are more frequent there take part. Ties go to
    the smaller term. Cells are ranked by their divergence with the number of their terms
    added up; a cell is opened when fewer than ``top`` terms lie in the cells above it.
    """
    places = kept.select("lang", F.explode("sources").alias("s"), "term", "total")
    places = places.select("lang", "s.source", "term", "s.n", "total")
    cells = places.groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("held"))
    valued = cells.join(groups, ["lang", "source"]).withColumn("value", share("n", "base") - share("total", "lang_base"))
    cells = store(valued.filter("value > 0").select("lang", "source", "n", "total", "held", "value"), "cells")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("held").alias("held"))
    highest = merged.withColumn("_nth", F.row_number().over(by_value)).filter(F.col("_nth") <= top)
    above = F.coalesce(F.sum("held").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = highest.withColumn("_above", above).filter(F.col("_above") < top).select("lang", "source", "value")
    opened = store(cells.join(reached, ["lang", "source", "value"]).drop("held"), "opened")
    terms = places.join(opened, ["lang", "source", "n", "total"]).withColumnRenamed("term", "item")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return terms.select("lang", "source", "item", "value", F.row_number().over(order).alias("rank")).filter(
        F.col("rank") <= top
    )


def _shares(n: np.ndarray, base: np.ndarray) -> np.ndarray:
    """As ``share``; Python integers stand in where the product could pass 64 bits."""
    if len(n) and int(n.max()) + SMOOTHING > ((1 << 63) - 1) // SHARE:
        n, base = n.astype(object), base.astype(object)
    return ((n + SMOOTHING) * SHARE // base + 1).astype(np.int64)


def _differences(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of absolute differences of shares over some terms, for any two sources of one language."""
    groups = groups.combine_chunks().sort_by("source")
    names = groups.column("source").combine_chunks()
    base = np.asarray(groups.column("base"), dtype=np.int64)
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    if len(terms):
        lists = terms.column("sources").combine_chunks()
        inside = lists.flatten()
        row = np.repeat(np.arange(len(terms)), np.asarray(pc.list_value_length(lists)))
        of = np.asarray(pc.index_in(inside.field("source"), value_set=names), dtype=np.int64)
        shares = np.tile(_shares(np.zeros(len(names), np.int64), base), (len(terms), 1))
        shares[row, of] = _shares(np.asarray(inside.field("n"), dtype=np.int64), base[of])
        for one in range(len(names)):
            sums[one] = np.abs(shares - shares[:, one : one + 1]).sum(axis=0)
    one, other = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = pa.array([groups.column("lang")[0].as_py()], pa.string()).take(pa.array(np.zeros(len(one), np.int64)))
    return pa.table(
        [lang, names.take(pa.array(one)), names.take(pa.array(other)), pa.array(sums[one, other])],
        names=["lang", "source", "item", "value"],
    )


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The divergence of any two sources of a language over all its kept terms: ``lang``, ``source``, ``item``, ``value``.

    The terms of a language are dealt by hash into chunks whose table of terms by sources
    has about ``CELLS`` cells, or, with many sources, as many as the pairs a chunk gives
    rise to, ``MOST_CELLS`` at most; chunks are added up. Without kept terms the value is 0.
    """
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("width"), F.max("terms").alias("terms"))
    room = F.greatest(F.lit(CELLS), F.least(F.col("width") * F.col("width"), F.lit(MOST_CELLS)))
    sizes = sizes.select("lang", F.ceil((F.col("terms") * F.col("width") + 1) / room).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")
    terms = kept.join(sizes, "lang").select("lang", chunk.alias("chunk"), "sources")
    chunks = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    beside = groups.join(sizes, "lang").select("lang", "source", "base", chunks)
    sums = terms.groupBy("lang", "chunk").cogroup(beside.groupBy("lang", "chunk"))
    parts = sums.applyInArrow(_differences, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """Sources of a language against each other and against the language.

    Part ``pair`` ranks the other sources by divergence, part ``term`` the ``top`` words
    that the source has more of. Every (``lang``, ``source``) of ``docs`` takes part, with
    null as ''; the only source of a language has no pair, and a group without terms none
    of its own. An empty table gives no rows. Each row of ``docs`` is a document.
    """
    kept = store(kept_terms(counted(docs), documents), "kept-terms")
    groups = store(group_totals(docs, kept), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(kept, groups).withColumn("rank", F.row_number().over(order))
    parts = [(pairs, "pair"), (term_ranks(kept, groups, top), "term")]
    columns = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for df, part in parts]
    return columns[0].unionByName(columns[1])


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM docs),
tokens AS (SELECT rid, lang, source, unnest(w) AS term FROM docs),
langs AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN langs USING (lang, term) GROUP BY ALL),
bases AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(n, 0) + 5 * coalesce(v, 0) AS base, coalesce(total, 0) + 5 * coalesce(v, 0) AS lang_base
  FROM groups g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS total FROM langs GROUP BY lang) USING (lang)
),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // base::HUGEINT AS p,
    1 + (1000000000 * (total + 5)::HUGEINT) // lang_base::HUGEINT AS q
  FROM langs JOIN bases USING (lang) LEFT JOIN counts USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""
