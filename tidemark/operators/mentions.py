"""Term matching for dictionaries too large to be written into patterns.

Gives exactly what the strict patterns give: a term counts when it starts the text
or follows white space, ``#`` or ``@``, in any ASCII case. One automaton over all terms
reads a text once, whatever the number of terms and entities; it is built in the tasks
from a broadcast of the terms, whose size is checked. A dictionary beyond that size is
joined: what follows each place where a term may begin is cut to the lengths that terms
have, and an equi-join finds the terms among these openings.
"""

from __future__ import annotations

import string
import sys
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.session import explode_words, spare_names, store
from tidemark.sources.readers import GENERAL, select_party

# the automaton travels to the workers with its code, so they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUT = r"[\s#@]"
CUTS = frozenset(" \t\n\x0b\f\r#@")
MAX_TERM_CHARS = 4_000_000  # of a dictionary that is broadcast; an automaton takes some fifty bytes for each
GRAM = 4


def _ascii_lower(text: Column) -> Column:
    """Lower case as the patterns see it: ASCII letters only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


# ---------------------------------------------------------------- automaton


def automaton_of(terms: list[tuple[str, list[int]]]) -> ahocorasick.Automaton | None:
    """All terms in one automaton, each with its length and the numbers of its entities; None without terms."""
    found = ahocorasick.Automaton()
    for term, entities in terms:
        found.add_word(term, (len(term), entities))
    if not terms:
        return None
    found.make_automaton()
    return found


def entities_in(text: str, automaton: ahocorasick.Automaton | None, always: set[int]) -> set[int]:
    """Numbers of the entities that a lower-cased text mentions; ``always`` are those with an empty term."""
    found = set(always)
    if automaton is not None:
        for end, (length, entities) in automaton.iter(text):
            start = end - length
            if start < 0 or text[start] in CUTS:
                found.update(entities)
    return found


def finder(terms: DataFrame) -> Callable[[Column], Column] | None:
    """A function from a text column to the array of mentioned entities, in dictionary order.

    ``terms`` has ``entity``, ``entity_pos`` and ``term``. None when the dictionary is
    too large to be sent to every task. A null text mentions nothing.
    """
    size = terms.agg(F.sum(F.length("term") + 1)).first()[0] or 0
    if size > MAX_TERM_CHARS:
        return None
    lowered = terms.select(_ascii_lower(F.col("term")).alias("term"), F.struct("entity_pos", "entity").alias("e"))
    rows = lowered.groupBy("term").agg(F.collect_set("e").alias("entities")).collect()
    names = sorted({(e.entity_pos, e.entity) for r in rows for e in r.entities})
    number = {name: i for i, name in enumerate(names)}
    words = [(r.term, [number[e.entity_pos, e.entity] for e in r.entities]) for r in rows]
    sent = terms.sparkSession.sparkContext.broadcast((words, [entity for _, entity in names]))
    built: list = []

    def mentioned(texts: pa.Array) -> pa.Array:
        words, names = sent.value
        if not built:  # once a task
            always = {e for term, entities in words if not term for e in entities}
            built.append((automaton_of([w for w in words if w[0]]), always))
        found = [
            [] if text is None else [names[i] for i in sorted(entities_in(text, *built[0]))]
            for text in pc.ascii_lower(texts).to_pylist()
        ]
        return pa.array(found, pa.list_(pa.string()))

    mentioned.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(mentioned, "array<string>")


# ---------------------------------------------------------------- join


def _heads(text: Column, longest: int) -> Column:
    """The first characters, ``longest`` at most, of what follows each place where a term may begin."""
    heads = F.regexp_extract_all(text, F.lit(f"(?s){CUT}(?=(.{{0,{longest}}}))"), F.lit(1))
    return F.array_distinct(F.array_append(heads, F.substring(text, F.lit(1), F.lit(longest))))


def term_mentions(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """Distinct ``(key, entity, entity_pos)`` of the terms each ``text`` mentions; ``texts`` has ``key`` and ``text``.

    Texts send the openings of their words, not themselves. The dictionary side has
    one row per term; Spark broadcasts it or splits frequent openings as needed. Only
    the term lengths reach the driver, one number each.
    """
    keyed = terms.select("entity", "entity_pos", _ascii_lower(F.col("term")).alias("opening")).distinct()
    sizes = sorted(r.n for r in keyed.select(F.length("opening").alias("n")).distinct().collect())
    lowered = texts.filter(F.col("text").isNotNull()).select("key", _ascii_lower(F.col("text")).alias("text"))
    if not sizes:
        return lowered.select("key", F.lit("").alias("entity"), F.lit(0).alias("entity_pos")).limit(0)
    heads = explode_words(lowered, ["key"], _heads(F.col("text"), sizes[-1]), name="head")
    # cut row by row: inside a lambda over the sizes, a text would be searched again for each of them
    cut = F.array(*[F.when(F.length("head") >= n, F.substring("head", 1, n)) for n in sizes])
    openings = explode_words(heads, ["key"], cut, name="opening")
    return openings.join(keyed, "opening").select("key", "entity", "entity_pos").distinct()


def entity_patterns(terms: DataFrame, mode: str) -> Column:
    """One pattern per entity of a dictionary, in dictionary order, as a single array value.

    The array is worked out by Spark as a scalar subquery; the driver sees no terms.
    """
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("term_pos", "term"))), lambda t: t["term"])
    by_entity = terms.groupBy("entity_pos", "entity").agg(tx.terms_pattern(ordered, mode).alias("pattern"))
    rows = F.sort_array(F.collect_list(F.struct("entity_pos", "entity", "pattern")))
    return by_entity.agg(rows.alias("patterns")).scalar()


def with_hits(posts: DataFrame, text: Column, terms: DataFrame, mode: str, name: str) -> DataFrame:
    """Posts with the entities whose pattern ``text`` matches, in dictionary order, as ``name``."""
    hits = F.filter(name, lambda entry: F.coalesce(F.rlike(text, entry["pattern"]), F.lit(False)))
    return posts.withColumn(name, entity_patterns(terms, mode)).withColumn(name, hits)


def tag_entities_joined(posts: DataFrame, terms: DataFrame, party: str | None = None, text: Column | None = None) -> DataFrame:
    """``search_terms`` of posts by join, on a hash of the text (or of ``text``); else ``['general']``."""
    key, hits = spare_names(posts, "_text_key", "_hits")
    keyed = posts.withColumn(key, F.sha2(F.col("text") if text is None else text, 256))
    texts = keyed.select(F.col(key).alias("key"), (F.col("text") if text is None else text).alias("text"))
    found = term_mentions(texts, select_party(terms, party)).groupBy(F.col("key").alias(key)).agg(
        F.sort_array(F.collect_set(F.struct("entity_pos", "entity"))).alias(hits)
    )
    named = F.coalesce(F.col(f"{hits}.entity"), F.array(F.lit(GENERAL)))
    return keyed.join(found, key, "left").select(*posts.columns, named.alias("search_terms"))


def mentioning(posts: DataFrame, terms: DataFrame) -> DataFrame:
    """Posts that mention any term of the dictionary, by join."""
    (key,) = spare_names(posts, "_text_key")
    keyed = posts.withColumn(key, F.sha2("text", 256))
    found = term_mentions(keyed.select(F.col(key).alias("key"), "text"), terms)
    return keyed.join(found.select(F.col("key").alias(key)).distinct(), key, "left_semi").select(posts.columns)


# ---------------------------------------------------------------- terms inside words


def grams(text: Column, size: Column | int) -> Column:
    """All runs of ``size`` characters of a text, none when it is shorter; the empty one for size 0."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.when(size == 0, F.lit(1)).otherwise(F.length(text) - size + 1)))
    runs = F.transform(starts, lambda at: F.substring(text, at, size))
    return F.array_distinct(F.coalesce(runs, F.array().cast("array<string>")))


def term_index(terms: DataFrame) -> DataFrame:
    """``terms`` with ``gram``: of a term's runs of ``GRAM`` characters the one that fewest terms have.

    A shorter term is its own. ``terms`` has a column ``term``.
    """
    runs = terms.select("term").distinct().select("term", F.explode(grams(F.col("term"), F.least(F.length("term"), F.lit(GRAM)))).alias("gram"))
    shared = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    rarest = runs.join(shared, "gram").groupBy("term").agg(F.min(F.struct("held", "gram")).alias("best"))
    return terms.join(rarest.select("term", F.col("best.gram").alias("gram")), "term")


def words_holding(words: DataFrame, terms: DataFrame) -> DataFrame:
    """``(word, term, ...)`` for every term that is part of a word, with all columns of ``terms``.

    Words meet terms through one run of characters each term was filed under, and only
    such pairs are compared. ``words`` has one column ``word``.
    """
    indexed = store(term_index(terms), "term-index")
    sizes = sorted(r.n for r in indexed.select(F.length("gram").alias("n")).distinct().collect())
    runs = F.array_distinct(F.flatten(F.array(*[grams(F.col("word"), n) for n in sizes]))) if sizes else F.array().cast("array<string>")
    cut = explode_words(words, ["word"], runs, name="gram")
    return cut.join(indexed, "gram").filter(F.contains("word", F.col("term"))).drop("gram")
