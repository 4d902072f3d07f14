"""Text expressions: tokens, counts, patterns, markers."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as tx


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text STRING").select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Hello, World!", ["hello", "world"]),
        ("a---b--c''d", ["a", "b", "c", "d"]),
        ("don't #tag @me a/b x=1;", ["don't", "#tag", "@me", "a/b", "x=1;"]),
        ("----", ["-"]),
        ("-----", []),
        ("", []),
        ("...", []),
    ],
)
def test_word_tokens(spark, text, expected):
    assert one(spark, text, tx.word_tokens(F.col("text"))) == expected


@pytest.mark.parametrize("text, n", [("", 1), ("a b", 2), ("a  b ", 4), (" ", 2)])
def test_raw_word_count_is_taken_from_the_untouched_text(spark, text, n):
    assert one(spark, text, tx.raw_word_count(F.col("text"))) == n


def test_ascii_only(spark):
    assert one(spark, "naïve ☃ café 🎉!", tx.ascii_only(F.col("text"))) == "nave  caf !"


@pytest.mark.parametrize(
    "text, strict, compat",
    [
        ("bush wins", True, True),       # at the text start; the first term is unguarded in compat mode
        ("ambush wins", False, True),    # the unguarded first term matches inside a word
        ("jeb wins", True, False),       # a guarded term does not match at the text start in compat mode
        ("go #JEB!", True, True),
        ("hi @jebbush", True, True),
        ("xjeb", False, False),
        ("a.jeb", False, False),
        ("jebediah", True, False),       # nothing has to end the term
    ],
)
def test_pattern_modes(spark, text, strict, compat):
    terms = ["bush", "jeb"]
    assert one(spark, text, tx.matches_terms(F.col("text"), terms)) is strict
    assert one(spark, text, tx.matches_terms(F.col("text"), terms, "compat")) is compat


def test_strict_terms_are_literal(spark):
    assert one(spark, "cost $5.0 (x)", tx.matches_terms(F.col("text"), ["$5.0"])) is True
    assert one(spark, "cost $5x0", tx.matches_terms(F.col("text"), ["$5.0"])) is False
    with pytest.raises(ValueError):
        tx.term_pattern(["a"], "other")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAB #@.é\n", max_size=12), min_size=1, max_size=20))
def test_substring_test_never_changes_a_match(spark, texts):
    terms = ["ab", "B.a"]
    pattern = re.compile(r"(?:^|[\s#@])(?:ab|b\.a)", re.I | re.A)
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = [r.v for r in df.select(tx.matches_terms(F.col("text"), terms).alias("v")).collect()]
    assert got == [bool(pattern.search(t)) for t in texts]


def test_between_markers(spark):
    line = '{"tweet":"a, b","hashtags":"x,y,"}'
    assert one(spark, line, tx.between_markers(F.col("text"), '"tweet":', ',"hashtags"')) == '"a, b"'
    assert one(spark, line, tx.between_markers(F.col("text"), "missing", ",")) is None
    assert one(spark, line, tx.between_markers(F.col("text"), '"tweet":', "missing")) is None


def test_joined_with_trailing_comma(spark):
    assert one(spark, "a b", tx.joined_with_trailing_comma(F.split("text", " "))) == "a,b,"
    assert one(spark, "", tx.joined_with_trailing_comma(F.array().cast("array<string>"))) == ""


def test_labels(spark):
    ddate = F.col("text")
    assert one(spark, "2015_sep_16", tx.debate_label(ddate, F.lit("gop"))) == "Sep 16 2015 (GOP)"
    assert one(spark, "2015_sep_16", tx.chart_title(ddate, F.lit("gop"), "S")) == "S: Sep 16 2015 GOP debate"


def test_words_are_split_without_a_call_for_every_word(spark):
    df = spark.createDataFrame([("  a\tb\n\x0b c  ",), ("",), ("   ",), (None,), ("one",)], "text STRING")
    words = df.select(tx.whitespace_words(F.col("text")).alias("words"))
    assert [r.words for r in words.collect()] == [["a", "b", "c"], [], [], None, ["one"]]
    assert "lambda" not in words._jdf.queryExecution().optimizedPlan().toString()
