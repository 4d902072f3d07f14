"""Text clean-up, tokenising and the guarded term patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokenizer and the strings blanked before it must equal the
# published word-happiness scorer's for equal scores.
TOKEN_PATTERN = r"[\w\@\#\'\&\]\*\-\/\[\=\;]+"
BLANKED = ["---", "--", "''"]

# Fixed value: what may stand in front of a term inside a post.
GUARD = r"(\s|#|@)"


def ascii_only(col: Column) -> Column:
    """Drop every character outside ASCII."""
    return F.regexp_replace(col, r"[^\x00-\x7F]", "")


def word_tokens(text: Column) -> Column:
    """Lower-case tokens of an ASCII text, in order, as an array."""
    for mark in BLANKED:
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def raw_word_count(text: Column) -> Column:
    """Pieces between single spaces of the untouched text; an empty text counts one."""
    return F.size(F.split(text, " ", -1)).cast("long")


def whitespace_words(text: Column) -> Column:
    """Words between runs of white space, without empty ones."""
    return F.array_remove(F.split(text, r"\s+"), "")  # a filter would call back for every word


def term_pattern(terms: list[str], mode: str = "strict") -> str:
    """One case-insensitive alternation for a list of terms.

    ``strict``: every term is literal and must start the text or follow white
    space, ``#`` or ``@``. ``compat``: terms are regular expressions, the first
    one matches anywhere and the others need the guard, even at the text start.
    """
    if not terms:
        return "$^"
    if mode == "strict":
        return r"(?i)(^|[\s#@])(" + "|".join(re.escape(t) for t in terms) + ")"
    if mode == "compat":
        return "(?i)" + ("|" + GUARD).join(terms)
    raise ValueError(f"unknown pattern mode {mode!r}")


def terms_pattern(terms: Column, mode: str = "strict") -> Column:
    """``term_pattern`` of a non-empty array column of terms."""
    if mode == "strict":
        literal = F.transform(terms, lambda t: F.regexp_replace(t, r"([^A-Za-z0-9_\x80-\x{10FFFF}])", r"\\$1"))
        return F.concat(F.lit(r"(?i)(^|[\s#@])("), F.array_join(literal, "|"), F.lit(")"))
    if mode == "compat":
        return F.concat(F.lit("(?i)"), F.array_join(terms, "|" + GUARD))
    raise ValueError(f"unknown pattern mode {mode!r}")


def matches_terms(text: Column, terms: list[str], mode: str = "strict") -> Column:
    """True where the text holds at least one of the terms.

    For literal ASCII terms a plain substring test on the lower-cased text goes
    first: it is a necessary condition and spares most texts the regex engine.
    """
    matched = text.rlike(term_pattern(terms, mode))
    if mode == "strict" and terms and all(t.isascii() for t in terms):
        lowered = F.lower(text)
        possible = F.contains(lowered, F.lit(terms[0].lower()))
        for term in terms[1:]:
            possible = possible | F.contains(lowered, F.lit(term.lower()))
        return possible & matched
    return matched


def hashtag_texts(hashtags: Column) -> Column:
    return F.transform(hashtags, lambda tag: tag["text"])


def joined_with_trailing_comma(items: Column) -> Column:
    """``a,b,`` for ``[a, b]`` and an empty string for an empty array."""
    return F.array_join(F.transform(items, lambda i: F.concat(i, F.lit(","))), "")


def between_markers(text: Column, start: str, end: str) -> Column:
    """Text between the first ``start`` marker and the first ``end`` marker after it.

    Null when either marker is missing.
    """
    at = F.instr(text, start)
    rest = F.substring(text, at + F.lit(len(start)), F.length(text))
    stop = F.instr(rest, end)
    return F.when((at > 0) & (stop > 0), F.substring(rest, F.lit(1), stop - 1))


def title_case(text: Column) -> Column:
    return F.initcap(text)


def debate_label(ddate: Column, party: Column) -> Column:
    """``Sep 16 2015 (GOP)`` from ``2015_sep_16`` and ``gop``."""
    piece = F.split(ddate, "_")
    return F.format_string(
        "%s %s %s (%s)", title_case(F.get(piece, F.lit(1))), F.get(piece, F.lit(2)),
        F.get(piece, F.lit(0)), F.upper(party),
    )


def chart_title(ddate: Column, party: Column, subject: str) -> Column:
    """``<subject>: Sep 16 2015 GOP debate``."""
    piece = F.split(ddate, "_")
    return F.format_string(
        "%s: %s %s %s %s debate", F.lit(subject), title_case(F.get(piece, F.lit(1))),
        F.get(piece, F.lit(2)), F.get(piece, F.lit(0)), F.upper(party),
    )
