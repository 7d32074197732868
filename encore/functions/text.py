"""Text expressions. Patterns use Java's Unicode classes so white space and digits follow the
wide definition; ``.`` is limited to one line by the UNIX_LINES flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from encore.config import ASCII_PUNCTUATION, CORPUS_STOP_WORDS

# White space including the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"
# A character that isn't white space.
_NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"
# Digits including super- and subscript forms.
_ALL_DIGITS = r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$"
# Where a text breaks into lines.
_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]"


def strip_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def match_key(text: Column) -> Column:
    """Lower case, no ASCII punctuation, single spaces: the key artists and titles match on."""
    bare = F.translate(F.lower(text), ASCII_PUNCTUATION, "")
    return F.trim(F.regexp_replace(bare, f"(?U){_SPACE}+", " "))


def clean_text(text: Column) -> Column:
    """Drop bracketed headers and the usual scraping leftovers (patterns are fixed values)."""
    for pattern in (
        r"(?d)\[.*?\]",
        r"(?idU)\d+\s+Contributors?.*",
        r"(?idU)You might also like.*",
        r"(?idU)Embed\s*$",
    ):
        text = F.regexp_replace(text, pattern, " ")
    return strip_whitespace(text)


def word_list(text: Column, stop_words: Sequence[str] = CORPUS_STOP_WORDS) -> Column:
    """Words of a text without stop words, single characters and pure numbers."""
    bare = F.translate(F.lower(text), ASCII_PUNCTUATION, "")
    raw = F.split(bare, f"(?U){_SPACE}+")
    stops = sorted({w for w in stop_words if len(w) > 1})
    # No digit lies between `a` and `z`: most words need no pattern.
    return F.filter(
        raw,
        lambda w: (F.length(w) > 1)
        & ~w.isin(stops)
        & (((w >= "a") & (w < "{")) | ~w.rlike(_ALL_DIGITS)),
    )


def adjacent_pairs(words: Column) -> Column:
    """``[a, b, c]`` -> ``["a b", "b c"]``."""
    size = F.size(words)
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(size - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(size - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(size > 1, pairs).otherwise(F.array().cast("array<string>"))


def flip_the(name: Column) -> Column:
    """``the x`` -> ``x`` and ``x`` -> ``the x``."""
    return F.when(name.startswith("the "), F.substring(name, 5, 1 << 30)).otherwise(
        F.concat(F.lit("the "), name)
    )


def sorted_words(text: Column) -> Column:
    """Words of a normalised text in byte order, joined by one space."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    return F.array_join(F.sort_array(words), " ")


def non_blank_lines(text: Column) -> Column:
    return F.filter(F.split(text, _LINE_BREAK), lambda line: line.rlike(_NOT_SPACE))
