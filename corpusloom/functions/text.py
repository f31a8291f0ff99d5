"""Column helpers for text: strip, normalise, keyword predicates, script and English-ness tests."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the white space that Python's str.strip removes, as a class that Java and RE2 both read.
WHITE_SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
STRIP_PATTERN = f"^{WHITE_SPACE}+|{WHITE_SPACE}+$"

#: Fixed value: any character outside U+0000-007F and U+00A0-024F.
NON_LATIN_PATTERN = r"[^\x00-\x7F\x{A0}-\x{24F}]"
NON_LATIN = re.compile("[^\x00-\x7f\xa0-ɏ]")

#: English function words that other Latin-script languages don't share.
ENGLISH_WORDS = ("the", "and", "of", "to", "is", "was", "are", "were", "that", "this", "with", "for", "from", "have", "has", "had", "been", "will", "would", "which", "their", "there", "they", "what", "when", "where", "about", "into", "than", "then", "these", "those", "them", "being", "should", "could", "after", "before", "through", "during", "between")
WORD_PATTERN = "[a-z']+"


def strip(c: Column) -> Column:
    """Without white space at either end; all of Unicode's, not only blanks."""
    return F.regexp_replace(c, STRIP_PATTERN, "")


def normalize_for_model(c: Column) -> Column:
    """What a classifier reads: null as empty, stripped, then newlines as blanks."""
    return F.replace(strip(F.coalesce(c.cast("string"), F.lit(""))), F.lit("\n"), F.lit(" "))


def literals(pattern: str) -> list[str] | None:
    """The alternatives of a pattern that is nothing but literals, or None."""
    parts = pattern.split("|")
    return parts if all(x and re.escape(x).replace("\\ ", " ") == x for x in parts) else None


def _apart(parts: list[str]) -> bool:
    """Whether no match of one alternative can overlap one of another, so that counts add up."""
    meets = lambda a, b: a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b))))
    return not any(meets(a, b) for i, a in enumerate(parts) for j, b in enumerate(parts) if i != j)


def count_matches(c: Column, pattern: str) -> Column:
    """How often a pattern matches. Literals are counted by their removal, a byte search without a regex."""
    parts = literals(pattern)
    if parts is None or not _apart(parts):
        return F.regexp_count(c, F.lit(pattern))
    each = [((F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))) / len(x)).cast("int") for x in parts]
    return reduce(lambda a, b: a + b, each)


def contains_any(c: Column, keywords) -> Column:
    """Whether the lower-cased text has any keyword, as a substring."""
    low = F.lower(c)
    if literals("|".join(keywords)) is None:
        return low.rlike("|".join(keywords))
    return reduce(lambda a, b: a | b, [low.contains(k) for k in keywords])


def has_non_latin(c: Column) -> Column:
    return c.rlike(NON_LATIN_PATTERN)


def has_english_word(c: Column) -> Column:
    words = F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), F.lit(0))
    return F.arrays_overlap(words, F.array(*(F.lit(w) for w in ENGLISH_WORDS)))
