"""Repetition rules from a suffix array over the words of each text.

Many texts share one suffix array: a word's symbol is (text, word), so no repeat crosses texts. The array
is built by prefix doubling that goes on only with suffixes that are still tied; the ranks of each round
give the longest common prefix of neighbours. A suffix that begins with a repeat of ``m`` words (the
larger of its two neighbouring LCPs, i.e. the deepest LCP interval that holds it) covers ``m`` words; the
union of these spans is the union of all maximal repeated substrings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common

#: Fewest words of a repeat that counts for the verdict.
MIN_REPEAT = 8
#: Most of a text's words that repeats may cover.
MAX_FRACTION = 0.3
#: Most words of a text's longest repeat.
MAX_LONGEST = 100

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, longest_repeat long, covered_words long, covered_fraction double, base_failed boolean, kept boolean"


def repeat_lengths(symbols: np.ndarray, doc: np.ndarray, doc_end: np.ndarray) -> np.ndarray:
    """For each word, how many words of its text from there on are found elsewhere in the text too.

    symbols: equal for equal words of one text, different across texts. doc: each word's text, ascending.
    doc_end: where each text's words end.
    """
    n = len(symbols)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    head = np.empty(n, bool)
    head[0], head[1:] = True, sorted_symbols[1:] != sorted_symbols[:-1]
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = group
    tied = np.empty(n, bool)  # by place in the array: the group has other members
    tied[:-1], tied[-1] = head[:-1] & ~head[1:] | ~head[:-1], not head[-1]
    levels, k = [rank], 1
    places = np.flatnonzero(tied)
    first_tied = places
    while len(places):
        at = order[places]
        nxt = at + k
        inside = nxt < doc_end[doc[at]]
        second = np.where(inside, rank[np.minimum(nxt, n - 1)].astype(np.int64) + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + second
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[places] = at  # groups keep their places: keys begin with the old rank
        new = np.empty(len(places), bool)
        new[0], new[1:] = True, key[1:] != key[:-1]
        start = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        rank = rank.copy()
        rank[at] = start
        levels.append(rank)
        k *= 2
        last = np.empty(len(places), bool)
        last[:-1], last[-1] = new[1:], True
        places = places[~(new & last)]
    # Neighbours in the array that shared their first word: descend through the rounds for their LCP.
    i = first_tied[first_tied > 0]
    i = i[symbols[order[i]] == symbols[order[i - 1]]]
    p, q = order[i - 1], order[i]
    end_p, end_q = doc_end[doc[p]], doc_end[doc[q]]
    lcp = np.zeros(len(i), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = p + lcp, q + lcp
        ok = (a < end_p) & (b < end_q)
        same = ok & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        lcp[same] += 1 << level
    np.maximum.at(longest, p, lcp)
    np.maximum.at(longest, q, lcp)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least ``least`` words."""
    p = np.flatnonzero(longest >= least)
    edge = np.zeros(len(longest) + 1, np.int64)
    edge[p] += 1
    np.subtract.at(edge, p + longest[p], 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: pa.Array, min_repeat: int) -> dict[str, np.ndarray]:
    """The figures of each text."""
    raw, off = common.compact(texts)
    begins, ends, counts = common.word_spans(raw, off)
    n_docs = len(texts)

    def per_text(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flag)])[at])

    word_off = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(n_docs), counts)
    codes = common.words_of(raw, begins, ends).dictionary_encode()
    symbols = doc * (len(codes.dictionary) + 1) + codes.indices.to_numpy().astype(np.int64)
    longest = repeat_lengths(symbols, doc, word_off[1:])
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, doc, longest)

    lines = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), "\n")
    line_doc = np.repeat(np.arange(n_docs), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    line_codes = pc.list_flatten(lines).dictionary_encode()
    with_word = pc.match_substring_regex(line_codes.dictionary, "[^\\t-\\r ]").to_numpy(zero_copy_only=False)
    code = line_codes.indices.to_numpy()
    full = with_word[code] if len(code) else np.zeros(0, bool)
    pairs = line_doc[full] * (len(with_word) + 1) + code[full]
    distinct = np.bincount(np.unique(pairs) // (len(with_word) + 1), minlength=n_docs)
    return {
        "n_words": counts,
        "word_chars": per_text(((raw & 0xC0) != 0x80) & ~common._SPACE[raw], off),
        "n_symbols": per_text(_SYMBOL[raw], off),
        "n_dup_lines": np.bincount(line_doc[full], minlength=n_docs) - distinct,
        "n_repeat_words": per_text(covered(longest, 3), word_off),
        "longest_repeat": np.where(top >= min_repeat, top, 0),
        "covered_words": per_text(covered(longest, min_repeat), word_off),
    }


def _run(min_repeat: int, max_fraction: float, max_longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(it, 1):
            m = measure(batch.column(1), min_repeat)
            fraction = m["covered_words"] / np.maximum(m["n_words"], 1)
            failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
            kept = ~failed & (fraction <= max_fraction) & (m["longest_repeat"] <= max_longest)
            cols = [batch.column(0).cast(pa.int64()), *(pa.array(v.astype(np.int64)) for v in m.values()), pa.array(fraction), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *m, "covered_fraction", "base_failed", "kept"])

    return go


def score_repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT, max_fraction: float = MAX_FRACTION, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per input row: the base figures, longest repeat, covered fraction and the verdict ``kept``.

    A null or empty text has no words, fails the base rule and isn't kept. A null id stays null. Repeated
    rows give repeated rows, an empty table an empty one, other columns are ignored. ``longest_repeat`` is
    0 if no repeat has ``min_repeat`` words. Texts are handled whole, some MB at a time or one longer text
    alone, so memory follows the longest text.
    """
    return common.own_columns(docs, id_col, text_col).transform(common.map_arrow, _run(min_repeat, max_fraction, max_longest), SCHEMA)
