"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades are ordered: P(grade > j) = sigmoid(w . x - theta_j), one weight vector shared by all thresholds
theta_1 < theta_2 < ... A text's features are the terms of a learned vocabulary, each 1 + log(its count): a
term is a whole word, or the beginning of a word (written with a final ``*``). The result is the expected
grade.

Labels are binary, so the graded target is made from them: grade 0 is label 0; a text of label 1 gets grade
1 to ``TOP_GRADE`` by the quantile, among those texts, of how much it uses the terms that set the two
classes apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .byte_cnn import training_rows
from .language_id import letter_words

TOP_GRADE = 3
#: Labelled rows of each class that the model is fitted on, at most about; terms kept; least rows and z of a term.
ROWS_PER_CLASS, MOST_TERMS, LEAST_ROWS, LEAST_Z = 3000, 4096, 4, 4.0
#: Labels of held-out rows (ids whose crc32 is 0 modulo this) are never used.
HELD_OUT_MOD = 5
STEPS, RATE, SHRINK = 1500, 0.05, 1e-4
#: From this P(grade > 0) on a text is called toxic.
TOXIC_FROM = 0.4
#: Lengths of the word beginnings that are terms too.
PREFIXES = (4, 5, 6, 7, 8)


@dataclass
class Severity:
    """terms: the vocabulary; weights: one a term; thresholds: ascending."""

    terms: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def grade(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for each text and threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -30, 30)))


def forms(words: pa.Array) -> list[tuple[np.ndarray, pa.Array]]:
    """The terms that words have: which of the words, and the term of each, form by form."""
    words = words.cast(pa.string())
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    out = [(np.arange(len(words)), words)]
    for k in PREFIXES:
        at = np.flatnonzero(size > k)
        out.append((at, pc.binary_join_element_wise(pc.utf8_slice_codeunits(words.take(pa.array(at)), 0, k), "*", "")))
    return out


def term_counts(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of each term that a text has, and the number of words of each text."""
    counts, words = letter_words(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    word, keys = words.indices.to_numpy(), []
    for at, names in forms(words.dictionary) if len(terms) and len(words) else []:
        term = np.full(len(words.dictionary), -1, np.int64)
        term[at] = pc.fill_null(pc.index_in(names, terms), -1).to_numpy(zero_copy_only=False)
        use = np.flatnonzero(term[word] >= 0)
        keys.append(doc[use] * (len(terms) + 1) + term[word[use]])
    key, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    return key // (len(terms) + 1), key % (len(terms) + 1), n, counts


def choose_terms(texts: list[str | None], labels: np.ndarray) -> list[str]:
    """Terms that far more label-1 texts have than their share, the strongest first; ties by alphabet.

    The measure is the z of the two classes' shares of texts with the term, a row counting once.
    """
    df: list[dict[str, int]] = [{}, {}]
    for a in range(0, len(texts), 256):
        counts, words = letter_words(pa.array(texts[a : a + 256], pa.large_string()))
        doc, word = np.repeat(np.arange(len(counts)), counts), words.indices.to_numpy()
        for at, names in forms(words.dictionary):
            coded = names.dictionary_encode()
            of_word = np.full(len(words.dictionary), -1, np.int64)
            of_word[at] = coded.indices.to_numpy()
            term, labelled = of_word[word], labels[a : a + 256][doc]
            for y in (0, 1):
                use = (term >= 0) & (labelled == y)
                pair = np.unique(doc[use] * (len(names) + 1) + term[use])
                own, n = np.unique(pair % (len(names) + 1), return_counts=True)
                for name, k in zip(coded.dictionary.take(pa.array(own)).to_pylist(), n.tolist(), strict=True):
                    df[y][name] = df[y].get(name, 0) + k
    total = [max(1, int((labels == y).sum())) for y in (0, 1)]
    scored = []
    for term, k in df[1].items():
        if k >= LEAST_ROWS:
            none = df[0].get(term, 0)
            both = (k + none + 1) / (sum(total) + 2)
            z = (k / total[1] - none / total[0]) / np.sqrt(both * (1 - both) * (1 / total[0] + 1 / total[1]))
            if z >= LEAST_Z:
                scored.append((-z, term))
    return [t for _, t in sorted(scored)[:MOST_TERMS]]


def fit(texts: list[str | None], labels: np.ndarray, weights: np.ndarray) -> Severity:
    """The regression, by gradient steps on the weighted negative log likelihood with an L2 penalty.

    Without rows of both classes there are no terms, and every text gets the same low severity.
    """
    terms = choose_terms(texts, labels) if len(texts) else []
    gaps = np.zeros(TOP_GRADE)
    theta0, w = 3.0, np.zeros(len(terms))
    if not terms:
        return Severity([], w, theta0 + np.arange(TOP_GRADE))
    doc, term, n, _ = term_counts(pa.array(texts, pa.large_string()), pa.array(terms, pa.string()))
    x = 1 + np.log(n)
    use = np.bincount(doc, x, len(texts))
    grades = np.zeros(len(texts), np.int64)
    toxic = np.flatnonzero(labels == 1)
    cuts = np.quantile(use[toxic], np.arange(1, TOP_GRADE) / TOP_GRADE)
    grades[toxic] = 1 + np.searchsorted(cuts, use[toxic], "left")
    above = grades[:, None] > np.arange(TOP_GRADE)
    share = weights / weights.sum()
    params = [w, np.array([theta0]), gaps[1:]]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        thetas = params[1][0] + np.concatenate([[0], np.cumsum(np.exp(params[2]))])
        s = np.bincount(doc, x * params[0][term], len(texts))
        p = 1 / (1 + np.exp(-np.clip(s[:, None] - thetas, -30, 30)))
        # Probability of each text's own grade, and its derivative by the score and the two thresholds.
        upper = np.concatenate([np.ones((len(s), 1)), p], 1)
        lower = np.concatenate([p, np.zeros((len(s), 1))], 1)
        row = np.arange(len(s))
        hi, lo = upper[row, grades], lower[row, grades]
        own = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
        d_score = -(d_hi - d_lo) / own * share
        d_theta = np.zeros(TOP_GRADE)
        inner = grades > 0
        np.add.at(d_theta, grades[inner] - 1, (d_hi / own * share)[inner])
        inner = grades < TOP_GRADE
        np.add.at(d_theta, grades[inner], (-d_lo / own * share)[inner])
        tail = np.cumsum(d_theta[::-1])[::-1]
        grads = [np.bincount(term, x * d_score[doc], len(terms)) + SHRINK * params[0], np.array([tail[0]]), tail[1:] * np.exp(params[2])]
        for q, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Severity(terms, params[0], params[1][0] + np.concatenate([[0], np.cumsum(np.exp(params[2]))]))


def _run(model: Severity) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(model.terms, pa.string())
        for batch in common.chunks(it, 1):
            doc, term, n, _ = term_counts(batch.column(1), terms)
            score = np.bincount(doc, (1 + np.log(n)) * model.weights[term], batch.num_rows) if len(doc) else np.zeros(batch.num_rows)
            above = model.grade(score)
            cols = [batch.column(0).cast(pa.int64()), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array((above > 0.5).sum(1).astype(np.int32)), pa.array(above[:, 0] >= TOXIC_FROM)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "severity", "p_toxic", "grade", "toxic"])

    return go


def score_severity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, severity (expected grade, 0 to 3), p_toxic, grade (median), toxic.

    A null or empty text has no terms and gets the lowest severity. Fits on about ``rows_per_class``
    labelled rows of each class; rows without a label are ignored, an id with several labels counts as
    toxic if one says so. Repeated rows give repeated rows, an empty table an empty one; other columns are
    ignored.
    """
    model = fit(*training_rows(docs, labels, label_col, HELD_OUT_MOD, rows_per_class))
    own = common.own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return own.transform(common.map_arrow, _run(model), "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
