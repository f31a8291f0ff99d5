"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability in a
language is the sum, by a forward pass, over all ways to cut it into pieces; a text's is the product over
its words. The piece probabilities are fitted by expectation-maximisation, whose expected counts come from
the forward and backward sums of the same lattice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled texts of each language that the probabilities are fitted on, at most about (drawn by a hash).
ROWS_PER_LANGUAGE = 600
ROUNDS = 2
#: Longer words are cut into parts of so many characters, so that no product underflows.
WORD_CHARS = 24
#: Words of a worker's cache, and words that one lattice holds.
CACHE_WORDS, LATTICE_WORDS = 150_000, 8_192
UNDETERMINED = "und"
_MARK = "▁"


def read_pieces(path: str) -> list[str]:
    """The lower-case pieces of a sentencepiece vocabulary, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in kept if p == p.lower()})


class Trie:
    """The pieces as arrays that many words are matched against at once."""

    def __init__(self, pieces: list[str]):
        letters = sorted({c for p in pieces for c in p})
        self.letter = np.zeros(0x110000, np.int32)  # 0: not in any piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.unknown = len(pieces)
        self.size = len(pieces) + 1
        nodes: dict[tuple[int, int], int] = {}
        end = {}
        for i, p in enumerate(pieces):
            at = 0
            for c in p:
                at = nodes.setdefault((at, int(self.letter[ord(c)])), len(nodes) + 1)
            end[at] = i
        self.width = len(letters) + 1
        keys = np.array([a * self.width + c for a, c in nodes], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = np.append(keys[order], np.iinfo(np.int64).max), np.array(list(nodes.values()), np.int64)[order]
        self.piece = np.full(len(nodes) + 1, -1, np.int64)
        self.piece[list(end)] = list(end.values())

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Of the words' lattices: word, begin, end and piece of each edge, by end; and each word's length.

        A character that is no piece by itself also has an edge of the unknown piece.
        """
        size = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        char = self.letter[code]
        off = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        begin = np.arange(len(char)) - off[word]
        stop = (off + size)[word]
        found, node, at, depth = [], np.zeros(len(char), np.int64), np.arange(len(char)), 0
        single = np.zeros(len(char), bool)
        while len(at):
            key = node * self.width + char[at + depth]
            i = np.searchsorted(self.keys, key)
            ok = self.keys[i] == key
            node, at = self.child[i[ok]], at[ok]
            depth += 1
            hit = self.piece[node] >= 0
            found.append((at[hit], np.full(hit.sum(), depth), self.piece[node[hit]]))
            if depth == 1:
                single[at[hit]] = True
            on = at + depth < stop[at]
            node, at = node[on], at[on]
        lone = np.flatnonzero(~single)
        found.append((lone, np.ones(len(lone), np.int64), np.full(len(lone), self.unknown)))
        at, length, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        return word[at], begin[at], begin[at] + length, piece, size

    @staticmethod
    def forward(edges: tuple[np.ndarray, ...], p: np.ndarray, n: int) -> np.ndarray:
        """Summed probability of each word's first characters: n x (longest + 1) x languages."""
        word, begin, end, piece, size = edges
        alpha = np.zeros((n, int(size.max(initial=0)) + 1, p.shape[1]))
        alpha[:, 0] = 1
        order = np.lexsort((word, end))
        w, b, e, q = word[order], begin[order], end[order], piece[order]
        cut = np.searchsorted(e, np.arange(1, alpha.shape[1] + 1))
        for j in range(1, alpha.shape[1]):
            s = slice(cut[j - 1], cut[j])
            if s.start == s.stop:
                continue
            own = w[s]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            alpha[own[first], j] = np.add.reduceat(alpha[own, b[s]] * p[q[s]], first, axis=0)
        return alpha

    @staticmethod
    def backward(edges: tuple[np.ndarray, ...], p: np.ndarray, n: int) -> np.ndarray:
        """Summed probability of what follows each place: the forward pass of the reversed lattice."""
        word, begin, end, piece, size = edges
        turned = Trie.forward((word, size[word] - end, size[word] - begin, piece, size), p, n)
        at = np.clip(size[:, None] - np.arange(turned.shape[1]), 0, None)
        return turned[np.arange(n)[:, None], at]


@lru_cache(2)
def _trie(pieces: tuple[str, ...]) -> Trie:
    return Trie(list(pieces))


def parts_of(word: str) -> list[str]:
    marked = _MARK + word
    return [marked[i : i + WORD_CHARS] for i in range(0, len(marked), WORD_CHARS)]


def log_probability(trie: Trie, p: np.ndarray, words: list[str]) -> np.ndarray:
    """words x languages: the log of each word's probability over all segmentations."""
    out = np.empty((len(words), p.shape[1]))
    for a in range(0, len(words), LATTICE_WORDS):
        own = words[a : a + LATTICE_WORDS]
        parts = [parts_of(w) for w in own]
        flat = [x for xs in parts for x in xs]
        edges = trie.edges(flat)
        alpha = trie.forward(edges, p, len(flat))
        logs = np.log(alpha[np.arange(len(flat)), edges[4]])
        count = np.array([len(x) for x in parts])
        out[a : a + len(own)] = np.add.reduceat(logs, np.cumsum(count) - count, axis=0)
    return out


def letter_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The lower-case runs of letters (with marks, a letter at least) of each text: their number, and all of them in order."""
    low = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    raw, off = common.compact(pc.replace_substring_regex(low, r"[^\pL\pM]+", " "))
    begins, ends, counts = common.word_spans(raw, off)
    words = common.words_of(raw, begins, ends).dictionary_encode()
    letters = pc.match_substring_regex(words.dictionary, r"\pL").to_numpy(zero_copy_only=False).astype(bool)
    if not letters.all():  # marks alone are no word
        use = letters[words.indices.to_numpy()]
        counts = np.diff(np.concatenate([[0], np.cumsum(use)])[np.concatenate([[0], np.cumsum(counts)])])
        words = words.filter(pa.array(use))
    return counts, words


def _word_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(it, 1):
        counts, words = letter_words(batch.column(1))
        lang = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), counts)
        d = max(1, len(words.dictionary))
        key, n = np.unique(lang.astype(np.int64) * d + words.indices.to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key // d), words.dictionary.take(pa.array(key % d)).cast(pa.string()), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])


def _expected(pieces: tuple[str, ...], p: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Expected uses of each piece under ``p``, summed over a partition's word counts."""

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(pieces)
        total = np.zeros_like(p)
        for batch in it:
            lang_all, words_all, n_all = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for a in range(0, batch.num_rows, LATTICE_WORDS):
                lang, words, n = (x[a : a + LATTICE_WORDS] for x in (lang_all, words_all, n_all))
                parts = [parts_of(w) for w in words]
                flat = [x for xs in parts for x in xs]
                count = np.array([len(x) for x in parts])
                lang, n = np.repeat(lang, count), np.repeat(n, count)
                edges = trie.edges(flat)
                word, begin, end, piece, size = edges
                for k in np.unique(lang):
                    pk = p[:, [k]]
                    alpha, beta = trie.forward(edges, pk, len(flat))[..., 0], trie.backward(edges, pk, len(flat))[..., 0]
                    use = lang[word] == k
                    w = word[use]
                    share = alpha[w, begin[use]] * pk[piece[use], 0] * beta[w, end[use]] / alpha[w, size[w]] * n[w]
                    total[:, k] += np.bincount(piece[use], share, len(p))
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(piece), pa.array(total[piece, lang])], names=["lang", "piece", "n"])

    return go


class Model:
    """languages; pieces; p: (pieces + unknown) x languages; prior: log share of each language."""

    def __init__(self, languages: list[str], pieces: tuple[str, ...], p: np.ndarray, prior: np.ndarray):
        self.languages, self.pieces, self.p, self.prior = languages, pieces, p, prior
        self.key = hashlib.sha256(p.tobytes()).hexdigest()

    @staticmethod
    def fit(train: DataFrame, pieces: list[str], rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
        """Fitted on texts with a language, about ``rows_per_language`` of each, drawn by a hash of the id.

        train: doc_id, text, lang. What reaches the driver is a row per language, and expected counts per
        language and piece: bounded by the vocabulary, whatever the input's size.
        """
        own = train.where("lang is not null and text is not null")
        size = {r.lang: r["count"] for r in own.groupBy("lang").count().orderBy("lang").collect()}
        languages = sorted(size)
        p = np.full((len(pieces) + 1, len(languages)), 1.0 / (len(pieces) + 1))
        prior = np.log(np.array([size[x] for x in languages], float) / max(1, sum(size.values())))
        if languages:
            lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)
            number = F.coalesce(*(F.when(F.col("lang") == x, F.lit(i)) for i, x in enumerate(languages)))
            bound = F.coalesce(*(F.when(F.col("lang") == x, F.lit(rows_per_language / size[x])) for x in languages))
            counts = own.where(lot < bound).select(number.cast("long").alias("lang"), "text").transform(common.map_arrow, _word_counts, "lang long, word string, n long")
            counts = common.cut(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")))
            for _ in range(rounds):
                got = counts.transform(common.map_arrow, _expected(tuple(pieces), p), "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
                n = np.full_like(p, 0.05)
                n[got.column("piece").to_numpy(), got.column("lang").to_numpy()] += got.column("n").to_numpy()
                p = np.maximum(n / n.sum(0), 1e-9)
        return Model(languages, tuple(pieces), p, prior)


class _Scorer:
    """A worker's model with its bounded cache of words."""

    def __init__(self, model: Model):
        self.model, self.trie = model, _trie(model.pieces)
        self.known: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.languages)))

    def words(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            self.logs, new = self.logs[:0], words
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.logs = np.concatenate([self.logs, log_probability(self.trie, self.model.p, new)])
        return self.logs[[known[w] for w in words]]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        counts, words = letter_words(texts)
        n = len(self.model.languages)
        if not n:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        total = np.tile(self.model.prior, (len(texts), 1))
        if len(words):
            logs = self.words(words.dictionary.to_pylist())[words.indices.to_numpy()]
            has = np.flatnonzero(counts)
            total[has] += np.add.reduceat(logs, (np.cumsum(counts) - counts)[has], axis=0)
        share = np.exp(total - total.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        lang = [self.model.languages[b] if c else UNDETERMINED for b, c in zip(best, counts, strict=True)]
        return lang, np.where(counts > 0, share[np.arange(len(best)), best], 0.0)


_scorers: dict[str, _Scorer] = {}


def _run(model: Model, n_before: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches whose first column is the text; the others are passed on before the prediction."""

    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.key not in _scorers:
            _scorers.clear()
            _scorers[model.key] = _Scorer(model)
        for batch in common.chunks(it, 0):
            lang, score = _scorers[model.key].predict(batch.column(0))
            cols = [*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[1:], "lang_pred", "score"])

    return go


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """For each row the columns ``keep``, then lang_pred and score (the language's posterior share).

    ``und`` with score 0 if the text is null or has no letter, or if the model knows no language. A tie goes
    to the language first in alphabetical order. Repeated rows give repeated rows, an empty table an empty
    one. ``keep`` may hold any column; lang_pred and score give way to the prediction's. Texts of any length
    are scored whole.
    """
    from pyspark.sql import types as T

    keep = [c for c in keep if c not in ("lang_pred", "score")]
    own = docs.select(F.col("text").alias("__loom_text"), *(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*own.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return own.transform(common.map_arrow, _run(model, len(keep)), schema)


def train_and_identify(docs: DataFrame, vocab_path: str, held_out_mod: int = 4, held_out: int = 2, **limits: int) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row, by a model fitted on the rows that aren't held out."""
    pieces = read_pieces(vocab_path)
    own = docs.select("doc_id", "text", "lang", (common.crc_mod("doc_id", held_out_mod) == held_out).alias("held_out"))
    model = Model.fit(own.where("not held_out"), pieces, **limits)
    return identify(own, model, ["doc_id", "held_out"]).withColumn("doc_id", F.col("doc_id").cast("long"))
