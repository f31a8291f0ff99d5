import itertools
import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from corpusloom.llm import language_id as L

PIECES = ["a", "b", "ab", "ba", "aba", "▁", "▁a"]
VOCAB = P.path("piece_bpe_32k.model")


def cuts(word):
    """All segmentations of a word into pieces or lone unknown characters."""
    word = "▁" + word
    for places in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, x in enumerate(places) if x), len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(at)]
        if all(p in PIECES or len(p) == 1 for p in parts):
            yield parts


def test_forward_sums_all_segmentations():
    p = np.random.default_rng(0).random((len(PIECES) + 1, 2))
    words = ["", "a", "ab", "abab", "xaéb", "babaab"]
    got = L.log_probability(L.Trie(PIECES), p, words)
    for w, row in zip(words, got, strict=True):
        for k in (0, 1):
            total = sum(math.prod(p[PIECES.index(x) if x in PIECES else -1, k] for x in c) for c in cuts(w))
            assert row[k] == pytest.approx(math.log(total))


def test_expected_counts_equal_brute_force():
    import pyarrow as pa

    p = np.random.default_rng(1).random((len(PIECES) + 1, 2))
    words, lang, n = ["ab", "aba", "xb"], [0, 1, 0], [2, 1, 3]
    batch = pa.RecordBatch.from_arrays([pa.array(lang), pa.array(words), pa.array(n)], names=["lang", "word", "n"])
    out = next(iter(L._expected(tuple(PIECES), p)(iter([batch])))).to_pydict()
    want = {}
    for w, k, times in zip(words, lang, n, strict=True):
        weighted = [(math.prod(p[PIECES.index(x) if x in PIECES else -1, k] for x in c), c) for c in cuts(w)]
        z = sum(x for x, _ in weighted)
        for x, c in weighted:
            for piece in c:
                key = (k, PIECES.index(piece) if piece in PIECES else len(PIECES))
                want[key] = want.get(key, 0) + times * x / z
    got = dict(zip(zip(out["lang"], out["piece"], strict=True), out["n"], strict=True))
    assert got == pytest.approx(want)


ENGLISH = "the house and the garden are near the river where people walk in the morning and talk about the weather"
GERMAN = "das haus und der garten sind nahe am fluss wo die leute am morgen gehen und über das wetter sprechen"


def test_held_out_languages(frame):
    rows = []
    for i in range(60):
        words = (ENGLISH if i % 2 else GERMAN).split()
        rows.append((i, " ".join(words[(i * 3 + j) % len(words)] for j in range(8)), "en" if i % 2 else "de"))
    got = L.train_and_identify(frame(rows), VOCAB).collect()
    assert len(got) == 60
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred == ("en" if r.doc_id % 2 else "de") and 0.5 < r.score <= 1


def test_edges(edges, empty, frame):
    got = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in L.train_and_identify(edges, VOCAB).collect()}
    assert {(1, True, True), (2, True, True), (3, True, True), (4, True, True), (7, False, False), (None, False, False)} <= got
    assert L.train_and_identify(empty, VOCAB).collect() == []
    untold = L.train_and_identify(frame([(1, "some words", None)]), VOCAB).collect()
    assert [(r.lang_pred, r.score) for r in untold] == [("und", 0.0)]


def test_long_words_are_cut_not_lost():
    word = "x" * 1000
    parts = L.parts_of(word)
    assert "".join(parts) == "▁" + word and max(map(len, parts)) == L.WORD_CHARS
    p = np.full((len(PIECES) + 1, 1), 1e-9)
    assert np.isfinite(L.log_probability(L.Trie(PIECES), p, [word])).all()


def test_marks_alone_are_no_letters(frame):
    rows = [(1, ENGLISH, "en"), (3, GERMAN, "de"), (10, "\u0301", None), (11, "12 \u0301\u0308 --", None), (12, f"\u0301 {GERMAN} \u0308", None)]
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in L.train_and_identify(frame(rows), VOCAB, held_out=-1).collect()}
    assert got[10] == got[11] == ("und", False) and got[12] == ("de", True)


def test_clashing_columns_give_way(frame):
    docs = frame([(1, ENGLISH, "en"), (3, GERMAN, "de")])
    got = L.identify(docs, L.Model.fit(docs, L.read_pieces(VOCAB)), docs.columns)
    assert got.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    assert {(r.text, r.lang_pred, r.key) for r in got.collect()} == {(ENGLISH, "en", -1), (GERMAN, "de", -1)}
