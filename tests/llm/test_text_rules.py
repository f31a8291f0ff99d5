import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import byte_cnn, repetition_rules, severity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least):
    text = text or ""
    w = WORD.findall(text)

    def windows(size):
        at = {}
        for i in range(len(w) - size + 1):
            at.setdefault(tuple(w[i : i + size]), []).append(i)
        return [v for v in at.values() if len(v) > 1]

    spanned = lambda size: len({j for v in windows(size) for i in v for j in range(i, i + size)})
    longest = max((k for k in range(1, len(w)) if windows(k)), default=0)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": dup, "n_repeat_words": spanned(3), "longest_repeat": longest if longest >= least else 0, "covered_words": spanned(least)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab#é \n\t", max_size=60)), max_size=5))
def test_repetition_equals_brute_force(texts):
    got = repetition_rules.measure(pa.array(texts, pa.string()), 4)
    assert [{k: int(v[i]) for k, v in got.items()} for i in range(len(texts))] == [brute(t, 4) for t in texts]


def test_repetition_edges_and_verdict(frame, edges, empty, prose):
    passage = prose(60, 1)
    rows = [(1, prose(200, 2)), (2, f"{passage} {prose(30, 3)} {passage}"), (3, prose(20, 4)), (4, "a b c " * 50)]
    got = {r.doc_id: r for r in repetition_rules.score_repetition(frame(rows)).collect()}
    assert got[1].kept and not got[1].base_failed
    assert not got[2].kept and got[2].longest_repeat == 60 and got[2].covered_words == 120
    assert got[3].base_failed and got[4].base_failed and not got[3].kept
    for r in repetition_rules.score_repetition(edges).collect():
        assert r.base_failed and not r.kept
    assert repetition_rules.score_repetition(empty).collect() == []


def direct_score(net, text):
    """The network by its definition: every window, every chunk."""
    data = (text or "").encode()
    blocks = max(1, -(-len(data) // byte_cnn.BLOCK))
    padded = np.zeros(blocks * byte_cnn.BLOCK + byte_cnn.BLOCK + byte_cnn.WIDTH, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    out = np.array([sum(net.taps[k][padded[i + k]] for k in range(byte_cnn.WIDTH)) for i in range(blocks * byte_cnn.BLOCK)])
    hidden, a = [], 0
    while True:
        hidden.append(np.maximum(out[a * byte_cnn.BLOCK : (a + byte_cnn.BLOCKS) * byte_cnn.BLOCK].max(0) + net.bias, 0))
        if a + byte_cnn.BLOCKS >= blocks:
            break
        a += byte_cnn.BLOCKS - 1
    hidden = np.array(hidden)
    return 1 / (1 + np.exp(-(hidden.mean(0) @ net.out[0] + hidden.max(0) @ net.out[1] + net.offset)))


def test_network_equals_its_definition(prose):
    rng = np.random.default_rng(0)
    net = byte_cnn.Network(rng.normal(0, 0.2, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)).astype(np.float32), np.zeros(byte_cnn.FILTERS, np.float32), rng.normal(0, 0.3, (2, byte_cnn.FILTERS)).astype(np.float32), 0.1)
    texts = [None, "", "é", prose(8, 1), prose(60, 2), prose(400, 3), "x" * byte_cnn.CHUNK, "y" * (byte_cnn.CHUNK + 1)]
    from corpusloom.llm import common

    got = net.score(*common.compact(pa.array(texts, pa.string())), net.pair_tables())
    np.testing.assert_allclose(got, [direct_score(net, t) for t in texts], rtol=1e-3, atol=1e-4)


def labelled(prose, n=160):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(40, 1000 + i)
        rows.append((i, " ".join(w + "%%%" for w in text.split()) if bad else text))
        labels.append((i, 0 if bad else 1, 1 if bad else 0))
    return rows, labels


def test_quality_on_held_out_rows(spark, frame, prose):
    rows, labels = labelled(prose)
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = byte_cnn.score_quality(frame(rows), y).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and len(held) > 15
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in got)


def test_models_take_edges(spark, edges, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(None, 1, 1), (5, None, None), (6, 1, 1), (6, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        for score in (byte_cnn.score_quality, severity.score_severity):
            assert score(edges, labels).count() == edges.count()
            assert score(empty, labels).count() == 0


def test_severity_orders_and_catches(spark, frame):
    import random

    rng = random.Random(1)
    clean = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(clean, k=60)
        bad = i % 4 == 0
        for _ in range(rng.choice((1, 3, 9)) if bad else 0):
            words.insert(rng.randrange(60), rng.choice(("nasty", "vilest", "horrid")))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(1000, " ".join(clean[:50]) + " nasty"), (1001, " ".join(clean[:50]) + " nasty vilest horrid" * 4), (1002, " ".join(clean[:50]))]
    got = {r.doc_id: r for r in severity.score_severity(frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got[1000].toxic and got[1001].toxic and not got[1002].toxic
    assert got[1002].severity < got[1000].severity < got[1001].severity <= severity.TOP_GRADE
    assert np.mean([got[i].toxic == (i % 4 == 0) for i in range(400)]) > 0.97


def test_thresholds_ascend():
    model = severity.fit(["bad bad"] * 8 + ["bad"] * 8 + ["fine"] * 40, np.array([1.0] * 16 + [0.0] * 40), np.ones(56))
    assert model.terms and (np.diff(model.thresholds) > 0).all()


def test_severity_equals_its_definition(frame, edges):
    """Scores by plain counting of words and word beginnings, and grades from the cumulative links."""
    import math
    import unicodedata

    terms = ["bad", "badl*", "word", "tex*", "ça"]
    model = severity.Severity(terms, np.array([0.7, 1.1, -0.2, 0.4, 0.9]), np.array([0.5, 1.5, 2.5]))
    rows = [*((r.doc_id, r.text) for r in edges.collect()), (20, "Bad badly BADLANDS word, bad texts"), (21, "bad" * 9)]
    got = next(iter(severity._run(model)(iter([pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"])]))))
    for (_, text), severe, toxic in zip(rows, got.column("severity").to_pylist(), got.column("p_toxic").to_pylist(), strict=True):
        words, run = [], ""
        for c in (text or "").lower() + " ":
            if unicodedata.category(c)[0] in "LM":
                run += c
            elif run:
                words, run = [*words, run], ""
        uses = [sum(w == t for w in words) if not t.endswith("*") else sum(w.startswith(t[:-1]) and len(w) > len(t) - 1 and len(t) - 1 in severity.PREFIXES for w in words) for t in terms]
        score = sum((1 + math.log(n)) * w for n, w in zip(uses, model.weights, strict=True) if n)
        above = [1 / (1 + math.exp(-(score - t))) for t in model.thresholds]
        assert abs(severe - sum(above)) < 1e-9 and abs(toxic - above[0]) < 1e-9


def test_severity_fit_is_a_minimum():
    """No small step of any parameter lowers the ordinal loss, taken from its definition."""
    texts = ["bad bad bad vile"] * 6 + ["bad word"] * 10 + ["vile bad"] * 8 + ["word"] * 8 + ["fine word"] * 60 + ["word"] * 20 + ["bad"] * 4 + ["vile bad bad"] * 3
    labels = np.array([1.0] * 32 + [0.0] * 87)  # the classes overlap, so the least loss is at finite weights
    model = severity.fit(texts, labels, np.ones(len(texts)))
    doc, term, n, _ = severity.term_counts(pa.array(texts, pa.large_string()), pa.array(model.terms, pa.string()))
    use = np.bincount(doc, 1 + np.log(n), len(texts))
    grades = np.zeros(len(texts), int)
    grades[:32] = 1 + np.searchsorted(np.quantile(use[:32], [1 / 3, 2 / 3]), use[:32], "left")

    def loss(weights, thresholds):
        s = np.bincount(doc, (1 + np.log(n)) * weights[term], len(texts))
        above = np.concatenate([np.ones((len(s), 1)), 1 / (1 + np.exp(-(s[:, None] - thresholds))), np.zeros((len(s), 1))], 1)
        return -np.log(np.maximum(above[np.arange(len(s)), grades] - above[np.arange(len(s)), grades + 1], 1e-9)).mean() + severity.SHRINK / 2 * (weights**2).sum()

    least = loss(model.weights, model.thresholds)
    for step in (-0.2, 0.2):
        for i in range(len(model.terms)):
            w = model.weights.copy()
            w[i] += step
            assert loss(w, model.thresholds) > least
        for i in range(severity.TOP_GRADE):
            t = model.thresholds.copy()
            t[i] += step
            assert loss(model.weights, t) > least


def test_network_gradient_lowers_the_loss(prose):
    """Training from the same start reaches a far lower loss than the untrained network has."""
    rows, labels = labelled(prose, 80)
    y = np.array([float(q) for _, q, _ in labels])
    texts = [t for _, t in rows]
    from corpusloom.llm import common

    def loss(net):
        p = np.clip(net.score(*common.compact(pa.array(texts, pa.string())), net.pair_tables()), 1e-6, 1 - 1e-6)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    trained = byte_cnn.fit(texts, y, np.ones(len(y)))
    assert loss(trained) < 0.2 * loss(byte_cnn.fit([], np.zeros(0), np.zeros(0)))
