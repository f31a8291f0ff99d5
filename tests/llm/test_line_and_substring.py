import random

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import chunk_dedup, common, line_templates


def test_recurring_templates_go_but_for_the_first(frame, prose):
    rows = []
    for i in range(30):
        lines = [prose(12, i), prose(9, 500 + i)]
        if i < 12:
            lines.insert(1, "All rights reserved.")
        if i >= 15:
            lines.append(f"Posted by user{i} on page {i} of the great forum")
        rows.append((i, "\n".join(lines)))
    names = ["anna", "bert", "carl", "dora", "emil", "fred", "gina", "hans", "ivan", "jane", "karl"]
    rows += [(100 + k, f"{prose(10, 900 + k)}\nThis fine recipe was sent by our reader {n} last week") for k, n in enumerate(names)]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(frame(rows)).collect()}
    text = dict(rows)
    for d, t in text.items():
        want = [x for x in t.split("\n") if d in (0, 15, 100) or not x.startswith(("All rights", "Posted by", "This fine"))]
        assert got[d].text == "\n".join(want), d
        assert (got[d].n_lines, got[d].n_dropped) == (len(t.split("\n")), len(t.split("\n")) - len(want))


def families(rng):
    """Lines of templates with variable words, and how many of each go: all but the first."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    out = []
    for k, (form, count) in enumerate(
        [
            ("Posted by {} today", 14),
            ("Mail is sent by {} to our {}", 14),  # 5 of 7 constant
            ("It is sent by {} to our friend {} in may", 14),
            ("It is sent with love {} of the {} great old company", 14),  # the same leaf as the one before
            ("It is here for {} of {} or {} of {} then", 14),  # too few constant
            ("It is a rare line about {} and the old house", 9),  # too few documents
            ("Half of it says {} {} {} {}", 14),
        ]
    ):
        rows = [form.format(*(word() for _ in range(form.count("{}")))) for _ in range(count)]
        out += [(100 * k + i, x, i > 0 and k < 4) for i, x in enumerate(rows)]
    # unrelated lines of the leaf of "It is ..." (10 tokens), more than any family has
    out += [(2000 + i, "It is " + " ".join(word() for _ in range(8)), False) for i in range(40)]
    # a variable field with a common value stays one template
    out += [(3000 + i, f"Our reader {'anna' if i < 11 else word()} sent this in", i > 0) for i in range(16)]
    return out


def test_a_leaf_may_hold_several_templates(frame):
    rows = families(random.Random(3))
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(frame([(d, x) for d, x, _ in rows])).collect()}
    for d, line, gone in rows:
        assert (got[d].n_dropped, got[d].text) == ((1, "") if gone else (0, line)), (d, line)


def chain(rng):
    """Lines of one leaf that take a round for each of 14 positions, before a template of 12 of them shows."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    fixed = [f"fixed{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)]
    out = []
    for p in range(14):
        for _ in range(30):
            loose = [word() for _ in range(20)]
            loose[p] = f"family{chr(97 + p)}"
            out.append((len(out), " ".join(fixed + loose), False))
    for i in range(12):
        out.append((len(out), " ".join([*fixed, *(word() for _ in range(14)), *(f"late{c}" for c in "abcdef")]), i > 0))
    return out


def test_many_rounds(frame):
    """Estimates of the rounds' tables must not grow with a power of the rounds: the driver held numbers of gigabits."""
    rows = chain(random.Random(7))
    got = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring_lines(frame([(d, x) for d, x, _ in rows])).collect()}
    assert got == {d: int(gone) for d, _, gone in rows}


def test_estimates_are_forgotten(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    bits = []
    for _ in range(4):
        df = common.cut_anew(df.join(common.cut(spark.range(5)), F.col("k") == F.col("id")).select("k"))
        assert sorted(r.k for r in df.collect()) == [0, 1, 2, 3, 4]
        bits.append(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length())
    assert len(set(bits)) == 1


def test_bounds_of_broadcasts_and_places_change_no_result(frame, monkeypatch):
    rows = families(random.Random(4)) + [(None, "It is a rare line about nobody and the old house", False)]
    docs = frame([(d, x) for d, x, _ in rows])
    take = lambda: sorted(str((r.doc_id, r.text, r.n_dropped)) for r in line_templates.drop_recurring_lines(docs).collect())
    want = take()
    monkeypatch.setattr(line_templates, "BROADCAST_ROWS", 3)
    assert take() == want
    monkeypatch.setattr(line_templates, "PLACES", 0)
    assert take() == want


def test_the_sieve_keeps_what_was_chosen_and_little_else(spark):
    rows = spark.range(3000).select((F.col("id") * 7).alias("doc_id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("key"))
    chosen = common.cut(rows.where("doc_id % 10 = 0").select(F.col("key").alias("_key"), F.col("doc_id").alias("first")))
    n = chosen.count()
    got = [r.doc_id for r in line_templates._sieve(rows, chosen, n).collect()]
    assert len(got) == len(set(got)) and {7 * i for i in range(0, 3000, 10)} <= set(got)
    assert len(got) - n < (3000 - n) / 10


def test_fewer_documents_than_the_bound_stay(frame):
    rows = [(i, f"Same line here\nown line {chr(97 + i) * 5}") for i in range(line_templates.MIN_DOCS - 1)]
    assert all(r.n_dropped == 0 for r in line_templates.drop_recurring_lines(frame(rows)).collect())


def test_repeated_rows_are_one_document(frame):
    rows = [(1, "Same line here")] * 30
    assert all(r.n_dropped == 0 for r in line_templates.drop_recurring_lines(frame(rows)).collect())


def test_line_edges(frame, edges, empty):
    got = line_templates.drop_recurring_lines(edges).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(str((r.doc_id, r.text)) for r in edges.collect())
    assert all(r.n_dropped == 0 for r in got)
    assert line_templates.drop_recurring_lines(empty).collect() == []
    copies = line_templates.drop_recurring_lines(frame([(i, "one line\n\n two lines ") for i in range(20)])).collect()
    assert sorted(r.text for r in copies) == [""] * 19 + ["one line\n\n two lines "]


def test_gear_hash_by_its_definition():
    raw = np.frombuffer(np.random.default_rng(0).bytes(300), np.uint8)
    got = chunk_dedup.rolling(raw)
    for i in range(300):
        assert int(got[i]) == sum(int(chunk_dedup.GEAR[raw[i - k]]) << k for k in range(chunk_dedup.WINDOW) if i >= k) % 65536


def chunks_of(text):
    raw = text.encode()
    ends = chunk_dedup.chunk_ends(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=False)]


def test_chunks_cover_texts_and_resist_shifts(prose):
    text = prose(400, 1)
    assert b"".join(chunks_of(text)).decode() == text
    moved = chunks_of("An insertion in front. " + text)
    own = chunks_of(text)
    assert len(set(own) & set(moved)) >= len(own) - 3
    for c in chunks_of("日本語テキスト" * 200):
        c.decode()  # whole characters


def test_batches_cut_like_single_texts(prose):
    import pyarrow as pa

    texts = [prose(n, n) for n in (3, 50, 0, 120)] + ["", "x"]
    raw, off = common.compact(pa.array(texts))
    ends = chunk_dedup.chunk_ends(raw, off).tolist()
    want, at = [], 0
    for t in texts:
        for c in chunks_of(t):
            at += len(c)
            want.append(at)
    assert ends == want


def test_repeated_passages_are_found_and_cut(frame, prose):
    rng = random.Random(2)
    passages = [prose(60, 7000 + k) for k in range(10)]
    rows = [(i, f"{prose(40, i)} {passages[i % 10]}\n{prose(30, 3000 + i)}") for i in range(30)]
    rows += [(100 + i, prose(150, 9000 + i)) for i in range(20)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in chunk_dedup.repeated_passages(frame(rows)).collect()}
    assert set(got) == set(range(30))
    for i in range(30):
        assert 20 <= got[i].repeated_words <= 62
        assert (got[i].removed_words == 0) == (i < 10)
    cut = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(frame(rows)).collect()}
    text = dict(rows)
    assert len(cut) == len(rows)
    for d, t in cut.items():
        assert t == text[d] if d < 10 or d >= 100 else len(t.split()) < len(text[d].split()) - 18


def test_substring_edges(frame, edges, empty, prose):
    assert [r.doc_id for r in chunk_dedup.repeated_passages(edges).collect()] == []
    assert chunk_dedup.repeated_passages(empty).collect() == []
    same = prose(80, 1)
    twice = [(1, same), (1, same), (2, same)]
    got = {r.doc_id: r for r in chunk_dedup.repeated_passages(frame(twice)).collect()}
    assert got[1].repeated_words == got[2].repeated_words == 80
    assert got[1].removed_words == 0 and got[2].removed_words == 80
    assert sorted(str(r.text) for r in chunk_dedup.remove_repeats(edges).collect()) == sorted(str(r.text) for r in edges.collect())


def brute_passages(rows):
    """Per document the spans of repeated passages, by the definition, byte by byte."""
    G = chunk_dedup

    def cut(raw):
        hashes = [sum(int(G.GEAR[raw[i - k]]) << k for k in range(G.WINDOW) if i >= k) % 65536 for i in range(len(raw))]
        low = [i + 1 for i, h in enumerate(hashes) if h < 65536 // G.RATE]
        ends = [e for j, e in enumerate(low) if e >= G.WINDOW + G.GAP and (j == 0 or e - low[j - 1] >= G.GAP) and e < len(raw) and raw[e] & 0xC0 != 0x80]
        return list(zip([0, *ends], [*ends, len(raw)], strict=True)) if raw else []

    owners, chunks = {}, {}
    for d, t in rows:
        raw = t.encode()
        chunks[d] = [(a, b, raw[a:b]) for a, b in cut(raw)]
        for _, _, c in chunks[d]:
            owners.setdefault(c, set()).add(d)
    out = {}
    for d, t in rows:
        raw, run, spans = t.encode(), [], []
        starts = {i for i in range(len(raw)) if chr(raw[i]).strip() and (i == 0 or not chr(raw[i - 1]).strip())}
        for a, b, c in [*chunks[d], (0, 0, None)]:
            if c is not None and len(owners[c]) > 1:
                run.append((a, b))
            else:
                if sum(x <= i < y for i in starts for x, y in run) >= G.MIN_WORDS:
                    spans.append((run[0][0], run[-1][1]))
                run = []
        if spans:
            out[d] = spans
    return out


def test_passages_equal_brute_force(frame, prose):
    passages = [prose(30 + 5 * k, 7100 + k) for k in range(6)]
    rows = [(i, f"{prose(15 + i % 4, 40 + i)} {passages[i % 6]} {prose(12, 800 + i)}") for i in range(18)]
    rows += [(50, passages[0]), (51, f"{passages[1]} {passages[2]}"), (52, prose(60, 5)), (53, "")]
    got = {r.doc_id: [tuple(p) for p in r.passages] for r in chunk_dedup.repeated_passages(frame(rows)).collect()}
    assert got == brute_passages(rows) and len(got) > 15
