import pytest

from corpusloom.llm import template_decontam as T

QUESTION = "In 2019, the trader Maria bought 12 km of cable for 30 dollars, and then Maria sold 5 kg of tin to Peter for 30 dollars."


@pytest.fixture(scope="module")
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def found(docs, benchmark):
    return {(r.doc_id, r.item_id) for r in T.contaminated(docs, benchmark).collect()}


def test_other_values_in_the_same_slots_are_found(frame, items):
    changed = QUESTION.replace("2019", "1987").replace("Maria", "Alice").replace("12 km", "7 km").replace("30", "45").replace("5 kg", "9 kg").replace("Peter", "Bob")
    clash = changed.replace("45 dollars.", "46 dollars.").replace("then Alice", "then Carol")
    docs = frame([(1, QUESTION), (2, f"Words before it. {changed} And after."), (3, clash), (4, "the trader bought cable and sold tin"), (5, QUESTION.upper())])
    got = found(docs, items([(10, QUESTION)]))
    assert {(1, 10), (2, 10)} <= got and (4, 10) not in got
    assert (3, 10) not in got  # one value of the item stands against two
    assert (5, 10) in got


def test_copies_in_other_case_or_lines_are_found(frame, items):
    wrapped = QUESTION.replace(" Maria", "\nMaria").replace(" Peter", "\n Peter")
    half = QUESTION.replace("and then Maria sold", "and then maria sold").replace("trader Maria", "trader Alice")
    docs = frame([(1, QUESTION.upper()), (2, QUESTION.lower()), (3, wrapped), (4, f"before it {QUESTION.title()} after"), (5, QUESTION), (6, half), (7, "the trader sold tin to peter")])
    got = {r.doc_id: r for r in T.contaminated(docs, items([(10, QUESTION)])).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert all(got[d].share == 1 for d in (1, 2, 5))
    # an item in capitals is met by its usual spelling, too
    assert found(frame([(1, QUESTION)]), items([(10, QUESTION.upper())])) == {(1, 10)}


def test_forms_have_equally_many_tokens(spark, frame):
    texts = ["5km and 5 km, 3.14 or 1,000 Euro", "So said Anna. Then Bob left", "Straße Élan ist naïve 12min", "12", "  ", "²³ 4ever x9", "of a\ue000b and Anna 5"]
    got = T.with_forms(frame(list(enumerate(texts)))).select("doc_id", "forms").collect()
    assert all(len({len(f) for f in r.forms}) == 1 for r in got)
    forms = {r.doc_id: [" ".join(f) for f in r.forms] for r in got}
    assert forms[0] == ["5km and 5 km 3 14 or 1 000 euro", "##u and # #u # # or # # euro", "##u and # #u # # or # # \ue000"]
    assert forms[1] == ["so said anna then bob left", "so said \ue000 then \ue000 left"]
    assert forms[6][0] == "of a b and anna 5" and forms[6][2] == "of a b and \ue000 #"


def test_nine_tokens_are_found_at_every_offset(frame, items, prose):
    """At least 80 % of the windows, wherever the passage stands."""
    words = prose(9, 1).split()
    rows = [(10 * k + cut, " ".join(prose(20 + k, 100 + k).split() + words[:cut] + prose(20, 300 + k).split())) for k in range(10) for cut in (8, 7)]
    assert found(frame(rows), items([(1, " ".join(words))])) == {(10 * k + 8, 1) for k in range(10)}


def test_short_items_are_found_by_their_own_words(frame, items):
    benchmark = items([(1, "what is the capital of france today"), (2, "Name 5 rivers"), (3, "12 + 30 = 42, so 42 - 30 = 12")])
    rows = [(1, "So: What is the capital of France today?"), (2, "what is the capital of Spain today"), (3, "name 5 rivers"), (4, "Please name 5 rivers"), (5, "name 6 rivers"), (6, "sum 12 30 42 so 42 30 12"), (7, "13 30 43 so 43 30 13"), (8, "what is the capital of")]
    assert found(frame(rows), benchmark) == {(1, 1), (3, 2), (6, 3)}


def test_a_text_of_numbers_doesnt_blow_up(frame, items):
    long = " ".join(str(k % 977) for k in range(20_000))
    benchmark = items([(1, " ".join(str(k) for k in range(900, 960))), (2, "x 0 " * 30), (3, "ha " * 40)])
    rows = [(1, long), (2, "x 1 " * 10_000), (3, "ha " * 20_000), (4, " ".join(str(k) for k in range(1000, 1060)))]
    assert found(frame(rows), benchmark) == {(1, 1), (3, 3)}


def test_rows_of_one_id_are_judged_one_by_one(frame, items):
    rows = [(None, QUESTION), (None, "Nothing of the kind"), (7, QUESTION), (7, "Nothing at all")]
    assert sorted(r.text for r in T.without_contaminated(frame(rows), items([(1, QUESTION)])).collect()) == ["Nothing at all", "Nothing of the kind"]


def test_equals_brute_force_ngrams(frame, items, prose):
    benchmark = [(k, prose(30 + k, 50 + k)) for k in range(12)]
    rows = []
    for i in range(60):
        words = prose(80, 2000 + i).split()
        if i % 3 == 0:
            own = benchmark[i % 12][1].split()
            lo, hi = (0, len(own)) if i % 2 else (3, 3 + 13 + i % 9)
            at = i % 70
            words[at:at] = own[lo:hi]
        elif i % 3 == 1:
            words[10:10] = benchmark[i % 12][1].split()[:8]  # too little
        rows.append((i, " ".join(words)))
    grams = {}
    for k, text in benchmark:
        w = text.split()
        for a in range(len(w) - 12):
            grams.setdefault(tuple(w[a : a + 13]), set()).add(k)
    want = {(i, k) for i, t in rows for a in range(len(t.split()) - 12) for k in grams.get(tuple(t.split()[a : a + 13]), ())}
    assert found(frame(rows), items(benchmark)) == want


def test_edges(frame, edges, empty, items):
    assert found(edges, items([(1, None), (None, QUESTION), (2, ""), (3, "too short an item")])) == set()
    assert found(empty, items([(1, QUESTION)])) == set() and found(edges, items([])) == set()
    twice = items([(1, QUESTION), (1, QUESTION), (2, QUESTION)])
    rows = [(None, QUESTION), (7, QUESTION), (7, QUESTION), (8, "Nothing here")]
    got = T.contaminated(frame(rows), twice).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted([(None, 1), (None, 2), (7, 1), (7, 2)], key=str)
    assert all(r.share == 1 for r in got)
    kept = T.without_contaminated(frame(rows), twice)
    assert [r.doc_id for r in kept.collect()] == [8] and kept.columns == frame(rows).columns


def test_shuffled_when_too_large_to_broadcast(frame, items, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_WINDOWS", 0)
    assert found(frame([(1, QUESTION), (2, "no")]), items([(5, QUESTION)])) == {(1, 5)}


def test_no_python_in_the_plan(frame, items):
    plan = T.contaminated(frame([(1, QUESTION)]), items([(5, QUESTION)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
