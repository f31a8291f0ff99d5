import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import count_matches, normalize_for_model, strip
from corpusloom.operators import cascade, corpus, export, gold, metrics, route, seeds, student
from corpusloom.operators.coarse import LexicalScorer, ModelScorer, PrecomputedScorer, best_of
from corpusloom.plans.taxonomy import COARSE_LABELS, PRODUCTION, RECALL_PROBES, SYNTHETIC, SYNTHETIC_LABELS, Domain, Taxonomy, TaxonomyError

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


def test_strip_is_pythons(spark):
    texts = [SPACES, f"{SPACES}a b{SPACES}", "a", "", f"x{SPACES}y", "​z﻿", None]
    got = [r.s for r in spark.createDataFrame([(t,) for t in texts], "t string").select(strip(F.col("t")).alias("s")).collect()]
    assert got == [t if t is None else t.strip() for t in texts]


def test_normalize(spark):
    got = spark.createDataFrame([(None,), (" a\nb\r\n",)], "t string").select(normalize_for_model(F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == ["", "a b"]


@pytest.mark.parametrize("pattern", ["ana", "ab|ba", "ab|cd", "a.c", "act |b"])
def test_count_matches_is_a_regex_count(spark, pattern):
    texts = ["", "ananana", "abab cdab", "abba", "abcabc act b act c", "anana ana"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(count_matches(F.col("t"), pattern).alias("a"), F.regexp_count("t", F.lit(pattern)).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_a_shared_label_has_the_keywords_of_all_its_domains():
    words = PRODUCTION.label_probes()["Law_and_Government"]
    assert "ministry" in words and "court" in words and "Internet_and_Telecom" not in PRODUCTION.label_probes()


def test_production_taxonomy():
    assert PRODUCTION.names == ["Tech", "Agriculture", "Climate", "Tourism", "Admin", "Health", "Law", "Education", "General"]
    assert PRODUCTION.direct() == {"Computers_and_Electronics": "Tech", "Internet_and_Telecom": "Tech", "Health": "Health", "Jobs_and_Education": "Education"}
    assert PRODUCTION.ambiguous() == ["Business_and_Industrial", "Food_and_Drink", "Law_and_Government", "Science", "Travel_and_Transportation"]
    assert len(COARSE_LABELS) == 26 and sum(r[1] == "general" for r in PRODUCTION.routing_rows()) == 17
    assert set(RECALL_PROBES) <= set(PRODUCTION.names)


@pytest.mark.parametrize(
    ("domains", "fallback"),
    [([Domain("A", "x")], "A"), ([Domain("A", "x"), Domain("B", "y")], "C"), ([Domain("A", " "), Domain("B", "y")], "B"), ([Domain("A", "x"), Domain("B", "y", ("l",))], "B"), ([Domain("A", "x"), Domain("A", "y")], "A")],
)
def test_bad_taxonomies(domains, fallback):
    with pytest.raises(TaxonomyError):
        Taxonomy(tuple(domains), fallback)


def test_route_grid(spark):
    labels = ["Health", "Science", "Law_and_Government", "News", "Unheard_of", None]
    rows = [(x, s) for x in labels for s in (0.0, 0.5999, 0.6, 1.0, None, math.nan)]
    got = route.apply_routing(spark.createDataFrame(rows, "label string, score double"), PRODUCTION).collect()
    assert len(got) == len(rows)
    for r in got:
        sure = r.score is not None and not math.isnan(r.score) and r.score >= 0.6
        want = "finegrain" if not sure or r.label in ("Science", "Law_and_Government") else "direct" if r.label == "Health" else "general"
        assert r.route == want
        assert r.domain == {"finegrain": None, "direct": "Health", "general": "General"}[want]


def test_scorers(spark):
    df = spark.createDataFrame([(1, "hah hah ering"), (2, "ndst edst"), (3, "nothing"), (4, None)], "k long, english string")
    got = {r.k: (r.label, r.score) for r in LexicalScorer(SYNTHETIC_LABELS).score(df).collect()}
    assert got == {1: ("c_hah", pytest.approx(2 / 3)), 2: ("c_edst", 0.5), 3: ("c_none", 0.0), 4: ("c_none", 0.0)}
    known = spark.createDataFrame([(1, "x", 0.7)], "k long, label string, score double")
    assert {r.k: r.label for r in PrecomputedScorer(known, "k").score(df).collect()} == {1: "x", 2: None, 3: None, 4: None}

    def load():
        return lambda texts: ([str(len(t)) for t in texts], [1.0] * len(texts))

    assert {r.k: r.label for r in ModelScorer(load, 2).score(df).collect()} == {1: "13", 2: "9", 3: "7", 4: "0"}
    best = spark.range(1).select(best_of(F.create_map(*(F.lit(x) for x in ("b", 0.4, "a", 0.4, "c", 0.2)))).alias("x")).first().x
    assert (best.label, best.score) == ("a", 0.4)


def test_clean_and_dedupe(spark):
    rows = [(0, " a ", "x"), (1, "a", "x　"), (2, None, "x"), (3, "\xa0", "y"), (4, "b", ""), (5, "NA", "None"), (6, "a", "z")]
    df = corpus.clean_pairs(spark.createDataFrame(rows, "n long, english string, target string"))
    assert sorted(r.n for r in df.collect()) == [0, 1, 5, 6]
    once = corpus.dedupe_pairs(df, [F.col("n")])
    assert sorted(r.n for r in once.collect()) == [0, 5, 6]
    assert corpus.dedupe_pairs(once, [F.col("n")]).count() == 3


def test_union_fills_missing_columns(spark):
    got = corpus.union_sources({"a": spark.createDataFrame([(1, "x")], "id int, english string"), "b": spark.createDataFrame([("y",)], "english string")}).collect()
    assert {(r.id, r.english, r.source_file) for r in got} == {("1", "x", "a"), (None, "y", "b")}


def test_ordinals_have_no_gap(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("k"))
    got = [r.ordinal for r in corpus.with_ordinal(df, ["k"]).orderBy("k").collect()]
    assert got == list(range(1000))
    assert corpus.with_ordinal(df.where("false"), ["k"]).count() == 0


def test_seeds(spark):
    lines = ["__label__Tech a b", "__label__Law x", "no label", "__label__Tech", "__label__ y", "x __label__Law z"]
    got = seeds.parse_seeds(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {(r.label, r.text) for r in got.collect()} == {("Tech", "a b"), ("Law", "x")}
    written = seeds.seed_lines(spark.createDataFrame([("Tech", "a\nb ")], "label string, text string")).first().value
    assert written == "__label__Tech a b"
    answers = spark.createDataFrame([("Tech",), ("tech",), ("Nothing",), (None,)], "label string")
    assert [r.label for r in seeds.on_taxonomy(answers, PRODUCTION).collect()] == ["Tech"]
    todo = seeds.todo(spark.createDataFrame([("a ",), ("a",), ("b\nc",), (" ",), (None,)], "english string"), spark.createDataFrame([("b c",)], "text string"))
    assert [r.text for r in todo.collect()] == ["a"]


def test_samples_are_bounded_and_repeatable(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"))
    a, b = ({r.id for r in seeds.sample(df.repartition(n), 50, "id").collect()} for n in (2, 7))
    assert a == b and len(a) == 50
    assert seeds.sample(df, 1000, "id").count() == 500
    assert {r["count"] for r in seeds.sample_per(df, "g", 20, "id").groupBy("g").count().collect()} == {20}


def test_teacher_skips_failures_and_drops_strangers(spark):
    def connect():
        def ask(prompt):
            text = prompt.rsplit("Sentence: ", 1)[1]
            if "fail" in text:
                raise RuntimeError
            return "Tech\n" if "chip" in text else "somewhere"

        return ask

    got = seeds.teach(spark.createDataFrame([("a chip",), ("fail",), ("other",)], "text string"), PRODUCTION, connect).collect()
    assert [(r.label, r.text) for r in got] == [("Tech", "a chip")]


def test_low_confidence_bucket(spark):
    rows = spark.createDataFrame([(1, "c_edst", "finegrain"), (2, "c_hah", "finegrain"), (3, "c_edst", "direct")], "k long, label string, route string")
    assert {r.k for r in seeds.targeted_seeds(rows, SYNTHETIC, "k").collect()} == {1}
    assert {(r.k, r.bucket) for r in seeds.targeted_seeds(rows, SYNTHETIC, "k", low_confidence=True).collect()} == {(1, "c_edst"), (2, "low_confidence")}


def test_metrics_toy(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", "d")]
    df = spark.createDataFrame(pairs, "truth string, pred string")
    got = {r.label: r for r in metrics.class_report(df).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].f1, got["a"].support) == (0.5, 0.5, 0.5, 2)
    assert (got["c"].precision, got["c"].f1) == (0, 0) and (got["d"].recall, got["d"].support, got["d"].predicted) == (0, 0, 1)
    total = metrics.f1_summary(df).first()
    assert (total.accuracy, total.macro_f1, total.rows) == (0.4, pytest.approx(1 / 4), 5)
    assert total.weighted_f1 == pytest.approx((2 * 0.5 + 2 * 0.5) / 5)
    matrix = {r.truth: (r.a, r.b, r.c) for r in metrics.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert matrix == {"a": (1, 1, 0), "b": (0, 1, 0), "c": (1, 0, 0)}


def test_folds_are_even_and_small_classes_go(spark):
    rows = [(i, "x" if i < 23 else "y") for i in range(33)] + [(99, "rare"), (100, None)]
    got = metrics.assign_folds(spark.createDataFrame(rows, "k long, label string"), "label", "k", 5).collect()
    assert len(got) == 33
    for label, n in (("x", 23), ("y", 10)):
        sizes = [sum(r.label == label and r.fold == f for r in got) for f in range(5)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_export_parts(spark):
    df = spark.range(7).select(F.lit("A").alias("domain"), "id").union(spark.range(6).select(F.lit("B"), F.col("id") + 100)).union(spark.range(2).select(F.lit(None).cast("string"), F.col("id") + 500))
    listed = {(r.domain, r.part): (r.first_row, r.last_row, r.rows) for r in export.part_list(df, "domain", 3).collect()}
    assert listed == {("A", 1): (1, 3, 3), ("A", 2): (4, 6, 3), ("A", 3): (7, 7, 1), ("B", 1): (1, 3, 3), ("B", 2): (4, 6, 3)}
    got = {r.id: r.part for r in export.parts(df, "domain", ["id"], 3).collect()}
    assert got == {i: i // 3 + 1 for i in range(7)} | {100 + i: i // 3 + 1 for i in range(6)}
    shares = {r.domain: (r.pairs, r.share) for r in export.domain_distribution(df).collect()}
    assert shares == {"A": (7, 46.67), "B": (6, 40.0)}
    chunks = export.corpus_chunk_histogram(df, ["id"], 5).collect()
    assert sum(r.rows for r in chunks) == 13 and max(r.chunk for r in chunks) == 3


def test_cascade_contract(spark):
    rows = [(0, "hah hah hah", "src"), (1, " \n", "src"), (2, "edst and edst", "src"), (3, None, None), (4, "plain", "src"), (5, "hah hah hah", "src")]
    df = spark.createDataFrame(rows, "n long, english string, domain string")
    out = cascade.classify(df, SYNTHETIC, LexicalScorer(SYNTHETIC_LABELS), cascade.keyword_stage2(SYNTHETIC))
    got = {r.n: r for r in out.collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5] and out.count() == 6
    assert (got[0].domain, got[0].stage, got[0].confidence, got[0].domain_source) == ("Beta", "stage 1 (direct)", 1.0, "src")
    assert (got[2].domain, got[2].stage, got[2].label, got[2].score) == ("Epsilon", "stage 2 (fasttext)", "c_edst", 1.0)
    assert got[1].stage == got[3].stage == "skipped (empty)" and got[1].domain is None and got[3].confidence is None
    assert (got[4].domain, got[4].confidence) == ("Other", 0.0)
    assert got[2].english == "edst and edst" and got[1].text_norm == ""


def test_stage2_sees_only_its_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def stage2(df):
        def run(frames):
            for pdf in frames:
                seen.add(len(pdf))
                yield pdf

        return df.mapInPandas(run, df.schema).withColumns({"domain": F.lit("Other"), "confidence": F.lit(0.5)})

    df = spark.createDataFrame([(i, "hah" if i % 4 else "edst") for i in range(40)], "n long, english string")
    assert cascade.classify(df, SYNTHETIC, LexicalScorer(SYNTHETIC_LABELS), stage2).collect()
    assert seen.value == 10


def test_gold_set_has_each_text_once(spark):
    rows = [(i, f"text {i % 90} {'edst' if i % 7 == 0 else ''}", ["Alpha", "Beta", None][i % 3]) for i in range(180)]
    df = spark.createDataFrame(rows, "k long, english string, domain string")
    got = gold.gold_set(df, {"Epsilon": ("edst",)}, "k", n=20, per_domain=10, per_probe=5).collect()
    assert len({r.english for r in got}) == len(got)
    assert sum(r.part == "random" for r in got) <= 20 and {r.part for r in got} <= {"random", "stratified", "recall:Epsilon"}
    labelled = spark.createDataFrame([(got[0].english, "Alpha"), (got[1].english, "")], "english string, domain string")
    left = gold.to_label(spark.createDataFrame(got), labelled)
    assert left.count() == len(got) - 1


def test_naive_bayes_equals_its_definition(spark):
    train = [("x", "red red blue"), ("x", "red"), ("y", "green blue"), ("y", "green green yellow"), ("z", "")]
    tests = ["red", "green blue", "unknown words", "yellow red red", "", None]
    model = student.NaiveBayes(spark.createDataFrame(train, "label string, text string"))
    got = {r.k: r.predicted for r in model.predict(spark.createDataFrame(list(enumerate(tests)), "k long, text string"), "k").collect()}
    words = {y: [w for label, t in train if label == y for w in t.split()] for y in "xyz"}
    vocabulary = {w for ws in words.values() for w in ws}
    for k, t in enumerate(tests):
        s = {y: math.log(sum(label == y for label, _ in train)) + sum(math.log((words[y].count(w) + 1) / (len(words[y]) + len(vocabulary))) for w in (t or "").split() if w in vocabulary) for y in "xyz"}
        assert got[k] == min(y for y in s if s[y] >= max(s.values()) - 1e-9)


def test_scores_of_naive_bayes_are_worked_out_once(spark):
    """A sum of doubles varies with the order of a shuffle, so a score that is compared with one worked out anew loses its row."""
    model = student.NaiveBayes(spark.createDataFrame([("x", "red apple"), ("y", "green grass")], "label string, text string"))
    predicted = model.predict(spark.createDataFrame([(1, "red grass apple"), (2, "")], "k long, text string"), "k")
    assert {r.k: r.predicted for r in predicted.collect()} == {1: "x", 2: "x"}
    assert predicted._jdf.queryExecution().optimizedPlan().toString().count("as double) * gain") == 1


def test_folds_put_no_label_into_one_task(spark):
    df = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") == 1, "single").otherwise("common").alias("label"))
    keys = {"rare": [k for k in range(4000) if k % 10 == 0], "common": [k for k in range(4000) if k % 10 and k != 1]}
    want = {k: i % 5 for own in keys.values() for i, k in enumerate(sorted(own, key=lambda k: (hashlib.md5(f"7:{k}".encode()).hexdigest(), k)))}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = metrics.assign_folds(df, "label", "k").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.k: r.fold for r in got} == want
    tasks = [r.task for r in got]
    assert max(map(tasks.count, set(tasks))) < 0.5 * len(tasks)


def test_ml_student_is_kept_by_its_seeds(spark, tmp_path):
    rows = [("x", f"red apple {i}") for i in range(12)] + [("y", f"green grass {i}") for i in range(12)]
    df = spark.createDataFrame(rows, "label string, text string")
    small = {"word_ngrams": 1, "chars": (3, 3), "features": 256, "max_iter": 5}
    student.train(df, str(tmp_path), **small)
    student.train(df, str(tmp_path), **small)
    assert len(list(tmp_path.iterdir())) == 1
    model = student.train(df.union(df.limit(1)), str(tmp_path), **small)
    assert len(list(tmp_path.iterdir())) == 2
    (r,) = student.ranked(model, spark.createDataFrame([(1, "red apple")], "k long, text string"), "k").collect()
    assert [s.label for s in r.scores][0] == "x" and r.scores[0].score >= r.scores[1].score
    assert sum(s.score for s in r.scores) == pytest.approx(1)


def test_metadata_comes_from_the_run(spark):
    df = spark.createDataFrame([("f1", "direct", "A", 0.9), ("f2", "finegrain", None, 0.1)], "source_file string, route string, domain string, score double")
    got = {(r.section, r.item): r.value for r in export.run_metadata(df, {"threshold": "0.6"}, "now").collect()}
    assert got[("run", "rows")] == "2" and got[("source", "files")] == "2" and got[("stage 1", "mean score")] == "0.5000"
    assert got[("domain distribution", "A")] == "1 (50.00%)" and got[("run", "generated")] == "now"
    own = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "z")], "label string, text string")
    got = {(r.section, r.item): r.value for r in export.run_metadata(df, {}, None, {"stage 1": {"model": "m"}}, own, export.COLUMN_NOTES).collect()}
    assert got[("stage 1", "model")] == "m" and got[("stage 2", "seeds")] == "3" and got[("seeds per domain", "A")] == "2"
    assert ("columns", "route") in got and ("columns", "english") not in got
