from corpusloom.operators.coarse import LexicalScorer
from corpusloom.plans.taxonomy import SYNTHETIC, SYNTHETIC_LABELS
from corpusloom.streaming import incremental

SCORER = LexicalScorer(SYNTHETIC_LABELS)
SCHEMA = "n long, english string"


def add(spark, folder, first, n):
    spark.createDataFrame([(i, f"hah line {i}") for i in range(first, first + n)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_a_second_pass_does_only_what_is_new(spark, tmp_path):
    source, out, at = (f"{tmp_path}/{x}" for x in ("in", "out", "at"))
    add(spark, source, 0, 5)
    add(spark, source, 5, 5)
    go = lambda **k: incremental.stage1_pass(spark, source, SCHEMA, out, at, SCORER, SYNTHETIC, **k)
    first = go()
    assert (first["batches"], first["rows"], first["stopped"]) == (2, 10, False)
    assert incremental.minutes_left(10, 4, 0.1) == 1.0 and incremental.minutes_left(10, 4, 0) is None and first["rows_per_second"] > 0
    assert go()["rows"] == 0
    add(spark, source, 10, 4)
    assert go()["rows"] == 4
    got = spark.read.parquet(out)
    assert sorted(r.n for r in got.collect()) == list(range(14)) and {r.domain for r in got.collect()} == {"Beta"}
    progress = incremental.progress(spark.read.parquet(source), got).first()
    assert (progress.total, progress.done, progress.percent) == (14, 14, 100.0)


def test_a_spent_budget_stops_and_a_later_pass_goes_on(spark, tmp_path):
    source, out, at = (f"{tmp_path}/{x}" for x in ("in", "out", "at"))
    for i in range(3):
        add(spark, source, i * 5, 5)
    go = lambda **k: incremental.stage1_pass(spark, source, SCHEMA, out, at, SCORER, SYNTHETIC, **k)
    assert go(budget_seconds=0)["stopped"]
    assert not go(budget_seconds=120)["stopped"]
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == list(range(15))


def test_labelling_batches_asks_only_for_new_sentences(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    def connect():
        def ask(prompt):
            asked.add(1)
            return "Alpha"

        return ask

    spark.sql("drop table if exists seeds_test")
    run = incremental.label_batch(connect, SYNTHETIC, "seeds_test")
    batch = spark.createDataFrame([("a",), ("a ",), ("b",)], "english string")
    run(batch, 0)
    run(batch, 1)
    assert sorted(r.text for r in spark.table("seeds_test").collect()) == ["a", "b"] and asked.value == 2
    spark.sql("drop table seeds_test")
