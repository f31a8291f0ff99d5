import corpus_pipeline as C
import pytest

import __spark_entry__

BENCH = "which of the following quantities would a careful observer measure first when the bridge begins to swing in the evening wind"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(1, BENCH), (None, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def texts(prose):
    english = "the man and the woman walk with their dog to the river where they have been before and talk about this and that {}"
    german = "der mann und die frau gehen mit dem hund an den fluss und sprechen über das wetter und die arbeit im garten {}"
    rows = []
    for i in range(24):
        rows.append((i, (english if i % 2 else german).format(prose(25, i)), "en" if i % 2 else "de", "s", 1))
    rows += [(30, rows[1][1], "en", "s", 1), (31, rows[1][1], "en", "s", 1)]  # copies
    rows += [(32, "12 345 !!!", "en", "s", 1), (33, None, "en", "s", 1), (34, "", None, "s", 0)]  # no letter
    rows += [(35, f"the text says: {BENCH} and that is all the man had to say about this {prose(9, 77)}", "en", "s", 1)]
    return rows


def test_stages_take_effect_and_keep_clean_documents(spark, frame, prose, sf_dir):
    docs = frame(texts(prose))
    columns, left = docs.columns, []
    for name, stage in C.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(24))
    assert left == [clean | {30, 31, 35}, clean | {30, 31, 35}, clean | {35}, clean, clean]
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} == set(docs.columns)


def test_stages_keep_texts_of_one_id_and_source_columns(spark, frame, prose, sf_dir):
    """What a plain loop over the rows keeps, with the columns' own values."""
    from pyspark.sql import functions as F

    words = "the man and the woman walk with their dog to the river {}"
    rows = [(1, words.format(prose(40, 1)), "en", "s", 1), (1, words.format(prose(40, 2)), "en", "s", 1), (None, words.format(prose(40, 3)), "en", "s", 1)]
    rows += [(10 + k, f"{words.format(prose(40, 10 + k))}\nAll rights reserved here", "en", "s", 1) for k in range(12)]
    docs = frame(rows).withColumn("n_lines", F.lit(-5))
    text = lambda t, d: t.split("\n")[0] if d and d > 10 else t
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    got = docs.select("doc_id", "text", "n_dropped", "n_lines", "score", "n_chars").collect()
    want = [(d, text(t, d), -1, -5, -1, len(text(t, d)) if text(t, d) != t else 1) for d, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("stage", [s for _, s in C.STAGES])
def test_stages_take_edges(spark, edges, empty, sf_dir, stage):
    assert stage(spark, empty, sf_dir).collect() == []
    assert len(stage(spark, edges, sf_dir).collect()) <= edges.count()


def test_run_reads_documents(spark, frame, prose, sf_dir):
    frame(texts(prose)).write.mode("overwrite").parquet(f"{sf_dir}/documents.parquet")
    assert {r.doc_id for r in C.run(spark, sf_dir).collect()} == set(range(24))


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
