import os

import duckdb
import pytest

import __spark_entry__
from corpusloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted(tuple(text(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, got.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_students_see_whole_texts(spark, tmp_path):
    """Texts that differ behind their first 400 characters only."""
    marks = ["kind", "stupid idiot", "%%% noise", "%%% stupid trash"]
    docs = [(i, f"{'the same beginning of all texts ' * 20}{marks[i % 4]} {'and end' * (i % 3)}", "en") for i in range(80)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1 - i % 4 // 2, i % 2) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    truth = ["good_clean", "good_toxic", "poor_clean", "poor_toxic"]
    got = catalog.queries()["ml_student"](spark, str(tmp_path)).collect()
    assert len(got) == 16 and all(r.predicted == truth[r.doc_id % 4] for r in got)
    top = catalog.queries()["stage2_topk"](spark, str(tmp_path)).where("rank = 0").collect()
    assert len(top) == 16 and all(r.label == truth[r.doc_id % 4] for r in top)


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["domain", "pairs", "share"] and df.count() > 0


def test_sql_names_are_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
