import os
import random

import duckdb
import pytest

from corpusloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are absent")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    got = con.execute(queries.oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in got.description], got.fetchall())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_runs_over_whole_tables(spark, name):
    df = queries.queries()[name](spark, SF)
    assert "doc_id" in df.columns and df.count() > 0


def test_decontamination_sql_with_names_numbers_and_units(spark, tmp_path, prose):
    item = "In 2019, the trader Maria Lopez bought 12 km of cable for 30 dollars, and then Maria sold 5kg of tin to Peter, Paul and Mary for 30 dollars."
    other = item.replace("Maria", "Alice").replace("12 km", "7 miles").replace("30", "45").replace("Peter, Paul", "Bob, Carl")
    clash = other.replace("for 45 dollars.", "for 46 dollars.").replace("then Alice", "then Carol")
    docs = [(1, item), (2, f"Before it. {other} After it."), (3, clash), (4, item[40:]), (5, "nothing of the kind"), (6, None), (7, f"{item}\n{other}"), (8, item.lower()), (9, item.upper().replace(" ", "\n")), (10, "Short"), (11, "so short"), (12, f"{prose(31, 1)} {item[:48]} {prose(9, 2)}"), (None, item)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, "Maria bought 12 km of cable"), (5, item[:48])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = queries.queries()["op1_template_decontam"](spark, str(tmp_path))
    got = con.execute(queries.oracle_sql()["op1_template_decontam"])
    want = rows([d[0] for d in got.description], got.fetchall())
    assert rows(df.columns, df.collect()) == want and len(want) >= 8


def test_line_template_sql_with_families_of_lines(spark, tmp_path, prose):
    from test_line_and_substring import families

    lines = families(random.Random(5))
    docs = [(d, f"{prose(5, d)}\n\n {x} \n{y}") for (d, x, _), (_, y, _) in zip(lines, reversed(lines), strict=True)] + [(-1, None), (-2, ""), (-3, "\n \n")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    df = queries.queries()["op6_line_templates"](spark, str(tmp_path))
    got = con.execute(queries.oracle_sql()["op6_line_templates"])
    want = rows([d[0] for d in got.description], got.fetchall())
    assert rows(df.columns, df.collect()) == want and sum(int(r[1]) for r in want) > 50
