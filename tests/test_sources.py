import io
import zipfile

import pytest

from corpusloom import cli
from corpusloom.operators import export, layout
from corpusloom.sources import books, files, xlsx

EN = [f"this is sentence {i} and it was written for the test" for i in range(6)]
NE = [f"यो वाक्य {i} हो" for i in range(6)]


def test_expand_lists_kinds_in_order(tmp_path):
    for n in ("b.csv", "a.csv", "z.xlsx", "y.xlsm", "skip.txt"):
        (tmp_path / n).touch()
    names = lambda paths: [p.rsplit("/", 1)[1] for p in paths]
    assert names(files.expand([str(tmp_path)])) == ["z.xlsx", "y.xlsm", "a.csv", "b.csv"]
    assert names(files.expand([f"{tmp_path}/*.csv", f"{tmp_path}/none.csv"])) == ["a.csv", "b.csv", "none.csv"]


def test_xlsx_round_trip(tmp_path):
    rows = [("a", 1, None), ("<&>\n x ", 2.5, "é\x01"), (None, None, "end")]
    xlsx.write_book(tmp_path / "x.xlsx", ["english", "n", "c"], rows, [("run", "k", "v")], sheet="s" * 40)
    assert xlsx.read_rows(tmp_path / "x.xlsx") == [("english", "n", "c"), ("a", "1"), ("<&>\n x ", "2.5", "é"), (None, None, "end")]
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        assert ("s" * 31).encode() in z.read("xl/workbook.xml") and b"frozen" in z.read("xl/worksheets/sheet1.xml")
        assert b'width="46"' in z.read("xl/worksheets/sheet1.xml") and b'width="72"' in z.read("xl/worksheets/sheet2.xml")
    assert [xlsx.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_xlsx_data_source(spark, tmp_path):
    xlsx.write_book(tmp_path / "x.xlsx", ["ID", "src", "tgt"], zip(range(6), EN, NE, strict=True))
    spark.dataSource.register(xlsx.XlsxSource)
    df = spark.read.format("xlsx").load(f"{tmp_path}/x.xlsx")
    assert df.columns == ["ID", "src", "tgt"] and [r.src for r in df.collect()] == EN


def test_reading_csv_with_bom_and_quoted_newlines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('english,target\n"one\ntwo ""q""",क\nNA,None\n,x\n', encoding="utf-8-sig")
    rows = files.read_parallel(spark, f"{tmp_path}/a.csv").collect()
    assert [(r.english, r.target) for r in rows] == [('one\ntwo "q"', "क"), ("NA", "None"), (None, "x")]
    rows = files.read_raw(spark, f"{tmp_path}/a.csv", na_values=["NA"]).collect()
    assert rows[1].english is None


@pytest.mark.parametrize("swap", [False, True])
def test_headerless_csv(spark, tmp_path, swap):
    pairs = [(n, e) if swap else (e, n) for e, n in zip(EN, NE, strict=True)]
    (tmp_path / "h.csv").write_text("\n".join(",".join(p) for p in pairs), encoding="utf-8-sig")
    rows = files.read_parallel(spark, f"{tmp_path}/h.csv").orderBy("row_number").collect()
    assert [(r.english, r.target) for r in rows] == list(zip(EN, NE, strict=True))


def test_empty_files_are_refused(spark, tmp_path):
    (tmp_path / "e.csv").write_text("english,target\n")
    with pytest.raises(layout.DetectionError, match="no rows"):
        files.read_parallel(spark, f"{tmp_path}/e.csv")


def test_corpus_keeps_the_first_of_two_files(spark, tmp_path):
    xlsx.write_book(tmp_path / "a.xlsx", ["ID", "src", "tgt"], zip("uvwxyz", EN, NE, strict=True))
    (tmp_path / "b.csv").write_text("SOURCE,TARGET\n" + "\n".join(f"{e} ,{n}" for e, n in zip([*EN[:2], "new one", " "], [*NE[:2], "नयाँ", "क"], strict=True)), encoding="utf-8-sig")
    got = {(r.id, r.english, r.source_file) for r in files.build_corpus(spark, files.expand([str(tmp_path)])).collect()}
    assert got == {(i, e, "a.xlsx") for i, e in zip("uvwxyz", EN, strict=True)} | {(None, "new one", "b.csv")}


def test_bom_is_put_once(tmp_path):
    (tmp_path / "x.csv").write_bytes(b"a\n")
    assert files.repair_bom([f"{tmp_path}/x.csv"]) == [f"{tmp_path}/x.csv"]
    assert files.repair_bom([f"{tmp_path}/x.csv"]) == []
    assert (tmp_path / "x.csv").read_bytes() == files.BOM + b"a\n"


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(i, f"e{i}", f"t{i}", "f", "A" if i < 7 else "B" if i < 10 else None, "direct", 0.5) for i in range(11)]
    return spark.createDataFrame(rows, "n long, english string, target string, source_file string, domain string, route string, score double")


def test_books(spark, classified, tmp_path):
    meta = export.run_metadata(classified, {})
    paths = books.write_domains(classified, meta, str(tmp_path), ["n"], 3)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a_part01.xlsx", "a_part02.xlsx", "a_part03.xlsx", "b.xlsx"]
    assert [r[1] for r in xlsx.read_rows(paths[1])[1:]] == ["e3", "e4", "e5"]
    chunks = books.write_chunks(classified, meta, f"{tmp_path}/c", ["n"], 4)
    assert [r[0] for p in chunks for r in xlsx.read_rows(p)[1:]] == [str(i) for i in range(11)]
    books.write_summary(classified, meta, f"{tmp_path}/s.xlsx", 3)
    assert [(r[0], r[1], r[4]) for r in xlsx.read_rows(f"{tmp_path}/s.xlsx")[1:]] == [("A", "7", "3"), ("B", "3", "1")]
    assert books.zip_domains(classified, f"{tmp_path}/z.zip", ["n"]) == ["a.xlsx", "b.xlsx", "_summary.xlsx"]
    with zipfile.ZipFile(f"{tmp_path}/z.zip") as z:
        assert len(xlsx.read_rows(io.BytesIO(z.read("a.xlsx")))) == 8


def test_splits(spark, classified, tmp_path):
    files.write_splits(classified, f"{tmp_path}/p")
    got = spark.read.parquet(f"{tmp_path}/p")
    assert {(r.domain_file, r["count"]) for r in got.groupBy("domain_file").count().collect()} == {("a", 7), ("b", 3)}
    (tmp_path / "old").mkdir()
    (tmp_path / "old/gone.csv").touch()
    assert files.export_domains(classified, f"{tmp_path}/old") == {"A": 7, "B": 3}
    assert sorted(p.name for p in (tmp_path / "old").iterdir()) == ["a.csv", "b.csv"]
    assert (tmp_path / "old/b.csv").read_bytes().startswith(files.BOM)


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "local_session", lambda *_: spark)
    (tmp_path / "in").mkdir()
    texts = ["the new software for the computer network", "farm crop and soil of the harvest", "the court and the tribunal", "they had been there before this"]
    (tmp_path / "in/a.csv").write_text("english,target\n" + "\n".join(f"{t},x{i}" for i, t in enumerate(texts)), encoding="utf-8-sig")
    run = lambda *a: cli.main(["--work", f"{tmp_path}/w", *a])
    with pytest.raises(SystemExit):
        run("probe")
    for command in (["build", f"{tmp_path}/in", "--dry-run"], ["build", f"{tmp_path}/in"], ["taxonomy"], ["probe"], ["stage1"], ["status"], ["seed"], ["seed-targeted"], ["finish"], ["export", "--rows", "2"], ["export", "--chunks"], ["make-gold"], ["predict", texts[0]], ["fix-bom", f"{tmp_path}/w/*.csv"]):
        assert run(*command) == 0, command
    assert sorted(p.name for p in (tmp_path / "w/domain_splits").iterdir()) == ["agriculture.csv", "general.csv", "law.csv", "tech.csv"]
    assert (tmp_path / "w/gold/gold_to_label.csv").exists() and (tmp_path / "w/classified.csv").exists()
    (tmp_path / "gold.csv").write_text("truth,pred,part\nA,A,random\nB,A,random\n")
    assert run("evaluate", f"{tmp_path}/gold.csv") == 0
    (tmp_path / "w/seeds").mkdir()
    words = {"Tech": "software computer", "Law": "court tribunal", "Admin": "ministry notice"}
    (tmp_path / "w/seeds/mine.txt").write_text("\n".join(f"__label__{d} the {w} number {i}" for d, w in words.items() for i in range(6)), encoding="utf-8")
    assert run("finish", "--no-combined") == 0
    got = {r.english: r for r in spark.read.parquet(f"{tmp_path}/w/classified").collect()}
    assert len(got) == 4 and got[texts[2]].domain == "Law" and got[texts[2]].route == "finegrain" and got[texts[2]].confidence < 1
    (tmp_path / "gold_rows.csv").write_text("english,part,domain\n" + f"{texts[2]},random,Law\n{texts[0]},recall:Law,Tech\n{texts[1]},random,\n")
    before = capsys.readouterr().out
    assert run("evaluate", f"{tmp_path}/gold_rows.csv") == 0
    report = capsys.readouterr().out
    assert "recall" in report and "no seeds" not in report and "|Law  |" in report
    assert run("status") == 0 and "Admin" in capsys.readouterr().out
    (tmp_path / "always_law.py").write_text("def connect():\n    return lambda prompt: 'Law'\n")
    spark.sparkContext.addPyFile(f"{tmp_path}/always_law.py")
    assert run("seed", "--teacher", "always_law:connect") == 0 and "4 seeds added" in capsys.readouterr().out
    assert run("seed-targeted", "--teacher", "always_law:connect") == 0 and "0 seeds added" in capsys.readouterr().out
    for out in ("p.csv", "p.xlsx", "p.zip"):
        assert run("predict-file", f"{tmp_path}/in/a.csv", "--out", f"{tmp_path}/{out}") == 0
    assert len(xlsx.read_rows(f"{tmp_path}/p.xlsx")) == 5 and (tmp_path / "p.csv").read_text(encoding="utf-8-sig").count("\n") == 5
    (tmp_path / "seeds.txt").write_text("\n".join(f"__label__{d} {w} number {i}" for d, w in (("Tech", "computer"), ("Law", "court")) for i in range(6)))
    assert run("evaluate-seeds", f"{tmp_path}/seeds.txt", "--folds", "3") == 0
    monkeypatch.setattr("sys.stdin", io.StringIO("1\ns\n9\nq\n"))
    assert run("label-gold") == 0
    monkeypatch.setattr("sys.stdin", io.StringIO("2\nq\n"))
    assert run("label-gold") == 0
    assert "stage 1 (direct)" in (said := before + capsys.readouterr().out) and "2 labelled" in said and "3 labelled" in said
