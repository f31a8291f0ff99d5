"""Commands over files and the shared checkpoint folder: ``python -m corpusloom.cli COMMAND``."""

from __future__ import annotations

import argparse
import csv
import importlib
import sys
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from .functions.text import normalize_for_model
from .operators import cascade, export, gold, metrics, route, seeds, student
from .operators.coarse import LexicalScorer
from .plans.taxonomy import PRODUCTION, RECALL_PROBES
from .session import local_session, stored
from .sources import books, files
from .streaming import incremental

#: Until a network is plugged in, the coarse labels come from the domains' probes.
SCORER = LexicalScorer({label: "|".join(words) for label, words in PRODUCTION.label_probes().items()}, none_label="News", none_score=0.0)
#: Fixed value: rows of an uploaded file that are classified.
UPLOAD_ROWS = 200_000
CORPUS = "id string, english string, target string, source_file string, row_number long"


class Work:
    """The places of a working folder."""

    def __init__(self, folder: str):
        self.folder = Path(folder)
        names = ("corpus", "stage1", "stage1_checkpoint", "classified", "domain_splits", "workbooks", "gold", "seeds", "models")
        self.corpus, self.stage1, self.checkpoint, self.classified, self.splits, self.books, self.gold, self.seeds, self.models = (str(self.folder / x) for x in names)

    def need(self, path: str, what: str) -> str:
        if not Path(path).exists():
            raise SystemExit(f"{path} is missing: {what} first")
        return path


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--work", default="work")
    sub = ap.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="files to one corpus")
    b.add_argument("paths", nargs="+")
    b.add_argument("--dry-run", action="store_true", help="only say which column is which")
    sub.add_parser("taxonomy")
    sub.add_parser("probe")
    sub.add_parser("status")
    s = sub.add_parser("stage1")
    s.add_argument("--budget", type=float)
    teacher = argparse.ArgumentParser(add_help=False)
    teacher.add_argument("--teacher", help="module:function that opens a teacher, a function from a prompt to its answer")
    sub.add_parser("seed", parents=[teacher])
    sub.add_parser("seed-targeted", parents=[teacher])
    f = sub.add_parser("finish")
    f.add_argument("--no-combined", action="store_true")
    e = sub.add_parser("export")
    e.add_argument("--rows", type=int, default=export.PART_ROWS)
    e.add_argument("--summary", action="store_true")
    e.add_argument("--domain")
    e.add_argument("--chunks", action="store_true")
    g = sub.add_parser("make-gold")
    g.add_argument("--random", type=int, default=gold.RANDOM)
    g.add_argument("--per-domain", type=int, default=gold.PER_DOMAIN)
    g.add_argument("--recall", type=int, default=gold.PER_PROBE)
    v = sub.add_parser("evaluate")
    v.add_argument("labelled", nargs="?", help="a CSV with english, part and the true domain, classified here, or with truth, pred and part; by default the labelled gold set")
    r = sub.add_parser("fix-bom")
    r.add_argument("paths", nargs="+")
    p = sub.add_parser("predict")
    p.add_argument("sentences", nargs="*", help="or one per line on the standard input")
    pf = sub.add_parser("predict-file", help="classify a file's English side")
    pf.add_argument("path")
    pf.add_argument("--out", default="predicted.csv", help=".csv, .xlsx, or .zip of a workbook per domain")
    pf.add_argument("--limit", type=int, default=UPLOAD_ROWS)
    es = sub.add_parser("evaluate-seeds", help="k-fold of the student against seed lines")
    es.add_argument("seeds")
    es.add_argument("--folds", type=int, default=5)
    sub.add_parser("label-gold", help="label the gold set by hand, its predictions hidden")
    sub.add_parser("all", parents=[teacher], help="stage1, seed, seed-targeted, finish, evaluate")
    args = ap.parse_args(argv)
    if args.command == "taxonomy":
        for label, outcome, domain, who in PRODUCTION.routing_rows():
            print(f"{label:28} {outcome:10} {domain or '-':12} {who}")
        return 0
    if args.command == "fix-bom":
        print(*files.repair_bom(files.expand(args.paths)), sep="\n")
        return 0
    spark, work = local_session("corpusloom"), Work(args.work)
    return {"build": _build, "probe": _probe, "status": _status, "stage1": _stage1, "seed": _seed, "seed-targeted": _seed, "finish": _finish, "export": _export, "make-gold": _gold, "evaluate": _evaluate, "predict": _predict, "predict-file": _predict_file, "evaluate-seeds": _evaluate_seeds, "label-gold": _label_gold, "all": _all}[args.command](spark, work, args)


def _corpus(spark, work):
    return spark.read.parquet(work.need(work.corpus, "build the corpus"))


def _build(spark, work, args):
    paths = files.expand(args.paths)
    if args.dry_run:
        for path in paths:
            try:
                print(path, *files.read_parallel(spark, path).columns)
            except files.layout.DetectionError as e:
                print(path, e)
        return 0
    files.build_corpus(spark, paths).drop("_file").write.mode("overwrite").parquet(work.corpus)
    print(spark.read.parquet(work.corpus).count(), "pairs")
    return 0


def _probe(spark, work, args):
    df = _corpus(spark, work)
    df.agg(F.count("*").alias("rows"), *(F.count_if(F.lower("english").rlike("|".join(k))).alias(d) for d, k in PRODUCTION.probes.items())).show(truncate=False)
    return 0


def _status(spark, work, args):
    done = spark.read.parquet(work.stage1) if Path(work.stage1).exists() else spark.createDataFrame([], "english string")
    incremental.progress(_corpus(spark, work), done).show()
    if Path(work.seeds).exists():
        seeds.distribution(_seeds(spark, work), "label").orderBy(F.desc("count"), "label").show(1000, truncate=False)
    return 0


def _stage1(spark, work, args):
    work.need(work.corpus, "build the corpus")
    print(incremental.stage1_pass(spark, work.corpus, CORPUS, work.stage1, work.checkpoint, SCORER, PRODUCTION, budget_seconds=getattr(args, "budget", None)))
    return 0


def _routed(spark, work):
    return spark.read.parquet(work.need(work.stage1, "run stage1")).withColumn("key", F.sha2("english", 256))


def _seeds(spark, work):
    """label and text of the seed lines on the taxonomy, of which any text file may be put into the folder."""
    lines = spark.read.text(work.seeds) if Path(work.seeds).exists() else spark.createDataFrame([], "value string")
    return seeds.on_taxonomy(seeds.parse_seeds(lines), PRODUCTION)


def _student(spark, work):
    """The stage 2 trained on the seeds, kept until they change; with seeds of less than two domains, by keywords."""
    rows = _seeds(spark, work)
    if rows.select("label").distinct().count() < 2:
        print("no seeds of two domains: stage 2 goes by keywords")
        return cascade.keyword_stage2(PRODUCTION)
    return student.stage2(student.train(rows, work.models, **student.SENTENCE_SIZE))


def _seed(spark, work, args):
    """A teacher's answers become seed lines; without a teacher the sentences to label are listed."""
    return _sow(spark, work, args.teacher, args.command == "seed-targeted")


def _sow(spark, work, teacher, targeted):
    rows = _routed(spark, work)
    chosen = seeds.targeted_seeds(rows, PRODUCTION, "key") if targeted else seeds.random_seeds(rows, PRODUCTION, "key")
    wanted = seeds.todo(chosen, _seeds(spark, work))
    if teacher is None:
        print(files.export_csv(wanted.select(F.col("text").alias("english")), f"{work.folder}/to_label.csv"), "sentences to label")
        return 0
    module, name = teacher.split(":")
    # The answers are stored first: the folder that they are appended to is read to find what is left to do.
    answers = stored(seeds.teach(wanted, PRODUCTION, getattr(importlib.import_module(module), name)), "answers")
    seeds.seed_lines(answers).write.mode("append").text(work.seeds)
    print(answers.count(), "seeds added")
    return 0


def _finish(spark, work, args):
    """Stage 2 over what stage 1 has stored; stage 1 isn't run again."""
    rows = spark.read.parquet(work.need(work.stage1, "run stage1")).withColumn("text_norm", normalize_for_model(F.col("english")))
    out = cascade.decide(rows, _student(spark, work)).withColumn("stage", route.stage_of(F.col("route")))
    out.write.mode("overwrite").parquet(work.classified)
    out = spark.read.parquet(work.classified)
    print(files.export_domains(out, work.splits))
    if not getattr(args, "no_combined", False):
        files.export_csv(out, f"{args.work}/classified.csv")
    export.domain_distribution(out).orderBy(F.desc("pairs"), "domain").show()
    return 0


def _classified(spark, work):
    return spark.read.parquet(work.need(work.classified, "finish"))


def _export(spark, work, args):
    df = _classified(spark, work)
    models = {"stage 1": {"model": type(SCORER).__name__, "labels": str(len(PRODUCTION.labels))}, "stage 2": {"model": "softmax over n-grams", **{k: str(v) for k, v in student.SENTENCE_SIZE.items()}}}
    meta = export.run_metadata(df, {"threshold": str(route.THRESHOLD)}, datetime.now().strftime("%Y-%m-%d %H:%M:%S"), models, _seeds(spark, work), export.COLUMN_NOTES)
    books.write_summary(df, meta, f"{work.books}/domain_summary.xlsx", args.rows)
    if args.chunks and not args.summary:
        print(*books.write_chunks(df, meta, f"{work.books}/chunks", ["source_file", "row_number"], args.rows), sep="\n")
    elif not args.summary:
        print(*books.write_domains(df, meta, work.books, ["source_file", "row_number"], args.rows, args.domain), sep="\n")
    return 0


def _gold(spark, work, args):
    df = _classified(spark, work).withColumn("key", F.sha2(F.concat_ws("\0", "english", "target"), 256))
    chosen = gold.gold_set(df, RECALL_PROBES, "key", n=args.random, per_domain=args.per_domain, per_probe=args.recall).join(df.select("key", "target").dropDuplicates(["key"]), "key")
    print(files.export_csv(chosen.orderBy("shuffle").select("english", "target", "part", "predicted", F.lit("").alias("domain")), f"{work.gold}/gold_to_label.csv"), "rows to label")
    return 0


def _evaluate(spark, work, args):
    """Both stages over the labelled gold rows, reported by part: the parts measure different things."""
    df = spark.read.csv(args.labelled or work.need(f"{work.gold}/gold_labelled.csv", "label-gold"), header=True, multiLine=True, escape='"')
    if "pred" not in df.columns:
        rows = df.where("domain is not null and trim(domain) <> ''").withColumnRenamed("domain", "truth")
        df = cascade.classify(rows, PRODUCTION, SCORER, _student(spark, work)).withColumnRenamed("domain", "pred")
    df = stored(df.withColumn("part", F.regexp_replace("part", ":.*", "") if "part" in df.columns else F.lit("all")).select("truth", "pred", "part"), "judged")
    metrics.class_report(df, ("part",)).orderBy("part", "label").show(1000, truncate=False)
    metrics.f1_summary(df, ("part",)).orderBy("part").show()
    metrics.f1_summary(df).show()
    names = [*PRODUCTION.names, *(r.truth for r in df.select("truth").distinct().orderBy("truth").collect() if r.truth is not None and r.truth not in PRODUCTION.names)]
    metrics.confusion_matrix(df, names).orderBy("truth").show(1000, truncate=False)
    return 0


def _predict(spark, work, args):
    texts = args.sentences or [x.rstrip("\n") for x in sys.stdin]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, english string")
    cascade.classify(df, PRODUCTION, SCORER, cascade.keyword_stage2(PRODUCTION)).orderBy("n").select(F.substring("english", 1, 70).alias("english"), "domain", "stage", "label", "score", "confidence").show(1000, truncate=False)
    return 0


def _predict_file(spark, work, args):
    raw = files.read_parallel(spark, args.path)
    df = stored(cascade.or_unclassified(cascade.classify(raw.orderBy("row_number").limit(args.limit), PRODUCTION, SCORER, cascade.keyword_stage2(PRODUCTION))), "predicted")
    meta = export.run_metadata(df.withColumn("source_file", F.lit(Path(args.path).name)), {"threshold": str(route.THRESHOLD)})
    rows = df.orderBy("row_number").drop("row_number")
    if args.out.endswith(".zip"):
        print(*books.zip_domains(df, args.out, ["row_number"]))
    elif args.out.endswith(".xlsx"):
        books.xlsx.write_book(args.out, rows.columns, (tuple(r) for r in rows.toLocalIterator()), [tuple(r) for r in meta.collect()])
    else:
        files.export_csv(rows, args.out)
    export.domain_distribution(df).orderBy(F.desc("pairs"), "domain").show()
    return 0


def _evaluate_seeds(spark, work, args):
    rows = seeds.parse_seeds(spark.read.text(args.seeds)).dropDuplicates(["text"]).withColumn("key", F.sha2("text", 256))
    found = stored(student.cross_validate(rows, "key", args.folds), "folds")
    metrics.class_report(found).orderBy("label").show(1000, truncate=False)
    metrics.f1_summary(found, ("fold",)).orderBy("fold").show()
    metrics.f1_summary(found).show()
    names = sorted(r.truth for r in found.select("truth").distinct().collect())
    metrics.confusion_matrix(found, names).orderBy("truth").show(1000, truncate=False)
    return 0


def _label_gold(spark, work, args):
    """1 to 9 choose a domain, s skips, q quits; each answer is saved at once, and a later session goes on."""
    at, done = Path(work.need(f"{work.gold}/gold_to_label.csv", "make-gold")), Path(f"{work.gold}/gold_labelled.csv")
    read = lambda p: list(csv.DictReader(p.open(encoding="utf-8-sig", newline=""))) if p.exists() else []
    labelled = read(done)
    known = {r["english"] for r in labelled if r["domain"]}
    for r in read(at):
        if r["english"] in known:
            continue
        print(r["english"][:300])
        print(*(f"{i} {d}" for i, d in enumerate(PRODUCTION.names, 1)))
        answer = sys.stdin.readline().strip()
        if answer in ("q", ""):
            break
        if answer.isdigit() and 1 <= int(answer) <= len(PRODUCTION.names):
            labelled.append({**r, "domain": PRODUCTION.names[int(answer) - 1]})
            with done.open("w", encoding="utf-8-sig", newline="") as f:
                out = csv.DictWriter(f, list(r))
                out.writeheader()
                out.writerows(labelled)
    print(len(labelled), "labelled")
    return 0


def _all(spark, work, args):
    _stage1(spark, work, args)
    _sow(spark, work, args.teacher, False)
    _sow(spark, work, args.teacher, True)
    _finish(spark, work, args)
    if not Path(f"{work.gold}/gold_labelled.csv").exists():
        print("no labelled gold set, so nothing to evaluate")
        return 0
    args.labelled = None
    return _evaluate(spark, work, args)


if __name__ == "__main__":
    sys.exit(main())
