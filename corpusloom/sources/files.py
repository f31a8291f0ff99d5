"""Raw files: expanding patterns, reading CSV and XLSX pairs, BOM, per-domain output."""

from __future__ import annotations

import glob
import os
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus, layout
from ..session import stored
from . import xlsx

BOM = b"\xef\xbb\xbf"
#: The kinds of input, in the order in which a folder's files are listed.
KINDS = (".xlsx", ".xlsm", ".xls", ".csv")


def expand(patterns: list[str]) -> list[str]:
    """Files of folders (by kind, then name), globs (by name) and plain paths, in the order given."""
    out: list[str] = []
    for pattern in patterns:
        if os.path.isdir(pattern):
            for kind in KINDS:
                out += sorted(glob.glob(os.path.join(glob.escape(pattern), f"*{kind}")))
        else:
            out += sorted(glob.glob(pattern)) or [pattern]
    return out


def _csv(spark: SparkSession, path: str, header: bool, na_values: list[str]) -> DataFrame:
    df = spark.read.csv(path, header=header, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False)
    if not header and df.columns:
        df = df.withColumn(df.columns[0], F.regexp_replace(df.columns[0], "^﻿", ""))
    for c in df.columns if na_values else []:
        df = df.withColumn(c, F.when(~F.col(f"`{c}`").isin(*na_values), F.col(f"`{c}`")))
    return df


def read_raw(spark: SparkSession, path: str, na_values: list[str] | None = None) -> DataFrame:
    """A file's rows as text columns, and their place as row_number; a header row that is data is read as data.

    Cells such as ``NA`` or ``None`` are text unless ``na_values`` lists them.
    """
    if path.lower().endswith((".xlsx", ".xlsm")):
        rows = xlsx.read_rows(path)
        width = max(map(len, rows), default=0)
        rows = [tuple((*r, *[None] * (width - len(r)))) for r in rows]
        names = [str(x) if x is not None else f"Unnamed: {i}" for i, x in enumerate(rows[0])] if rows else []
        if layout.headerless(names):
            names = [f"c{i}" for i in range(width)]
        else:
            rows = rows[1:]
        schema = ", ".join(["row_number long", *(f"`{n}` string" for n in names)])
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    if path.lower().endswith(".xls"):
        raise layout.DetectionError(f"{path}: the old binary .xls isn't read; save it as .xlsx or .csv")
    df = _csv(spark, path, True, na_values or [])
    if layout.headerless(df.columns):
        df = _csv(spark, path, False, na_values or [])
    return df.select(F.monotonically_increasing_id().alias("row_number"), *(F.col(f"`{c}`").alias("row_number_source" if c == "row_number" else c) for c in df.columns))


def read_parallel(spark: SparkSession, path: str, target: str = "target", na_values: list[str] | None = None) -> DataFrame:
    """row_number, id (if there is one), english and ``target`` of a file; DetectionError if it is empty or unclear."""
    df = read_raw(spark, path, na_values)
    if df.isEmpty():
        raise layout.DetectionError(f"{os.path.basename(path)} has no rows")
    return corpus.normalize_frame(df, "row_number", target)


def build_corpus(spark: SparkSession, paths: list[str], target: str = "target") -> DataFrame:
    """All files' usable pairs, the first of exact duplicates by file order and place: id, english, target, source_file."""
    frames = {}
    for i, path in enumerate(paths):
        frames[i] = read_parallel(spark, path, target).withColumns({"_file": F.lit(i), "_name": F.lit(os.path.basename(path))})
    merged = corpus.union_sources({str(i): f for i, f in frames.items()})
    if "id" not in merged.columns:
        merged = merged.withColumn("id", F.lit(None).cast("string"))
    clean = corpus.clean_pairs(merged, "english", target)
    kept = corpus.dedupe_pairs(clean, [F.col("_file"), F.col("row_number")], "english", target)
    return kept.select("id", "english", target, F.col("_name").alias("source_file"), "_file", "row_number")


def repair_bom(paths: list[str]) -> list[str]:
    """Puts a byte order mark before the files that lack one, each replaced at once; returns those changed."""
    changed = []
    for path in paths:
        data = Path(path).read_bytes()
        if not data.startswith(BOM):
            with tempfile.NamedTemporaryFile(dir=os.path.dirname(path) or ".", delete=False) as f:
                f.write(BOM + data)
            os.replace(f.name, path)
            changed.append(path)
    return changed


def write_splits(df: DataFrame, folder: str) -> None:
    """A Parquet folder per domain (domain_file=<name>), none for a domain without rows; older ones go."""
    df.where("domain is not null").withColumn("domain_file", F.lower("domain")).write.partitionBy("domain_file").mode("overwrite").parquet(folder)


def by_domain(df: DataFrame) -> tuple[list[str], Callable[[str], DataFrame]]:
    """The domains that have rows, and a domain's rows: the table is dealt out once, then each read alone."""
    dealt = stored(df.where("domain is not null").withColumn("_group", F.md5("domain")), "domains", ("_group",))
    names = [r.domain for r in dealt.select("domain").distinct().orderBy("domain").collect()]
    return names, lambda d: dealt.where(F.col("_group") == F.md5(F.lit(d))).select(*df.columns)


def export_csv(df: DataFrame, path: str) -> int:
    """One CSV with header and BOM for people to open, streamed through the driver; returns its rows."""
    import csv

    n = 0
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if x is None else x for x in row])
            n += 1
    return n


def export_domains(df: DataFrame, folder: str) -> dict[str, int]:
    """A CSV per domain that has rows, older ones removed first; returns their rows."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    for old in Path(folder).glob("*.csv"):
        old.unlink()
    names, own = by_domain(df)
    return {d: export_csv(own(d), f"{folder}/{d.lower()}.csv") for d in names}
