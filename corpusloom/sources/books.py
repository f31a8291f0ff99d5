"""Workbooks and archives for people: per-domain parts, corpus chunks, a summary, a zip of all."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import corpus, export
from ..session import stored
from . import files, xlsx


def _rows(df: DataFrame):
    return (tuple(r) for r in df.toLocalIterator())


def _meta(meta: DataFrame) -> list[tuple]:
    return [tuple(r) for r in meta.select("section", "item", "value").collect()]


def write_domains(df: DataFrame, meta: DataFrame, folder: str, order: list[str], part_rows: int = export.PART_ROWS, only: str | None = None) -> list[str]:
    """``name.xlsx``, or ``name_partNN.xlsx`` each of ``part_rows`` rows, per domain; returns the paths.

    One part at a time goes through the driver.
    """
    if only:
        df = df.where(F.lower("domain") == only.lower())
    numbered = stored(export.parts(df, "domain", order, part_rows).withColumn("_group", F.md5("domain")), "books", ("_group", "part"))
    notes, paths = _meta(meta), []
    Path(folder).mkdir(parents=True, exist_ok=True)
    listed = export.part_list(df, "domain", part_rows).orderBy("domain", "part").collect()
    count = {r.domain: r.part for r in listed}
    for r in listed:
        n, name = count[r.domain], r.domain.lower()
        path = f"{folder}/{name}.xlsx" if n == 1 else f"{folder}/{name}_part{r.part:02d}.xlsx"
        note = [("this part", "contents", f"all {r.rows:,} {r.domain} rows")] if n == 1 else [("this part", "part", f"{r.part} of {n}"), ("this part", "rows", f"{r.first_row:,} - {r.last_row:,}"), ("this part", "other parts", f"{name}_part01..part{n:02d}.xlsx")]
        rows = numbered.where((F.col("_group") == F.md5(F.lit(r.domain))) & (F.col("part") == r.part)).orderBy(*order).select(*df.columns)
        xlsx.write_book(path, df.columns, _rows(rows), note + notes)
        paths.append(path)
    return paths


def write_chunks(df: DataFrame, meta: DataFrame, folder: str, order: list[str], part_rows: int = export.PART_ROWS) -> list[str]:
    """The corpus in its own order, ``corpus_chunkNN.xlsx`` each of ``part_rows`` rows, noting the domains in it."""
    numbered = stored(corpus.with_ordinal(df, order).withColumn("chunk", (F.floor(F.col("ordinal") / part_rows) + 1).cast("long")), "books", ("chunk",))
    histogram: dict[int, list] = {}
    for r in numbered.where("domain is not null").groupBy("chunk", "domain").count().orderBy("chunk", F.desc("count"), "domain").collect():
        histogram.setdefault(r.chunk, []).append(f"{r.domain} {r['count']:,}")
    total, notes, paths = numbered.count(), _meta(meta), []
    n = -(-total // part_rows)
    Path(folder).mkdir(parents=True, exist_ok=True)
    for k in range(1, n + 1):
        path = f"{folder}/corpus_chunk{k:02d}.xlsx"
        note = [("this chunk", "chunk", f"{k} of {n}"), ("this chunk", "rows", f"{(k - 1) * part_rows + 1:,} - {min(k * part_rows, total):,} of {total:,}"), ("this chunk", "domains here", ", ".join(histogram.get(k, [])))]
        xlsx.write_book(path, df.columns, _rows(numbered.where(F.col("chunk") == k).orderBy("ordinal").select(*df.columns)), note + notes)
        paths.append(path)
    return paths


def write_summary(df: DataFrame, meta: DataFrame, path: str, part_rows: int = export.PART_ROWS) -> None:
    summary = export.domain_summary(df, part_rows).orderBy(F.desc("pairs"), "domain")
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    xlsx.write_book(path, summary.columns, _rows(summary), _meta(meta), sheet="summary")


def zip_domains(df: DataFrame, path: str, order: list[str]) -> list[str]:
    """A zip of one workbook per domain and ``_summary.xlsx``, each streamed into it; returns the names in it."""
    names, own = files.by_domain(df)
    summary = export.domain_distribution(df).orderBy(F.desc("pairs"), "domain")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name in names:
            with z.open(f"{name.lower()}.xlsx", "w", force_zip64=True) as f:
                xlsx.write_book(f, df.columns, _rows(own(name).orderBy(*order)), sheet=name)
        with z.open("_summary.xlsx", "w") as f:
            xlsx.write_book(f, summary.columns, _rows(summary), sheet="summary")
        return z.namelist()
