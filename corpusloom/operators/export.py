"""What is exported: distributions, parts, histograms, run metadata, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Fixed value: rows of a workbook part.
PART_ROWS = 100_000


def domain_distribution(df: DataFrame) -> DataFrame:
    """domain, pairs, share: rows without a domain aren't listed but count for the shares."""
    counts = df.groupBy("domain").agg(F.count("*").alias("pairs"))
    total = counts.agg(F.sum("pairs").alias("_total"))
    listed = counts.where("domain is not null").crossJoin(F.broadcast(total))  # one row
    return listed.select("domain", "pairs", F.round(100.0 * F.col("pairs") / F.col("_total"), 2).alias("share"))


def domain_summary(df: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """domain, pairs, share, csv, parts: what the summary workbook lists."""
    out = domain_distribution(df)
    return out.withColumns({"csv": F.concat(F.lower("domain"), F.lit(".csv")), "parts": F.ceil(F.col("pairs") / part_rows).cast("long")})


def parts(df: DataFrame, group: str, order: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """Adds part (from 1): consecutive ``part_rows`` rows of each group, numbered by ranges, not in one task."""
    from .corpus import with_ordinal

    numbered = with_ordinal(stored(df.where(F.col(group).isNotNull()), "parts"), [group, *order], "_n")
    first = numbered.groupBy(group).agg(F.min("_n").alias("_first"))
    return numbered.join(F.broadcast(first), group).withColumn("part", (F.floor((F.col("_n") - F.col("_first")) / part_rows) + 1).cast("long")).drop("_n", "_first")  # a row per group


def part_list(df: DataFrame, group: str, part_rows: int = PART_ROWS) -> DataFrame:
    """group, part, first, last, rows of each part, from the groups' sizes alone."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    each = sizes.select(group, "n", F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / part_rows).cast("int"))).alias("part"))
    first, last = (F.col("part") - 1) * part_rows + 1, F.least(F.col("part") * part_rows, F.col("n"))
    return each.select(group, F.col("part").cast("long").alias("part"), first.cast("long").alias("first_row"), last.cast("long").alias("last_row"), (last - first + 1).cast("long").alias("rows"))


def corpus_chunk_histogram(df: DataFrame, order: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """chunk (from 1), domain, rows: the corpus cut in its own order."""
    from .corpus import with_ordinal

    chunked = with_ordinal(df, order).withColumn("chunk", (F.floor(F.col("ordinal") / part_rows) + 1).cast("long"))
    return chunked.where("domain is not null").groupBy("chunk", "domain").agg(F.count("*").alias("rows"))


def _section(df: DataFrame, section: str, item: Column, value: Column) -> DataFrame:
    return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), value.cast("string").alias("value"))


#: What the added columns mean, for the report.
COLUMN_NOTES = {
    "english": "the side that is classified",
    "source_file": "the file that the pair came from",
    "label": "label of stage 1",
    "score": "score of stage 1",
    "route": "direct: one domain claims the label; general: none does; finegrain: stage 2 decides",
    "domain": "the final domain",
    "stage": "the stage that decided",
    "confidence": "score of the stage that decided",
}


def run_metadata(df: DataFrame, settings: dict[str, str], generated: str | None = None, models: dict[str, dict[str, str]] | None = None, seeds: DataFrame | None = None, notes: dict[str, str] | None = None) -> DataFrame:
    """section, item, value: one flat report of a run, all of it derived from the run itself.

    models: item -> value by section, e.g. of stage 1. seeds: label and text of the student's training rows.
    notes: of columns; those that ``df`` has are listed.
    """
    spark = df.sparkSession
    listed = [("columns", c, note) for c, note in (notes or {}).items() if c in df.columns]
    df = stored(df.select("source_file", "route", "domain", "score"), "report")  # every section reads it
    total = df.agg(F.count("*").alias("n"), F.countDistinct("source_file").alias("sources"), F.round(F.avg("score"), 4).alias("mean"))
    percent = lambda digits: F.concat("n", F.lit(" ("), F.format_string(f"%.{digits}f", F.round(100.0 * F.col("n") / F.col("_total"), digits)), F.lit("%)"))
    out = _section(total, "run", F.lit("rows"), F.col("n")).unionByName(_section(total, "source", F.lit("files"), F.col("sources"))).unionByName(_section(total, "stage 1", F.lit("mean score"), F.format_string("%.4f", "mean")))
    all_rows = df.agg(F.count("*").alias("_total"))
    for section, column, value in (("rows per file", "source_file", F.col("n")), ("routing", "route", percent(1)), ("domain distribution", "domain", percent(2))):
        counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).crossJoin(F.broadcast(all_rows))
        out = out.unionByName(_section(counts, section, F.col(column), value))
    if seeds is not None:
        counts = seeds.groupBy("label").agg(F.count("*").alias("n"))
        out = out.unionByName(_section(counts, "seeds per domain", F.col("label"), F.col("n"))).unionByName(_section(seeds.agg(F.count("*").alias("n")), "stage 2", F.lit("seeds"), F.col("n")))
    fixed = [("settings", k, v) for k, v in settings.items()] + ([("run", "generated", generated)] if generated else []) + listed
    fixed += [(section, k, v) for section, items in (models or {}).items() for k, v in items.items()]
    return out.unionByName(spark.createDataFrame(fixed, "section string, item string, value string")) if fixed else out


def preview(df: DataFrame, order: list[str], text: str, rows: int = 100, chars: int = 70) -> DataFrame:
    return df.orderBy(*order).limit(rows).withColumn("preview", F.substring(F.col(text), 1, chars))


def length_buckets(df: DataFrame, text: str, width: int = 32) -> DataFrame:
    """bucket, rows, chars, padding: what padding each bucket's texts to its upper end would waste."""
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    bucket = F.floor((size - 1) / width) + 1
    own = df.select(size.alias("size"), F.when(size == 0, 0).otherwise(bucket).cast("long").alias("bucket"))
    return own.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum("size").cast("long").alias("chars"), F.sum(F.col("bucket") * width - F.col("size")).cast("long").alias("padding"))


