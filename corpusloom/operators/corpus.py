"""The corpus: reading pairs, cleaning, union, exact dedupe that keeps the first, stable ordinals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from . import layout


def normalize_frame(df: DataFrame, order: str, target: str = "target") -> DataFrame:
    """order, id (if there is one), english and ``target``, by the resolved layout."""
    found = layout.resolve_columns(df, order)
    own = [F.col(order)]
    if found["id"] is not None:
        own.append(F.col(f"`{found['id']}`").cast("string").alias("id"))
    return df.select(*own, F.col(f"`{found['english']}`").alias("english"), F.col(f"`{found['target']}`").alias(target))


def clean_pairs(df: DataFrame, english: str = "english", target: str = "target") -> DataFrame:
    """Both sides stripped; rows with a null or blank side go."""
    return df.withColumns({c: strip(F.col(c)) for c in (english, target)}).where(f"`{english}` <> '' and `{target}` <> ''")


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in ``order``: a minimum, which combines before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    place = F.struct(*(o.alias(f"_o{i}") for i, o in enumerate(order)))
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in others)), place).alias("_row"))
    return kept.select(*(F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns))


def dedupe_pairs(df: DataFrame, order: list[Column], english: str = "english", target: str = "target") -> DataFrame:
    """Exact duplicates of (english, target) but for the first in ``order``."""
    return first_of(df, [english, target], order)


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All frames with their name as source_file; a missing column is null, ids are text."""
    tagged = [(df.withColumn("id", F.col("id").cast("string")) if "id" in df.columns else df).withColumn("source_file", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """A number from 0 without gaps in the order given, without one task that sees all rows.

    Rows are dealt out by ranges of the order; each range is numbered by itself, and the counts of the
    ranges before it (a row per range) are added.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    # The parts must not move between the two uses, so they are stored.
    from ..session import stored

    ranged = stored(ranged, "ordinal")
    sizes = ranged.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*order)
    numbered = ranged.withColumn("_within", F.row_number().over(within)).join(F.broadcast(offsets), "_part")  # a row per range
    return numbered.withColumn(name, (F.col("_before") + F.col("_within") - 1).cast("long")).drop("_part", "_within", "_before")
