"""Routing: which rows stage 1 settles, and which go to stage 2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.taxonomy import Taxonomy

#: Least score that stage 1 is believed with; names of the stages.
THRESHOLD = 0.6
STAGES = {"general": "stage 1 (general)", "direct": "stage 1 (direct)", "finegrain": "stage 2 (fasttext)"}
STAGE_EMPTY = "skipped (empty)"


def route_of(taxonomy: Taxonomy, label: Column, score: Column, threshold: float = THRESHOLD) -> Column:
    """finegrain below the threshold (or without a score) or for an ambiguous label; direct; else general."""
    unsure = score.isNull() | F.isnan(score) | (score < threshold)
    listed = lambda names: label.isin(*names) if names else F.lit(False)
    return F.when(unsure | listed(taxonomy.ambiguous()), "finegrain").when(listed(sorted(taxonomy.direct())), "direct").otherwise("general")


def apply_routing(df: DataFrame, taxonomy: Taxonomy, threshold: float = THRESHOLD) -> DataFrame:
    """Adds route and domain; the domain is null where stage 2 must decide."""
    direct = [F.lit(x) for pair in sorted(taxonomy.direct().items()) for x in pair]
    known = F.try_element_at(F.create_map(*direct), F.col("label")) if direct else F.lit(None).cast("string")
    routed = df.withColumn("route", route_of(taxonomy, F.col("label"), F.col("score"), threshold))
    return routed.withColumn("domain", F.when(F.col("route") == "direct", known).when(F.col("route") == "general", taxonomy.fallback))


def stage_of(route: Column) -> Column:
    return F.coalesce(*(F.when(route == r, s) for r, s in STAGES.items()), F.lit(STAGE_EMPTY))
