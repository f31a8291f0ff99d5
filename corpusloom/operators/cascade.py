"""Both stages over a frame: blanks skipped, stage 1 for the rest, stage 2 for what it couldn't place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_matches, normalize_for_model
from ..plans.taxonomy import Taxonomy
from ..session import stored
from . import route

#: Columns that the cascade adds; a source column of the same name is kept with the suffix ``_source``.
ADDED = ("text_norm", "label", "score", "route", "domain", "stage", "confidence")


def keyword_stage2(taxonomy: Taxonomy, text: str = "text_norm") -> Callable[[DataFrame], DataFrame]:
    """A stage 2 by the taxonomy's probes: the domain of most hits (first in taxonomy order on a tie), confidence its share."""

    def decide(df: DataFrame) -> DataFrame:
        names = list(taxonomy.probes)
        hits = F.array(*(F.struct(count_matches(F.col("_low"), "|".join(taxonomy.probes[n])).alias("n"), F.lit(-i).alias("rank"), F.lit(n).alias("domain")) for i, n in enumerate(names)))

        def judge(h):
            best, total = F.array_max(h), F.aggregate(h, F.lit(0), lambda a, x: a + x["n"])
            domain = F.when(total > 0, best["domain"]).otherwise(taxonomy.fallback)
            share = F.when(total > 0, best["n"] / F.nullif(total, F.lit(0))).otherwise(F.lit(0.0))
            return F.struct(domain.alias("domain"), F.round(share, 4).alias("confidence"))

        ready = df.drop("domain").select("*", F.explode(F.array(F.lower(F.col(text)))).alias("_low"))
        return ready.select("*", F.inline(F.transform(F.array(hits), judge))).drop("_low")

    return decide


def decide(scored: DataFrame, stage2: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows that stage 1 has scored and routed, with the final domain and ``confidence``: stage 2 sees only its own."""
    settled = scored.where("route <> 'finegrain'").withColumn("confidence", F.col("score"))
    return settled.unionByName(stage2(scored.where("route = 'finegrain'")).select(*settled.columns))


def classify(df: DataFrame, taxonomy: Taxonomy, scorer, stage2: Callable[[DataFrame], DataFrame], text: str = "english", threshold: float = route.THRESHOLD) -> DataFrame:
    """Every input row once, with all its columns and text_norm, label, score, route, domain, stage, confidence.

    ``score`` is stage 1's, ``confidence`` that of the stage which decided. Blank rows reach no model: their
    added columns are null but for text_norm and stage. Stage 2 sees only the rows routed to it, as
    conditionals wouldn't keep it from the others.
    """
    source = df.withColumnsRenamed({c: f"{c}_source" for c in ADDED if c in df.columns and c != text})
    ready = source.withColumn("text_norm", normalize_for_model(F.col(text)))
    # Both branches below read stage 1's rows: they are stored, or the model would run twice.
    scored = stored(route.apply_routing(scorer.score(ready.where("text_norm <> ''"), "text_norm"), taxonomy, threshold), "stage1")
    out = decide(scored, stage2)
    blank = ready.where("text_norm = ''").withColumns({c: F.lit(None).cast("double" if c in ("score", "confidence") else "string") for c in ("label", "score", "route", "domain", "confidence")})
    out = out.unionByName(blank.select(*out.columns))
    return out.withColumn("stage", route.stage_of(F.col("route"))).select(*ready.columns, "label", "score", "route", "domain", "stage", "confidence")


def or_unclassified(df: DataFrame) -> DataFrame:
    return df.withColumn("domain", F.coalesce("domain", F.lit("Unclassified")))
