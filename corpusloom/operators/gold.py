"""The gold set in three parts: a random sample, a sample of each predicted domain, and probes for misses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .corpus import first_of
from .seeds import lot, sample, sample_per

#: Sizes of the parts and the sampler's seed.
RANDOM, PER_DOMAIN, PER_PROBE, SEED = 200, 30, 12, 7


def stratified(df: DataFrame, key: str, per_domain: int = PER_DOMAIN) -> DataFrame:
    return sample_per(df.where("domain is not null"), "domain", per_domain, key, SEED)


def recall(df: DataFrame, probes: dict[str, tuple[str, ...]], key: str, per_probe: int = PER_PROBE, text: str = "english") -> DataFrame:
    """Rows with a domain's keywords that were given another domain, so many of each: with column probe."""
    table = F.array(*(F.struct(F.lit(d).alias("probe"), F.lower(F.col(text)).rlike("|".join(k)).alias("hit")) for d, k in probes.items()))
    missed = df.where("domain is not null").withColumn("_p", F.explode(table)).where("_p.hit and _p.probe <> domain").withColumn("probe", F.col("_p.probe")).drop("_p")
    return sample_per(missed, "probe", per_probe, key, SEED)


def gold_set(df: DataFrame, probes: dict[str, tuple[str, ...]], key: str, text: str = "english", n: int = RANDOM, per_domain: int = PER_DOMAIN, per_probe: int = PER_PROBE) -> DataFrame:
    """key, text, part, predicted and an order to label in; a text is in one part only, the first of the three."""
    own = stored(df.where(F.col(text).isNotNull()).select(key, text, "domain"), "gold")  # three parts read it
    cut = lambda x, part, rank: x.select(key, text, F.col("domain").alias("predicted"), part.alias("part"), F.lit(rank).alias("_rank"))
    parts = cut(sample(own, n, key, SEED), F.lit("random"), 0).unionByName(cut(stratified(own, key, per_domain), F.lit("stratified"), 1))
    parts = parts.unionByName(cut(recall(own, probes, key, per_probe, text), F.concat(F.lit("recall:"), "probe"), 2))
    once = first_of(parts, [text], [F.col("_rank"), lot(SEED, F.col(key)), F.col(key), F.col("part")])
    return once.drop("_rank").withColumn("shuffle", lot(SEED + 1, F.col(key)))


def to_label(gold: DataFrame, labelled: DataFrame, text: str = "english") -> DataFrame:
    """Gold rows whose text has no label yet."""
    return gold.join(labelled.where("domain <> ''").select(text).distinct(), text, "left_anti")
