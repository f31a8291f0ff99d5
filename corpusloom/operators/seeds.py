"""Seeds: sampling sentences for the teacher, its answers, and the seed file's lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_for_model
from ..plans.taxonomy import Taxonomy

#: Random seeds per domain, targeted seeds per label, the samplers' seed.
RANDOM_PER_DOMAIN, PER_LABEL, SEED = 200, 700, 42


def lot(seed: int, key: Column) -> Column:
    """What samples are ordered by: the same rows for the same seed, wherever they are computed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """``n`` rows without replacement (all, if there are fewer)."""
    return df.withColumn("_lot", lot(seed, F.col(key))).orderBy("_lot", key).limit(n).drop("_lot")


def sample_per(df: DataFrame, group: str, n: int, key: str, seed: int = SEED) -> DataFrame:
    """Up to ``n`` rows of each group; a group-limit prunes within each task before the shuffle."""
    order = Window.partitionBy(group).orderBy(lot(seed, F.col(key)), key)
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def random_seeds(df: DataFrame, taxonomy: Taxonomy, key: str, per_domain: int = RANDOM_PER_DOMAIN) -> DataFrame:
    return sample(df, per_domain * len(taxonomy.domains), key)


def targeted_seeds(routed: DataFrame, taxonomy: Taxonomy, key: str, per_label: int = PER_LABEL, low_confidence: bool = False) -> DataFrame:
    """Rows that stage 2 must decide, so many of each ambiguous label; with ``low_confidence`` of the other labels too, as one bucket."""
    rows = routed.where("route = 'finegrain'")
    known = F.col("label").isin(*taxonomy.ambiguous())
    bucket = F.when(known, F.col("label")).when(F.lit(low_confidence), "low_confidence")
    return sample_per(rows.withColumn("bucket", bucket).where("bucket is not null"), "bucket", per_label, key)


def todo(sentences: DataFrame, seeds: DataFrame, text: str = "english") -> DataFrame:
    """Distinct normalised sentences (column text) that aren't blank and have no seed yet."""
    wanted = sentences.select(normalize_for_model(F.col(text)).alias("text")).where("text <> ''").distinct()
    return wanted.join(seeds.select(normalize_for_model(F.col("text")).alias("text")).distinct(), "text", "left_anti")


def on_taxonomy(answers: DataFrame, taxonomy: Taxonomy, label: str = "label") -> DataFrame:
    """Answers that are exactly a domain's name; others are dropped."""
    return answers.where(F.col(label).isin(*taxonomy.names))


def seed_lines(seeds: DataFrame) -> DataFrame:
    """The seed file's lines (value) of label and text."""
    return seeds.select(F.concat(F.lit("__label__"), "label", F.lit(" "), normalize_for_model(F.col("text"))).alias("value"))


def parse_seeds(lines: DataFrame) -> DataFrame:
    """label and text of the well-formed lines."""
    own = lines.where(F.col("value").rlike("^__label__[^ ]+ ."))
    cut = F.split(F.col("value"), " ", 2)
    return own.select(F.regexp_replace(F.get(cut, 0), "^__label__", "").alias("label"), F.get(cut, 1).alias("text"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """column, count, share (percent of the counted rows); nulls aren't counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    total = counts.agg(F.sum("count").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(column, F.col("count").cast("long"), F.round(100.0 * F.col("count") / F.col("_total"), 2).alias("share"))  # the broadcast is one row


def teach(sentences: DataFrame, taxonomy: Taxonomy, connect: Callable[[], Callable[[str], str]]) -> DataFrame:
    """label, text by a teacher: ``connect()`` opens it once per task; a failing sentence is skipped.

    Answers that are no domain's name are dropped.
    """
    prompt = taxonomy.prompt()

    def run(frames):
        ask = connect()
        for pdf in frames:
            rows = []
            for text in pdf["text"]:
                try:
                    rows.append((ask(prompt.replace("{sent}", text)).strip(), text))
                except Exception:  # noqa: BLE001 - a teacher may fail in any way; the sentence stays to do
                    continue
            yield type(pdf)(rows, columns=["label", "text"])

    return on_taxonomy(sentences.select("text").mapInPandas(run, "label string, text string"), taxonomy)
