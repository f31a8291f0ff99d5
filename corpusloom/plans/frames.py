"""The synthetic tables seen as a corpus: English lines, parallel pairs, and labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.coarse import LexicalScorer
from ..operators.route import apply_routing
from .taxonomy import SYNTHETIC, SYNTHETIC_LABELS

SCORER = LexicalScorer(SYNTHETIC_LABELS)

#: Documents play the workbooks' rows, one line each; the place of a line orders it within its document.
LINES_PER_DOCUMENT = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one that has fewer splits than there are cores is dealt out to all of them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.repartition(spark.sparkContext.defaultParallelism) if name == "documents" and df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism else df


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, source_file, english: the lines of the English documents."""
    docs = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", F.col("source").alias("source_file"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "english"))
    return docs.select((F.col("doc_id") * LINES_PER_DOCUMENT + F.col("pos")).alias("row_id"), "source_file", "english")


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with label, score, route and domain."""
    return apply_routing(SCORER.score(lines(spark, sf_dir)), SYNTHETIC)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, english, target: a user's turn and the assistant's next one."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("english"))
    told = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    return asked.join(told, ["conv_id", "turn"])


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, part, truth, pred: labelled documents and a fixed rule's prediction."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("part"))
    labels = table(spark, sf_dir, "labels")
    truth = F.concat(F.when(F.col("quality") == 1, "good").otherwise("poor"), F.when(F.col("toxic") == 1, "_toxic").otherwise("_clean"))
    poor, toxic = F.col("text").rlike("%%%|!!"), F.lower(F.col("text")).rlike("stupid|worthless|idiot|trash")
    pred = F.concat(F.when(poor, "poor").otherwise("good"), F.when(toxic, "_toxic").otherwise("_clean"))
    return docs.join(labels, "doc_id").select("doc_id", "text", "part", truth.alias("truth"), pred.alias("pred"))
