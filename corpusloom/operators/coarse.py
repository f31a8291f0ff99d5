"""Stage 1: a label and a score for each row, from one of three providers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_matches, normalize_for_model
from ..session import ship

#: A Python worker's model, by the scoring that it belongs to.
_models: dict[str, Callable] = {}


@dataclass(frozen=True)
class LexicalScorer:
    """A deterministic stand-in for the network: hits of each label's pattern.

    The label with most hits wins, the smallest name on a tie; the score is its share of all hits. A row
    without a hit gets ``none_label`` and ``none_score``. It doesn't reproduce any model's labels.
    """

    patterns: dict[str, str]
    none_label: str = "c_none"
    none_score: float = 0.0

    def score(self, df: DataFrame, text: str = "english") -> DataFrame:
        names = sorted(self.patterns)
        hits = F.array(*(F.struct(count_matches(F.col("_low"), self.patterns[n]).alias("n"), F.lit(-i).alias("rank"), F.lit(n).alias("label")) for i, n in enumerate(names)))

        def judge(h):
            best, total = F.array_max(h), F.aggregate(h, F.lit(0), lambda a, x: a + x["n"])
            label = F.when(total > 0, best["label"]).otherwise(self.none_label)
            score = F.when(total > 0, best["n"] / F.nullif(total, F.lit(0))).otherwise(F.lit(self.none_score))
            return F.struct(label.alias("label"), score.cast("double").alias("score"))

        # Through a generator, so that filters on the result don't pull the patterns into their conditions.
        ready = df.select("*", F.explode(F.array(F.lower(normalize_for_model(F.col(text))))).alias("_low"))
        return ready.select("*", F.inline(F.transform(F.array(hits), judge))).drop("_low")


@dataclass(frozen=True)
class PrecomputedScorer:
    """Labels and scores from a table (key, label, score) made elsewhere, e.g. by the real network."""

    table: DataFrame
    key: str

    def score(self, df: DataFrame, text: str = "english") -> DataFrame:
        return df.join(self.table.select(self.key, "label", "score"), self.key, "left")


@dataclass(frozen=True)
class ModelScorer:
    """A model in Python workers, loaded once each: ``load()`` gives texts -> (labels, scores).

    Rows are sorted by length within partitions first, so that a batch holds texts of like length.
    """

    load: Callable[[], Callable[[list[str]], tuple[list[str], list[float]]]]
    batch: int = 64

    def score(self, df: DataFrame, text: str = "english") -> DataFrame:
        load, batch = self.load, self.batch
        names, key = df.columns, uuid.uuid4().hex
        ship(df.sparkSession)

        def run(frames: Iterator) -> Iterator:
            from corpusloom.operators import coarse  # the worker's own module, which outlives the task

            if key not in coarse._models:
                coarse._models.clear()
                coarse._models[key] = load()
            model = coarse._models[key]
            for pdf in frames:
                labels, scores = [], []
                texts = pdf["_text"].tolist()
                for a in range(0, len(texts), batch):
                    got = model(texts[a : a + batch])
                    labels += got[0]
                    scores += got[1]
                yield pdf[names].assign(label=labels, score=scores)

        schema = df.limit(0).withColumns({"label": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
        ready = df.withColumn("_text", normalize_for_model(F.col(text))).sortWithinPartitions(F.length("_text"))
        return ready.mapInPandas(run, schema)


def best_of(scores: str):
    """Of a map label -> score: the label of the highest score, the smallest name on a tie, and the score."""
    entries = F.transform(F.array_sort(F.map_keys(scores)), lambda k: F.struct(k.alias("label"), F.element_at(scores, k).alias("score")))
    top = F.array_max(F.map_values(scores))
    return F.get(F.filter(entries, lambda e: e["score"] == top), 0)
