"""The resumable pass over raw input: a bounded file stream whose checkpoint remembers what is done."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import route, seeds
from ..plans.taxonomy import Taxonomy


def stage1_pass(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, scorer, taxonomy: Taxonomy, files_per_batch: int = 1, budget_seconds: float | None = None, text: str = "english") -> dict:
    """Scores and routes the Parquet files of ``source`` that no earlier pass has done, and appends them to ``out``.

    Each micro-batch is committed as a whole, so a lost run repeats the batch in flight at most and a
    finished file is never scored again. With a budget no further batch begins once it is spent; the next
    pass goes on from there. Returns batches, rows, rows_per_second and whether the pass was stopped.
    """
    began = time.monotonic()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    scored = route.apply_routing(scorer.score(stream, text), taxonomy)
    start = lambda: scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if budget_seconds is None:
        q = start().trigger(availableNow=True).start()
        q.awaitTermination()
        progress = q.recentProgress
        return _summary(progress, began, False)
    q = start().trigger(processingTime="0 seconds").start()
    stopped = False
    while q.isActive:
        if time.monotonic() - began >= budget_seconds:
            stopped = True
            break
        last = q.lastProgress
        if not q.status["isDataAvailable"] and not q.status["isTriggerActive"] and last is not None and last["numInputRows"] == 0:
            break
        time.sleep(0.2)
    q.stop()
    return _summary(q.recentProgress, began, stopped)


def _summary(progress: list, began: float, stopped: bool) -> dict:
    rows = [p["numInputRows"] for p in progress if p["numInputRows"]]
    return {"batches": len(rows), "rows": sum(rows), "rows_per_second": round(sum(rows) / max(1e-3, time.monotonic() - began), 1), "stopped": stopped}


def minutes_left(total: int, done: int, rows_per_second: float) -> float | None:
    """At the rate of the last pass; None if that did nothing."""
    return round((total - done) / rows_per_second / 60, 1) if rows_per_second > 0 else None


def progress(source: DataFrame, done: DataFrame) -> DataFrame:
    """total, done, percent: rows scored against an exact count of the source."""
    counts = source.agg(F.count("*").alias("total")).crossJoin(done.agg(F.count("*").alias("done")))  # two single rows
    return counts.select("total", "done", F.round(100.0 * F.col("done") / F.nullif("total", F.lit(0)), 2).alias("percent"))


def label_batch(teacher, taxonomy: Taxonomy, table: str):
    """A foreachBatch function: sentences without a seed go to the teacher, its answers are appended to ``table``."""

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        known = spark.table(table) if spark.catalog.tableExists(table) else spark.createDataFrame([], "label string, text string")
        seeds.teach(seeds.todo(batch, known), taxonomy, teacher).write.mode("append").saveAsTable(table)

    return run
