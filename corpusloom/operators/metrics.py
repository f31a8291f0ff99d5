"""Classification metrics as aggregates: report, averages, confusion matrix, folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .seeds import lot

#: Hex digits of a lot that make a range: 4096 of them.
RANGE_DIGITS = 3


def assign_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 7) -> DataFrame:
    """Adds fold (0 to k - 1), each label dealt out evenly; labels of fewer than ``k`` rows are left out."""
    # A label's rows are ranked by ranges of the lot, counted first, so that no task gets a whole label.
    part = F.coalesce(F.substring(lot(seed, F.col(key)), 1, RANGE_DIGITS), F.lit(""))
    # Label and range make one key: of two, Spark could take the label's partitioning for enough.
    own = df.where(F.col(label).isNotNull()).withColumn("_range", F.struct(F.col(label).alias("label"), part.alias("part")))
    of_label = Window.partitionBy("_of.label")
    counts = own.groupBy(F.col("_range").alias("_of")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(of_label.orderBy("_of.part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    counts = counts.withColumns({"_before": before, "_total": F.sum("_n").over(of_label)}).where(F.col("_total") >= k)
    order = Window.partitionBy("_range").orderBy(lot(seed, F.col(key)), key)
    ranked = own.join(counts, F.col("_range") == F.col("_of"))
    return ranked.withColumn("fold", ((F.col("_before") + F.row_number().over(order) - 1) % k).cast("int")).select(*df.columns, "fold")


def class_report(df: DataFrame, by: tuple[str, ...] = (), truth: str = "truth", pred: str = "pred") -> DataFrame:
    """by, label, precision, recall, f1, support, predicted for each label that is true or predicted; 0 where undefined."""
    own = df.where(F.col(truth).isNotNull() & F.col(pred).isNotNull())
    sides = F.array(F.struct(F.col(truth).alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p")), F.struct(F.col(pred).alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p")))
    hit = (F.col(truth) == F.col(pred)).cast("int")
    counts = own.select(*by, hit.alias("hit"), F.explode(sides).alias("s")).groupBy(*by, F.col("s.label").alias("label")).agg(F.sum(F.col("hit") * F.col("s.t")).alias("tp"), F.sum("s.t").alias("support"), F.sum("s.p").alias("predicted"))
    ratio = lambda a, b: F.when(b > 0, a / F.nullif(b, F.lit(0))).otherwise(0.0)
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return counts.select(*by, "label", ratio(tp, predicted).alias("precision"), ratio(tp, support).alias("recall"), ratio(2 * tp, support + predicted).alias("f1"), support.cast("long").alias("support"), predicted.cast("long").alias("predicted"))


def f1_summary(df: DataFrame, by: tuple[str, ...] = (), truth: str = "truth", pred: str = "pred") -> DataFrame:
    """by, accuracy, macro_f1, micro_f1, weighted_f1, rows. With one label per row, micro F1 is the accuracy."""
    report = class_report(df, by, truth, pred)
    n = F.sum("support")
    accuracy = F.sum(F.col("recall") * F.col("support")) / F.nullif(n, F.lit(0))
    return report.groupBy(*by).agg(accuracy.alias("accuracy"), F.avg("f1").alias("macro_f1"), accuracy.alias("micro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.nullif(n, F.lit(0))).alias("weighted_f1"), n.cast("long").alias("rows"))


def confusion_matrix(df: DataFrame, labels: list[str], truth: str = "truth", pred: str = "pred") -> DataFrame:
    """A row for each true label, a column for each of ``labels`` as predicted, in that order."""
    cells = [F.count_if(F.col(pred) == x).cast("long").alias(x) for x in labels]
    return df.where(F.col(truth).isin(*labels)).groupBy(truth).agg(*cells)
