"""Stage 2: the student that decides between domains, trained on seeds.

``NaiveBayes`` is multinomial, in DataFrame operations alone. ``ml_pipeline`` is the nearest Spark analogue of
a linear softmax over word and character n-grams.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

TOKEN_PATTERN = "[a-z]+"
#: The n-grams of words and of characters that a student of single sentences uses.
SENTENCE_SIZE = {"word_ngrams": 5, "chars": (3, 6)}


def _tokens(df: DataFrame, text: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))).alias("token"))


class NaiveBayes:
    """Add-one smoothed: P(label) and P(token | label) as small tables."""

    def __init__(self, seeds: DataFrame, label: str = "label", text: str = "text"):
        own = seeds.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
        counts = _tokens(own, "text", "label").groupBy("label", "token").agg(F.count("*").alias("n"))
        vocabulary = counts.agg(F.countDistinct("token").alias("v"))
        per_label = own.groupBy("label").agg(F.count("*").alias("docs")).join(counts.groupBy("label").agg(F.sum("n").alias("total")), "label", "left")
        self.labels = per_label.crossJoin(vocabulary).select("label", F.log(F.col("docs").cast("double")).alias("prior"), F.log(1.0 / (F.coalesce("total", F.lit(0)) + F.col("v"))).alias("unseen"))
        self.tokens = counts.select("label", "token", F.log(1.0 + F.col("n")).alias("gain"))  # over an unseen token
        self.vocabulary = counts.select("token").distinct()

    def predict(self, df: DataFrame, key: str, text: str = "text") -> DataFrame:
        """key, predicted: the likeliest label, the smallest name on a tie. Tokens that no seed has don't count."""
        tokens = _tokens(df, text, key).groupBy(key, "token").agg(F.count("*").alias("n")).join(self.vocabulary, "token", "left_semi")
        gains = tokens.join(self.tokens, "token").groupBy(key, "label").agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
        lengths = tokens.groupBy(key).agg(F.sum("n").alias("length"))
        every = df.select(key).distinct().join(lengths, key, "left").crossJoin(F.broadcast(self.labels))  # a row per label
        scored = every.join(gains, [key, "label"], "left").select(key, "label", (F.col("prior") + F.coalesce("length", F.lit(0)) * F.col("unseen") + F.coalesce("gain", F.lit(0.0))).alias("s"))
        # One look at each score: sums of doubles vary with the order of a shuffle, so a score worked out anew may miss its own maximum.
        return scored.groupBy(key).agg(F.min(F.struct((-F.round("s", 9)).alias("minus"), "label")).alias("best")).select(key, F.col("best.label").alias("predicted"))


def cross_validate(seeds: DataFrame, key: str, k: int = 5, fit=None) -> DataFrame:
    """key, fold, truth, pred: each seed's prediction by a student that was trained without its fold.

    seeds: key, label, text. Labels of fewer than ``k`` rows are left out. ``fit(rows)`` gives a function
    from (rows, key) to key and predicted; by default it is naive Bayes. One student is trained per fold.
    """
    from .metrics import assign_folds

    fit = fit or (lambda rows: NaiveBayes(rows).predict)
    rows = stored(assign_folds(seeds.select(key, "label", "text"), "label", key, k), "folds")
    out = []
    for f in range(k):
        own = rows.where(F.col("fold") == f)
        predicted = fit(rows.where(F.col("fold") != f))(own, key)
        out.append(own.select(key, "fold", F.col("label").alias("truth")).join(predicted.select(key, F.col("predicted").alias("pred")), key))
    return reduce(DataFrame.unionByName, out)


def model_key(seeds: DataFrame, **params: object) -> str:
    """Names a trained model by its seeds and parameters, so that a change of either trains anew."""
    of_seeds = seeds.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("label", "text")).alias("x")).first()
    return hashlib.sha256(repr((of_seeds.n, of_seeds.x, sorted(params.items()))).encode()).hexdigest()[:16]


def ml_pipeline(word_ngrams: int = 2, chars: tuple[int, int] = (3, 4), features: int = 1 << 14, max_iter: int = 20, reg: float = 1e-3):
    """A pyspark.ml pipeline from text and label to probability and prediction."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler

    stages = [StringIndexer(inputCol="label", outputCol="label_index", stringOrderType="alphabetAsc"), RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+")]
    parts = []
    for n in range(1, word_ngrams + 1):
        stages += [NGram(n=n, inputCol="words", outputCol=f"w{n}"), HashingTF(numFeatures=features, inputCol=f"w{n}", outputCol=f"fw{n}")]
        parts.append(f"fw{n}")
    stages += [SQLTransformer(statement="SELECT *, filter(split(lower(text), ''), c -> c <> '') AS chars FROM __THIS__")]
    for n in range(chars[0], chars[1] + 1):
        stages += [NGram(n=n, inputCol="chars", outputCol=f"c{n}"), HashingTF(numFeatures=features, inputCol=f"c{n}", outputCol=f"fc{n}")]
        parts.append(f"fc{n}")
    stages += [VectorAssembler(inputCols=parts, outputCol="features"), LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=max_iter, regParam=reg, family="multinomial")]
    return Pipeline(stages=stages)


def train(seeds: DataFrame, folder: str | None = None, **params: object):
    """A fitted pipeline; with a folder, kept there under its key and reused while seeds and parameters stay."""
    from pyspark.ml import PipelineModel

    if folder is None:
        return ml_pipeline(**params).fit(seeds)
    path = f"{folder}/{model_key(seeds, **params)}"
    spark = seeds.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return PipelineModel.load(path)
    model = ml_pipeline(**params).fit(seeds)
    model.write().overwrite().save(path)
    return model


def stage2(model, text: str = "text_norm"):
    """A stage 2 by a trained student: its likeliest label as the domain, and that label's probability."""

    def decide(df: DataFrame) -> DataFrame:
        names = [c for c in df.columns if c not in ("domain", "confidence")]
        own = df.select(F.struct(*names).alias("_key"), F.col(text).alias("text"))
        top = F.get("scores", 0)
        return ranked(model, own, "_key", 1).select("_key.*", top["label"].alias("domain"), F.round(top["score"], 4).alias("confidence"))

    return decide


def ranked(model, df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """key and scores: the labels with their probabilities, highest first (ties by name), the top ``k`` or all."""
    from pyspark.ml.functions import vector_to_array

    labels = [s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"][0].labels
    probability = vector_to_array("probability")
    pairs = F.array(*(F.struct((-probability[i]).alias("minus"), F.lit(x).alias("label")) for i, x in enumerate(labels)))
    ordered = F.transform(F.array_sort(pairs), lambda x: F.struct(x["label"].alias("label"), (-x["minus"]).alias("score")))
    ready = df.withColumn("label", F.lit(labels[0] if labels else ""))
    return model.transform(ready).select(key, (F.slice(ordered, 1, k) if k else ordered).alias("scores"))
