"""From raw documents to token ids in five stages, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage's rows as Parquet in the shared folder and reads them again for the
next stage. Repeated rows, nulls, empty texts and empty tables behave as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe_codec, common, language_id, line_templates, simhash_dedup, template_decontam

#: Least posterior share of the language that a document is kept with.
MIN_LANGUAGE_SCORE = 0.5

#: Not expressible in SQL (fitted language model, SimHash, BPE); the tests plant what each stage must drop or keep,
#: and compare each operator with brute force or its library.
ORACLE_SQL = None


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a clear language (operator 2), fitted on ``docs`` itself.

    If no row has a language there is nothing to learn from, and nothing but documents without a letter goes.
    """
    model = language_id.Model.fit(docs, language_id.read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    # The row travels whole, so that no column of it can clash with the prediction's.
    rows = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    found = language_id.identify(rows, model, ["row"])
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def drop_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines (operator 6), and documents of which nothing else is left; n_chars follows the text."""
    # All but id and text travels in one column, so that nothing can clash with the operator's figures.
    rows = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    found = line_templates.drop_recurring_lines(rows).where((F.col("n_dropped") == 0) | (F.col("text") != ""))
    changed = F.col("n_dropped") > 0
    of_row = {c: F.col(f"row.`{c}`") for c in docs.columns}
    n_chars = F.when(changed, F.length("text")).otherwise(of_row["n_chars"]).cast("long")
    return found.select(*((F.col("text") if c == "text" else n_chars if c == "n_chars" else x).alias(c) for c, x in of_row.items()))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (operator 3), the document of the smallest id stays, once; texts tell rows of one id apart."""
    return simhash_dedup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which an item of ``benchmark`` is found (operator 1)."""
    return template_decontam.without_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the digests of ids and decoded bytes (operator 7)."""
    found = bpe_codec.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)
    return found.drop("decoded")


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_template_lines),
    ("simhash_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` of ``sf_dir``; the last stage's rows."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
