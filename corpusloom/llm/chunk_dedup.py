"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text: each step shifts the hash left and adds the byte's value from a
random table, so that it depends on the last ``WINDOW`` bytes alone. A chunk ends where the hash falls below
a bound, unless another such place lies within the ``GAP`` bytes before. Both rules look at a few bytes only,
so an insertion moves no boundaries beyond its surroundings, and a passage is cut alike wherever it stands.
Chunks are compared by a 128-bit digest. Neighbouring chunks that occur elsewhere too make a run; a run of
``MIN_WORDS`` words or more is a repeated passage, and all but its first copy can go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Bytes that the hash depends on; one place in ``RATE`` falls below the bound; least distance of two ends.
WINDOW, RATE, GAP = 16, 16, 16
#: Words of the least run that counts as a repeated passage.
MIN_WORDS = 20

#: The gear table: 256 random 16-bit values from a fixed seed.
GEAR = np.random.default_rng(20240229).integers(0, 1 << 16, 256, dtype=np.uint16)


def rolling(raw: np.ndarray) -> np.ndarray:
    """The gear hash behind each byte: sum of GEAR[byte i back] << i over the last WINDOW bytes, modulo 2^16."""
    h, width = GEAR[raw], 1
    while width < WINDOW:  # twice as many bytes each time
        h[width:] = h[width:] + (h[:-width] << width)
        width *= 2
    return h


def chunk_ends(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The places behind which a chunk ends, each text's end included, ascending; texts don't share chunks."""
    if not len(raw):
        return np.zeros(0, np.int64)
    hit = np.flatnonzero(rolling(raw) < (1 << 16) // RATE) + 1
    alone = np.diff(hit, prepend=-GAP) >= GAP
    hit = hit[alone]
    hit = hit[hit < len(raw)]
    hit = hit[(raw[hit] & 0xC0) != 0x80]  # a chunk holds whole characters
    # Near a text's beginning the hash would see the text before it: no ends there.
    start = off[np.searchsorted(off, hit, "left") - 1]
    hit = hit[hit - start >= WINDOW + GAP]
    return np.union1d(hit, off[1:][np.diff(off) > 0])


def _chunk_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest

    for batch in common.chunks(it, 1):
        raw, off = common.compact(batch.column(1))
        ends = chunk_ends(raw, off)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        data = raw.tobytes()
        doc = np.searchsorted(off, begins, "right") - 1
        first = np.searchsorted(begins, off[:-1])
        word_begins, _, _ = common.word_spans(raw, off)
        digests = np.frombuffer(b"".join([xxh3_128_digest(data[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(doc)),
                pa.array(np.ascontiguousarray(digests[:, 0])),
                pa.array(np.ascontiguousarray(digests[:, 1])),
                pa.array((np.arange(len(begins)) - first[doc]).astype(np.int32)),
                pa.array((begins - off[doc]).astype(np.int32)),
                pa.array((ends - begins).astype(np.int32)),
                pa.array(np.diff(np.searchsorted(word_begins, np.append(begins, len(raw)))).astype(np.int32)),
            ],
            names=["doc_id", "d1", "d2", "nth", "at", "size", "words"],
        )


def chunk_table(docs: DataFrame) -> DataFrame:
    """A row for each chunk: doc_id, its digest (d1, d2), its number, place and size in bytes, and words begun in it."""
    own = common.own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return own.transform(common.map_arrow, _chunk_rows, "doc_id long, d1 long, d2 long, nth int, at int, size int, words int")


def repeated_chunks(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The chunks of repeated passages: doc_id, run (a passage of the document), at, size, words, is_first.

    A chunk repeats if documents of different ids have it; is_first marks those of the smallest id, which
    stay when the others go. A passage is a run of neighbouring chunks that repeat, of ``min_words`` words
    or more. Rows with a null doc_id or text are left out. Rows of one id count as one document, and a
    chunk that such rows share counts once. An empty table gives an empty one.
    """
    chunks = common.written(chunk_table(docs.where("doc_id is not null and text is not null")), "chunks")
    owners = chunks.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    # Stored, so that both sides of the join come straight from an exchange, whose hot digests can be split.
    owners = common.written(owners.select("d1", "d2", "first"), "owners")
    found = chunks.join(owners, ["d1", "d2"]).select("doc_id", "nth", "at", "size", "words", (F.col("first") == F.col("doc_id")).alias("is_first"))
    order = Window.partitionBy("doc_id").orderBy("nth", "at", "size")
    found = found.select("*", (F.col("nth") - F.dense_rank().over(Window.partitionBy("doc_id").orderBy("nth"))).alias("run"), F.lag(F.struct("nth", "at", "size")).over(order).alias("before"))
    found = found.where("before is null or before <> struct(nth, at, size)")
    total = F.sum("words").over(Window.partitionBy("doc_id", "run"))
    return found.withColumn("total", total).where(F.col("total") >= min_words).select("doc_id", "run", "at", "size", "words", "is_first")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document with a repeated passage: doc_id, n_passages, repeated_words, removed_words, removed_bytes, passages.

    passages: start and end (in bytes) of each. What is a first occurrence isn't removed. For nulls, repeated
    rows and empty tables see ``repeated_chunks``.
    """
    gone = lambda c: F.when(F.col("is_first"), 0).otherwise(F.col(c))
    runs = repeated_chunks(docs, min_words).groupBy("doc_id", "run").agg(F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("end"), F.sum("words").alias("words"), F.sum(gone("words")).alias("removed_words"), F.sum(gone("size")).alias("removed_bytes"))
    return runs.groupBy("doc_id").agg(
        F.count("*").alias("n_passages"),
        F.sum("words").alias("repeated_words"),
        F.sum("removed_words").alias("removed_words"),
        F.sum("removed_bytes").alias("removed_bytes"),
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("passages"),
    )


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its own columns and rows, and every repeated passage cut from ``text`` but for first occurrences.

    Null texts and rows with a null doc_id stay as they are.
    """
    spans = repeated_chunks(docs, min_words).where("not is_first").groupBy(F.col("doc_id").alias("__loom_id")).agg(F.sort_array(F.collect_list(F.struct("at", "size"))).alias("__loom_spans"))

    @F.pandas_udf("string")
    def cut(text, spans):
        out = []
        for t, s in zip(text, spans, strict=True):
            if t is not None and s is not None:
                raw, kept, at = t.encode(), [], 0
                for x in s:
                    kept.append(raw[at : x["at"]])
                    at = max(at, x["at"] + x["size"])
                t = b"".join([*kept, raw[at:]]).decode("utf-8", "ignore")
            out.append(t)
        import pandas as pd

        return pd.Series(out, dtype=object)

    joined = docs.join(spans, docs["doc_id"].cast("long") == spans["__loom_id"], "left")
    return joined.select(*(F.when(F.col("__loom_spans").isNull(), docs["text"]).otherwise(cut(docs["text"], F.col("__loom_spans"))).alias(c) if c == "text" else docs[f"`{c}`"] for c in docs.columns))
