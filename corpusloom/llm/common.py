"""What the operators share: shared scratch space, bounded Arrow chunks, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, ship, stored

#: Bytes of text that a Python worker handles at once; a longer single text makes a chunk of its own.
CHUNK_BYTES = 3 << 20

#: ASCII white space as bytes: space and \t \n \v \f \r.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder (a reliable checkpoint), for small tables."""
    at, sc = shared_dir(df.sparkSession), df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return df.checkpoint(eager=True)


def cut_anew(df: DataFrame) -> DataFrame:
    """Like ``cut``, for tables that a loop makes out of themselves: Spark forgets how large it took ``df`` to be.

    A checkpoint keeps its plan's estimate, and that of a join is the product of its sides, so that in a loop
    with joins the number's digits multiply in each round, until the driver's memory can't hold it.
    """
    kept = cut(df)._jdf
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(kept.queryExecution().logical().rdd(), kept.schema(), False), spark)


#: ``written(df, name)``: df written as Parquet under a new name in the shared folder, and read back.
written = stored


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def chunks(it: Iterator[pa.RecordBatch], column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices whose ``column`` (text) holds at most ``most`` bytes, or one row."""
    for batch in it:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()  # workers live on and share the executor's memory


def compact(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and each text's offsets (one more than texts).

    A null counts as empty.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words ``[^\\x20\\x09-\\x0D]+`` begin and end in ``raw``, and how many each text has.

    Words don't run on from one text into the next. Given the byte classes ``before`` and ``after``, words
    are also cut between a byte of the one and a byte of the other.
    """
    solid = ~_SPACE[raw]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    if before is not None:
        start[1:] |= before[raw[:-1]] & after[raw[1:]]
    edge = off[1:-1][off[1:-1] < len(raw)]
    start[edge] = solid[edge]  # a text's first byte begins a word whatever stands before it
    end = solid.copy()
    end[:-1] &= ~solid[1:] | start[1:]
    begins, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return begins, ends, np.diff(np.searchsorted(begins, off))


def words_of(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow array: one copy of the words' bytes, without the gaps."""
    if not len(begins):
        return pa.array([], pa.large_string())
    depth = np.zeros(len(raw) + 1, np.int8)
    depth[begins] += 1
    depth[ends] -= 1  # ends are distinct, but one may be the next word's beginning
    inside = np.cumsum(depth[:-1], dtype=np.int8).astype(bool)
    data = raw[inside]
    offsets = np.concatenate([[0], np.cumsum(ends - begins)])
    return pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


def own_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns; a missing one is an error, others are left out and can't clash."""
    return df.select(*(F.col(f"`{c}`").alias(c) for c in columns))


def bounded(stored: DataFrame, rows: int) -> DataFrame:
    """A stored table marked for broadcast if it has at most ``rows`` rows (counted), or as it is."""
    return F.broadcast(stored) if stored.count() <= rows else stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, mod: int):
    """crc32 of the id as text, modulo ``mod``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(mod)
