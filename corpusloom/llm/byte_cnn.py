"""A byte-level convolutional network for text quality, trained and applied in numpy.

Learned filters of ``WIDTH`` bytes slide over every byte of a text. Chunks of ``CHUNK`` positions overlap by
``BLOCK`` positions and together cover the whole text; each filter is max-pooled within a chunk and
rectified. The mean and the maximum over a text's chunks go through one logistic unit, which gives one
probability for a text of any length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH, FILTERS, BLOCK, BLOCKS = 6, 12, 64, 8
CHUNK, STEP = BLOCK * BLOCKS, BLOCK * (BLOCKS - 1)
#: Labelled rows of each class that the network is fitted on, at most about (they are drawn by a hash).
ROWS_PER_CLASS = 1500
#: Chunks of one text that one training step sees, drawn anew each epoch; scoring always uses all.
TRAIN_CHUNKS = 24
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.01, 7
_SLICE = 1 << 17


def layout(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out in blocks: the padded bytes, and the number of blocks of each text.

    A text has a block at least, and a block of zeros after it that belongs to nobody.
    """
    size = np.diff(off)
    blocks = np.maximum(1, -(-size // BLOCK))
    at = np.concatenate([[0], np.cumsum(blocks + 1)]) * BLOCK
    data = np.zeros(at[-1] + WIDTH, np.uint8)
    if len(raw):
        data[np.arange(len(raw)) + np.repeat(at[:-1] - off[:-1], size)] = raw
    return data, blocks


def chunk_bounds(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-plus-one block of each chunk, as laid out, and how many chunks each text has."""
    n = np.maximum(1, -(-(blocks - 1) // (BLOCKS - 1)))
    first_block = np.concatenate([[0], np.cumsum(blocks + 1)])[:-1]
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(first_block, n) + nth * (BLOCKS - 1)
    return begin, np.minimum(begin + BLOCKS, np.repeat(first_block + blocks, n)), n


@dataclass
class Network:
    """taps: WIDTH x 256 x FILTERS; bias: FILTERS; out: 2 x FILTERS weights of the means and maxima; offset."""

    taps: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float

    def pair_tables(self) -> list[np.ndarray]:
        """For each two neighbouring taps, their sum for any two bytes."""
        return [np.ascontiguousarray((self.taps[k][:, None, :] + self.taps[k + 1][None, :, :]).reshape(65536, -1), np.float32) for k in range(0, WIDTH, 2)]

    def score(self, raw: np.ndarray, off: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """The probability of label 1 for each text."""
        data, blocks = layout(raw, off)
        total = (len(data) - WIDTH) // BLOCK
        pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
        top = np.empty((total, len(self.bias)), np.float32)
        for a in range(0, total * BLOCK, _SLICE):
            b = min(a + _SLICE, total * BLOCK)
            out = tables[0][pairs[a:b]]
            for k in range(1, len(tables)):
                out += tables[k][pairs[a + 2 * k : b + 2 * k]]
            top[a // BLOCK : b // BLOCK] = out.reshape(-1, BLOCK, out.shape[1]).max(1)
        begin, end, n = chunk_bounds(blocks)
        pooled = top[begin]
        for k in range(1, BLOCKS):
            pooled = np.maximum(pooled, top[np.minimum(begin + k, end - 1)])
        hidden = np.maximum(pooled + self.bias, 0)
        at = np.cumsum(n) - n
        mean = np.add.reduceat(hidden, at, axis=0) / n[:, None]
        z = np.concatenate([mean, np.maximum.reduceat(hidden, at, axis=0)], 1) @ self.out.reshape(-1) + self.offset
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def fit(texts: list[str | None], labels: np.ndarray, weights: np.ndarray) -> Network:
    """A network fitted by Adam on weighted log loss; the same rows in the same order give the same network.

    With no rows the network is untrained, and with one class it learns that class's share.
    """
    rng = np.random.default_rng(SEED)
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.5
    net = Network(rng.normal(0, 0.15, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, (2, FILTERS)), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    params = [net.taps, net.bias, net.out, np.array([net.offset])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(EPOCHS if len(texts) else 0):
        rows = rng.permutation(len(texts))
        for b in range(0, len(rows), BATCH):
            own = rows[b : b + BATCH]
            raw, off = common.compact(pa.array([texts[i] for i in own], pa.large_string()))
            data, blocks = layout(raw, off)
            begin, end, n = chunk_bounds(blocks)
            doc = np.repeat(np.arange(len(own)), n)
            lot = np.lexsort((rng.random(len(doc)), doc))
            keep = np.sort(lot[(np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) < TRAIN_CHUNKS])
            begin, end, doc = begin[keep], end[keep], doc[keep]
            n = np.bincount(doc, minlength=len(own))
            at = np.cumsum(n) - n
            # Forward: each chunk's windows, padded by repeating its last block.
            base = np.minimum(begin[:, None] + np.arange(BLOCKS), end[:, None] - 1) * BLOCK
            where = (base[:, :, None] + np.arange(BLOCK)).reshape(len(begin), CHUNK)
            out = params[0][0][data[where]]
            for k in range(1, WIDTH):
                out += params[0][k][data[where + k]]
            best = out.argmax(1)
            pooled = np.take_along_axis(out, best[:, None, :], 1)[:, 0] + params[1]
            hidden = np.maximum(pooled, 0)
            mean = np.add.reduceat(hidden, at, axis=0) / n[:, None]
            most = np.maximum.reduceat(hidden, at, axis=0)
            z = mean @ params[2][0] + most @ params[2][1] + params[3][0]
            error = (1 / (1 + np.exp(-z)) - labels[own]) * weights[own] / len(own)
            # Backward: only the windows that won the pooling get a gradient.
            hit = (hidden == most[doc]) & (hidden > 0)
            to_hidden = (error / n)[doc][:, None] * params[2][0] + error[doc][:, None] * params[2][1] * hit
            to_hidden *= pooled > 0
            win = np.take_along_axis(where, best, 1)
            grad = np.zeros_like(params[0])
            f = np.broadcast_to(np.arange(FILTERS), win.shape)
            for k in range(WIDTH):
                np.add.at(grad[k], (data[win + k], f), to_hidden)
            grads = [grad, to_hidden.sum(0), np.stack([error @ mean, error @ most]) + 1e-4 * params[2], np.array([error.sum()])]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(params[0].astype(np.float32), params[1].astype(np.float32), params[2].astype(np.float32), float(params[3][0]))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, held_out_mod: int, rows_per_class: int) -> tuple[list, np.ndarray, np.ndarray]:
    """About ``rows_per_class`` texts of each class, drawn by a hash of the id from rows that aren't held out.

    Weights restore the classes' shares. Rows without a label, or of ids with several labels, use the largest.
    """
    own = labels.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)").where(common.crc_mod("_id", held_out_mod) != 0).groupBy("_id").agg(F.max("_y").alias("_y"))
    size = {r._y: r["count"] for r in own.groupBy("_y").count().collect()}
    if not size:
        return [], np.zeros(0), np.zeros(0)
    lot = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) / float(1 << 20)
    bound = F.coalesce(*(F.when(F.col("_y") == y, F.lit(rows_per_class / n)) for y, n in size.items()))
    picked = F.broadcast(own.where(lot < bound))  # about 2 x rows_per_class ids
    rows = common.own_columns(docs, "doc_id", "text").join(picked, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_y").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    y = rows.column("_y").to_numpy().astype(np.float64)
    got = np.bincount(y.astype(int), minlength=2)
    share = {k: n / sum(size.values()) for k, n in size.items()}
    weight = np.array([share.get(k, 0) * len(y) / got[k] if got[k] else 0 for k in (0, 1)])
    return rows.column("text").to_pylist(), y, weight[y.astype(int)]


def _run(net: Network) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables()
        for batch in common.chunks(it, 1):
            p = net.score(*common.compact(batch.column(1)), tables)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(p), pa.array((p >= 0.3).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return go


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", held_out_mod: int = 5, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (probability of label 1) and predicted (score >= 0.3).

    Fits on at most about ``rows_per_class`` labelled rows of each class. Null and empty texts get the
    network's score of no bytes. Null ids count as not labelled. Repeated rows give repeated rows, an empty
    table an empty one; other columns are ignored. Without any labels every score comes from an untrained
    network.
    """
    net = fit(*training_rows(docs, labels, label_col, held_out_mod, rows_per_class))
    own = common.own_columns(docs, "doc_id", "text").select("doc_id", "text", (common.crc_mod("doc_id", held_out_mod) == 0).alias("held_out"))
    return own.transform(common.map_arrow, _run(net), "doc_id long, held_out boolean, score double, predicted int")
