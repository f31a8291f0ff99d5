"""SimHash near-duplicates by a segment-popcount embedding and a grid join.

A fingerprint of 64 bits is mapped to the bit counts of its 2-bit segments, a point with 32 coordinates. The
Manhattan distance of two points is at most the Hamming distance of the fingerprints. The coordinates fall
into slabs; points within Manhattan distance ``d`` differ in at most ``d`` of the slabs, so they share a grid
cell in some choice of all but ``d`` slabs. The range join is thus an equi-join on (choice, cell); what it finds
passes the Manhattan bound and then the exact Hamming test. More fingerprints get more slabs, so that cells stay
small; every number of slabs gives the same links.

Pairs are found between distinct fingerprints only, so copies cost nothing. Cells that hold many near
fingerprints don't give all pairs: first each is linked to the least of its cell where that is a true link,
and only pairs of different components are joined after that.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: A row of the grid costs about as much as testing so many pairs.
PAIRS_PER_ROW = 20


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The SimHash of each text as unsigned 64-bit: words of lower-cased (A-Z) text, shingles with repeats."""
    from xxhash import xxh64_intdigest

    raw, off = common.compact(texts)
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    begins, ends, counts = common.word_spans(raw, off)
    size = ends - begins
    # All words joined by single spaces: a shingle is one slice of this.
    at = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(at[-1], 32, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = raw[np.arange(int(size.sum())) + np.repeat(begins - (np.cumsum(size) - size), size)]
    text = joined.tobytes()
    word_off = np.concatenate([[0], np.cumsum(counts)])
    n = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
    first = np.repeat(word_off[:-1], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    last = np.minimum(first + shingle, np.repeat(word_off[1:], n))
    hashes = np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)), np.uint64, len(first))
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[full]
    for a in range(0, len(full)):
        h = hashes[starts[a] : starts[a] + n[full[a]]]
        ones = _bit_sums(h)
        out[full[a]] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def _bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set, in blocks of bounded memory."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return total


def _fingerprint_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.chunks(it, 1):
        prints = pa.array(fingerprints(batch.column(1)).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), prints, *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])


def with_fingerprints(docs: DataFrame, *hashes: Column) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and ``hashes`` (longs s1, s2 ...) of each row; a null or empty text has fp 0."""
    own = docs.select(F.col("doc_id").cast("long"), "text", *(h.alias(f"s{k}") for k, h in enumerate(hashes, 1)))
    return own.transform(common.map_arrow, _fingerprint_rows, "doc_id long, fp long" + "".join(f", s{k} long" for k in range(1, len(hashes) + 1)))


def slabs_for(n: int, distance: int) -> int:
    """The number of slabs for n fingerprints: least work for the grid's rows and the pairs in one cell.

    A segment's count has 1.5 bits of information, so a cell of ``s - distance`` of s slabs has 48 / s bits for each.
    """
    rows = lambda s: math.comb(s, distance) * (PAIRS_PER_ROW * n + n * n / 2 ** (48 * (s - distance) / s))
    return min(range(distance + 1, distance + 13), key=rows)


def _masks(slabs: int) -> list[int]:
    """The bits of each slab: consecutive 2-bit segments, as evenly as they go."""
    cuts = [round(i * 32 / slabs) for i in range(slabs + 1)]
    return [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def embedded(fp: Column) -> Column:
    """The 32 segment bit counts in one long, each in unary: 00, 01 or 11 for 0, 1 or 2."""
    low, high = F.lit(0x5555555555555555), F.lit(_signed(0xAAAAAAAAAAAAAAAA))
    some = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(low)
    return some.bitwiseOR(fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(high))


def manhattan(a: Column, b: Column) -> Column:
    """The Manhattan distance of two embedded points: unary coordinates differ in as many bits as they are apart."""
    return F.bit_count(a.bitwiseXOR(b))


def cells(points: DataFrame, distance: int, slabs: int) -> DataFrame:
    """A row for each point (fp, with its other columns) and choice of slabs: ``cell``, a hash of the choice and its coordinates."""
    masks = _masks(slabs)
    point = embedded(F.col("fp"))
    chosen = [_signed(sum(masks[i] for i in c)) for c in itertools.combinations(range(slabs), slabs - distance)]
    keys = F.array(*(F.xxhash64(F.lit(k), point.bitwiseAND(F.lit(m))) for k, m in enumerate(chosen)))
    return points.select("*", F.explode(keys).alias("cell"))


def _near(a: Column, b: Column, distance: int) -> Column:
    return (manhattan(embedded(a), embedded(b)) <= distance) & (F.bit_count(a.bitwiseXOR(b)) <= distance)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """fp and root of each node: the least node (as a signed long) that can be reached from it.

    Each round takes the least root among a node and its neighbours, then follows roots once, until
    nothing changes; a round's table is stored in the shared folder, without its size estimate.
    """
    both = common.cut_anew(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    linked = both.select(F.col("a").alias("fp")).distinct()
    roots = common.cut_anew(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        told = both.join(roots.select(F.col("fp").alias("b"), "root"), "b").select(F.col("a").alias("fp"), "root")
        least = roots.select("fp", "root").union(told).groupBy("fp").agg(F.min("root").alias("root"))
        hop = roots.select(F.col("fp").alias("root"), F.col("root").alias("next"))
        new = common.cut_anew(least.join(hop, "root", "left").select("fp", F.least("root", F.coalesce("next", "root")).alias("root")))
        changed = new.join(roots.withColumnRenamed("root", "old"), "fp").where("root <> old").limit(1).count()
        roots = new
        if not changed:
            break
    return nodes.join(linked, "fp", "left_anti").select("fp", F.col("fp").alias("root")).union(roots)


def link(fps: DataFrame, distance: int = DISTANCE, slabs: int | None = None) -> DataFrame:
    """fp and root for the distinct fingerprints ``fps``: equal roots if and only if linked by a chain of true links."""
    fps = common.cut(fps)
    slabs = slabs or slabs_for(fps.count(), distance)
    grid = cells(fps, distance, slabs)
    # Only cells of several points matter from here on. Stored, so that a crowded cell's rows can be split.
    least = grid.groupBy("cell").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1").select("cell", "hub")
    least = common.cut(least)
    stars = grid.join(least.hint("merge"), "cell").where((F.col("fp") != F.col("hub")) & _near(F.col("fp"), F.col("hub"), distance)).select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()
    rough = common.cut_anew(components(fps, stars))
    points = common.cut(cells(rough, distance, slabs).join(least.select("cell").hint("merge"), "cell", "left_semi"))
    mixed = points.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("cell")
    points = common.cut(points.join(common.cut(mixed), "cell", "left_semi"))
    left = points.select("cell", F.col("fp").alias("a"), F.col("root").alias("ra"))
    right = points.select(F.col("cell").alias("own_cell"), F.col("fp").alias("b"), F.col("root").alias("rb"))
    # One link between two rough components is as good as all of them.
    near = left.join(right, (F.col("cell") == F.col("own_cell")) & (F.col("ra") < F.col("rb")) & _near(F.col("a"), F.col("b"), distance))
    more = common.cut(near.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if more.isEmpty():
        return rough
    roots = rough.select(F.col("root").alias("fp")).distinct()
    # Stored, like all that is joined on a root, so that a large component's rows can be split.
    final = common.cut_anew(components(roots, more).withColumnsRenamed({"fp": "r", "root": "top"}))
    return common.cut_anew(rough.join(final, rough["root"] == final["r"]).select(rough["fp"], F.col("top").alias("root")))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, slabs: int | None = None) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that a chain of links (at most ``distance`` differing bits) reaches,
    itself included; it is null only in a component all of whose ids are null. Null and empty texts have
    fingerprint zero and link like any other. Rows of one doc_id with different texts link by their texts only.
    Repeated rows give repeated rows, an empty table an empty one; other columns are ignored. Texts of any
    length are handled whole.
    """
    prints = common.cut(with_fingerprints(docs))
    least = common.cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = common.cut(link(least.select("fp"), distance, slabs).join(least, "fp"))
    top = common.cut(joined.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id")))
    of_fp = common.cut(joined.join(top, F.col("root") == F.col("r")).select(F.col("fp").alias("own"), "component_id"))
    return prints.join(of_fp, F.col("fp") == F.col("own")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Of each component one row of ``docs``, with all its columns: that of the smallest doc_id (none is the greatest).

    Among different texts of that id the one with the least fingerprint stays, then that of the least hash; of
    rows with the same id and text, any one. Rows of one id in different components all have their own say.
    """
    s1, s2 = F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))
    prints = common.cut(with_fingerprints(docs, s1, s2).groupBy("doc_id", "fp", "s1", "s2").agg(F.count("*").alias("n")))
    roots = common.cut(link(prints.select("fp").distinct(), distance).withColumnRenamed("fp", "own"))
    placed = prints.join(roots, F.col("fp") == F.col("own"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "fp", "s1", "s2", "n")).alias("first"))
    keepers = common.cut(first.select(*(F.col(f"first.{c}").alias(f"__loom_{c}") for c in ("doc_id", "s1", "s2", "n"))))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__loom_doc_id")) & (s1 == F.col("__loom_s1")) & (s2 == F.col("__loom_s2"))
    kept = docs.join(keepers.where("__loom_n = 1"), same, "left_semi")
    repeated = keepers.where("__loom_n > 1")
    if repeated.isEmpty():
        return kept
    once = docs.join(repeated, same).dropDuplicates(["__loom_doc_id", "__loom_s1", "__loom_s2"]).select(*(docs[f"`{c}`"] for c in docs.columns))
    return kept.union(once)
