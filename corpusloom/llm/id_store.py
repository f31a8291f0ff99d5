"""Token ids in shards of raw binary, with a minimal perfect hash index from document key to offset.

A shard holds the ids of a range of documents, in ascending order of the key, one after another as
little-endian integers. Behind them stand the documents' offsets and keys, and the index: a cascade of bit
vectors (each level keeps the keys that are alone in their place, the others go to the next) whose ranks
number the distinct keys without a gap, then per number a 32-bit fingerprint of the key and the first
document that has it. A lookup hashes the key a few times, reads one number, compares the fingerprint and
slices the payload. A footer says where each section is.
"""

from __future__ import annotations

import itertools
import json
import os
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MAGIC = b"LOOMIDS1"
#: Rows of a shard, about: the former while that gives no more than some shards for each core, and up to the
#: latter beyond it, so that a huge table doesn't have millions of shards.
ROWS_PER_SHARD, MOST_ROWS_PER_SHARD, SHARDS_PER_CORE = 8192, 1 << 17, 8
#: Words whose ids a worker keeps; later ones are encoded anew in each chunk.
CACHE_WORDS = 900_000
_GAMMA, _MOST_LEVELS = 2, 40
_CHUNK_BYTES = 12 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER, _POINT = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True  # ASCII punctuation but for the apostrophe, which may begin a suffix


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys (the public splitmix64 finaliser with its fixed multipliers)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest  # bits as uint8, 8 places a byte; keys that no level took, sorted
        self.ranks = []
        total = 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(np.cumsum(ones) - ones + total)
            total += int(ones.sum())
        self.total = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys) and len(levels) < _MOST_LEVELS:
            size = max(64, -(-_GAMMA * len(keys) // 64) * 64)
            at = (mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(levels, np.sort(keys))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; some number, or -1, for a key that isn't in the set."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mix(keys[left], level) % np.uint64(len(bits) * 8)).astype(np.int64)
            byte, bit = bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit & 1).astype(bool)
            below = np.bitwise_count(byte & ((np.uint16(1) << bit) - 1).astype(np.uint8))
            out[left[hit]] = rank[at[hit] >> 3] + below[hit]
            left = left[~hit]
        if len(self.rest) and len(left):
            i = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            found = self.rest[i] == keys[left]
            out[left[found]] = self.total + i[found]
        return out


def filesystem(path: str):
    """The file system and the path in it, for a URI or a plain path."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


class ShardWriter:
    """Writes one shard: ``add`` in ascending order of keys (missing keys first), then ``close``."""

    def __init__(self, path: str, dtype: str):
        self.fs, self.path = filesystem(path)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{os.path.dirname(self.path)}/.{os.path.basename(self.path)}.{uuid.uuid4().hex}"
        self.out, self.dtype = self.fs.open_output_stream(self.part), np.dtype(dtype)
        self.sizes: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.missing = 0

    def add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.out.write(ids.astype(self.dtype).tobytes())
        self.sizes.append(sizes)
        self.missing += keys.null_count
        self.keys.append(keys.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))

    def close(self) -> tuple[int, int]:
        """Numbers of documents and ids."""
        sizes, keys = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.sizes, self.keys))
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
        own, first = np.unique(keys, return_index=True)
        index = PerfectHash.build(own)
        number = index.find(own)
        prints, ordinals = np.zeros(len(own), "<u4"), np.zeros(len(own), "<u4")
        prints[number], ordinals[number] = fingerprint(own), first + self.missing
        at, where = int(offsets[-1]) * self.dtype.itemsize, {}
        for name, data in (("offsets", offsets), ("keys", keys.astype("<i8")), ("prints", prints), ("ordinals", ordinals), ("rest", index.rest.astype("<i8")), *((f"level{i}", bits) for i, bits in enumerate(index.levels))):
            where[name] = [at, data.nbytes]
            self.out.write(data.tobytes())
            at += data.nbytes
        foot = json.dumps({"dtype": self.dtype.str, "docs": len(sizes), "ids": int(offsets[-1]), "missing": self.missing, "levels": len(index.levels), "at": where}).encode()
        self.out.write(foot + len(foot).to_bytes(4, "little") + MAGIC)
        self.out.close()
        self.fs.move(self.part, self.path)  # complete or absent: a lost task leaves no half shard
        return len(sizes), int(offsets[-1])


class Shard:
    """Reads one shard: by key in constant time, or all documents in blocks."""

    def __init__(self, path: str):
        self.fs, self.path = filesystem(path)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        tail = self.file.read_at(min(size, 65536), max(0, size - 65536))
        if tail[-8:] != MAGIC:
            raise ValueError(f"{path} is no complete shard")
        n = int.from_bytes(tail[-12:-8], "little")
        self.foot = json.loads(tail[-12 - n : -12] if n + 12 <= len(tail) else self.file.read_at(n, size - 12 - n))
        self.dtype = np.dtype(self.foot["dtype"])
        self._index = None

    def section(self, name: str, dtype: str) -> np.ndarray:
        at, size = self.foot["at"][name]
        return np.frombuffer(self.file.read_at(size, at), dtype)

    def slice(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last``, counted within the shard."""
        return np.frombuffer(self.file.read_at((last - first) * self.dtype.itemsize, first * self.dtype.itemsize), self.dtype).astype("<u4")

    def index(self) -> tuple[PerfectHash, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The hash, fingerprints and first documents by number, offsets and keys by document; read once."""
        if self._index is None:
            levels = [self.section(f"level{i}", "u1") for i in range(self.foot["levels"])]
            self._index = PerfectHash(levels, self.section("rest", "<i8")), self.section("prints", "<u4"), self.section("ordinals", "<u4"), self.section("offsets", "<u8"), self.section("keys", "<i8")
        return self._index

    def first_of(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key, by its number and fingerprint; -1 for a key that isn't here.

        A key that isn't here passes for another with a chance of 2^-32; ``get`` compares the stored key, too.
        """
        index, prints, ordinals, _, _ = self.index()
        number = index.find(keys)
        known = np.flatnonzero(number >= 0)
        known = known[prints[number[known]] == fingerprint(keys[known])]
        out = np.full(len(keys), -1, np.int64)
        out[known] = ordinals[number[known]]
        return out

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with this key (several if rows were repeated), or an empty list."""
        doc, out = int(self.first_of(np.array([key], np.int64))[0]), []
        _, _, _, offsets, keys = self.index()
        while 0 <= doc < self.foot["docs"] and keys[doc - self.foot["missing"]] == key:
            out.append(self.slice(int(offsets[doc]), int(offsets[doc + 1])))
            doc += 1
        return out

    def places(self) -> np.ndarray:
        """Where the index says that each document stands: its key's first document, and how many of that key come before it.

        Documents without a key come first.
        """
        keys, missing = self.index()[4], self.foot["missing"]
        run = np.arange(len(keys)) - np.searchsorted(keys, keys, "left")
        return np.concatenate([np.arange(missing), self.first_of(keys) + run])

    def blocks(self, ids: int = 1 << 20) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """Keys (null where missing), offsets (one more) and ids of the documents, some at a time."""
        offsets, keys, missing = self.section("offsets", "<u8").astype(np.int64), self.section("keys", "<i8"), self.foot["missing"]
        all_keys = pa.concat_arrays([pa.nulls(missing, pa.int64()), pa.array(keys, pa.int64())])
        a = 0
        while a < self.foot["docs"]:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + ids, "right")) - 1)
            yield all_keys.slice(a, b - a), offsets[a : b + 1], self.slice(int(offsets[a]), int(offsets[b]))
            a = b


class WordEncoder:
    """The tokenizers library applied to distinct words; texts are gathered from their words.

    That equals encoding the whole text for tokenizers that drop white space and never join what it
    separates, as word-level ones with an end-of-word mark do. If the tokenizer's own settings say so,
    words are lower-cased (A-Z) and cut between a letter and ASCII punctuation first, as it would do itself;
    then fewer of them are distinct. Neither is done in a chunk with ``<|``, where a special token may stand.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        settings = json.loads(tokenizer_json)
        self.lowers = '"Lowercase"' in json.dumps(settings["normalizer"])
        self.cuts = all(x in json.dumps(settings["pre_tokenizer"]) for x in (r"[\\p{L}]+|", r"|[^\\s\\p{L}\\p{N}]+"))
        # Characters of text that a token stands for, as long as the text is ASCII.
        mark = settings["model"].get("end_of_word_suffix") or ""
        pieces = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
        self.widths = np.array([len(x.removesuffix(mark)) for x in pieces], np.int64)
        self.known: dict[str, int] = {}
        self.sizes = np.zeros(1024, np.int64)
        self.starts = np.zeros(1024, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.n = self.used = 0

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number per word from one text of all the words, which is quicker than one by one.

        The words' ends are found by the lengths of the tokens; None if they don't fit.
        """
        flat = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        ends, wanted = np.cumsum(self.widths[flat]), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.searchsorted(ends, wanted)
        if not len(flat) or at[-1] != len(ends) - 1 or not np.array_equal(ends[at], wanted):
            return None
        return flat, np.diff(at, prepend=-1)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.int32, int(size.sum())), size

    def _add(self, words: list[str]) -> None:
        """Adds words that are all ASCII or, if not, are encoded one by one."""
        flat, size = (self._together(words) if words[0].isascii() else None) or self._each(words)
        while self.n + len(words) > len(self.sizes):
            self.sizes, self.starts = np.resize(self.sizes, 2 * len(self.sizes)), np.resize(self.starts, 2 * len(self.starts))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.sizes[self.n : self.n + len(words)] = size
        self.starts[self.n : self.n + len(words)] = self.used + np.cumsum(size) - size
        self.ids[self.used : self.used + len(flat)] = flat
        self.n, self.used = self.n + len(words), self.used + len(flat)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the texts one after another with ``end_id`` behind each, and the number of each text's."""
        raw, off = common.compact(texts)
        plain = b"<|" not in raw.tobytes()
        begins, ends, counts = common.word_spans(raw, off, _LETTER, _POINT) if plain and self.cuts else common.word_spans(raw, off)
        if plain and self.lowers:
            raw = _LOWER[raw]
        words = common.words_of(raw, begins, ends).dictionary_encode()
        names, known = words.dictionary.to_pylist(), self.known
        at = np.fromiter(map(known.get, names, itertools.repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(at < 0)
        keep = self.n, self.used
        new = [names[i] for i in missing.tolist()]
        simple = np.fromiter(map(str.isascii, new), bool, len(new))
        missing = np.concatenate([missing[simple], missing[~simple]])
        for part in ([w for w, x in zip(new, simple, strict=True) if x], [w for w, x in zip(new, simple, strict=True) if not x]):
            for a in range(0, len(part), 4096):
                self._add(part[a : a + 4096])
        at[missing] = np.arange(keep[0], self.n)
        if full := len(known) + len(missing) > CACHE_WORDS:
            keep_n, keep_used = keep
        else:
            known.update((names[i], j) for i, j in zip(missing.tolist(), at[missing].tolist(), strict=True))
        word = at[words.indices.to_numpy()] if len(names) else np.zeros(0, np.int64)
        size = self.sizes[word]
        word_ends = np.cumsum(size)
        flat = self.ids[np.arange(int(size.sum())) + np.repeat(self.starts[word] - (word_ends - size), size)]
        doc_ends = np.concatenate([[0], word_ends])[np.cumsum(counts)]
        out = np.insert(flat, doc_ends, end_id)
        if full:
            self.n, self.used = keep_n, keep_used  # the cache is full: this chunk's new words are forgotten
        return out, np.diff(np.concatenate([[0], doc_ends])) + 1


_encoders: dict[int, WordEncoder] = {}


def _write(out_dir: str, tokenizer_json: str, end_id: int, dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key = zlib.crc32(tokenizer_json.encode())
        if key not in _encoders:
            _encoders[key] = WordEncoder(tokenizer_json)
        number = TaskContext.get().partitionId()
        path, writer, first, last = f"{out_dir}/shard-{number:06d}.ids", None, None, None
        for batch in common.chunks(it, 1, _CHUNK_BYTES):
            writer = writer or ShardWriter(path, dtype)
            keys = batch.column(0).cast(pa.int64())
            writer.add(keys, *_encoders[key].encode(batch.column(1), end_id))
            here = keys.drop_null()
            if len(here):
                first = here[0].as_py() if first is None else first
                last = here[-1].as_py()
        if writer:
            docs, ids = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((number, pa.int64()), (path, pa.string()), (docs, pa.int64()), (ids, pa.int64()), (first, pa.int64()), (last, pa.int64()))], names=["shard", "path", "docs", "ids", "first_key", "last_key"])

    return go


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, out_dir: str | None = None, rows_per_shard: int = ROWS_PER_SHARD) -> str:
    """Encodes every text and writes the shards and their manifest; returns the folder.

    A null text counts as empty and has the end id alone. Rows with a null key come first and are read in
    order but have no entry in the index; rows of equal keys stand in order of the input, in one shard or in
    several. An empty table gives a store without shards. Texts of any length are encoded whole. Other columns are ignored. The folder must be one that all executors and
    the driver share: by default a new one under ``spark.checkpoint.dir``. A repeated task overwrites its
    shard with the same bytes. The driver gets one row per shard.
    """
    spark = docs.sparkSession
    out_dir = out_dir or f"{common.shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    from tokenizers import Tokenizer

    dtype = "<u2" if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    own = common.own_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows, most = own.select("doc_id").count(), max(rows_per_shard, MOST_ROWS_PER_SHARD)
    shards = max(1, min(-(-rows // rows_per_shard), max(SHARDS_PER_CORE * spark.sparkContext.defaultParallelism, -(-rows // most))))
    # The row's number lets rows of one id, or of none, go to several shards.
    ordered = own.withColumn("lot", F.monotonically_increasing_id()).repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "lot").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "lot").drop("lot")
    schema = "shard long, path string, docs long, ids long, first_key long, last_key long"
    written = sorted(ordered.transform(common.map_arrow, _write(out_dir, tokenizer_json, end_id, dtype), schema).collect())
    start, manifest = 0, []
    for r in written:
        manifest.append({**r.asDict(), "start": start})
        start += r.ids
    fs, path = filesystem(out_dir)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps({"end_id": end_id, "shards": manifest}).encode())
    return out_dir


def read_manifest(store: str) -> list[dict]:
    fs, path = filesystem(store)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        return json.loads(f.read())["shards"]


class Store:
    """An opened store: the manifest is read once, the last ``most_open`` shards stay open with their indexes."""

    def __init__(self, path: str, most_open: int = 64):
        self.shards = [m for m in read_manifest(path) if m["first_key"] is not None]
        self.firsts, self.lasts = [m["first_key"] for m in self.shards], [m["last_key"] for m in self.shards]
        self.open = lru_cache(most_open)(Shard)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with this key: the shards by their ranges, the document by the perfect hash."""
        at = range(bisect_left(self.lasts, key), bisect_right(self.firsts, key))
        return [ids for i in at for ids in self.open(self.shards[i]["path"]).get(key)]


def lookup(store: str, key: int) -> list[np.ndarray]:
    """The ids of each document with this key; for many keys open the ``Store`` once."""
    return Store(store).get(key)


def _read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard, done = Shard(path), 0
            places, offsets = shard.places(), shard.index()[3].astype(np.int64)
            if not np.array_equal(places, np.arange(len(places))):
                raise ValueError(f"{path}: the index doesn't lead to the documents")
            for keys, block, ids in shard.blocks():
                own = places[done : done + len(keys)]
                begins, ends = offsets[own], offsets[own + 1]
                sums = [zlib.crc32(ids[a:b]) for a, b in zip((begins - block[0]).tolist(), (ends - block[0]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys, pa.array(begins + start), pa.array(ends - begins), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                done += len(keys)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, from the files.

    Every key is found through its shard's hash, fingerprint and offset; an index that doesn't lead to the
    documents in their order is an error.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    manifest = read_manifest(store)
    if not manifest:
        return spark.createDataFrame([], schema)
    shards = spark.createDataFrame([(m["path"], m["start"]) for m in manifest], "path string, start long")
    return shards.repartition(len(manifest)).transform(common.map_arrow, _read, schema)
