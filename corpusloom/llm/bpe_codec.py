"""Byte-level BPE encoding and decoding through a sentencepiece model made from the rank file.

The rank file's vocabulary is serialised straight into a sentencepiece ``ModelProto``: every byte is
mapped to one printable character, each entry becomes a piece whose score is its negative rank, and the
normaliser is the identity. sentencepiece's BPE then merges the pair of the best score, leftmost first,
which is the merge of the lowest rank. Each pre-token is encoded on its own; decoding maps ids back to
pieces and characters back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Entries of a worker's pre-token cache; it starts anew when full, so memory stays bounded.
CACHE_WORDS = 200_000
#: A pre-token of more characters isn't cached.
CACHE_CHARS = 64


def byte_letters() -> list[str]:
    """One printable character for each byte: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file, in order of rank; ranks must run from 0 without a gap."""
    with open(path, "rb") as f:
        pairs = [(int(rank), base64.b64decode(word)) for word, rank in (line.split() for line in f if line.strip())]
    pairs.sort()
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks must run from 0 without a gap")
    return [w for _, w in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes as length-delimited, int as varint, float as 32-bit."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(vocab: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the last id, one more, is <unk>.

    Fixed values of the public ModelProto: pieces=1 (piece=1, score=2, type=3 with UNKNOWN=2),
    trainer_spec=2 (model_type=3 with BPE=2, vocab_size=4), normalizer_spec=3 (name=1,
    add_dummy_prefix=3, remove_extra_whitespaces=4, escape_whitespaces=5).
    """
    letter = byte_letters()
    pieces = [_field(1, _field(1, "".join(letter[b] for b in w).encode()) + _field(2, float(-rank))) for rank, w in enumerate(vocab)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes texts; one per Python worker."""

    def __init__(self, vocab: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.vocab = vocab
        self.whole = {w: struct.pack("<I", i) for i, w in enumerate(vocab)}
        self.letters = dict(zip(range(256), byte_letters(), strict=True))
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(vocab))
        self.cache: dict[str, bytes] = {}

    def _piece(self, word: str) -> bytes:
        """Ids of one pre-token as little-endian 32-bit integers."""
        raw = word.encode()
        if (one := self.whole.get(raw)) is None:
            one = np.array(self.model.encode(raw.decode("latin-1").translate(self.letters)), "<u4").tobytes()
        return one

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian 32-bit integers."""
        words, cache = self.split(text), self.cache
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            pass
        if len(cache) > CACHE_WORDS:
            cache.clear()
        own = {}
        for w in set(words):
            if (ids := cache.get(w)) is None:
                ids = self._piece(w)
                if len(w) <= CACHE_CHARS and len(cache) <= CACHE_WORDS:
                    cache[w] = ids
            own[w] = ids
        return b"".join([own[w] for w in words])

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the pieces that the ids name."""
        vocab = self.vocab
        return b"".join([vocab[i] for i in np.frombuffer(ids, "<u4").tolist()])


_codecs: dict[tuple, Codec] = {}


def _codec(vocab: list[bytes], pattern: str) -> Codec:
    key = (len(vocab), hashlib.sha256(b"\0".join(vocab)).digest(), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(vocab, pattern)
    return _codecs[key]


def _run(vocab: list[bytes], pattern: str, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def go(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocab, pattern)
        for batch in common.chunks(it, 1):
            n, sums, backs, all_ids, texts = [], [], [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                back = codec.decode(ids)
                n.append(len(ids) // 4)
                sums.append(hashlib.sha256(ids).hexdigest())
                backs.append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    all_ids.append(np.frombuffer(ids, "<u4").astype(np.int32))
                    texts.append(back)
            out = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sums, pa.string()), pa.array(backs, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                out += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return go


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` the ids and decoded bytes.

    A null text counts as empty: no tokens, and the digests of nothing. A null id stays null. Repeated rows
    give repeated rows, an empty table an empty one, and other columns of ``docs`` are ignored. The rank
    file is read on the driver and travels with the tasks, so executors need no copy.
    """
    vocab = read_ranks(rank_file)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else "")
    return common.own_columns(docs, id_col, text_col).transform(common.map_arrow, _run(vocab, pattern, with_ids), schema)
