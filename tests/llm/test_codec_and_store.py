import base64
import hashlib
import os
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import bpe_codec, id_store

RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(bpe_codec.read_ranks(RANKS), P.PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_codec_equals_tiktoken(reference, codec, text):
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_every_piece_encodes_to_itself(codec):
    for i, w in list(enumerate(codec.vocab))[::97]:
        assert codec.decode(struct.pack("<I", i)) == w


def test_ranks_with_a_gap_are_refused(tmp_path):
    path = tmp_path / "x"
    path.write_bytes(base64.b64encode(b"a") + b" 1\n")
    with pytest.raises(ValueError, match="gap"):
        bpe_codec.read_ranks(str(path))


def test_encode_documents_edges(reference, edges, empty):
    rows = bpe_codec.encode_documents(edges, RANKS, P.PATTERN, with_ids=True).collect()
    texts = edges.select("doc_id", "text").collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in rows) == sorted((t.doc_id or -1, (t.text or "").encode()) for t in texts)
    for r in rows:
        text = bytes(r.decoded).decode()
        ids = reference.encode_ordinary(text)
        assert (r.n_tokens, list(r.ids)) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe_codec.encode_documents(empty, RANKS, P.PATTERN).collect() == []


def expected_rows(rows):
    tokenizer, start, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in sorted(((r.doc_id, r.text) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_store_equals_the_library(spark, edges):
    store = id_store.write_store(edges, WORDS, 2, rows_per_shard=3)
    got = sorted((tuple(r) for r in id_store.read_store(spark, store).collect()), key=lambda r: r[1])
    assert got == expected_rows(edges.collect())
    assert len(id_store.lookup(store, 5)) == 2
    assert id_store.lookup(store, 2)[0].tolist() == [2]
    assert id_store.lookup(store, 10**12) == [] and id_store.lookup(store, -1) == []


def test_every_key_is_found_by_the_opened_store(spark, frame, prose):
    rows = [(7 * i - 500, prose(1 + i % 9, i)) for i in range(200)] + [(0, f"again {i}") for i in range(40)] + [(None, "no id")] * 30
    store = id_store.write_store(frame(rows), WORDS, 2, rows_per_shard=20)
    opened, tokenizer = id_store.Store(store, most_open=2), Tokenizer.from_file(WORDS)
    assert len(opened.shards) > 5
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append([*tokenizer.encode(t, add_special_tokens=False).ids, 2])
    for d in {d for d, _ in rows} - {None}:
        assert sorted(x.tolist() for x in opened.get(d)) == sorted(want[d])
    assert all(opened.get(d) == [] for d in (-501, 1, 10**15, -(10**15)))
    # rows of one id, or of none, are dealt over several shards
    assert len({m["path"] for m in opened.shards if m["first_key"] <= 0 <= m["last_key"]}) > 1
    assert id_store.read_store(spark, store).count() == len(rows)


def test_a_wrong_index_is_noticed(spark, frame):
    store = id_store.write_store(frame([(i, f"text {i}") for i in range(50)]), WORDS, 2)
    path = id_store.read_manifest(store)[0]["path"].removeprefix("file:")
    at, size = id_store.Shard(path).foot["at"]["ordinals"]
    data = bytearray(open(path, "rb").read())
    data[at : at + size] = data[at : at + size][::-1]
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="doesn't lead to the documents"):
        id_store.read_store(spark, store).collect()


def test_every_text_of_the_documents_is_encoded_as_a_whole(spark):
    """Words put together equal the library's encoding of whole texts, on all of the driver's smaller table."""
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(sf):
        pytest.skip("the driver's tables are absent")
    texts = pq.read_table(sf, columns=["text"]).column("text").combine_chunks()
    encoder = id_store.WordEncoder(open(WORDS, encoding="utf-8").read())
    ids, sizes = encoder.encode(texts, 2)
    whole = [[*e.ids, 2] for e in encoder.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in whole] and ids.tolist() == [i for x in whole for i in x]


def test_empty_store(spark, empty):
    assert id_store.read_store(spark, id_store.write_store(empty, WORDS, 2)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB'.,-!<|>é́ \n12中’", max_size=60))
def test_word_encoder_equals_the_library(text):
    import pyarrow as pa

    encoder = id_store.WordEncoder(open(WORDS, encoding="utf-8").read())
    ids, sizes = encoder.encode(pa.array([text, None, text]), 2)
    whole = [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert ids.tolist() == [*whole, 2, *whole]
    assert sizes.tolist() == [len(whole), 1, len(whole)]


def test_full_cache_forgets_but_encodes_alike(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(id_store, "CACHE_WORDS", 2)
    encoder = id_store.WordEncoder(open(WORDS, encoding="utf-8").read())
    for text in ("one two three", "four five", "one six", "two two"):
        assert encoder.encode(pa.array([text]), 2)[0].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    own = np.array(sorted(keys), np.int64)
    index = id_store.PerfectHash.build(own)
    assert sorted(index.find(own).tolist()) == list(range(len(own)))
    stored = id_store.PerfectHash(index.levels, index.rest)
    assert stored.find(own).tolist() == index.find(own).tolist()


def test_half_a_shard_is_refused(tmp_path):
    (tmp_path / "x.ids").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="complete"):
        id_store.Shard(str(tmp_path / "x.ids"))
