import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from weftline.llm import bpe, token_store
from weftline.llm.files import at

from .conftest import corpus

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


def odd_texts(n):
    rng = random.Random(5)
    alphabet = "aaabcdeéÉß'sStll 019٣   \t\n\r\x1c\x85\xa0 　ΣσςİIıǅﬁ你好🙂é!!''.,-_‍\xad"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + ["<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "hello<|endoftext|", "  <|endoftext|>  ", "a" * 500, "ΑΣ ΣΣ", "it's they'Ll"]


def test_bpe_is_the_library_exactly():
    own, lib = bpe.codec(WORD), library(WORD)
    for t in odd_texts(4000):
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_memory_is_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHARS", 1000)
    known = bpe._Chunks(bpe.codec(WORD), tuple)
    for k in range(50):
        assert list(known["x" * (100 + k)]) == bpe.codec(WORD).chunk("x" * (100 + k))
        known.trim()
        assert sum(map(len, known)) + sum(map(len, known.old)) < 2000


def test_bpe_query_digests(docs, empty):
    lib = library(WORD)
    want = []
    for i, t, *_ in corpus():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digests(docs, WORD).collect()), key=str) == sorted(want, key=str)
    assert bpe.digests(empty, WORD).count() == 0


def test_bpe_round_trip_columns(docs, empty):
    encoded = bpe.encode(docs, WORD)
    decoded = bpe.decode(encoded, WORD).where("doc_id = 65").first()
    assert encoded.columns[: len(docs.columns)] == docs.columns and decoded.bpe_text == "one</w>" and decoded.bpe_n == 1
    assert bpe.encode(empty, WORD).count() == 0
    again = bpe.decode(bpe.encode(decoded_twice := bpe.decode(encoded, WORD), WORD), WORD)
    assert sorted(again.columns) == sorted(decoded_twice.columns)
    assert sorted(map(str, again.select("doc_id", "bpe_ids", "bpe_n", "bpe_text").collect())) == sorted(map(str, decoded_twice.select("doc_id", "bpe_ids", "bpe_n", "bpe_text").collect()))


def test_units_are_the_library_exactly():
    own, lib = token_store.Encoder(BYTE, 2), library(BYTE)
    texts = odd_texts(4000) + ["\x01a \x03b", "a\x02", " \x01a b", "Zeile eins.\nÖl, Ähre;; don't\nx1 y2!", "état ça", "a . b", ".a $$$ b", "× ÷ a×b"] + [t for _, t, *_ in corpus() if t]
    for some in (pa.array(texts), pa.array(texts).slice(3000), pa.array([t for t in texts if not t.isascii()])):
        for data, t in zip(own.encode(some), some.to_pylist(), strict=True):
            assert np.frombuffer(data, "<u2").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_other_vocabularies_get_whole_texts():
    own, lib = token_store.Encoder(WORD, 4), library(WORD)
    texts = odd_texts(200)
    for data, t in zip(own.encode(pa.array(texts)), texts, strict=True):
        assert np.frombuffer(data, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("shard_ids,bucket_keys", [(token_store.SHARD_IDS, token_store.BUCKET_KEYS), (5000, 3)])
def test_store_round_trip(docs, spark, shard_ids, bucket_keys):
    lib = library(BYTE)
    written = token_store.write(docs, BYTE, shard_ids=shard_ids, bucket_keys=bucket_keys)
    store = token_store.open_store(spark, written.folder)
    assert -(-store.n_buckets // store.per_file) <= 8
    got = token_store.fetch(store, token_store.lookup(store, docs.select("doc_id")), with_ids=True).collect()
    want = sorted((-1 if i is None else i, tuple(lib.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, *_ in corpus())
    assert sorted((-1 if r.doc_id is None else r.doc_id, tuple(r.ids)) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [(-1 if r.doc_id is None else r.doc_id) for r in got] == [i for i, _ in want]
    at_ = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at_, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at_ += r.n_tokens
    assert store.shards.count() >= (5 if shard_ids == 5000 else 1)
    reader = token_store.Reader(store.folder)
    for key in {i for i, *_ in corpus()}:
        assert sorted(tuple(ids.tolist()) for ids in reader.get(key)) == sorted(t for i, t in want if i == (-1 if key is None else key))
    assert reader.get(10**12) == []


def test_lookup_refuses_unknown_keys(spark, docs, empty):
    store = token_store.write(docs.select("doc_id", "text"), BYTE)
    asked = spark.createDataFrame([(k,) for k in range(10_000, 60_000)] + [(70,)], "doc_id long")
    assert {r.doc_id for r in token_store.lookup(store, asked).collect()} == {70}
    nothing = token_store.write(empty, BYTE)
    assert token_store.Reader(nothing.folder).get(70) == []
    assert token_store.fetch(nothing, token_store.lookup(nothing, empty.select("doc_id"))).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 20_000):
        h1, h2 = (rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(2))
        table = token_store.PerfectHash.build(h1, h2)
        assert sorted(table.find(h1, h2).tolist()) == list(range(n))


def test_second_write_gives_the_same_bytes(docs):
    def content(store):
        fs, path = at(store.folder)
        from pyarrow import fs as pafs

        files = [f for f in fs.get_file_info(pafs.FileSelector(path)) if f.type == pafs.FileType.File]
        return [(f.base_name, fs.open_input_file(f.path).read()) for f in sorted(files, key=lambda f: f.base_name)]

    assert {n.rsplit(".")[-1] for n, _ in content(token_store.write(docs, BYTE))} == {"ids", "len", "mph", "json"}
    assert content(token_store.write(docs, BYTE)) == content(token_store.write(docs, BYTE))
