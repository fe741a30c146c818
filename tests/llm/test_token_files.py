import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import clashing
from tokenizers import Tokenizer

from opinio.llm import token_files
from opinio.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "'s", "'ll", " ", "  ", "\x1c", "\x85", "É", "<|endoftext|>", "12", "!?", "한", "\n", "\n\n", "　", "\t"]), max_size=14))
def test_encoder_equals_library(library, pieces):
    text = "".join(pieces)
    assert token_files.encoder(PATH).encode(text) + b"\0\0\0\0" == ids_of(library, text)


def test_every_code_point(library):
    own = token_files.encoder(PATH)
    for block in range(0, 0x110000, 64):
        text = " ".join(f"A{c}:{c}{c}1" for c in map(chr, range(block, block + 64)) if not 0xD800 <= ord(c) < 0xE000)
        assert own.encode(text) + b"\0\0\0\0" == ids_of(library, text)


def written(spark, docs):
    return token_files.write(docs, scratch_dir(spark, "test-files"), PATH)


def test_odd_documents(spark, odd_docs, no_docs, library):
    for docs in (odd_docs, clashing(odd_docs)):
        got = sorted(token_files.read(spark, written(spark, docs)).collect(), key=lambda r: r.start)
        # ascending ids, nulls last, every row with the ids of its text
        assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 5, 6, 7, 8, None, None]
        want = sorted((r.doc_id is None, r.doc_id or 0, ids_of(library, r.text)) for r in docs.collect())
        assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
        ahead = np.cumsum([0, *(len(r.ids) // 4 for r in got)])
        assert [r.start for r in got] == ahead[:-1].tolist()
    assert token_files.read(spark, written(spark, no_docs)).count() == 0


def test_lookup_reads_single_documents(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 2000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = written(spark, docs)
    assert spark.read.parquet(f"{out}/blocks").count() > 20
    texts = {r.doc_id: r.text for r in docs.collect()}
    whole = {r.doc_id: r.start for r in token_files.read(spark, out).collect()}
    some = token_files.read(spark, out, [3, 77, 199, 10**9]).collect()
    assert sorted(r.doc_id for r in some) == [3, 77, 199]
    assert all(bytes(r.ids) == ids_of(library, texts[r.doc_id]) and r.start == whole[r.doc_id] for r in some)
    assert token_files.read(spark, out, []).count() == 0


def test_block_of_another_dictionary_is_refused():
    data = token_files.pack([1, None], [1, 1], [b"a", b"bc"], b"x" * 16)
    ids, known, counts, offsets, frames = token_files.unpack(data, b"x" * 16)
    assert known.tolist() == [1, 0] and offsets.tolist() == [0, 1, 3] and bytes(frames) == b"abc"
    with pytest.raises(ValueError):
        token_files.unpack(data, b"y" * 16)


def test_query_on_documents(spark, library):
    sf = "/root/testdata/sf0.01"
    got = sorted(token_files.op10(spark, sf).collect())
    start = 0
    for r, d in zip(got, sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda d: d.doc_id), strict=True):
        ids = ids_of(library, d.text)
        assert tuple(r) == (d.doc_id, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


@pytest.mark.parametrize("n", [3, 20000])
def test_short_documents_share_a_dictionary(spark, library, n):
    words = "the quick brown fox jumps over a lazy dog while some other animals of this forest look on".split()
    texts = [" ".join(words[(i * k + k) % len(words)] for k in range(1, 13)) + f" {i}" for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = written(spark, docs)
    dictionary = bytes(spark.read.parquet(f"{out}/dictionary").first().dictionary)
    ids = [np.frombuffer(ids_of(library, t), "<u4").astype("<u2").tobytes() for t in texts]
    assert 8 <= len(dictionary) <= max(256, sum(map(len, ids)) // 8)
    got = {r.doc_id: bytes(r.ids) for r in token_files.read(spark, out).collect()}
    assert len(got) == n and all(got[i] == ids_of(library, texts[i]) for i in range(0, n, max(1, n // 50)))
    if n > 1000:
        alone = token_files.zstandard.ZstdCompressor(level=token_files.LEVEL).compress
        stored = sum(len(r.data) for r in spark.read.parquet(f"{out}/blocks").select("data").collect()) - 21 * n
        assert stored < 0.9 * sum(len(alone(x)) for x in ids)
