import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import clashing, rows
from tokenizers import Tokenizer

from opinio.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(PATH)


def same(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == np.array(ids, dtype="<u4").tobytes()
    assert own.decode(own.encode(text)).decode() == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(own, library, text):
    same(own, library, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["the", "'S", "'ll", " ", "\x1c", "\x85", "É", "é", "Σ", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "1", "½", "!?", "한", "\n", " ", "ﬁ"]), max_size=12))
def test_mixed_pieces(own, library, pieces):
    same(own, library, "".join(pieces))


def test_long_words(own, library):
    for text in ("x" * 5000, "ab" * 3000 + "é", "!" * 700, "theandingoer" * 40):
        same(own, library, text)


def test_heap_and_rank_array_agree(own):
    rng = np.random.default_rng(0)
    for _ in range(300):
        parts = [own.inner[b] for b in rng.choice(list(b"theandingoerst"), 30)]
        assert bpe.merge_short(list(parts), own.rank) == bpe.merge_long(list(parts), own.rank)


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_documents(spark, odd_docs, no_docs, library):
    want = sorted([(r.doc_id, *digest(library, r.text)) for r in odd_docs.collect()], key=repr)
    assert rows(bpe.digests(bpe.encode_decode(odd_docs, PATH))) == want
    assert rows(bpe.digests(bpe.encode_decode(clashing(odd_docs), PATH))) == want
    assert bpe.encode_decode(no_docs, PATH).count() == 0


def test_query_on_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert rows(bpe.op8(spark, sf)) == sorted([(r.doc_id, *digest(library, r.text)) for r in docs], key=repr)
