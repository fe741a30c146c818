import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import DOCS, clashing, rows

from opinio.llm import lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.pieces(PATH)


def segmentations(word, v, start=True):
    """The pieces of every segmentation of a word."""
    table = v.initial if start else v.inner
    if not word and not start:
        yield []
        return
    for j in range(0 if start else 1, len(word) + 1):
        if word[:j] in table:
            for rest in segmentations(word[j:], v, False):
                yield [table[word[:j]], *rest]


@pytest.mark.parametrize("word", [b"the", b"nting.", "été".encode(), b"q", b"\xf0\x9f\x98\x80", b"onnd"])
def test_forward_sums_all_segmentations(vocabulary, word):
    probs = vocabulary.weights()
    total = sum(math.prod(probs[p] for p in s) for s in segmentations(word, vocabulary)) * probs[vocabulary.stop]
    assert lattice.forward(word, vocabulary, np.log(probs).tolist()) == pytest.approx(math.log(total))


@pytest.mark.parametrize("word", [b"the", b"inting", "été".encode(), b"ab" * 40])
def test_expected_uses(vocabulary, word):
    probs = vocabulary.weights()
    uses = [0.0] * len(probs)
    lattice.expected(word, vocabulary, probs.tolist(), np.log(probs).tolist(), uses)
    covered = {p: len(w) for w, p in [*vocabulary.initial.items(), *vocabulary.inner.items()]}
    # expected pieces cover the word exactly, start once and stop once
    assert sum(u * covered.get(p, 0) for p, u in enumerate(uses)) == pytest.approx(len(word))
    assert sum(uses[p] for p in vocabulary.initial.values()) == pytest.approx(1)
    assert uses[vocabulary.stop] == 1
    if len(word) < 10:
        logs = np.log(probs)
        paths = list(segmentations(word, vocabulary))
        weight = np.exp([logs[s].sum() for s in paths])
        brute = Counter()
        for s, w in zip(paths, weight / weight.sum()):
            for p in s:
                brute[p] += w
        assert all(uses[p] == pytest.approx(x) for p, x in brute.items())


def test_weights_are_distributions(vocabulary):
    rng = np.random.default_rng(0)
    for probs in (vocabulary.weights(), vocabulary.weights(rng.random(len(vocabulary.first)))):
        assert probs[vocabulary.is_initial].sum() == pytest.approx(1)
        assert probs[~vocabulary.is_initial].sum() == pytest.approx(1)
        assert (probs > 0).all()


def test_more_rounds_fit_better(vocabulary):
    words = [b"thanedble", b"onnting", b"ingreou", b"thstnd", b"enthe"]
    probs, before = vocabulary.weights(), -math.inf
    for _ in range(4):
        logs = np.log(probs).tolist()
        now = sum(lattice.forward(w, vocabulary, logs) for w in words)
        assert now > before
        before, uses = now, [0.0] * len(probs)
        for w in words:
            lattice.expected(w, vocabulary, probs.tolist(), logs, uses)
        probs = vocabulary.weights(np.array(uses))


def base_by_hand(docs, training):
    count, ends = Counter(), 0
    for r in docs:
        if training(r):
            count.update((r.text or "").encode().lower().split())
            ends += 1
    n = sum(count.values()) + ends
    v = len(count) + (ends > 0)
    out = []
    for r in docs:
        words = (r.text or "").encode().lower().split()
        each = [count[w] for w in words] + [ends]
        out.append((r.doc_id, len(each), sum(c > 0 for c in each), sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in each)))
    return out, n


def trains(r):
    return r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1


def test_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, clashing(odd_docs)):
        want, n = base_by_hand(odd_docs.collect(), trains)
        model, counts = lattice.fit(docs, PATH)
        assert model.tokens == n
        got = lattice.score(docs, model, counts)
        for g, w in zip(rows(got, "id", "n_tokens", "n_known", "base_score"), sorted(want, key=repr), strict=True):
            assert g[:3] == w[:3] and g[3] == pytest.approx(w[3])
        assert all(-math.inf < r.score < 0 for r in got.collect())
    model, counts = lattice.fit(no_docs, PATH)
    assert lattice.score(no_docs, model, counts).count() == 0
    assert all(r.score < 0 for r in lattice.score(odd_docs, model, counts).collect())


def test_head_and_rest_give_the_same_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, counts = lattice.fit(docs, PATH)
    all_rest = {r.id: r for r in lattice.score(docs, model, counts, head_words=0).collect()}
    seen = {bytes(r.word): r.c for r in counts.collect()}
    for r in lattice.score(docs, model, counts).collect():
        o = all_rest[r.id]
        assert (r.n_tokens, r.n_known) == (o.n_tokens, o.n_known)
        assert r.score == pytest.approx(o.score) and r.base_score == pytest.approx(o.base_score)
    # and those of a plain loop
    for d in docs.limit(20).collect():
        words = d.text.encode().lower().split()
        each = [model.word(w, seen.get(w, 0)) for w in words]
        assert all_rest[d.doc_id].score == pytest.approx(model.end() + sum(x for x, _ in each))
        assert all_rest[d.doc_id].word_score == pytest.approx(model.end() + sum(x for _, x in each))


def test_seen_words_and_end_are_a_distribution(spark):
    docs = spark.createDataFrame([(2, "a a a b b c d", None, None, None), (4, "a e f", None, None, None)], DOCS)
    model, counts = lattice.fit(docs, PATH)
    assert model.words_share + 10 ** model.end() == pytest.approx(1)
    whole = sum((r.c - model.discount) / model.shared for r in counts.collect())
    assert whole + model.unseen_share + 10 ** model.end() == pytest.approx(1)


def test_score_sums_all_segmentations_of_whole_texts(spark, vocabulary):
    """Seen and unseen words alike: the text's probability is that of all ways to cut it into vocabulary pieces."""
    texts = ["the cat, the mat", "Thand ond", "", "the zqx"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in zip((2, 4, 6, 1), texts)], DOCS)
    model, counts = lattice.fit(docs, PATH)
    assert {bytes(r.word) for r in counts.collect()} == {w.encode().lower() for t in texts for w in t.split()} - ({b"zqx"} if lattice_held(1) else set())
    probs = np.exp(model.logs)
    got = {r.id: r.score for r in lattice.score(docs, model, counts).collect()}
    for i, t in zip((2, 4, 6, 1), texts):
        want = 10 ** model.end()
        for w in t.lower().encode().split():
            ways = sum(math.prod(probs[p] for p in s) for s in segmentations(w, vocabulary))
            want *= model.words_share * ways * probs[vocabulary.stop]
        assert got[i] == pytest.approx(math.log10(want))


def lattice_held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 1


def test_counts_weigh_in_the_round(vocabulary):
    """``times`` occurrences count as that many single ones, also by logarithms."""
    probs = vocabulary.weights()
    for word in (b"inting", b"ab" * 40):
        one, many = [0.0] * len(probs), [0.0] * len(probs)
        lattice.expected(word, vocabulary, probs.tolist(), np.log(probs).tolist(), one)
        lattice.expected(word, vocabulary, probs.tolist(), np.log(probs).tolist(), many, 7)
        assert many == pytest.approx([7 * x for x in one])


def test_one_very_long_word_is_scored_in_little_memory(vocabulary):
    import tracemalloc

    logs = np.log(vocabulary.weights()).tolist()
    word = b"x7q" * 60_000
    tracemalloc.start()
    assert lattice.forward(word, vocabulary, logs) < 0
    assert tracemalloc.get_traced_memory()[1] < 1_000_000
    tracemalloc.stop()


def test_fits_held_out_text_better_than_pieces_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, counts = lattice.fit(docs, PATH)
    got = lattice.score(docs, model, counts).filter("held_out").collect()
    plain = lattice.Model(PATH, lattice.pieces(PATH).weights(), 1000, 0, 0, 0, 0)
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces_only = sum(sum(plain.word(w, 0)[0] for w in texts[r.id].encode().lower().split()) for r in got)
    assert sum(r.score for r in got) > pieces_only


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want, n = base_by_hand(docs, trains)
    got = lattice.op5(spark, sf).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(*w[:3], n) for w in want}
    assert all(r.held_out == (not trains(r)) for r in got)
