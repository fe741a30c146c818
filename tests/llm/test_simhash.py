import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import DOCS, clashing, rows

from opinio.llm import simhash


def plain(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, radius=2):
    """Smallest id of each row's component, by comparing all pairs."""
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= radius and find(i) != find(j):
                root[find(i)] = find(j)
    out = []
    for i, (doc, fp) in enumerate(pairs):
        ids = [p[0] for j, p in enumerate(pairs) if find(j) == find(i) and p[0] is not None]
        out.append((doc, fp, min(ids, default=None)))
    return sorted(out, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB É\t\x0b\x1c", max_size=40))
def test_fingerprint_by_the_letter(text):
    assert simhash.fingerprint(text) == plain(text)


def test_odd_documents(spark, odd_docs, no_docs):
    want = classes([(r.doc_id, plain(r.text)) for r in odd_docs.collect()])
    got = [(i, fp % (1 << 64), c) for i, fp, c in rows(simhash.components(odd_docs))]
    assert sorted(got, key=repr) == want
    assert sorted([(i, fp % (1 << 64), c) for i, fp, c in rows(simhash.components(clashing(odd_docs)))], key=repr) == want
    assert simhash.components(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_links_find_every_component(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = {int(x) for x in base}
    for x in base[:30]:  # chains of near copies, some of them through fingerprints that differ by more than the radius
        for _ in range(6):
            x ^= np.uint64(1 << int(rng.integers(0, 63))) ^ np.uint64(1 << int(rng.integers(0, 63)))
            fps.add(int(x))
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    got = dict(simhash.connected(simhash.links(spark.createDataFrame(signed, "fp long"))).collect())
    want = classes([(s, s % (1 << 64)) for (s,) in signed])
    assert all(got.get(s, s) == c for s, _, c in want)


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    # one group of near copies far above the size of a block
    signed = [(1 << i ^ 1 << j,) for i in range(1, 16) for j in range(i)]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"))
    assert edges.count() < 50 * len(signed)
    got = dict(simhash.connected(edges).collect())
    want = classes([(s, s) for (s,) in signed])
    assert all(got[s] == c for s, _, c in want)


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)], "u long, v long")
    got = dict(simhash.connected(edges).collect())
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_keep_one_keeps_all_columns(spark, odd_docs):
    kept = simhash.keep_one(clashing(odd_docs))
    assert kept.columns == clashing(odd_docs).columns
    ids = sorted([r.doc_id for r in kept.select("doc_id").collect()])
    # empty texts are one group (1, 2, 3 and a null id), "one two" another
    assert ids == [1, 4, 5, 6, 7, 8]
    same = spark.createDataFrame([(3, "a b c d", None, None, None)] * 2 + [(None, "a b c d", None, None, None)], DOCS)
    assert [r.doc_id for r in simhash.keep_one(same).collect()] == [3]


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, f"{fp:016x}", c) for i, fp, c in classes([(r.doc_id, plain(r.text)) for r in docs])]
    assert rows(simhash.op7(spark, sf), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
