import string
import zlib
from hashlib import sha256

import numpy as np
import pytest
from llm_helpers import DOCS, clashing, rows
from pyspark.sql import functions as F

from opinio.llm import merkle

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
OUT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(docs):
    """The contract, read literally."""
    trees = {}
    for r in docs:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
        trees.setdefault(r.lang, []).append((r.doc_id, leaf(r, r.text), leaf(r, r.text.translate(LOW) if hit else r.text)))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    inner = {k: levels([x[1] for x in trees[k]]) for k in order if not trees[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))}
    top = levels([inner[k][-1][0] for k in order])
    out = []
    for j, k in enumerate(order):
        for i, (doc_id, own, now) in enumerate(trees[k]):
            proof = ""
            for tree, p in ((inner[k], i), (top, j)):
                for nodes in tree[:-1]:
                    a = p // 8 * 8
                    run = nodes[a : a + 8]
                    proof += "".join(run[: p - a] + run[p - a + 1 :])
                    now = h("".join(run[: p - a] + [now] + run[p - a + 1 :]))
                    p //= 8
            out.append((doc_id, own, inner[k][-1][0], top[-1][0], h(proof), now, now == top[-1][0]))
    return sorted(out, key=repr)


def run(docs):
    return merkle.prove(merkle.manifest(merkle.cards(docs))).withColumnRenamed("id", "doc_id")


def test_addresses_are_a_van_emde_boas_layout():
    for height in range(6):
        places = np.concatenate([merkle.address(d, np.arange(8**d), height + 1) for d in range(height + 1)])
        assert sorted(places) == list(range(merkle.size(height + 1)))
    # four levels: the upper two first (root, its eight children), then one lower pair of levels after another
    assert merkle.address(1, np.arange(8), 4).tolist() == list(range(1, 9))
    assert merkle.address(2, np.array([0, 1, 63]), 4).tolist() == [9, 18, 9 + 63 * 9]
    assert merkle.address(3, np.array([0, 7, 8]), 4).tolist() == [10, 17, 19]


def test_block_round_trip():
    for n in (1, 2, 8, 9, 64, 65, 100):
        digests = [sha256(bytes([i])).digest() for i in range(n)]
        height = merkle.height_over(n)
        nodes = merkle.build(digests, height)
        want = levels([d.hex() for d in digests])[-1][0]
        assert nodes[:32].hex() == want
        for i in range(n):
            path = merkle.siblings(nodes, i, n, height)
            assert merkle._unpack(merkle._pack(path)) == path
            assert merkle.fold(digests[i], path).hex() == want
            assert merkle.fold(b"\0" * 32, path).hex() != want


@pytest.mark.parametrize("height", [1, 4])
def test_query_against_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)  # height 1: several stages of blocks
    sf = "/root/testdata/sf0.001"
    got = rows(merkle.op13(spark, sf), *OUT)
    assert got == brute(spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert {r[-1] for r in got} == {True, False}


def test_many_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), (F.col("id") % 100).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(6).cast("long").alias("n_chars"))
    assert rows(run(docs), *OUT) == brute(docs.collect())


def test_odd_rows(spark, odd_docs, no_docs):
    want = brute(odd_docs.collect())
    assert rows(run(odd_docs), *OUT) == want
    assert rows(run(clashing(odd_docs)), *OUT) == want
    assert rows(run(no_docs)) == [] and run(no_docs).columns == OUT


def test_a_row_that_is_a_third_of_all(spark):
    hot = [(7, "Same", "en", "a", 4)] * 400 + [(i, f"T{i}", "en" if i % 2 else None, "a", 2) for i in range(800)]
    docs = spark.createDataFrame(hot, DOCS).repartition(5)
    assert rows(run(docs), *OUT) == brute(docs.collect())
