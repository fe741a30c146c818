import math
import zlib
from collections import Counter

import numpy as np
from llm_helpers import DOCS, clashing, rows
from pyspark.sql import functions as F

from opinio.llm import shards


def test_hypergeometric_follows_its_law():
    rng = np.random.default_rng(5)
    for good, bad, n in ((5, 7, 4), (1, 30, 10), (40, 3, 20), (6, 6, 12)):
        seen, draws = Counter(shards.hypergeometric(rng, good, bad, n) for _ in range(4000)), 4000
        for k in range(n + 1):
            p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) if k <= good and n - k <= bad else 0
            assert abs(seen[k] - draws * p) <= 5 * math.sqrt(draws * p * (1 - p)) + (1e-9 if p in (0, 1) else 1)


def test_hypergeometric_of_large_populations():
    rng = np.random.default_rng(6)
    good, bad, n = 3 * 10**11, 10**12, 4 * 10**10
    x = np.array([shards.hypergeometric(rng, good, bad, n) for _ in range(60)], dtype=float)
    sd = math.sqrt(n * good / (good + bad) * bad / (good + bad) * (good + bad - n) / (good + bad))
    assert abs(x.mean() - n * good / (good + bad)) < 5 * sd / math.sqrt(60) and 0.6 < x.std() / sd < 1.5


def test_matrix_has_exact_margins(spark):
    sizes, room = [0, 5, 100, 3] * 20, shards.even(108 * 20, 24)
    m = {r.part: r.counts for r in shards.matrix(spark, sizes, room, 1).collect()}
    assert [sum(m[p]) for p in range(80)] == sizes
    assert np.sum([m[p] for p in range(80)], axis=0).tolist() == room.tolist()


def check(got, want, n_shards):
    """Exact sizes, gapless slots, and the rows of the input."""
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, ())) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(n_shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    keep = [c for c in want.columns if c not in ("shard", "slot")]
    assert sorted((tuple(r[c] for c in keep) for r in got), key=repr) == rows(want, *keep)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = shards.op12(spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = got.collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {k: (len(v) + 1, zlib.crc32(v)) for k, v in texts.items()}
    check(got, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id"), 8)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_same_result_on_any_layout_and_another_for_another_seed(spark):
    docs = spark.range(3000).select("id", F.concat(F.lit("t"), "id").alias("text"))
    a = rows(shards.into_shards(docs, 5))
    assert a == rows(shards.into_shards(docs.repartition(7).select("id", "text"), 5))
    assert a != rows(shards.into_shards(docs, 5, seed=1))


def test_the_shuffle_is_uniform(spark):
    """Every row is in every shard, and every pair of neighbours in one shard, as often as chance has it."""
    docs = spark.range(400)
    where, apart = np.zeros((400, 4)), 0
    for seed in range(12):
        s = {r.id: r.shard for r in shards.into_shards(docs, 4, seed).collect()}
        for i in range(400):
            where[i, s[i]] += 1
        apart += sum(s[i] == s[i + 1] for i in range(399))
    # chi-square with 400 * 3 degrees of freedom, five standard deviations
    assert abs(((where - 3) ** 2 / 3).sum() - 1200) < 5 * math.sqrt(2 * 1200)
    assert abs(apart - 12 * 399 * 99 / 399) < 5 * math.sqrt(12 * 399 * 0.25 * 0.75)


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, clashing(odd_docs).withColumn("slot", F.lit("x")).drop("range")):
        for n in (1, 3, 40):
            check(shards.into_shards(docs, n).collect(), docs, n)
    got = shards.into_shards(no_docs)
    assert got.count() == 0 and got.columns == [*no_docs.columns, "shard", "slot"]
    assert shards.into_shards(clashing(odd_docs)).count() == len(odd_docs.collect())


def test_a_row_that_is_a_third_of_all_is_spread(spark, tmp_path):
    docs = spark.createDataFrame([(7, "Same", "en", "a", 4)] * 3000 + [(i, f"T{i}", "en", "a", 2) for i in range(6000)], DOCS)
    sharded = shards.into_shards(docs, 6)
    check(sharded.collect(), docs, 6)
    hot = Counter(r.shard for r in sharded.filter("doc_id = 7").collect())
    assert min(hot.values()) > 400 and max(hot.values()) < 600
    shards.write_shards(sharded, f"{tmp_path}/out")
    for k in range(6):
        for f in sorted((tmp_path / "out" / f"shard={k}").glob("*.parquet")):
            slots = [r.slot for r in spark.read.parquet(str(f)).select("slot").coalesce(1).collect()]
            assert slots == list(range(slots[0], slots[0] + len(slots)))
