import numpy as np
import pytest
from pyspark.sql import types as T

from opinio.llm import learned_partitions, va_file

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])
ODD = [
    (0, None, 1), (1, [], 1), (2, [1.0, None], 1), (3, [1.0, float("nan")], 1), (4, [float("inf"), 0.0], 1), (None, [1.0, 2.0], 1),
    (50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (51, [1.0, 2.0], 2), (52, [0.0, 0.0], None), (100, [1.0, 2.0, 3.0], 1), (101, [3.0, 2.0, -1.5], 1),
    (150, [-0.001, 0.5], 1), (200, [7.0], 1), (250, [0.0, 0.0, 0.0], 1),
]


def top_products(rows, k, every):
    """Ranks, ids and scores by comparing every query with every row."""
    ints = [(i, tuple(np.floor(256 * np.array(v)).astype(int).tolist())) for i, v in {(i, tuple(v)) for i, v in rows}]
    out = []
    for q, v in ints:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q and len(w) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def finite(df):
    return [(r.vec_id, r.embedding) for r in df.collect() if r.vec_id is not None and r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)]


def products(df, k, every):
    vectors = va_file.integers(va_file.usable(df, "vec_id", "embedding"))
    return sorted(map(tuple, va_file.search(vectors.filter(f"id % {every} = 0"), va_file.build(vectors, k), k).collect()))


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD, VECTORS)
    assert products(df, 5, 50) == top_products(finite(df), 5, 50)
    assert products(df.limit(0), 5, 50) == []
    assert learned_partitions.search(va_file.usable(df.limit(0), "vec_id", "embedding"), va_file.usable(df.limit(0), "vec_id", "embedding"), 3).count() == 0


@pytest.mark.parametrize(("spread", "copies"), [(1.0, 0), (0.01, 150), (3000.0, 20), (5e5, 5)])
def test_exact_with_ties_and_copies(spark, monkeypatch, spread, copies):
    monkeypatch.setattr(va_file, "BLOCK", 64)
    monkeypatch.setattr(va_file, "FIRST", 4)
    monkeypatch.setattr(va_file, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(3)
    data = [(i, (rng.normal(size=6) * spread).tolist(), 0) for i in range(300)] + [(1000 + i, [spread] * 6, 0) for i in range(copies)]
    data += [(2000 + i, rng.integers(-1, 2, 6).astype(float).tolist(), 0) for i in range(100)]
    df = spark.createDataFrame(data, VECTORS)
    assert products(df, 5, 10) == top_products(finite(df), 5, 10)


def test_products_beyond_a_long_are_refused(spark):
    df = spark.createDataFrame([(0, [1e8, 1e8], 0), (1, [1e8, 1e8], 0)], VECTORS)
    with pytest.raises(Exception, match="do not fit a long"):
        products(df, 5, 50)


def test_bounds_spare_exact_reads():
    rng = np.random.default_rng(0)
    v = rng.integers(-100, 100, (4000, 32))
    low, high = v.min(axis=0), v.max(axis=0)
    step = (high - low) // va_file.CELLS + 1
    cells = ((v - low) // step).astype(np.uint8)
    read = []

    class Exact:
        def __getitem__(self, near):
            read.append(len(near))
            return v[near]

    q = rng.integers(-100, 100, (20, 32))
    for one, (places, scores) in zip(q, va_file.meet(q, low, step, cells, Exact(), np.arange(4000), 5)):
        want = np.lexsort((np.arange(4000), -(v @ one)))[:5]
        assert places.tolist() == want.tolist() and scores.tolist() == (v @ one)[want].tolist()
    assert sum(read) < 0.2 * 20 * 4000


def nodes(plan):
    """The nodes of a plan that has run, those inside its stages too."""
    name = plan.nodeName()
    below = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan] + [x for b in below for x in nodes(b)]


def test_queries_are_sent_once_a_group(spark, monkeypatch):
    monkeypatch.setattr(va_file, "BLOCK", 16)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist(), 0) for i in range(3000)], VECTORS)
    vectors = va_file.integers(va_file.usable(df, "vec_id", "embedding"))
    file = va_file.build(vectors, 5)
    found = va_file.search(vectors.filter("id % 10 = 0"), file, 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if the tables were large
    try:
        assert sorted(map(tuple, found.collect())) == top_products(finite(df), 5, 10)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    blocks, groups = file.count(), 2 * spark.sparkContext.defaultParallelism
    assert blocks > 150 > 2 * groups
    ran = nodes(found._jdf.queryExecution().executedPlan())
    hits = next(x for x in ran if x.nodeName() == "MapInArrow")
    # k rows for each query and group, where it was a list and more for each block
    assert 300 * 5 <= hits.metrics().apply("pythonNumRowsReceived").value() <= 300 * 5 * groups
    # a query of 8 components in as many groups, and the file, not a query of 64 bytes for each block
    sent = [x.metrics().apply("dataSize").value() for x in ran if x.nodeName() == "Exchange"]
    assert max(sent) < 300 * 64 * blocks / 4


def test_many_parts_and_groups(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("QUERY_BLOCK", 8), ("PART", 100), ("GROUP", 2), ("TOGETHER", 3), ("GATHERED", 50)):
        monkeypatch.setattr(va_file, name, value)
    rng = np.random.default_rng(7)
    data = [(i, rng.integers(-3, 4, 4 + i % 2).astype(float).tolist(), 0) for i in range(900)]
    df = spark.createDataFrame(data, VECTORS)
    assert products(df, 5, 10) == top_products(finite(df), 5, 10)


def test_rows_of_the_own_id_take_no_places(spark):
    rng = np.random.default_rng(5)
    data = [(50, [100.0 + i, 100.0], 0) for i in range(20)] + [(i, rng.normal(size=2).tolist(), 0) for i in range(1, 40)] + [(50, [1.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    ints = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v, _ in data]
    want = sorted((-int(v @ w), i) for q, v in ints if q == 50 for i, w in ints if i != 50)[:5]
    got = products(spark.createDataFrame(data, VECTORS), 5, 50)
    assert got == [(50, r, i, -s) for r, (s, i) in enumerate(want, 1)]


def test_lists_go_on_from_block_to_block():
    rng = np.random.default_rng(6)
    blocks = [rng.integers(-w, w, (n, 5)) for w, n in ((1 << 28, 3), (30, 200), (1 << 18, 70), (3, 300), (1 << 28, 90), (2, 9))]
    q = np.concatenate([rng.integers(-w, w, (9, 5)) for w in (2, 1 << 10, 1 << 28)])
    ids, own = rng.permutation(sum(map(len, blocks))), np.arange(27)
    best, start = va_file.Best(len(q), 4), 0
    for v in blocks:
        low = v.min(axis=0)
        step = (v.max(axis=0) - low) // va_file.CELLS + 1
        here = ids[start : start + len(v)]
        # every third vector has a second row
        seconds = np.where(here % 3 == 0, here + 1000, here)
        va_file.meet(q, low, step, ((v - low) // step).astype(np.uint8), va_file._narrow(v), here, 4, seconds, own, best, start)
        start += len(v)
    v = np.concatenate(blocks)
    for one, me, (places, scores) in zip(q, own, best):
        least = np.where((ids == me) & (ids % 3 == 0), ids + 1000, ids)
        want = sorted((-int(s), int(i), p) for p, (s, i) in enumerate(zip(v @ one, least)) if i != me)[:4]
        assert [(-s, least[p], p) for p, s in zip(places.tolist(), scores.tolist())] == want


def nearest(df, k, every):
    rows = va_file.usable(df, "vec_id", "embedding").filter("exists(x, c -> c != 0)")
    return learned_partitions.search(rows.filter(f"id % {every} = 0"), rows, k)


def test_nearest_of_odd_vectors(spark):
    # too few for parts, so all are compared
    got = [tuple(r) for r in nearest(spark.createDataFrame(ODD, VECTORS), 3, 50).orderBy("query_id", "rank").collect()]
    far = float(np.sqrt(((np.array([1, 2]) - np.array([-0.001, 0.5])) ** 2).sum()))
    other = float(np.sqrt(((np.array([1, 2, 3]) - np.array([3, 2, -1.5])) ** 2).sum()))
    assert got == [(50, 1, 51, 0.0), (50, 2, 150, far), (100, 1, 101, other), (150, 1, 50, far), (150, 2, 51, far)]


def recall(df, got, k, every):
    x = {r.vec_id: np.array(r.embedding, dtype=float) for r in df.collect()}
    ids = np.array(sorted(x))
    all_ = np.stack([x[i] for i in ids])
    hit = total = 0
    for q in ids[ids % every == 0]:
        d = np.sqrt(((all_ - x[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        rows = sorted(r for r in got if r.query_id == q)
        assert [r.rank for r in rows] == list(range(1, k + 1))
        assert [r.score for r in rows] == [np.sqrt(((x[r.vec_id] - x[q]) ** 2).sum()) for r in rows]
        assert rows == sorted(rows, key=lambda r: (r.score, r.vec_id))
        hit += len({r.vec_id for r in rows} & set(ids[np.lexsort((ids, d))[:k]].tolist()))
        total += k
    return hit / total


def test_recall_without_clusters(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = learned_partitions.op2(spark, "/root/testdata/sf0.1").collect()
    assert recall(df, got, 10, 100) >= 0.9


def test_clusters_need_few_parts(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16)) * 4
    data = [(i, (centres[i % 40] + rng.normal(size=16) * 0.5).tolist(), 0) for i in range(4000)]
    data += [(10_000 + i, data[0][1], 0) for i in range(2000)]  # a third of the rows are one vector
    df = spark.createDataFrame(data, VECTORS)
    router = learned_partitions.fit(np.array([d[1] for d in data[:3000]]), 5)
    assert router.probes <= 6
    assert recall(df, nearest(df, 5, 100).collect(), 5, 100) >= 0.9


def test_parts_are_balanced():
    x = np.random.default_rng(0).normal(size=(1000, 8))
    near = learned_partitions.neighbours(x, 8)
    place = learned_partitions.partition_graph(x, near, 10)
    sizes = np.bincount(place)
    assert len(sizes) == 10 and sizes.max() <= 106
    kept = (place[near] == place[:, None]).mean()
    assert kept > 0.3  # of links, against 0.1 by chance


def test_query_on_embeddings(spark):
    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in va_file.op1(spark, sf).collect())
    assert got == top_products(finite(df), 5, 50)
