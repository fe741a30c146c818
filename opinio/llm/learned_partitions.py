"""Approximate nearest neighbours (Euclidean) by learned partitions.

``fit`` takes a sample of about ``SAMPLE`` vectors by hash, links each to its
``LINKS`` nearest in the sample, and cuts this graph into parts of nearly equal
size: median splits along principal directions first, then rounds of
moves to the part that holds most of a vertex's neighbours, while that part has
room.  A small network (one hidden layer) learns the shares of the parts among
a vector's neighbours.  The number of parts to ask is the least for which held-out
sample vectors find ``RECALL`` of their true nearest in the sample.

``search`` puts every row (not only the sample) into its most probable part,
cuts each part into blocks of about ``BLOCK`` rows, sends each query to all blocks of its most
probable parts, measures exact distances there in double precision, and merges
the k nearest of each block.  Parts have no cap: a large one has more blocks.

The neighbours found are approximate, their scores exact.  On vectors without
clusters (the test tables: nearly uniform on the sphere in 64 dimensions)
RECALL needs about half of the parts; the README has figures.

Results for odd input: vectors that are null, zero, empty, or hold null or
non-finite components, and rows without id, take no part; each dimension has an
index of its own; rows repeated with id and vector count once; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import cut, ship
from opinio.llm.va_file import usable

SAMPLE = 6000
PARTS = 32
LINKS = 12
HIDDEN = 96
STEPS = 150
RECALL = 0.94
BLOCK = 4096
QUERY_BLOCK = 512
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances of one vector to rows, in double precision."""
    return np.sqrt(((x - q) ** 2).sum(axis=1))


def _squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.maximum((q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None] - 2 * q @ x.T, 0)


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    out = []
    for at in range(0, len(x), 512):
        d = _squares(x[at : at + 512], x)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def partition_graph(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.05) -> np.ndarray:
    """A part for each vertex: median splits, then moves that cut fewer links and keep within ``slack`` of equal size."""
    place = np.zeros(len(x), dtype=np.int64)
    split = [(np.arange(len(x)), parts)]
    number = 0
    while split:
        rows, p = split.pop()
        if p == 1 or len(rows) < 2:
            place[rows] = number
            number += 1
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        along = centred @ np.linalg.svd(centred, full_matrices=False)[2][0]
        at = len(rows) * (p // 2) // p
        order = rows[np.argsort(along, kind="stable")]
        split += [(order[:at], p // 2), (order[at:], p - p // 2)]
    room = int(np.ceil(len(x) / number * slack))
    ends = np.concatenate([near.ravel(), np.repeat(np.arange(len(x)), near.shape[1])])
    starts = np.concatenate([np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()])
    for _ in range(rounds):
        votes = np.zeros((len(x), number))
        np.add.at(votes, (starts, place[ends]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), place]
        sizes, moved = np.bincount(place, minlength=number), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < room:
                sizes[place[v]] -= 1
                sizes[best[v]] += 1
                place[v] = best[v]
                moved += 1
        if not moved:
            break
    return place


class Router:
    """A network from a vector to the chances of the parts, and how many parts a query asks."""

    def __init__(self, x: np.ndarray, shares: np.ndarray, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.scale = np.sqrt((x**2).mean()) or 1.0
        d, p = x.shape[1], shares.shape[1]
        self.w = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, p)), np.zeros(p)]
        m, v = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w]
        self.probes = p
        for t in range(1, STEPS + 1):
            pick = rng.choice(len(x), min(len(x), 1024), replace=False)
            z = x[pick] / self.scale
            h = np.maximum(z @ self.w[0] + self.w[1], 0)
            e = (self._chances(h) - shares[pick]) / len(pick)
            back = (e @ self.w[2].T) * (h > 0)
            for i, g in enumerate((z.T @ back, back.sum(axis=0), h.T @ e, e.sum(axis=0))):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g**2
                self.w[i] = self.w[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)

    def _chances(self, h: np.ndarray) -> np.ndarray:
        s = h @ self.w[2] + self.w[3]
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """The parts of each row, most probable first."""
        h = np.maximum(x / self.scale @ self.w[0] + self.w[1], 0)
        return np.argsort(-self._chances(h), axis=1, kind="stable")


def fit(x: np.ndarray, k: int, recall: float = RECALL) -> Router | None:
    """A router from a sample; None if it is too small for parts."""
    parts = min(PARTS, len(x) // (4 * LINKS))
    if parts < 2:
        return None
    near = neighbours(x, LINKS)
    place = partition_graph(x, near, parts)
    shares = np.zeros((len(x), parts))
    np.add.at(shares, (np.repeat(np.arange(len(x)), LINKS), place[near].ravel()), 1)
    shares[np.arange(len(x)), place] += 1
    learn = np.arange(len(x)) % 8 != 0
    router = Router(x[learn], shares[learn] / shares[learn].sum(axis=1, keepdims=True))
    # the parts that held-out vectors must ask, over rows placed as all rows will be
    asked = router.ranked(x)
    of = asked[~learn][:, :, None] == asked[:, 0][near[~learn]][:, None, : min(k, LINKS)]
    found = of.any(axis=1).mean() and np.cumsum(of.mean(axis=(0, 2)))
    router.probes = int(min(parts, np.searchsorted(found, recall) + 1))
    return router


def _one_dimension(queries: DataFrame, rows: DataFrame, dim: int, k: int, recall: float) -> DataFrame:
    spark = rows.sparkSession
    share = min(1.0, SAMPLE / max(1, rows.count()))
    hashed = F.pmod(F.shiftright(F.xxhash64("x"), 1), F.lit(1 << 20)) < int(share * (1 << 20))
    # about SAMPLE vectors; equal ones enter once
    sample = np.array([r.x for r in rows.filter(hashed).select("x").distinct().orderBy(F.xxhash64("x"), "x").collect()]).reshape(-1, dim)
    router = spark.sparkContext.broadcast(fit(sample, k, recall))

    def place(batches: Iterator[pa.RecordBatch], probes: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, dim)
            one = router.value
            parts = np.zeros((len(x), 1), dtype=np.int64) if one is None else one.ranked(x)[:, : one.probes if probes else 1]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(parts.tolist(), pa.list_(pa.int32()))], names=["id", "x", "parts"])

    fields = "id long, x array<double>, parts array<int>"
    placed = rows.mapInArrow(lambda it: place(it, False), fields).select("id", "x", F.col("parts")[0].alias("part"))
    placed = cut(placed, "learned-rows")
    sizes = placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("id", "x"), F.col("blocks").cast("long")).cast("int")
    # at most PARTS rows of sizes
    file = placed.join(F.broadcast(sizes), "part").groupBy("part", block.alias("block")).agg(F.collect_list(F.struct("id", "x")).alias("rows"))
    sent = queries.mapInArrow(lambda it: place(it, True), fields).select("id", "x", F.explode("parts").alias("part"))
    sent = cut(sent, "learned-queries")
    groups = sent.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("groups"))
    group = F.pmod(F.xxhash64("id", "x"), F.col("groups").cast("long")).cast("int")
    asked = sent.join(F.broadcast(groups), "part").groupBy("part", group.alias("group")).agg(F.collect_list(F.struct("id", "x")).alias("queries"))
    asked = asked.join(F.broadcast(sizes), "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = asked.join(file, ["part", "block"]).select("queries", "rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                (q_ids, q), (ids, x) = ((c[r].values.field("id").to_numpy(), c[r].values.field("x").flatten().to_numpy().reshape(-1, dim)) for c in b.columns)
                for at in range(0, len(q), 256):
                    out = []
                    squares = _squares(q[at : at + 256], x)
                    wide = 1e-9 * (1 + (q[at : at + 256] ** 2).sum(axis=1) + (x**2).sum(axis=1).max())
                    most = min(k, len(x) - 1)
                    reach = np.partition(squares, most, axis=1)[:, most] + wide  # one more than k: the query's own row
                    for own, v, row, far in zip(q_ids[at : at + 256], q[at : at + 256], squares, reach):
                        near = np.flatnonzero((row <= far) & (ids != own))
                        d = distances(v, x[near])
                        best = np.lexsort((ids[near], d))[:k]
                        out += zip([own] * len(best), ids[near[best]].tolist(), d[best].tolist())
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), HITS)], schema=HITS)

    return work.mapInArrow(run, "query_id long, vec_id long, score double")


def search(queries: DataFrame, rows: DataFrame, k: int, recall: float = RECALL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: about the k nearest of each query but its own row; inputs ``(id, x)``."""
    spark = rows.sparkSession
    ship(spark)
    rows = cut(rows.dropDuplicates(["id", "x"]), "learned-vectors")
    queries = queries.dropDuplicates(["id", "x"])
    dims = [r.dim for r in rows.groupBy(F.size("x").alias("dim")).count().collect()]
    hits = [_one_dimension(queries.filter(F.size("x") == d), rows.filter(F.size("x") == d), d, k, recall) for d in dims]
    merged = reduce(DataFrame.unionByName, hits) if hits else spark.createDataFrame([], "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    """About the 10 nearest rows of every vector whose id is divisible by 100."""
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding").filter(F.exists("x", lambda c: c != 0))
    return search(rows.filter("id % 100 = 0"), rows, 10)
