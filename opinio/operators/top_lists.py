"""Exact lists of greatest inner products without scoring all pairs (ML-4, ML-5).

By Cauchy-Schwarz a candidate scores at most the product of the two norms.
The candidates are cut into blocks by norm, largest first; a query
meets them in that order and stops as soon as the bound is below its
n-th score so far, since no later candidate can be better.

The blocks are met in rounds of 2, 8, 16, 16, ... blocks.  A round deals the queries
still open over parts, sends a copy of its blocks to every part and streams the
queries past them: about a thousand queries against a few hundred candidates as one
matrix product, of which only scores that reach a query's n-th so far are looked at.
A task holds one round's candidates and one batch of queries.  A query's best so far
travels with it, so a round is one shuffle and one write, and a lost executor repeats
a part of one round only.  The driver sees one norm a block and two sums a round.

Scores are summed in double precision in the order of the components and ties go to
the smaller id, so the result does not depend on the layout.  Rows whose vector is
null are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.session import ship_package
from opinio.sources.files import materialize

# Candidates in a block, queries in a matrix product, and the most blocks of a round.
BLOCK = 16384
PACK = 1024
ROUND = 16
# Queries that are worth a copy of a round's blocks, and candidates in a matrix product.
PART = 32768
CHUNK = 512
# Bounds are products of two rounded square roots; matrix products add up in any order.
_SLACK = 1 + 1e-9
_ROUNDING = 1e-12


@dataclass
class Lists:
    """``rows`` (query, item, score), at most n a query; pairs scored, and all pairs."""
    rows: DataFrame
    scored: int
    pairs: int


def _norm() -> F.Column:
    return F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))


def _vectors(df: DataFrame) -> DataFrame:
    v = F.transform("features", lambda x: x.cast("double"))
    return df.filter("features IS NOT NULL").select("id", v.alias("v")).withColumn("norm", _norm())


def blocks_by_norm(candidates: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(block, id, v, norm)``: vectors in ranges of falling norm, about ``block`` in each."""
    ranges = max(1, -(-candidates.count() // block))
    # the range sampler sees distinct keys, so equal norms do not pile up in one range
    ranged = _vectors(candidates).repartitionByRange(ranges, F.desc("norm"), "id")
    return materialize(ranged.withColumn("block", F.spark_partition_id()), "norm-blocks")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _merge(items: np.ndarray, scores: np.ndarray, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
    """Put the hits (row, item, score) among the best of their rows, in place."""
    n = items.shape[1]
    hit = np.unique(row)
    rows = np.concatenate([np.repeat(hit, n), row])
    all_items, all_scores = np.concatenate([items[hit].ravel(), item]), np.concatenate([scores[hit].ravel(), score])
    order = np.lexsort((all_items, -all_scores, rows))
    rows = rows[order]
    keep = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < n]
    items[hit], scores[hit] = all_items[keep].reshape(-1, n), all_scores[keep].reshape(-1, n)


def _scan(q: np.ndarray, norm: np.ndarray, items: np.ndarray, scores: np.ndarray,
          ids: np.ndarray, x: np.ndarray, x_norm: np.ndarray, chunk: int) -> np.ndarray:
    """Meet the queries with candidates of falling norm; bests change in place; candidates scored a query."""
    n = items.shape[1]
    scored = np.zeros(len(q), np.int64)
    for first in range(0, len(ids), chunk):
        open_ = np.nonzero(norm * x_norm[first] * _SLACK >= scores[:, -1])[0]
        if not len(open_):
            break
        part = slice(first, min(first + chunk, len(ids)))
        scored[open_] += part.stop - first
        product = q[open_] @ x[part].T
        least = scores[open_, -1]
        fresh = np.isneginf(least)
        if fresh.any() and product.shape[1] > n:
            least[fresh] = np.partition(product[fresh], -n, axis=1)[:, -n]
        hits = np.flatnonzero(product >= (least - _ROUNDING * norm[open_] * x_norm[first])[:, None])
        if len(hits):
            row, col = open_[hits // product.shape[1]], hits % product.shape[1] + first
            exact = q[row, 0] * x[col, 0]
            for k in range(1, q.shape[1]):
                exact += q[row, k] * x[col, k]
            _merge(items, scores, row, ids[col], exact)
    return scored


def _meet(still: DataFrame, count: int, blocks: DataFrame, numbers: list[int], n: int, chunk: int, pack: int) -> DataFrame:
    """The ``count`` queries with their best n after the numbered blocks and ``scored``, the candidates each was scored with."""
    spark = still.sparkSession
    ship_package(spark)
    parts = max(1, -(-count // PART), min(spark.sparkContext.defaultParallelism, -(-count // pack)))
    sent = blocks.filter(F.col("block").isin(numbers)).select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("asks"), (-F.col("norm")).alias("place"),
        F.col("id").cast("long"), "v", "norm", F.lit(None).cast("array<long>").alias("items"), F.lit(None).cast("array<double>").alias("scores"))
    asked = still.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("asks"),
                         (-F.try_divide(F.element_at("scores", -1), "norm")).alias("place"), "id", "v", "norm", "items", "scores")
    # a part's candidates by falling norm, then its queries, those that close late together; parts may share a partition
    order = ["part", "asks", "place", "id"]
    dealt = sent.union(asked).repartition(parts, "part").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, known = None, [], None
        for b in batches:
            cuts = np.flatnonzero(np.diff(b.column(0).to_numpy(), prepend=-1, append=-1))
            for start, end in zip(cuts[:-1], cuts[1:]):
                if b.column(0)[start].as_py() != part:
                    part, held, known = b.column(0)[start].as_py(), [], None
                rows = b.slice(start, end - start)
                asks = rows.column(1).to_numpy(zero_copy_only=False)
                k = int(np.argmax(asks)) if asks.any() else len(asks)
                if k:
                    c = rows.slice(0, k)
                    held.append((c.column(3).to_numpy(), _matrix(c.column(4)), c.column(5).to_numpy()))
                for at in range(k, len(asks), pack):
                    known = known or tuple(np.concatenate(z) for z in zip(*held))
                    r = rows.slice(at, pack)
                    norm, items, scores = r.column(5).to_numpy(), _matrix(r.column(6)).copy(), _matrix(r.column(7)).copy()
                    scored = _scan(_matrix(r.column(4)), norm, items, scores, *known, chunk)
                    ends = pa.array(np.arange(0, items.size + 1, n), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [r.column(3), r.column(4), r.column(5), pa.ListArray.from_arrays(ends, pa.array(items.ravel(), pa.int64())),
                         pa.ListArray.from_arrays(ends, pa.array(scores.ravel(), pa.float64())), pa.array(scored)],
                        names=["id", "v", "norm", "items", "scores", "scored"])

    return dealt.select("part", "asks", "place", "id", "v", "norm", "items", "scores").mapInArrow(
        run, "id long, v array<double>, norm double, items array<long>, scores array<double>, scored long")


def top_lists(queries: DataFrame, candidates: DataFrame, n: int, block: int = BLOCK, pack: int = PACK) -> Lists:
    """For every query the n candidates of greatest inner product; both are ``(id, features)`` with distinct ids.

    Both are read several times, so pass written or kept tables (a fitted model keeps its factors).
    """
    kinds = dict(queries.dtypes)["id"], dict(candidates.dtypes)["id"]
    blocks = blocks_by_norm(candidates, block)
    # (block, greatest norm, candidates), one row a block, the greatest norm first
    order = sorted(blocks.groupBy("block").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["top"])
    still = _vectors(queries).select(F.col("id").cast("long").alias("id"), "v", "norm", F.array_repeat(F.lit(0).cast("long"), n).alias("items"),
                                     F.array_repeat(F.lit(float("-inf")), n).alias("scores"))
    asked = open_count = still.count()
    done, scored, first, width = [], 0, 0, 2
    while first < len(order) and open_count:
        now = order[first : first + width]
        met = materialize(_meet(still, open_count, blocks, [r["block"] for r in now], n, min(block, CHUNK), pack), "best")
        first, width = first + len(now), min(4 * width, ROUND)
        open_ = F.lit(False) if first >= len(order) else F.col("norm") * order[first]["top"] * _SLACK >= F.element_at("scores", -1)
        row = met.agg(F.sum("scored"), F.count_if(open_)).first()
        scored, open_count = scored + (row[0] or 0), row[1]
        done.append(met.filter(~open_))
        still = met.filter(open_)
    if not done:
        best = still.sparkSession.createDataFrame([], f"query {kinds[0]}, item {kinds[1]}, score double")
    else:
        entry = F.explode(F.arrays_zip("items", "scores"))
        best = reduce(DataFrame.union, done).select("id", entry.alias("e")).filter("e.scores > double('-Infinity')").select(
            F.col("id").cast(kinds[0]).alias("query"), F.col("e.items").cast(kinds[1]).alias("item"), F.col("e.scores").alias("score"))
    return Lists(best, scored, asked * sum(r["n"] for r in order))
