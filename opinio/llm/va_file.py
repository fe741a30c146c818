"""Exact top-k inner products with a vector-approximation file.

``build`` cuts the distinct vectors into blocks of about ``BLOCK`` by a hash and
writes, for each block, the cell of every component (``CELLS`` equal cells
between the block's least and greatest value of the dimension) and the exact
integer's place within its cell.

``search`` packs queries in chunks of about ``QUERY_BLOCK`` and deals a grid: the
blocks in groups of about ``GROUP`` at most, the chunks in parts of about ``PART`` components.  A task
holds a part and the k best of each of its queries while the blocks of one
group stream past.  From the cells alone a block gives an upper bound of each
inner product (a component's greatest contribution within its cell); a query
without a list reads the ``FIRST`` exact vectors of greatest bound, and then only
those whose bound reaches its k-th score, so nothing unread can belong to the
result.  So a task's memory is that of a part, and a query is sent once a
group and gives k rows a group, not once a block.

A vector that many rows share stands once, with its k + 1 smallest ids: no
query can return more of them.  The ids come from a window limited before the
shuffle, so copies that fill a third of the table meet in no task.

Results for odd input: vectors that are null, empty, or hold null or
non-finite components, and rows without id, take no part; vectors only meet
others of their dimension; rows repeated with id and vector count once; no row of a
query's own id is returned, however many there are; an
empty table gives an empty result; inner products beyond a long are an error;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import cut, quoted, ship, width

# Fixed value: components are floor(SCALE * x).
SCALE = 256
BLOCK = 4096
QUERY_BLOCK = 1024
CELLS = 64
FIRST = 32
# Blocks in a group and components of queries in a part, about; queries that meet a block at once; components gathered at once.
GROUP = 64
PART = 1 << 24
TOGETHER = 512
GATHERED = 1 << 22
# The score of a place in a list that is not taken yet: below all products, above the least long.
EMPTY = -(1 << 63) + 1


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, x)``: rows with an id and a non-empty vector of finite doubles."""
    x = quoted(vec_col).cast("array<double>")
    ok = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return df.select(quoted(id_col).cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & (F.size("x") > 0) & ok)


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    return vectors.select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest type in which inner products of integer rows of a and b are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most >= 1 << 63:
        raise OverflowError("inner products of these vectors do not fit a long")
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _narrow(a: np.ndarray) -> np.ndarray:
    """The same integers in the shortest signed type that also holds their negatives."""
    most = max(-int(a.min(initial=0)), int(a.max(initial=0)))
    return a.astype(f"<i{next(n for n in (1, 2, 4, 8) if n == 8 or most < 1 << (8 * n - 1))}")


def _integers_of(data: bytes, n: int, dim: int) -> np.ndarray:
    """n rows of integers, of the length that the data have."""
    return np.frombuffer(data, f"<i{len(data) // (n * dim)}").reshape(n, dim)


def build(vectors: DataFrame, k: int) -> DataFrame:
    """The file, one row per block: ``(dim, block, low, step, cells, rest, ids, counts)`` of distinct vectors ``v``."""
    ship(vectors.sparkSession)
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = vectors.dropDuplicates(["id", "v"]).withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    distinct = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = cut(distinct.withColumn("dim", F.size("v")), "va-vectors")
    counts = distinct.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = distinct.join(F.broadcast(counts), "dim").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks").cast("long")).cast("int"))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        dim, block = (x.as_py() for x in key)
        v = rows["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        low, high = v.min(axis=0), v.max(axis=0)
        step = (high - low) // CELLS + 1
        cells = ((v - low) // step).astype(np.uint8)
        ids = rows["ids"].combine_chunks()
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()), "low": [low.astype("<i8").tobytes()], "step": [step.astype("<i8").tobytes()],
            "cells": [cells.tobytes()], "rest": [_narrow(v - low - cells * step).tobytes()],
            "ids": [ids.flatten().to_numpy().astype("<i8").tobytes()], "counts": [ids.value_lengths().to_numpy().astype("<i4").tobytes()],
        })

    fields = "dim int, block int, low binary, step binary, cells binary, rest binary, ids binary, counts binary"
    return cut(placed.select("dim", "block", "v", "ids").groupBy("dim", "block").applyInArrow(pack, fields), "va-file")


class Best:
    """For each query the places of its k best vectors, their scores and their least ids that are not the query's own."""

    def __init__(self, queries: int, k: int) -> None:
        self.places, self.scores, self.leasts = np.full((queries, k), -1), np.full((queries, k), EMPTY), np.zeros((queries, k), np.int64)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return ((p[p >= 0], s[p >= 0]) for p, s in zip(self.places, self.scores))

    def merge(self, row: np.ndarray, place: np.ndarray, score: np.ndarray, least: np.ndarray) -> None:
        """Put vectors among the best of their rows, ties to smaller least ids."""
        # one that does not beat the last of a full list cannot enter it
        last, full = self.scores[row, -1], self.places[row, -1] >= 0
        enters = ~full | (score > last) | ((score == last) & (least < self.leasts[row, -1]))
        row, new = row[enters], [x[enters] for x in (place, score, least)]
        if not len(row):
            return
        k, hit = self.places.shape[1], np.unique(row)
        known = self.places, self.scores, self.leasts
        rows = np.concatenate([np.repeat(hit, k), row])
        places, scores, leasts = (np.concatenate([x[hit].ravel(), y]) for x, y in zip(known, new))
        order = np.lexsort((leasts, -scores, places < 0, rows))
        rows = rows[order]
        keep = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]
        for x, y in zip(known, (places, scores, leasts)):
            x[hit] = y[keep].reshape(-1, k)


def _least_bounds(floor: np.ndarray, over: np.ndarray, kind: type) -> np.ndarray:
    """``floor - over``, or a little less where ``kind`` does not hold it."""
    least = np.maximum(floor, EMPTY + over) - over
    if kind is np.int64:
        return least
    near = least.astype(kind)
    return np.where(np.abs(least) < 1 << (24 if kind is np.float32 else 53), near, np.nextafter(near, kind(-np.inf)))


def meet(
    queries: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray, exact: np.ndarray, firsts: np.ndarray, k: int,
    seconds: np.ndarray | None = None, own: np.ndarray | None = None, best: Best | None = None, start: int = 0,
) -> Best:
    """The best of each query so far and of this block, whose places count from ``start``, ties to smaller ``firsts`` (least ids).

    With ``own`` ids, a vector's least id is the second if the first is the query's own, and one without another takes no part.
    """
    best = Best(len(queries), k) if best is None else best
    n = len(cells)
    kind = _exact_type(queries, np.stack([low, low + step * CELLS]))
    bottom = (low + cells * step).astype(kind)
    together = min(TOGETHER, len(queries))
    # rows of whole words, so that eight pairs are passed over at once
    room, reached = np.empty((together, n), kind), np.zeros((together, -(-n // 8) * 8), bool)
    for at in range(0, len(queries), TOGETHER):
        q = queries[at : at + TOGETHER].astype(kind)
        # a bound is the product with the cells' least corner and, for components above zero, the cells' width less one
        bounds, over = np.matmul(q, bottom.T, out=room[: len(q)]), np.maximum(queries[at : at + TOGETHER], 0).astype(np.int64) @ (step - 1)
        floors, lasts, ends = (x[at : at + TOGETHER, -1] for x in (best.scores, best.leasts, best.places))

        def read(row: np.ndarray, place: np.ndarray) -> None:
            least = firsts[place]
            if own is not None:
                mine = own[at + row]
                least = np.where(least == mine, seconds[place], least)
                other = least != mine
                row, place, least = row[other], place[other], least[other]
            # a bound equal to the k-th score may hide a tie with a smaller id
            may = (ends[row] < 0) | (bounds[row, place] > _least_bounds(floors, over, kind)[row]) | (least < lasts[row])
            row, place, least = row[may], place[may], least[may]
            score = np.einsum("ij,ij->i", q[row], exact[place].astype(kind)).astype(np.int64)
            best.merge(at + row, start + place, score, least)

        def read_all(pairs: np.ndarray) -> None:
            some = max(1, GATHERED // queries.shape[1])
            for first in range(0, len(pairs), some):
                read(*np.divmod(pairs[first : first + some], n))

        fresh = np.flatnonzero(ends < 0)
        if len(fresh):
            wide = min(n, max(FIRST, k))
            near = np.argpartition(-bounds[fresh], wide - 1, axis=1)[:, :wide] if wide < n else np.tile(np.arange(n), (len(fresh), 1))
            near = (fresh[:, None] * n + near).ravel()
            read_all(near)
            bounds.ravel()[near] = -np.inf if kind is not np.int64 else np.iinfo(kind).min
        np.greater_equal(bounds, _least_bounds(floors, over, kind)[:, None], out=reached[: len(q), :n])
        words = np.flatnonzero(reached[: len(q)].view(np.uint64))
        word, place = np.nonzero(reached.reshape(-1, 8)[words])
        row, word = np.divmod(words[word], reached.shape[1] // 8)
        read_all(row * n + word * 8 + place)
    return best


def _hits(own: np.ndarray, best: Best, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The k best rows of each query by the ids of its best vectors."""
    k, starts = best.places.shape[1], np.cumsum(counts) - counts
    for at in range(0, len(own), 1 << 14):
        places = best.places[at : at + (1 << 14)]
        row, col = np.nonzero(places >= 0)
        many = counts[places[row, col]]
        ends = np.cumsum(many)
        vec = ids[np.repeat(starts[places[row, col]] - ends + many, many) + np.arange(many.sum())]
        score = np.repeat(best.scores[at : at + (1 << 14)][row, col], many)
        row = np.repeat(row, many)
        other = vec != own[at + row]
        row, vec, score = row[other], vec[other], score[other]
        order = np.lexsort((vec, -score, row))
        row = row[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        order = order[keep]
        if len(order):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (own[at + row[keep]], vec[order], score[order])], schema=HITS)


HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def search(queries: DataFrame, file: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best rows but its own, ties to smaller ids."""
    spark = queries.sparkSession
    ship(spark)
    counted = queries.dropDuplicates(["id", "v"]).withColumn("dim", F.size("v"))
    counted = cut(counted, "va-queries")
    chunks = counted.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("chunks"))
    mine = counted.join(F.broadcast(chunks), "dim").withColumn("chunk", F.pmod(F.xxhash64("id", "v"), F.col("chunks").cast("long")).cast("int"))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        dim, chunk = (x.as_py() for x in key)
        v = rows["v"].combine_chunks().flatten().to_numpy()
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
            "v": [_narrow(v).tobytes()], "ids": [rows["id"].combine_chunks().to_numpy().astype("<i8").tobytes()],
        })

    packed = mine.select("dim", "chunk", "id", "v").groupBy("dim", "chunk").applyInArrow(pack, "dim int, chunk int, v binary, ids binary")
    blocks = file.groupBy("dim").agg((F.max("block") + 1).alias("blocks"))
    # small tables have a group for every core
    groups = F.greatest(F.ceil(F.col("blocks") / GROUP), F.least("blocks", F.lit(2 * spark.sparkContext.defaultParallelism))).cast("int")
    parts = F.least("chunks", F.ceil(F.col("chunks") * F.col("dim").cast("double") * QUERY_BLOCK / PART)).cast("int")
    grid = F.broadcast(chunks.join(F.broadcast(blocks), "dim").select("dim", parts.alias("parts"), groups.alias("groups")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    none = [F.lit(None).cast("binary").alias(c) for c in ("low", "step", "rest", "counts")]
    asked = packed.join(grid, "dim").select(
        "dim", "groups", F.pmod("chunk", "parts").alias("part"), every("groups").alias("group"), F.lit(True).alias("asks"), "v", "ids", *none)
    sent = file.join(grid, "dim").select(
        "dim", "groups", every("parts").alias("part"), F.pmod("block", "groups").alias("group"), F.lit(False).alias("asks"),
        F.col("cells").alias("v"), "ids", "low", "step", "rest", "counts")
    # neighbours in the grid go to different partitions; more places than partitions share them
    to = F.pmod(F.col("dim") + F.col("part").cast("long") * F.col("groups") + F.col("group"), F.lit(width(spark))).cast("int")
    dealt = asked.union(sent).withColumn("to", to).repartitionById(width(spark), F.col("to"))
    # a place's queries, then its blocks
    work = dealt.sortWithinPartitions("dim", "part", "group", F.desc("asks")).select("dim", "part", "group", "asks", "v", "ids", "low", "step", "rest", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, own, best, stored, start = None, [], None, None, [], 0

        def hits() -> Iterator[pa.RecordBatch]:
            return _hits(own, best, *(np.concatenate(x) for x in zip(*stored))) if stored else iter(())

        for b in batches:
            for r in range(b.num_rows):
                dim, part, group, asks, v, ids, low, step, rest, counts = (c[r].as_py() for c in b.columns)
                if (dim, part, group) != at:
                    yield from hits()
                    at, held, own, best, stored, start = (dim, part, group), [], None, None, [], 0
                ids = np.frombuffer(ids, "<i8")
                if asks:
                    held.append((ids, _integers_of(v, len(ids), dim)))
                    continue
                if not held:  # this part is empty
                    continue
                if best is None:
                    own, q = (np.concatenate(x) for x in zip(*held))
                    held, best = [True], Best(len(own), k)
                low, step, counts = np.frombuffer(low, "<i8"), np.frombuffer(step, "<i8"), np.frombuffer(counts, "<i4")
                cells = np.frombuffer(v, np.uint8).reshape(-1, dim)
                exact = _narrow(low + cells * step + _integers_of(rest, len(counts), dim))
                firsts = np.cumsum(counts) - counts
                meet(q, low, step, cells, exact, ids[firsts], k, ids[firsts + (counts > 1)], own, best, start)
                stored.append((ids, counts))
                start += len(counts)
        yield from hits()

    hits = work.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    """The 5 rows of greatest integer inner product for every vector whose id is divisible by 50."""
    k = 5
    vectors = cut(integers(usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")), "va-integers")
    return search(vectors.filter("id % 50 = 0"), build(vectors, k), k)
