"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

N rows lie in about sqrt(N) / 4 parts and go to as many blocks, a whole number of
blocks to each shard; the sizes of shards and blocks are known beforehand and
differ by one row at most.  How many rows of each part a block gets is drawn
first: row by row the matrix is multivariate hypergeometric, given what the rows
before it left of every block, which is the law of these counts under a uniform
shuffle.  Then every part permutes its rows and deals them out by its counts,
the rows are exchanged, and every block permutes what it got.  A row's slot is
its place in its block plus the rows of its shard's earlier blocks.

The matrix is never in one place: ``SPLIT`` ranges of parts are drawn from the
whole, then each range is split again in a task of its own, until every part has its
row.  ``hypergeometric`` inverts the distribution on a window of twelve standard
deviations around the mode, so it has no largest population.

Rows are known by two 64-bit hashes and their number among equal rows, so the
result follows from the rows and the seed alone, however the input is laid out.
Equal rows are folded to a count and spread again before they are dealt
(``opinio.operators.rank``), so a row that fills a third of the table is in no
part alone.  The largest tasks hold one part or one block of the hashes, about
4 sqrt(N) rows.

Results for odd input: nulls in any column and empty or very long texts are
values like any other; repeated rows are rows of their own; there may be more
shards than rows (the last ones are empty); an empty table gives an empty
result; columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import cut, free_name, quoted, row_hash, ship, table
from opinio.operators.rank import spread_copies

# Fixed value: the shards of the query.
SHARDS = 8
# Ranges of parts drawn by one task.
SPLIT = 32


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many good ones are among n drawn without replacement from good + bad."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    whole = good + bad
    mode = (n + 1) * (good + 1) // (whole + 2)
    spread = math.sqrt(n * (good / whole) * (bad / whole) * ((whole - n) / max(1, whole - 1)))
    window = 40 + int(12 * spread)
    first, last = max(low, mode - window), min(high, mode + window)
    k = np.arange(first, last, dtype=np.float64)
    step = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(step)])
    total = np.cumsum(np.exp(weight - weight.max()))
    return first + min(int(np.searchsorted(total, rng.random() * total[-1], side="right")), last - first)


def deal(rng: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    """Counts of n rows over blocks with ``room`` places, multivariate hypergeometric."""
    counts, left = np.zeros_like(room), int(room.sum())
    for b, places in enumerate(room.tolist()):
        if not n:
            break
        left -= places
        counts[b] = got = hypergeometric(rng, places, left, n)
        n -= got
    return counts


def even(total: int, into: int) -> np.ndarray:
    """``into`` sizes that add up to ``total``, the larger ones first."""
    return np.array([total // into + (i < total % into) for i in range(into)], dtype=np.int64)


MATRIX = pa.schema([("first", pa.int32()), ("last", pa.int32()), ("room", pa.list_(pa.int64()))])


def matrix(spark, sizes: list[int], room: np.ndarray, seed: int) -> DataFrame:
    """``(part, counts)``: for every part how many of its rows each block gets."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()

    def split(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rng, left = np.random.default_rng([seed, r["first"], r["last"]]), np.array(r["room"], dtype=np.int64)
                width = -(-(r["last"] - r["first"]) // SPLIT)
                for a in range(r["first"], r["last"], width):
                    b = min(a + width, r["last"])
                    counts = deal(rng, left, ends[b] - ends[a])
                    left = left - counts
                    yield pa.RecordBatch.from_pylist([{"first": a, "last": b, "room": counts.tolist()}], schema=MATRIX)

    fields = "first int, last int, room array<long>"
    rows = spark.createDataFrame([(0, len(sizes), room.tolist())], fields)
    width = len(sizes)
    while width > 1:
        # each range is split in a task of its own
        rows = rows.repartition(max(1, len(sizes) // width), "first").mapInArrow(split, fields)
        width = -(-width // SPLIT)
    return cut(rows.select(F.col("first").alias("part"), F.col("room").alias("counts")), "shard-matrix")


def place(tags: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``(hi, lo, shard, slot)`` for every row of ``tags`` (hi, lo), equal ones included."""
    spark = tags.sparkSession
    ship(spark)
    cards = cut(spread_copies(tags.select("hi", "lo")).withColumnRenamed("_copy", "copy"), "shard-cards")
    n = cards.count()
    parts = max(1, math.isqrt(n) // 4)
    whole, per_shard = even(n, shards), -(-parts // shards)
    room = np.concatenate([even(int(x), per_shard) for x in whole])

    def draw(what: int):
        return F.xxhash64(F.lit(seed), F.lit(what), "hi", "lo", "copy")

    cards = cards.withColumn("part", F.pmod(draw(1), F.lit(parts)).cast("int"))
    # one number a part, about sqrt(n) / 4 of them
    found = dict(cards.groupBy("part").agg(F.count(F.lit(1))).collect())
    counts = matrix(spark, [found.get(p, 0) for p in range(parts)], room, seed)

    def hand_out(key: tuple, rows: pa.Table, row: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("order", "hi", "lo", "copy")])
        given = row["counts"].combine_chunks().flatten().to_numpy()[: len(room)] if rows.num_rows else np.zeros(len(room), dtype=np.int64)
        return rows.select(["hi", "lo", "copy"]).append_column("block", pa.array(np.repeat(np.arange(len(room)), given), pa.int64()))

    permuted = cards.withColumn("order", draw(2)).groupBy("part").cogroup(counts.groupBy("part"))
    dealt = permuted.applyInArrow(hand_out, "hi long, lo long, copy long, block long")
    within = F.row_number().over(Window.partitionBy("block").orderBy(draw(3), "hi", "lo", "copy")) - 1
    shard, b = F.floor(F.col("block") / per_shard), F.col("block") % per_shard
    size = F.lit(n // shards) + (shard < n % shards).cast("long")
    before = b * F.floor(size / per_shard) + F.least(b, size % per_shard)
    return dealt.select("hi", "lo", shard.cast("int").alias("shard"), (before + within).cast("long").alias("slot"))


def into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Every row of ``docs`` with its ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in ("shard", "slot")])
    hi = free_name(docs, "hi")
    lo = free_name(docs.withColumn(hi, F.lit(0)), "lo")
    tagged = docs.select(row_hash(docs, 0).alias(hi), row_hash(docs, 1).alias(lo), *[quoted(c) for c in docs.columns])
    placed = cut(place(tagged.select(quoted(hi).alias("hi"), quoted(lo).alias("lo")), shards, seed), "shard-places").toDF(hi, lo, "shard", "slot")
    return tagged.dropDuplicates([hi, lo]).join(placed, [hi, lo]).drop(hi, lo)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``shard=k`` per shard; its files, in order of name, hold its rows in order of ``slot``."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op12(spark, sf_dir: str) -> DataFrame:
    """Every document's shard and slot under the law ``rows``; the seed is fixed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    sharded = into_shards(docs)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
