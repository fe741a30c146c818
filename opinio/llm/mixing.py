"""Mixing sources to target weights by weighted fair queueing.

Sizes are words (runs outside space and U+0009..U+000D; null text: 0).  Sources
are numbered by code point, null last, and weigh 1, 2, 3, 1, 2, 3, ...; the
budget is the sum of all sizes, shared by weight.  A target stops at
``EPOCHS`` times its source's size, and what is over is shared again by weight
among the others until no target is above its stop.

Each source's documents are shuffled by a hash of the whole row and queued
``EPOCHS`` times over.  The virtual finish time of a queued copy is its source's
cumulative words, itself included, divided by the source's target, so at any
virtual time every source has been served the same share of its target.  All
copies are put into ranges of virtual time, the ranges' words are summed up,
and the queue is cut at the last copy that keeps the total within the budget.

Nothing is ordered in one task: a source's cumulative words come from ranges of
the shuffle hash (sums of the ranges first, then the rows of one range each),
and the cut from ranges of virtual time (sums first, then the rows of the range
that crosses the budget).  With n rows there are about sqrt(n) ranges, so no
task sees more than about sqrt(n) rows or sums, whatever a source's share is.
Equal rows are counted once with their number; a row of more than ``CHUNK`` copies
is spread again in chunks dealt over tasks, so no task makes all its copies.

Results for odd input: documents without words take 0 and have no place in the
queue; a null source is a source; null doc_ids and repeated rows are documents
like any other; an empty table gives an empty result; clashing column names do
no harm, since only the three named columns and the row hash are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import WORD_PATTERN, cut, free_name, quoted, row_hash, width
from opinio.operators.rank import row_number_global

# The weights in turn and the most copies of a document.
WEIGHTS = (1, 2, 3)
EPOCHS = 3
# Copies of one row that one task makes at most.
CHUNK = 4096
_HALF = float(1 << 63)


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(quoted(text).cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``: shares of the whole by weight, stopped and shared again.

    Every round is one aggregate row on the driver: the words left and the
    weight of the sources that have not stopped.  A stop stays a stop in later
    rounds, since what is shared per weight only grows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("no_source", F.col("source").isNull())
    placed = row_number_global(totals, ["no_source", "source"], [], out="place", collapse_copies=False, id_type="bigint")
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    weighed = cut(placed.select("source", "source_size", turn.alias("weight")), "mix-weights")
    stop = F.col("source_size") * epochs
    whole = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = 0.0, -1
    while True:
        over = stop <= F.col("weight") * share
        now = weighed.agg(F.sum(F.when(over, stop)), F.sum(F.when(~over, F.col("weight"))), F.count(F.when(over, 1))).first()
        if now[2] == stopped or not now[1]:
            break
        share, stopped = (whole - (now[0] or 0)) / now[1], now[2]
    return weighed.select("source", "source_size", F.least(stop.cast("double"), F.col("weight") * F.lit(share)).alias("target"))


def queue(rows: DataFrame) -> DataFrame:
    """``(source, tag, size, n)`` plus ``before``: the words of the source's earlier rows in the order of ``tag``."""
    n = rows.count()
    ranges = max(1, math.isqrt(n))
    place = F.floor((F.col("tag") / _HALF + 1) / 2 * ranges).cast("int")
    placed = rows.withColumn("range", F.least(F.greatest(place, F.lit(0)), F.lit(ranges - 1)))
    sums = placed.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "range").orderBy("tag", "id").rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("inside", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    same = run["source"].eqNullSafe(bases["source"]) & (run["range"] == bases["range"])
    return run.join(bases, same).select(run["source"], "id", "tag", "size", "n", (F.col("base") + F.col("inside")).alias("before"))


def numbered(rows: DataFrame, n: str, out: str, chunk: str, deal_by: list[str]) -> DataFrame:
    """Every row n times, numbered from 1 in ``out``; chunks of copies are dealt over tasks (``chunk`` is a free name)."""
    n, at = quoted(n).cast("long"), quoted(chunk)
    chunks = rows.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / CHUNK).cast("long"))))
    dealt = chunks.repartition(width(rows.sparkSession), *[quoted(c) for c in deal_by], at)
    return dealt.withColumn(out, F.explode(F.sequence(at * CHUNK + 1, F.least((at + 1) * CHUNK, n)))).drop(chunk)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(id, tag, source, size, source_size, target, copies)`` for every row of ``docs``.

    ``tag`` is the row's hash, ``copies`` how often the mix takes the row.
    """
    sized = docs.select(quoted(source_col).alias("source"), quoted(id_col).alias("id"), row_hash(docs, seed).alias("tag"), words(text_col).alias("size"))
    sized = cut(sized.groupBy("source", "id", "tag", "size").agg(F.count(F.lit(1)).alias("n")), "mix-rows")
    aims = cut(targets(sized.select("source", (F.col("size") * F.col("n")).alias("size")), weights, epochs), "mix-targets")
    queued = queue(sized.filter("size > 0"))
    # one row per copy of equal rows, then one per time over
    copies = numbered(queued, "n", "copy", "chunk", ["tag", "id"])
    lined = copies.join(aims, copies["source"].eqNullSafe(aims["source"])).drop(aims["source"])
    reached = F.col("before") + F.col("copy") * F.col("size")
    lined = cut(lined.select("source", "id", "tag", "size", "copy", "source_size", "target", reached.alias("reached")), "mix-queue")

    def finish(epoch: Column) -> Column:
        return ((epoch - 1) * F.col("source_size") + F.col("reached")) / F.col("target")

    whole = aims.agg(F.sum("source_size")).first()[0] or 0
    ranges = max(1, math.isqrt(lined.count()))
    times = lined.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn("finish", finish(F.col("epoch")))
    times = times.withColumn("range", F.least(F.floor(F.col("finish") * ranges), F.lit(2 * ranges)).cast("int"))
    sums = times.groupBy("range").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    crossing = sums.withColumn("upto", upto).filter(F.col("upto") > whole).orderBy("range").first()
    keys = ["finish", "tag", "id", "copy", "epoch"]
    if crossing:
        room = whole - (crossing["upto"] - crossing["words"])
        line = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = times.filter(F.col("range") == crossing["range"]).withColumn("total", F.sum("size").over(line))
        first_out = last.filter(F.col("total") > room).orderBy("total").select(*keys).limit(1)
    else:
        first_out = times.select(*keys).limit(0)
    marked = lined.join(F.broadcast(first_out.select(F.struct(*keys).alias("first_out"))), F.lit(True), "left")
    taken = sum(
        F.when(F.col("first_out").isNull() | (F.struct(finish(F.lit(e)).alias("finish"), "tag", "id", "copy", F.lit(e).alias("epoch")) < F.col("first_out")), 1).otherwise(0)
        for e in range(1, epochs + 1)
    )
    got = marked.select("source", "id", "tag", "size", taken.alias("copies"))
    empty = numbered(sized.filter("size = 0"), "n", "copy", "chunk", ["tag", "id"])
    every = got.union(empty.select("source", "id", "tag", "size", F.lit(0).alias("copies")))
    return every.join(aims, every["source"].eqNullSafe(aims["source"])).drop(aims["source"])


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns."""
    tag, times, chunk, copy = (free_name(docs, x) for x in ("row_tag", "times", "row_chunk", "row_copy"))
    taken = mix(docs, id_col, text_col, source_col, seed).groupBy(F.col("tag").alias(tag)).agg(F.sum("copies").cast("long").alias(times))
    taken = cut(taken.filter(quoted(times) > 0), "mix-taken")
    tagged = docs.withColumn(tag, row_hash(docs, seed))
    columns = [quoted(c) for c in docs.columns]
    few = tagged.dropDuplicates([tag]).join(taken.filter(quoted(times) <= CHUNK), tag)
    out = few.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), quoted(times)))).select(*columns)
    many = taken.filter(quoted(times) > CHUNK)
    if not many.isEmpty():
        # rows of so many copies are looked up by themselves, so that only they are dealt out anew
        out = out.union(numbered(tagged.join(many, tag).dropDuplicates([tag]), times, copy, chunk, [tag]).select(*columns))
    return out


def op4(spark, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words of it that the mix takes."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
