"""A maintained keyed table (KV-1..5): log segments are merged into the row-key ranges they touch.

``operators.keyed`` replays a whole log.  Here the replayed state is kept on disk, cut
into ranges of the row key, and a new segment of the log rewrites only the ranges
that its row keys fall in.

    base/_ranges                          the sorted first row keys of all ranges but the first
    base/cells/version=<v>/range=<r>      the cells of range r as of version v
    base/_published/<n>                   the ranges that merge n rewrote, and in which version

Kept rows are ``row_key, family, qualifier, seq, op, value``: the newest operation of
every cell, deletes included, and the newest ``delete_row`` of a row (with null family
and qualifier), but nothing that a row's delete hides.  As the deletes stay, merging
is associative: segments may come late, overlap or be merged again, and the state is
always that of the whole log.  :func:`forget_deletes` drops old deletes once no older
operation can come.

Nothing is overwritten.  A merge writes new folders and then adds a record to
``_published``; a reader sees the state before or after it, and a failed merge leaves
folders that nobody reads (:func:`vacuum` deletes them).  Two merges at once claim
the same record, so the second one fails and can be run again.

Scale: a segment is folded per cell before it meets the old cells; the join with the row
deletes is left to Spark's size checks and skew splitting; the files are range-partitioned
on the whole cell key, so that a row with very many cells spreads over tasks.  The driver
sees the bounds and the touched ranges, at most ``ranges`` values each.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.operators import rank
from opinio.operators.keyed import CELL_KEY, DELETE_ROW, PUT
from opinio.sources.files import materialize

CELLS = "row_key string, family string, qualifier string, seq long, op string, value string"
_COLUMNS = ("row_key", "family", "qualifier", "seq", "op", "value")
_PUBLISHED = "merge long, range int, version long, filled boolean"


def fold(cells: DataFrame) -> DataFrame:
    """The rows to keep of any mutations ``row_key, family, qualifier, seq, op, value`` (a log, kept rows, or both)."""
    newest = (
        cells.filter(F.col("op") != DELETE_ROW)
        .groupBy(*CELL_KEY)
        .agg(F.max_by(F.struct("seq", "op", "value"), "seq").alias("last"))
    )
    gone = cells.filter(F.col("op") == DELETE_ROW).groupBy("row_key").agg(F.max("seq").alias("gone_at"))
    kept = newest.join(gone, "row_key", "left").filter(F.col("gone_at").isNull() | (F.col("last.seq") > F.col("gone_at")))
    marks = gone.select("row_key", F.lit(None).cast("string").alias("family"), F.lit(None).cast("string").alias("qualifier"),
                        F.col("gone_at").alias("seq"), F.lit(DELETE_ROW).alias("op"), F.lit(None).cast("string").alias("value"))
    return kept.select(*CELL_KEY, "last.seq", "last.op", "last.value").unionByName(marks)


def live(kept: DataFrame) -> DataFrame:
    """The cells that exist: ``row_key, family, qualifier, value``."""
    return kept.filter(F.col("op") == PUT).select(*CELL_KEY, "value")


def range_of(row_key: Column, bounds: list[str]) -> Column:
    """The range of a row key: how many of the sorted ``bounds`` are not above it, by bisection (a null key: 0)."""
    if not bounds:
        return F.lit(0)
    # one constant array, not one expression a bound
    firsts = F.from_json(F.lit(json.dumps(bounds)), "array<string>")

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span["lo"], span["hi"]
        mid = F.shiftright(lo + hi, 1)
        above = F.coalesce(F.get(firsts, mid) <= row_key, F.lit(False))
        return F.when(lo >= hi, span).otherwise(F.struct(
            F.when(above, mid + 1).otherwise(lo).alias("lo"), F.when(above, hi).otherwise(mid).alias("hi")))

    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve, lambda span: span["lo"])


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _bounds(spark: SparkSession, base: str) -> list[str]:
    return [r.first for r in spark.read.parquet(f"{base}/_ranges").orderBy("first").collect()]


def published(spark: SparkSession, base: str) -> DataFrame:
    """Every finished merge: ``merge, range, version, filled`` (not filled: the range has no cells left)."""
    if not _exists(spark, f"{base}/_published"):
        return spark.createDataFrame([], _PUBLISHED)
    return spark.read.schema(_PUBLISHED).option("recursiveFileLookup", "true").parquet(f"{base}/_published")


def _current(spark: SparkSession, base: str) -> list:
    newest = published(spark, base).groupBy("range").agg(F.max_by(F.struct("version", "filled"), "merge").alias("at"))
    return newest.filter("at.filled").select("range", "at.version").collect()


def _read(spark: SparkSession, base: str, ranges: list) -> DataFrame:
    if not ranges:
        return spark.createDataFrame([], CELLS)
    paths = [f"{base}/cells/version={r.version}/range={r.range}" for r in ranges]
    return spark.read.schema(CELLS).parquet(*paths)


def _write(spark: SparkSession, base: str, kept: DataFrame, bounds: list[str], touched: list[int]) -> int:
    merge = (published(spark, base).agg(F.max("merge")).first()[0] or 0) + 1
    version = time.time_ns()
    placed = kept.withColumn("range", range_of(F.col("row_key"), bounds))
    keys = ["range", *CELL_KEY]
    placed.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("range").mode("errorifexists").parquet(
        f"{base}/cells/version={version}")
    # from the folder names; a range without rows has no folder
    written = spark.read.schema(f"{CELLS}, range int").parquet(f"{base}/cells/version={version}")
    filled = {r.range for r in written.select("range").distinct().collect()}
    record = spark.createDataFrame([(merge, r, version, r in filled) for r in touched], _PUBLISHED)
    record.coalesce(1).write.mode("errorifexists").parquet(f"{base}/_published/{merge:010d}")
    return merge


def create(log: DataFrame, base: str, ranges: int = 64) -> None:
    """A new store at ``base`` from the first segment of a log, cut into ``ranges`` ranges of about as many row keys."""
    spark = log.sparkSession
    keys = log.select("row_key").filter(F.col("row_key").isNotNull()).distinct()
    numbered = materialize(rank.row_number_global(keys, ["row_key"], tie_break=[], out="n", collapse_copies=False, id_type="bigint"), "kv-keys")
    step = -(-numbered.count() // ranges) or 1
    firsts = numbered.filter((F.col("n") > 1) & ((F.col("n") - 1) % step == 0)).select(F.col("row_key").alias("first"))
    firsts.coalesce(1).write.mode("errorifexists").parquet(f"{base}/_ranges")
    merge(log, base)


def merge(log: DataFrame, base: str) -> list[int]:
    """Merge a segment of the log (columns as in ``operators.keyed``) into the store; returns the ranges rewritten."""
    spark = log.sparkSession
    bounds = _bounds(spark, base)
    segment = materialize(fold(log.select(*_COLUMNS)), "kv-segment")
    touched = sorted(r.range for r in segment.select(range_of(F.col("row_key"), bounds).alias("range")).distinct().collect())
    if touched:
        hit = set(touched)
        old = _read(spark, base, [r for r in _current(spark, base) if r.range in hit])
        _write(spark, base, fold(old.unionByName(segment)), bounds, touched)
    return touched


def kept(spark: SparkSession, base: str) -> DataFrame:
    """Every kept row of the newest state, deletes included."""
    return _read(spark, base, _current(spark, base))


def state(spark: SparkSession, base: str) -> DataFrame:
    """KV-3..5, SRC-7: the live cells ``row_key, family, qualifier, value`` of the newest state."""
    return live(kept(spark, base))


def get_row(spark: SparkSession, base: str, row_key: str) -> DataFrame:
    """KV-2: the cells of one row; only its range is read, and its sorted files are skipped by their statistics."""
    asked = spark.range(1).select(range_of(F.lit(row_key), _bounds(spark, base)).alias("range")).first().range
    cells = _read(spark, base, [r for r in _current(spark, base) if r.range == asked])
    return live(cells.filter(F.col("row_key") == row_key)).select("family", "qualifier", "value")


def forget_deletes(spark: SparkSession, base: str, before: int) -> None:
    """Drop deletes with ``seq`` under ``before``; call it when no operation older than that can still be merged."""
    cells = kept(spark, base)
    old = (F.col("op") != PUT) & (F.col("seq") < before)
    bounds = _bounds(spark, base)
    touched = sorted(r.range for r in cells.filter(old).select(range_of(F.col("row_key"), bounds).alias("range")).distinct().collect())
    if touched:
        hit = set(touched)
        _write(spark, base, _read(spark, base, [r for r in _current(spark, base) if r.range in hit]).filter(~old), bounds, touched)


def vacuum(spark: SparkSession, base: str) -> int:
    """Delete the folders of ranges that no reader of the newest state needs; returns how many.

    Not while a merge or an older reader is at work.
    """
    needed = {(r.version, r.range) for r in _current(spark, base)}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/cells")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    deleted = 0
    for version in fs.listStatus(root):
        for part in fs.listStatus(version.getPath()):
            name = part.getPath().getName()
            if name.startswith("range="):
                v, r = int(version.getPath().getName().split("=")[1]), int(name.split("=")[1])
                if (v, r) not in needed:
                    fs.delete(part.getPath(), True)
                    deleted += 1
    return deleted
