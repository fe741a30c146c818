"""Global ranks without a single-partition window (WIN-1..3).

``row_number().over(Window.orderBy(...))`` with no partition key moves every
row into one task.  Here the same numbers come from a range-partitioned sort:

1. range-partition on the order key plus a tie-break and sort within
   partitions (one shuffle; the sampler can split a hot key because the
   tie-break makes keys distinct);
2. tag each row with ``monotonically_increasing_id`` - partition index in the
   upper bits, position inside the sorted partition in the lower 33 bits -
   and write the frame to the shared checkpoint folder, so the tags are fixed
   even if executors are lost and tasks rerun;
3. count rows per partition (one row per partition after map-side combine),
   turn the counts into running offsets, and broadcast that table, whose size
   is the number of partitions, not the number of rows;
4. rank = offset of the partition + position in the partition + 1.

Identical rows cannot be split by any sort key, so when the order covers every
column the rows are first folded to ``(row, copies)`` by an aggregate with
map-side combine and expanded again with a copy index.  A group with more than
``COPY_CHUNK`` copies (say, one row holding a third of the table) is expanded
in chunks spread round-robin over tasks, so no task generates or sorts it
alone; the copy index then lets the range sampler split it like any other key.

Dense ranks of a key with few values run the same steps over the distinct keys
(one row per key, so no range can be skewed) and join the ranks back on the
key, null-safe.  Dense ranks of a text that is nearly different on every row
(:func:`rank_by_sort`) need neither the distinct nor the join: the rows
themselves are range-sorted once and the changes of the key are counted as each
sorted partition streams by; a hash of its first and last key tells whether
the next partition goes on with the same key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from opinio.operators.clean import q, resolve
from opinio.session import ship_package
from opinio.sources.files import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1
# Fixed value: the reference derives product ids as user id modulo 1000.
SURROGATE_PRODUCT_MODULUS = 1000
# Copies of one row expanded by a single task at most.
COPY_CHUNK = 4096


def _sort_keys(order: list[str], tie_break: list[str]) -> list[Column]:
    # ascending with nulls first, Spark's default order
    return [q(c).asc_nulls_first() for c in order + tie_break]


def spread_copies(df: DataFrame, chunk: int = COPY_CHUNK) -> DataFrame:
    """``df`` with a ``_copy`` index that numbers identical rows 0..n-1.

    Identical rows are folded first (partial aggregation, so a hot row costs
    one record per map task in the shuffle); every group is cut into chunks of
    at most ``chunk`` copies, the chunks are spread round-robin, and a task
    expands one chunk at a time.
    """
    n = F.col("_n")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    last_chunk = F.floor((n - 1) / F.lit(chunk)).cast("long")
    chunks = groups.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("_chunk"))
    return (
        chunks.repartition(tasks)
        .select("*", F.explode(F.sequence(F.col("_chunk") * chunk,
                                          F.least((F.col("_chunk") + 1) * chunk, n) - 1)).alias("_copy"))
        .drop("_chunk", "_n")
    )


def tagged_positions(df: DataFrame, order: list[str], tie_break: list[str], collapse_copies: bool) -> DataFrame:
    """Steps 1-2: range-partitioned, sorted, tagged with ``_mid`` and written to the shared folder."""
    source = spread_copies(df) if collapse_copies else df
    keys = _sort_keys(order, tie_break + (["_copy"] if collapse_copies else []))
    ranged = source.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()), "rank")


def row_number_global(df: DataFrame, order: list[str], tie_break: list[str] | None = None,
                      out: str = "row_number", collapse_copies: bool | None = None,
                      id_type: str = "int") -> DataFrame:
    """``df`` plus an INT column ``out`` equal to ``row_number() over (order by order, tie_break)``.

    ``tie_break`` defaults to every other column, which makes the order total
    up to identical rows (whose numbers are interchangeable); the result is
    then deterministic.  ``collapse_copies`` (default: when the order covers
    every column) folds identical rows first, see :func:`spread_copies`; pass
    False when the rows are known to be distinct.  ``id_type`` is INT like
    Spark's ``row_number``; past 2,147,483,647 rows pass ``"bigint"`` (under
    ANSI mode an INT overflow raises instead of wrapping).
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in order]
    if collapse_copies is None:
        collapse_copies = set(df.columns) <= set(order) | set(tie_break)
    tagged = tagged_positions(df, order, tie_break, collapse_copies)
    counts = tagged.groupBy(F.shiftright("_mid", _POS_BITS).alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: the window below sees a bounded, tiny frame
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_cnt")).alias("_off"),
    )
    ranked = tagged.join(F.broadcast(offsets), F.shiftright(tagged["_mid"], _POS_BITS) == offsets["_pid"])
    number = (ranked["_off"] + F.col("_mid").bitwiseAND(F.lit(_POS_MASK)) + 1).cast(id_type)
    return ranked.select(*[q(c) for c in df.columns], number.alias(out))


def key_ranks(df: DataFrame, key: str, out: str, id_type: str = "int") -> DataFrame:
    """``_k, <out>``: the dense rank of every distinct value of ``key`` (one row per value)."""
    distinct_keys = df.select(q(key).alias("_k")).distinct()
    return row_number_global(distinct_keys, ["_k"], tie_break=[], out=out, collapse_copies=False, id_type=id_type)


def _edge(value: str | None) -> str:
    return "null" if value is None else hashlib.sha256(value.encode()).hexdigest()


def _count_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with ``_key`` -> the rows without it, with ``_local`` (distinct keys of this partition so far)
    and ``_edge`` (the key's hash on the partition's first and last row, else null)."""
    seen, last, held = 0, None, None
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        at = b.schema.get_field_index("_key")
        key = b.column(at)
        here, before = key.slice(1), key.slice(0, n - 1)
        changed = np.empty(n, bool)
        changed[0] = seen == 0 or key[0].as_py() != last
        # a comparison with a null is null: it is a change if only one side is
        changed[1:] = pc.coalesce(pc.not_equal(here, before), pc.xor(pc.is_null(here), pc.is_null(before))).to_numpy(zero_copy_only=False)
        local = seen + np.cumsum(changed)
        edges = [None] * n
        if seen == 0:
            edges[0] = _edge(key[0].as_py())
        seen, last = int(local[-1]), key[n - 1].as_py()
        if held is not None:
            yield pa.RecordBatch.from_arrays([*held[0], pa.array(held[1], pa.string())], names=held[2])
        rest = [(b.schema.names[i], b.column(i)) for i in range(b.num_columns) if i != at]
        held = [c for _, c in rest] + [pa.array(local, pa.int64())], edges, [name for name, _ in rest] + ["_local", "_edge"]
    if held is not None:
        held[1][-1] = _edge(last)
        yield pa.RecordBatch.from_arrays([*held[0], pa.array(held[1], pa.string())], names=held[2])


def rank_by_sort(df: DataFrame, key: str, out: str, id_type: str = "int") -> DataFrame:
    """``df`` plus ``out`` = dense rank of the text column ``key`` (null first) by one range sort of the rows.

    ``_row``, the tie-break, is fixed in a written table, so a key on a third of
    the rows is split over ranges like any other, identical rows included.  A
    partition's rows stream through Python in Arrow batches of bounded bytes
    with one counter; what is brought together afterwards is one row a partition
    (a count and two hashes).  An empty frame gives an empty frame.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rank-input")
    order = [q(key).asc_nulls_first(), F.col("_row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.drop("_row").select("*", F.spark_partition_id().cast("long").alias("_pid"), q(key).alias("_key"))
    names = [f"c{i}" for i in range(len(df.columns))]  # plain names on the way through Arrow, whatever the headers are
    fields = [StructField(n, f.dataType) for n, f in zip(names, df.schema.fields)]
    counted = ranged.toDF(*names, "_pid", "_key").mapInArrow(
        _count_changes, StructType([*fields, StructField("_pid", LongType()), StructField("_local", LongType()), StructField("_edge", StringType())]))
    counted = materialize(counted, "rank-sorted")
    parts = counted.filter(F.col("_edge").isNotNull()).groupBy("_pid").agg(
        F.max("_local").alias("_n"), F.min_by("_edge", "_local").alias("_first"), F.max_by("_edge", "_local").alias("_last"))
    # one row per partition: the windows below see a bounded, tiny frame
    by_range = Window.orderBy("_pid")
    goes_on = F.coalesce(F.col("_first") == F.lag("_last").over(by_range), F.lit(False)).cast("long")
    new = parts.select("_pid", "_n", (F.col("_n") - goes_on).alias("_new"))
    offsets = new.select("_pid", (F.sum("_new").over(by_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_off"))
    kept = [(n, c) for n, c in zip(names, df.columns) if c.lower() != out.lower()]
    return counted.join(F.broadcast(offsets), "_pid").select(
        *[F.col(n).alias(c) for n, c in kept], (F.col("_off") + F.col("_local")).cast(id_type).alias(out))


def with_ranks(df: DataFrame, ranked_keys: list[tuple[str, str]], id_type: str = "int") -> DataFrame:
    """``df`` plus one dense-rank column per ``(key, out)``; null keys rank first.

    A rank table holds one row per distinct key, computed from ``df`` written
    once, and is joined back null-safe: Spark broadcasts a small one (its size
    is known from the written files) and sort-merge joins a large one, with AQE
    splitting a skewed key.  A column already named ``out`` (without case) is
    replaced, as ``withColumn`` would.
    """
    return _join_ranks(materialize(df, "rank-input"), ranked_keys, id_type)


def _join_ranks(df: DataFrame, ranked_keys: list[tuple[str, str]], id_type: str = "int") -> DataFrame:
    """:func:`with_ranks` for a frame that is cheap to read twice."""
    ranked_keys = [(resolve(df, k), out) for k, out in ranked_keys]
    outs = {out.lower() for _, out in ranked_keys}
    joined = df
    rank_cols = []
    for i, (key, out) in enumerate(ranked_keys):
        t = key_ranks(df, key, f"_rank{i}", id_type).withColumnRenamed("_k", f"_k{i}")
        joined = joined.join(t, df[f"`{key}`"].eqNullSafe(t[f"_k{i}"]), "left")
        rank_cols.append(t[f"_rank{i}"].alias(out))
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in outs]
    return joined.select(*kept, *rank_cols)


def dense_rank_global(df: DataFrame, key: str, out: str = "dense_rank") -> DataFrame:
    """``df`` plus ``out`` = ``dense_rank() over (order by key)`` as INT (null key ranks first).

    Like ``withColumn``, a column already named ``out`` (without case) is replaced.
    """
    return with_ranks(df, [(key, out)])


def surrogate_ids(df: DataFrame, order: str = "review", tie_break: list[str] | None = None,
                  collapse_copies: bool | None = None, id_type: str = "bigint") -> DataFrame:
    """WIN-1/WIN-2: ``user_id`` = global row number by ``order``; ``product_id`` = user_id % 1000."""
    numbered = row_number_global(df, [order], tie_break=tie_break, out="user_id", collapse_copies=collapse_copies,
                                 id_type=id_type)
    return numbered.withColumn("product_id", (F.col("user_id") % SURROGATE_PRODUCT_MODULUS).cast("int"))


def dense_rank_ids(df: DataFrame, review_col: str, product_col: str) -> DataFrame:
    """WIN-3: ``user_id`` = dense rank of the review text, ``product_id`` = dense rank of the product.

    The review text is nearly different on every row, so it is ranked by sorting
    the rows; a product stands on many rows, so its few values are ranked and joined.
    """
    review, product = resolve(df, review_col), resolve(df, product_col)
    by_sort = df.schema[review].dataType == StringType() and not {review.lower(), product.lower()} & {"user_id", "product_id"}
    if not by_sort:
        return with_ranks(df, [(review, "user_id"), (product, "product_id")])
    return _join_ranks(rank_by_sort(df, review, "user_id"), [(product, "product_id")])
