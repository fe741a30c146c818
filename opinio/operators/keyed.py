"""Keyed (wide-column) tables maintained from a mutation log (KV-1..5, SRC-7).

Log schema: ``seq`` (unique, increasing), ``op`` in {put, delete_column,
delete_row}, ``row_key``, ``family``, ``qualifier``, ``value``.

State rule: a cell is live when its newest put is newer than every
delete_column of that cell and every delete_row of its row.  A row without
live cells does not exist.

Plan: one aggregate per cell (newest op by ``seq``; partial aggregation folds a
hot cell before the shuffle), one aggregate per row for row deletes, and one
join of the two on ``row_key``.  The join side sizes are data-dependent, so the
strategy (broadcast or sort-merge, with skew splitting) is left to AQE, which
decides on measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Operation names of the log.
PUT, DELETE_COLUMN, DELETE_ROW = "put", "delete_column", "delete_row"
CELL_KEY = ("row_key", "family", "qualifier")


def latest_cells(log: DataFrame) -> DataFrame:
    """KV-1: newest put per cell (value and its ``seq``), ignoring deletes."""
    return (
        log.filter(F.col("op") == PUT)
        .groupBy(*CELL_KEY)
        .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"))
    )


def apply_log(log: DataFrame) -> DataFrame:
    """KV-3..5: current state ``row_key, family, qualifier, value`` after all mutations."""
    newest = (
        log.filter(F.col("op") != DELETE_ROW)
        .groupBy(*CELL_KEY)
        .agg(F.max_by(F.struct("seq", "op", "value"), "seq").alias("last"))
    )
    row_deletes = (
        log.filter(F.col("op") == DELETE_ROW).groupBy("row_key").agg(F.max("seq").alias("deleted_at"))
    )
    joined = newest.join(row_deletes, "row_key", "left")
    live = (F.col("last.op") == PUT) & (F.col("deleted_at").isNull() | (F.col("last.seq") > F.col("deleted_at")))
    return joined.filter(live).select(*CELL_KEY, F.col("last.value").alias("value"))


def get_row(state: DataFrame, row_key: str) -> DataFrame:
    """KV-2: the cells of one row, long form (pushed down as an equality filter)."""
    return state.filter(F.col("row_key") == row_key).select("family", "qualifier", "value")


def get_row_map(state: DataFrame, row_key: str) -> DataFrame:
    """KV-2, row view: ``row_key, cells`` with ``cells`` a map ``'family:qualifier' -> value``.

    One output row holding the cells of the requested row, which is what a
    single-row read returns.  For bulk access use the long form
    (:func:`get_row`, :func:`scan`): a map per row would gather a wide row
    into one task.
    """
    one = state.filter(F.col("row_key") == row_key)
    entry = F.struct(F.concat_ws(":", "family", "qualifier").alias("k"), F.col("value").alias("v"))
    return one.groupBy("row_key").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cells"))


def scan(state: DataFrame) -> DataFrame:
    """SRC-7: every live cell in row-key order."""
    return state.orderBy(*CELL_KEY)
