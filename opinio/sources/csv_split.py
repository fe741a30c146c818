"""SRC-2 by several tasks a file: quoted fields with line breaks, read from byte ranges.

Spark reads a multi-line CSV file in one task, as only a scan from its start tells
whether a line break stands inside quotes.  That takes one bit a byte range:

1. each range of physical lines counts its quotes; their parity summed over the
   ranges before says whether a range starts inside quotes (one row a range);
2. a second pass cuts every range into records.  A record that crosses ranges comes
   in one piece a range, labelled with the range where it began;
3. the pieces are joined, and ``from_csv`` parses every record's text.

Only the pieces are shuffled.  What is broadcast has one row a range (say 128 MB of
input).  The cut records are written to the shared folder once.

Files must follow the usual rule that a field with a quote in it is quoted and its
quotes doubled (as ``files.write_csv`` does).  A file whose quotes do not pair up is
an error, not a wrong result.  Each file has a header line; empty lines are skipped;
a record may end in LF or CRLF; line breaks inside quotes stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinio.session import ship_package
from opinio.sources.files import materialize

_BLOCKS = "file string, block long, odd int, closes_out boolean, closes_in boolean"
_PIECES = pa.schema([("text", pa.string()), ("header", pa.bool_()), ("file", pa.string()), ("owner", pa.int64()), ("block", pa.int64())])


def _runs(b: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The rows of each byte range in a batch (columns value, file, block, ...), in order."""
    files = b.column(1).dictionary_encode().indices.to_numpy()
    blocks = b.column(2).to_numpy()
    cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
    for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
        if end > start:
            yield b.column(1)[int(start)].as_py(), int(blocks[start]), b.slice(int(start), int(end - start))


def _odd(values: pa.Array) -> np.ndarray:
    """Whether the quotes up to the end of each line are odd in number."""
    return np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False)) & 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[str, int], list] = {}
    for b in batches:
        for file, block, rows in _runs(b):
            odd, out, inside = seen.get((file, block), (0, False, False))
            ends = _odd(rows.column(0)) ^ odd
            seen[file, block] = [int(ends[-1]), out or bool((ends == 0).any()), inside or bool((ends == 1).any())]
    columns = list(zip(*[(f, k, *v) for (f, k), v in seen.items()])) or [[]] * 5
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()))],
        names=["file", "block", "odd", "closes_out", "closes_in"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, parts, state, leading, owner, first = None, [], 0, False, None, False
    out: list[tuple] = []

    def emit(text: str, to: int | None) -> None:
        nonlocal first
        out.append((text, first, at[0], to, at[1]))
        first = False

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 5, _PIECES)], schema=_PIECES)
        out.clear()
        return made

    def finish() -> None:
        if parts:
            emit("\n".join(parts), owner if leading else at[1])
            parts.clear()

    for b in batches:
        for file, block, rows in _runs(b):
            if at != (file, block):
                finish()
                at = (file, block)
                inside = rows.column(3)[0].as_py()
                if inside is None:
                    raise RuntimeError(f"{file}: the byte ranges changed between two reads; run again")
                state, owner, leading, first = int(inside), rows.column(4)[0].as_py(), inside, block == 0
            ends = _odd(rows.column(0)) ^ state
            for line, end in zip(rows.column(0).to_pylist(), ends.tolist()):
                if parts or leading or end:
                    parts.append(line)
                    if not end:
                        emit("\n".join(parts), owner if leading else None)
                        parts.clear()
                        leading = False
                elif line and line != "\r":
                    emit(line, None)
            state = int(ends[-1])
        yield batch()
    finish()
    yield batch()


def _blocks(lines: DataFrame) -> DataFrame:
    """``file, block, inside, owner`` of every byte range: where it starts, and where the record it starts in began."""
    counted = materialize(lines.mapInArrow(_count, _BLOCKS), "csv-blocks")
    unpaired = counted.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).filter("odd = 1").select("file").first()
    if unpaired:
        raise ValueError(f"{unpaired.file}: a quote is not closed")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1
    placed = counted.withColumn("inside", inside)
    ends_inside = placed["inside"] != (F.col("odd") == 1)
    opens = ends_inside & F.when(F.col("inside"), F.col("closes_in")).otherwise(F.lit(True))
    return placed.withColumn("opener", F.when(opens, F.col("block"))).select(
        "file", "block", "inside", F.max("opener").over(before).alias("owner"))


def read_csv_split(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC-2: the rows of header CSV files with quoted line breaks, each file read by as many tasks as it has byte ranges."""
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # one row a byte range; the hash join leaves the lines in their order
    placed = lines.join(F.broadcast(_blocks(lines)), ["file", "block"], "left").select("value", "file", "block", "inside", "owner")
    pieces = materialize(placed.mapInArrow(_cut, "text string, header boolean, file string, owner long, block long"), "csv-records")
    whole = pieces.filter(F.col("owner").isNull() & ~F.col("header")).select("text")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda piece: piece["text"])
    joined = (
        pieces.filter(F.col("owner").isNotNull()).groupBy("file", "owner")
        .agg(F.array_join(in_order, "\n").alias("text"), F.max("header").alias("header"))
        .filter(~F.col("header")).select("text")
    )
    text = F.when(F.endswith(F.col("text"), F.lit("\r")), F.col("text").substr(F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    return whole.unionByName(joined).select(F.from_csv(text, ddl, {"escape": '"', "multiLine": "true"}).alias("r")).select("r.*")
