"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.session import scratch_dir

# A word is a run of characters other than space and U+0009..U+000D.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so Python tasks import it by name there."""
    sc = spark.sparkContext
    if getattr(sc, "_opinio_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="opinio-pkg-"), "opinio.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("opinio", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._opinio_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs restart from there, not from the input."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores in front until no column of ``df`` has that name (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A 64-bit hash of the whole row; equal only for equal rows (but for collisions).

    Map columns cannot be hashed by Spark and enter as their entries.
    """
    parts = [F.map_entries(quoted(n)) if kind.startswith("map<") else quoted(n) for n, kind in df.dtypes]
    return F.xxhash64(F.lit(seed), *parts)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased (bytes.lower and bytes.split know ASCII only)."""
    return text.encode("utf-8").lower().split() if text else []


def texts_of(column: pa.Array):
    """Python strings (None for null) of an Arrow string column, one at a time."""
    for x in column:
        yield x.as_py()
