"""Document collections as table folders (SNK-4, SNK-5, SRC-6, FLT-6, FLT-7).

A collection is a folder of Parquet files written by the executors, sorted by
its lookup key so that an equality reads the row groups whose range holds the
value.  Replacing a collection is an overwrite with all rows (SNK-5's bounded
form worked around a driver-side copy and is not needed).  A document-store
connector takes another ``fmt`` and its ``options``.  Each document carries a
stable ``_id``: SHA-256 of its field values, so the same record always gets the
same id and different records get different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinio.operators.clean import q

# The id field, the null marker inside the hashed text and the preview size.
ID_FIELD = "_id"
NULL_MARKER = "N"
PREVIEW_DOCUMENTS = 3


def record_id(columns: list[str]) -> Column:
    """SHA-256 (hex) of the record's fields as text, in column order, each with its length in front.

    The lengths keep the fields apart whatever they hold; a null field is the bare marker.
    """
    texts = [q(c).cast("string") for c in columns]
    # null if the text is null; outside a condition, so Spark makes each text once
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARKER)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def with_record_id(df: DataFrame, copies: bool = False) -> DataFrame:
    """``_id`` + the record's fields.

    With ``copies=True`` identical records get distinct ids: each copy's
    ordinal (from :func:`opinio.operators.rank.spread_copies`, which folds
    the copies map-side and spreads a hot record over tasks) is hashed with
    the fields.  Without it, identical records share an id, which is right
    when the input is de-duplicated (as every writer here does).
    """
    if not copies:
        return df.select(record_id(df.columns).alias(ID_FIELD), "*")
    from opinio.operators.rank import spread_copies

    spread = spread_copies(df)
    return spread.select(record_id([*df.columns, "_copy"]).alias(ID_FIELD), *[q(c) for c in df.columns])


def write_collection(df: DataFrame, path: str, fmt: str = "parquet", key: str | None = None,
                     options: dict[str, str] | None = None) -> None:
    """SNK-4 / SNK-5: replace the collection at ``path`` with all of ``df`` (executors write, no collect).

    ``key``: the field that lookups use; the files are range-partitioned and sorted by it.
    ``options`` go to the writer as they are.
    """
    if key is not None:
        df = df.repartitionByRange(q(key)).sortWithinPartitions(q(key))
    df.write.mode("overwrite").format(fmt).options(**(options or {})).save(path)


def read_collection(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                    options: dict[str, str] | None = None) -> DataFrame:
    return spark.read.schema(schema).format(fmt).options(**(options or {})).load(path)


def preview(docs: DataFrame, fields: list[str] | None = None, key: str = ID_FIELD,
            n: int = PREVIEW_DOCUMENTS) -> DataFrame:
    """SRC-6: projected fields of the first ``n`` documents in key order."""
    out = docs.orderBy(key).limit(n)
    return out.select(*fields) if fields else out


def find_equal(docs: DataFrame, field: str, value) -> DataFrame:
    """FLT-6 / FLT-7: equality lookup, pushed to the scan, which skips row groups by their range of the key."""
    return docs.filter(q(field) == F.lit(value))
