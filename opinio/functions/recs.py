"""Recommendation-list expressions (PRJ-6, SCL-13..16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

# Defaults shown for missing fields, and the preview sizes.
MISSING_ID_TEXT = "N/A"
MISSING_LIST_TEXT = "[]"
PREVIEW_ENTRIES = 3

ITEM_LIST_TYPE = ArrayType(
    StructType([StructField("product_id", IntegerType()), StructField("rating", FloatType())])
)


def list_to_json(c: Column) -> Column:
    """Array of structs as JSON text, e.g. ``[{"product_id":1,"rating":4.5}]``."""
    return F.to_json(c)


def json_head(text: Column, n: int = PREVIEW_ENTRIES, schema: ArrayType = ITEM_LIST_TYPE) -> Column:
    """First ``n`` entries of a JSON list as JSON text; text that is no such list is returned whole.

    A missing list reads as ``'[]'``.
    """
    t = F.coalesce(text, F.lit(MISSING_LIST_TEXT))
    parsed = F.from_json(t, schema)
    return F.coalesce(F.to_json(F.slice(parsed, 1, n)), t)
