"""Rating parsing and guarded casts (SCL-7, SCL-8, FLT-8).

Spark runs with ANSI mode on: a plain cast of a dirty string raises.  The
reference relies on dirty values turning into null, so every cast of input
data here is a ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

# The first-number pattern and the fill value of the universal path.
FIRST_NUMBER_PATTERN = r"(\d+\.?\d*)"
DEFAULT_RATING = 3.0


def first_number(c: Column) -> Column:
    """First ``\\d+\\.?\\d*`` in the text of ``c`` as FLOAT, null when there is none.

    The sign, thousands separators and exponents are not part of the match:
    ``'-3'`` gives 3, ``'1,234'`` gives 1, ``'1e3'`` gives 1.
    """
    return F.regexp_extract(c.cast("string"), FIRST_NUMBER_PATTERN, 1).try_cast("float")


def rating_or_default(c: Column) -> Column:
    """:func:`first_number`, with null or NaN replaced by 3.0 (FLOAT)."""
    # nanvl/coalesce read the parsed value once (a when-chain would parse it up to three times)
    return F.coalesce(F.nanvl(first_number(c), F.lit(None).cast("float")), F.lit(DEFAULT_RATING).cast("float"))


def to_int_truncating(c: Column, source_type: DataType) -> Column:
    """Integer view of a rating with truncation and null for anything unparsable.

    Numbers truncate toward zero (5.9 -> 5); NaN and out-of-range values are
    null.  Strings go through a decimal first so ``'4.5'`` truncates to 4
    instead of failing.
    """
    if isinstance(source_type, StringType):
        return c.try_cast("decimal(38,18)").try_cast("int")
    if isinstance(source_type, NumericType):
        return c.try_cast("int")
    return c.try_cast("string").try_cast("decimal(38,18)").try_cast("int")


def int_rating(df: DataFrame, name: str) -> Column:
    return to_int_truncating(F.col(name), df.schema[name].dataType)
