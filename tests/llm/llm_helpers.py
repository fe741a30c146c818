"""Odd tables for the tests of the operators."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])

# Null and empty texts, blanks, a very long text, repeated rows, null ids and sources.
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", "b", 3),
    (5, "one two", "en", "b", 7), (5, "one two", "en", "b", 7), (None, "one two", "en", "b", 7), (None, None, None, None, None),
    (6, "Straße ÉTÉ  x y \x1c z <|endoftext|> 12345 'll", "de", None, 1), (7, "word " * 30000, "en", "c", 150000), (8, "x" * 20000, "en", "c", 20000),
]


def clashing(df):
    """The same rows with extra columns whose names the operators use inside."""
    names = ["id", "row_tag", "times", "fp", "tag", "size", "n", "draw", "whole_text", "row", "key", "block"]
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)], F.create_map(F.lit("a"), F.lit(1)).alias("range"))


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=repr)
