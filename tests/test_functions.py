"""Edge rows of FIXTURES.md B6 for the column functions and plan-time helpers."""

from pyspark.sql import functions as F

from opinio.functions import ratings, sentiment, text
from opinio.operators import clean, columns


def test_first_number_edge_cases(spark):
    rows = [("4 out of 5",), ("-3",), ("4.",), (".5x",), ("1,234",), ("1e3",), ("none",), (None,)]
    df = spark.createDataFrame(rows, "r string")
    got = [r[0] for r in df.select(ratings.rating_or_default(F.col("r"))).collect()]
    assert got == [4.0, 3.0, 4.0, 5.0, 1.0, 1.0, 3.0, 3.0]
    raw = [r[0] for r in df.select(ratings.first_number(F.col("r"))).collect()]
    assert raw[-2:] == [None, None]


def test_int_rating_truncates_then_range(spark):
    df = spark.createDataFrame([(5.9,), (0.9,), (None,), (float("nan"),), (3e9,)], "rating double")
    assert [r[0] for r in df.select(ratings.int_rating(df, "rating")).collect()] == [5, 0, None, None, None]
    kept = clean.validate_ratings(df).collect()
    assert [r.rating for r in kept] == [5]


def test_int_rating_from_strings(spark):
    df = spark.createDataFrame([("4.5",), ("abc",), ("",), ("5",)], "rating string")
    assert [r[0] for r in df.select(ratings.int_rating(df, "rating")).collect()] == [4, None, None, 5]


def test_normaliser_order_matters_for_kelvin_sign(spark):
    df = spark.createDataFrame([("K",), ("\t a",), ("  Hello, World!! ",)], "t string")
    first = [r[0] for r in df.select(text.clean_lower_first(F.col("t"))).collect()]
    last = [r[0] for r in df.select(text.clean_lower_last(F.col("t"))).collect()]
    assert first[0] == "k" and last[0] == ""
    assert first[1] == "\t a"  # trim strips only spaces
    assert first[2] == "hello world"


def test_normaliser_is_idempotent(spark):
    df = spark.sql("SELECT text AS t FROM parquet.`/root/testdata/sf0.001/documents.parquet`")
    once = df.select(text.clean_lower_first(F.col("t")).alias("a"))
    twice = once.select(F.col("a"), text.clean_lower_first(F.col("a")).alias("b"))
    assert twice.filter(F.col("a") != F.col("b")).count() == 0


def test_sentiment_thresholds(spark):
    df = spark.createDataFrame([(4.0,), (3.9,), (2.0,), (2.1,), (None,)], "r double")
    got = [x[0] for x in df.select(sentiment.label(F.col("r"))).collect()]
    assert got == ["Positive", "Neutral", "Negative", "Neutral", "Neutral"]


def test_lexicon_is_substring_presence(spark):
    df = spark.createDataFrame([("my glove is goodish not bad",), ("bad bad bad",)], "review_clean string")
    got = df.select(sentiment.positive_score(F.col("review_clean")).alias("p"),
                    sentiment.negative_score(F.col("review_clean")).alias("n")).collect()
    assert (got[0].p, got[0].n) == (2, 1)
    assert (got[1].p, got[1].n) == (0, 1)


def test_confidence_values(spark):
    df = spark.createDataFrame([(5,), (4,), (3,), (2,), (1,), (0,), (None,)], "rating int")
    got = [r[0] for r in df.select(sentiment.confidence(F.col("rating"))).collect()]
    assert got == [0.95, 0.75, 0.5, 0.75, 0.95, 0.5, 0.5]


def test_detect_columns():
    assert columns.detect_columns(["id", " Text ", "Stars"]) == (" Text ", "Stars", "id")
    assert columns.detect_columns(["brand", "review", "product"])[2] == "product"
    # no keyword at all: first / last / first
    assert columns.detect_columns(["a", "b", "c"]) == ("a", "c", "a")
    # the product keyword may not pick the review column, the fallback may
    assert columns.detect_columns(["title", "x"]) == ("title", "x", "title")


def test_missing_counts_single_pass(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, 1.0, None)], "a int, b double, c string")
    got = {r.column_name: r.missing_count for r in clean.missing_counts(df).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}


def test_recommended_conf_scales_with_input():
    from opinio.session import recommended_conf

    small = recommended_conf(10 << 20, 8)
    big = recommended_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
