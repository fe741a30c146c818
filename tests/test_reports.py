"""Report operators on hand-made frames: rounding, ties, shares, labels."""

from pyspark.sql import functions as F

from opinio.operators import reports


def test_percentage_rounds_half_up_on_exact_ratio(spark):
    # 1 of 800 is 0.125 %: half up gives 0.13; 1 of 3 is 33.333.. %: 33.33
    rows = [("a",)] + [("b",)] * 799
    got = {r.sentiment: r.percentage for r in reports.sentiment_distribution(
        spark.createDataFrame(rows, "sentiment string")).collect()}
    assert got == {"a": 0.13, "b": 99.88}
    got3 = {r.rating: r.percentage for r in reports.rating_distribution(
        spark.createDataFrame([(1,), (2,), (3,)], "rating int")).collect()}
    assert got3 == {1: 33.33, 2: 33.33, 3: 33.33}


def test_top_products_ties_broken_by_id(spark):
    rows = [(p, 5) for p in (9, 3, 7) for _ in range(2)] + [(1, 1)]
    got = [r.product_id for r in reports.top_products(spark.createDataFrame(rows, "product_id int, rating int"), 3).collect()]
    assert got == [3, 7, 9]


def test_sentiment_top_products_uses_top_n(spark):
    reviews = spark.createDataFrame([(1, 5)] * 3 + [(2, 1)] * 2 + [(3, 3)], "product_id int, rating int")
    sent = reviews.withColumn("sentiment", F.when(F.col("rating") >= 4, "Positive").otherwise("Negative"))
    got = sorted(map(tuple, reports.sentiment_top_products(sent, reviews, 2).collect()))
    assert got == [(1, "Positive", 3), (2, "Negative", 2)]
    same = sorted(map(tuple, reports.sentiment_top_products(sent, n=2).collect()))
    assert same == got


def test_labelled_counts_unknown(spark):
    df = spark.createDataFrame([("Positive",), ("",), (None,)], "sentiment string")
    got = {r.sentiment: r["count"] for r in reports.sentiment_counts_labelled(df).collect()}
    assert got == {"Positive": 1, "Unknown": 2}


def test_rmse_and_top_n(spark):
    p = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "rating double, prediction double")
    assert abs(reports.rmse(p).first()["rmse"] - (0.5 ** 0.5)) < 1e-12
    flat = spark.createDataFrame([(1, i, float(i)) for i in range(10)] + [(2, 0, 1.0)],
                                 "user_id int, product_id int, predicted_rating double")
    top = reports.top_n_per_group(flat, "user_id", "predicted_rating", "product_id", 3).collect()
    assert sorted((r.user_id, r.product_id) for r in top) == [(1, 7), (1, 8), (1, 9), (2, 0)]
