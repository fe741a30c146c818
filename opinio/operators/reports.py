"""Aggregate reports, top-k and the semi-join (AGG-4..15, AGG-17/18, TOP-1..7, JOIN-1, WIN-4).

Group-by aggregates plan as partial + final hash aggregates (map-side combine,
so a hot key is folded before the shuffle).  ``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject (per-partition top-k, then a merge of k rows per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Report sizes.
TOP_PRODUCTS = 10
TOP_USERS = 10
TOP_PRODUCTS_FOR_SENTIMENT = 5
TOP_RECOMMENDED = 10
PREVIEW_ROWS = 5
UNKNOWN_LABEL = "Unknown"


def percent_expr(count: str, total: str) -> Column:
    """``round(count * 100 / total, 2)`` with half-up rounding on the exact ratio, as DOUBLE.

    Integer division, so the result does not depend on decimal precision or
    summation order: (20000 * count + total) div (2 * total), in hundredths.
    """
    return F.expr(f"CAST((20000 * `{count}` + `{total}`) DIV (2 * `{total}`) AS DOUBLE) / 100")


def with_share(grouped: DataFrame, count: str = "count", out: str = "percentage") -> DataFrame:
    """WIN-4: share of the grand total over already-grouped rows.

    ``sum(count) over ()`` runs in one task, but over the grouped rows only
    (one row per label or rating value), never over the input rows.
    """
    with_total = grouped.withColumn("_total", F.sum(count).over(Window.partitionBy()))
    return with_total.withColumn(out, percent_expr(count, "_total")).drop("_total")


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


# --- SQL report pack (JOB-6) -------------------------------------------------

def sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    """AGG-11 (Query 1): sentiment, count, percentage; largest first."""
    return with_share(_counts(sentiment, "sentiment")).orderBy(F.desc("count"), "sentiment")


def rating_stats_by_sentiment(sentiment: DataFrame) -> DataFrame:
    """AGG-12 (Query 2): rounded mean, min, max and count of ratings per sentiment."""
    return (
        sentiment.groupBy("sentiment")
        .agg(
            F.round(F.avg("rating"), 2).alias("avg_rating"),
            F.min("rating").alias("min_rating"),
            F.max("rating").alias("max_rating"),
            F.count(F.lit(1)).alias("review_count"),
        )
        .orderBy(F.desc("avg_rating"), "sentiment")
    )


def _most_reviewed(reviews: DataFrame, key: str, n: int) -> DataFrame:
    return (
        reviews.groupBy(key)
        .agg(F.count(F.lit(1)).alias("review_count"), F.round(F.avg("rating"), 2).alias("avg_rating"))
        .orderBy(F.desc("review_count"), F.asc(key))
        .limit(n)
    )


def top_products(reviews: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """TOP-1 (Query 3): most reviewed products with their mean rating; ties by product id."""
    return _most_reviewed(reviews, "product_id", n)


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """AGG-13 (Query 4): rating, count, percentage; highest rating first."""
    return with_share(_counts(reviews, "rating")).orderBy(F.desc("rating"))


def top_users(reviews: DataFrame, n: int = TOP_USERS) -> DataFrame:
    """TOP-2 (Query 5): users with the most reviews; ties by user id."""
    return _most_reviewed(reviews, "user_id", n)


def top_product_ids(reviews: DataFrame, n: int = TOP_PRODUCTS_FOR_SENTIMENT) -> DataFrame:
    """TOP-3: ids of the ``n`` most reviewed products (ties by id)."""
    return _counts(reviews, "product_id").orderBy(F.desc("count"), "product_id").limit(n).select("product_id")


def sentiment_top_products(sentiment: DataFrame, reviews: DataFrame | None = None,
                           n: int = TOP_PRODUCTS_FOR_SENTIMENT) -> DataFrame:
    """AGG-14 / JOIN-1 (Query 6): sentiment counts of the ``n`` most reviewed products, one lazy plan.

    The table is grouped by (product, sentiment) first.  The ``n`` products
    come from that small result if ``reviews`` is None (a labelled table has the
    rows of the cleaned one), else from ``reviews``; they are broadcast (``n``
    rows) into a left semi join.
    """
    counts = _counts(sentiment, "product_id", "sentiment")
    if reviews is None:
        totals = counts.groupBy("product_id").agg(F.sum("count").alias("count"))
        top = totals.orderBy(F.desc("count"), "product_id").limit(n).select("product_id")
    else:
        top = top_product_ids(reviews, n)
    return counts.join(F.broadcast(top), "product_id", "left_semi").orderBy("product_id", F.desc("count"), "sentiment")


# --- further aggregates ----------------------------------------------------------

def distinct_counts(triples: DataFrame, user: str = "user_id", item: str = "product_id") -> DataFrame:
    """AGG-4: exact distinct users and products in one aggregate."""
    return triples.agg(
        F.count_distinct(user).alias("distinct_users"), F.count_distinct(item).alias("distinct_products")
    )


def approx_distinct_counts(triples: DataFrame, user: str = "user_id", item: str = "product_id",
                           rsd: float = 0.01) -> DataFrame:
    """AGG-4, sketch option: HyperLogLog++ counts, mergeable and without a distinct shuffle."""
    return triples.agg(
        F.approx_count_distinct(user, rsd).alias("distinct_users"),
        F.approx_count_distinct(item, rsd).alias("distinct_products"),
    )


def rating_counts(reviews: DataFrame) -> DataFrame:
    """AGG-5: rows per rating, ascending."""
    return _counts(reviews, "rating").orderBy("rating")


def sentiment_counts(sentiment: DataFrame) -> DataFrame:
    """AGG-6: rows per sentiment, largest first."""
    return _counts(sentiment, "sentiment").orderBy(F.desc("count"), "sentiment")


def sentiment_counts_labelled(docs: DataFrame) -> DataFrame:
    """AGG-7: rows per sentiment with a missing or empty label shown as 'Unknown'."""
    label = F.coalesce(F.nullif(F.col("sentiment"), F.lit("")), F.lit(UNKNOWN_LABEL)).alias("sentiment")
    return docs.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def sentiment_by_rating(sentiment: DataFrame) -> DataFrame:
    """AGG-8: rows per (rating, sentiment)."""
    return _counts(sentiment, "rating", "sentiment").orderBy("rating", "sentiment")


def confidence_by_sentiment(sentiment: DataFrame, digits: int = 6) -> DataFrame:
    """AGG-9: mean confidence per sentiment (rounded, summation order aside)."""
    return sentiment.groupBy("sentiment").agg(F.round(F.avg("confidence"), digits).alias("avg_confidence"))


def avg_rating_by_sentiment(sentiment: DataFrame, rating: str = "Rating") -> DataFrame:
    """AGG-10: mean rating per sentiment, two decimals, highest first."""
    return (
        sentiment.groupBy("sentiment")
        .agg(F.round(F.avg(rating), 2).alias("Avg_Rating"))
        .orderBy(F.desc("Avg_Rating"), "sentiment")
    )


def avg_predicted_by_user(recs: DataFrame) -> DataFrame:
    """AGG-15: mean predicted rating per user."""
    return recs.groupBy("user_id").agg(F.avg("predicted_rating").alias("avg_predicted_rating"))


def top_recommended(recs: DataFrame, n: int = TOP_RECOMMENDED) -> DataFrame:
    """TOP-4: products that appear in the most recommendation lists."""
    return _counts(recs, "product_id").orderBy(F.desc("count"), "product_id").limit(n)


def recommendation_stats(recs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ML-7: (mean predicted rating per user, most recommended products)."""
    return avg_predicted_by_user(recs), top_recommended(recs)


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """AGG-18: root mean squared error as a one-row frame (no driver round trip)."""
    err = F.col(label) - F.col(prediction)
    return predictions.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def table_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """AGG-17: ``table_name, records`` for each named frame (one count job per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview_rows(df: DataFrame, order: list[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """TOP-6: the first ``n`` rows in a stated order (a deterministic ``take``)."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group: str, score: str, tie: str, n: int) -> DataFrame:
    """TOP-7 on a flat score table: the ``n`` best rows per group (score desc, tie asc).

    ``row_number() <= n`` lets Spark insert a partial window group limit
    before the shuffle, so a hot group ships at most ``n`` rows per map task.
    """
    w = Window.partitionBy(group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
