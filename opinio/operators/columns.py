"""PRJ-1: find the review, rating and product columns of an arbitrary header.

This is a plan-time choice over ``df.columns`` (no data is read); the result
feeds a plain ``select``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from opinio.operators.clean import q

# Header keywords in priority order.
REVIEW_KEYWORDS = ("review_text", "text", "body", "review_body", "comment", "desc", "review")
RATING_KEYWORDS = ("review_rating", "rating", "stars", "score", "points")
PRODUCT_KEYWORDS = ("product_name", "product_title", "product", "item", "asin", "title", "brand", "product_id")


def detect_columns(columns: list[str]) -> tuple[str, str, str]:
    """``(review, rating, product)`` original column names.

    Headers are compared after strip + lowercase; the first keyword present
    wins (keyword priority, not header order).  Fallbacks: review = first
    column, rating = last column, product = first column.  A keyword hit for
    the product may not be the review column; the fallback may be.
    """
    normal = [c.strip().lower() for c in columns]

    def first_hit(keywords, default, exclude=None):
        for kw in keywords:
            if kw in normal:
                found = columns[normal.index(kw)]
                if exclude is None or found != exclude:
                    return found
        return default

    review = first_hit(REVIEW_KEYWORDS, columns[0])
    rating = first_hit(RATING_KEYWORDS, columns[-1])
    product = first_hit(PRODUCT_KEYWORDS, columns[0], exclude=review)
    return review, rating, product


def detected_projection(df: DataFrame) -> DataFrame:
    """The three detected columns under canonical names."""
    review, rating, product = detect_columns(df.columns)
    return df.select(
        q(review).alias("detected_review"),
        q(rating).alias("detected_rating"),
        q(product).alias("detected_product"),
    )
