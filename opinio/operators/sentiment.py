"""Sentiment operators (SEN-1..5, PRJ-3, JOB-2 body).

The 26 lexicon flags and the two scores are built in a single ``select`` so
the analyser sees one projection instead of 28 nested ``withColumn`` calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions import sentiment as S

SENTIMENT_COLUMNS = (
    "user_id", "product_id", "rating", "review", "review_clean",
    "sentiment", "positive_score", "negative_score", "confidence",
)


def add_label(df: DataFrame, rating: str = "rating", out: str = "sentiment") -> DataFrame:
    """SEN-1 (integer rating) and SEN-2 (``Rating_Cleaned``): same thresholds."""
    return df.withColumn(out, S.label(F.col(rating)))


def add_lexicon_flags(df: DataFrame, text: str = "review_clean") -> DataFrame:
    """SEN-3: ``has_<word>`` = 1 when the word occurs as a substring, else 0."""
    return df.select("*", *S.flag_columns(F.col(text)))


def add_lexicon_scores(df: DataFrame, text: str = "review_clean") -> DataFrame:
    """SEN-4: positive and negative score = number of distinct lexicon words present."""
    t = F.col(text)
    return df.select("*", S.positive_score(t).alias("positive_score"), S.negative_score(t).alias("negative_score"))


def add_confidence(df: DataFrame, rating: str = "rating") -> DataFrame:
    """SEN-5: confidence from rating extremity."""
    return df.withColumn("confidence", S.confidence(F.col(rating)))


def sentiment_table(cleaned: DataFrame) -> DataFrame:
    """JOB-2 / PRJ-3: label, scores and confidence in one projection."""
    r, t = F.col("rating"), F.col("review_clean")
    return cleaned.select(
        "user_id", "product_id", "rating", "review", "review_clean",
        S.label(r).alias("sentiment"),
        S.positive_score(t).alias("positive_score"),
        S.negative_score(t).alias("negative_score"),
        S.confidence(r).alias("confidence"),
    )


def universal_sentiment(df: DataFrame) -> DataFrame:
    """SEN-2: label on the parsed FLOAT rating of the universal path."""
    return add_label(df, "Rating_Cleaned")
