"""Sentiment column expressions (SEN-1..5)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lexicon word lists (in their original order), label names and
# rating thresholds, and the confidence for each integer rating.
POSITIVE_WORDS = (
    "good", "great", "excellent", "amazing", "awesome", "love", "perfect",
    "wonderful", "fantastic", "best", "brilliant", "outstanding", "superb",
)
NEGATIVE_WORDS = (
    "bad", "terrible", "awful", "horrible", "hate", "worst", "poor",
    "disappointing", "useless", "waste", "broken", "defective", "cheap",
)
POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"
POSITIVE_AT_LEAST = 4
NEGATIVE_AT_MOST = 2
CONFIDENCE_BY_RATING = {5: 0.95, 4: 0.75, 3: 0.50, 2: 0.75, 1: 0.95}
CONFIDENCE_OTHERWISE = 0.50


def label(rating: Column) -> Column:
    """>= 4 Positive, <= 2 Negative, anything else (null included) Neutral."""
    return (
        F.when(rating >= POSITIVE_AT_LEAST, F.lit(POSITIVE))
        .when(rating <= NEGATIVE_AT_MOST, F.lit(NEGATIVE))
        .otherwise(F.lit(NEUTRAL))
    )


def word_flag(text: Column, word: str) -> Column:
    """1 when ``word`` occurs anywhere in ``text`` (substring, so 'glove' hits 'love')."""
    return F.when(text.contains(word), F.lit(1)).otherwise(F.lit(0))


def flag_columns(text: Column) -> list[Column]:
    """The 26 ``has_<word>`` columns, positive words first."""
    return [word_flag(text, w).alias(f"has_{w}") for w in POSITIVE_WORDS + NEGATIVE_WORDS]


def score(text: Column, words: tuple[str, ...]) -> Column:
    """Row-wise sum of the word flags: each word counts at most once."""
    return reduce(add, [word_flag(text, w) for w in words])


def positive_score(text: Column) -> Column:
    return score(text, POSITIVE_WORDS)


def negative_score(text: Column) -> Column:
    return score(text, NEGATIVE_WORDS)


def confidence(rating: Column) -> Column:
    expr = None
    for r, v in CONFIDENCE_BY_RATING.items():
        expr = (F.when(rating == r, F.lit(v)) if expr is None else expr.when(rating == r, F.lit(v)))
    return expr.otherwise(F.lit(CONFIDENCE_OTHERWISE))
