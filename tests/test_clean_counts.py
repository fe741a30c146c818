"""The cleaner that counts while it writes equals the cleaner and the separate statistics, from one read."""

import pytest
from pyspark.sql import functions as F

from opinio.operators import clean
from opinio.plans import queries
from tests.conftest import SF_SMALL

SCHEMA = "product_name string, rating string, review string"


def _same(got, want):
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _check(df, **limits):
    out = clean.clean_with_counts(df, **limits)
    _same(out.cleaned, clean.clean_reviews(df, **limits))
    _same(out.funnel, clean.cleaning_funnel(df, **limits))
    _same(out.duplicates, clean.duplicate_stats(df))
    _same(out.missing, clean.missing_counts(df))
    return out


def _rows(spark):
    rows = [("a", "5", "A fine product!"), ("a", "5", "A fine product!"), ("a", "5.0", "A fine product!"), ("b", None, "no rating here"),
            ("b", "x", "text rating here"), ("c", "9", "too high a rating"), ("c", "1", "bad"), (None, "2", None), ("d", "3", "x" * 6000),
            ("d", "4", ""), (None, None, None), (None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_equals_the_separate_steps(spark):
    out = _check(_rows(spark))
    assert out.duplicates.first().asDict() == {"rows_before": 12, "rows_after": 10, "duplicates_removed": 2}
    assert {r.column_name: r.missing_count for r in out.missing.collect()} == {"product_name": 3, "rating": 3, "review": 3}
    _check(_rows(spark), min_chars=None, max_chars=None)
    _check(_rows(spark), min_chars=3, max_chars=100)


def test_equals_the_separate_steps_on_the_fixture(spark):
    _check(queries.raw(spark, SF_SMALL))


def test_hot_row(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("product_name"),
                                     F.lit("4").alias("rating"), F.lit("one text for all").alias("review"))
    out = _check(hot)
    assert out.duplicates.first().duplicates_removed == 9_999


def test_input_is_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = _rows(spark).mapInArrow(count, SCHEMA)
    out = clean.clean_with_counts(df)
    for frame in (out.cleaned, out.funnel, out.duplicates, out.missing):
        frame.collect()
    assert read.value == 12


def test_empty_and_reserved_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = clean.clean_with_counts(empty)
    assert out.cleaned.count() == 0 and out.missing.count() == 0
    assert [r.records for r in out.funnel.orderBy("step_no").collect()] == [0] * 6
    assert out.duplicates.first().asDict() == {"rows_before": 0, "rows_after": 0, "duplicates_removed": 0}
    with pytest.raises(ValueError):
        clean.clean_with_counts(_rows(spark).withColumn("_N", F.lit(1)))


def test_totals_follow_the_limits(spark):
    df = _rows(spark)
    for limits in ({}, {"min_chars": None, "max_chars": None}, {"min_chars": 3, "max_chars": 14}):
        totals = {r.table_name: r.records for r in clean.stage_totals(df, **limits).collect()}
        assert totals["cleaned_reviews"] == clean.clean_reviews(df, **limits).count()
