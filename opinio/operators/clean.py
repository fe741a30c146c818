"""Cleaning operators (AGG-1..3, AGG-16, FLT-1..5, FLT-8, SCL-4/5, PRJ-2/5).

All row filters are plain ``filter`` calls on built-in expressions, so Catalyst
fuses them into one codegen stage after the de-duplication shuffle.  Counting
is done in one aggregation pass instead of an action per step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from opinio.functions import ratings, text
from opinio.sources.files import materialize

# Length limits of the batch cleaner.
MIN_CLEAN_LENGTH = 5
MAX_CLEAN_LENGTH = 5000
RATING_MIN, RATING_MAX = 1, 5
FINAL_COLUMNS = ("user_id", "product_id", "rating", "review", "review_clean")


def q(name: str) -> Column:
    """Column by exact name, safe for dots and spaces in headers."""
    return F.col("`" + name.replace("`", "``") + "`")


def resolve(df: DataFrame, name: str) -> str:
    """The frame's own spelling of ``name`` (exact match first, then without case, as Spark resolves)."""
    if name in df.columns:
        return name
    hits = [c for c in df.columns if c.lower() == name.lower()]
    if len(hits) != 1:
        raise ValueError(f"column {name!r} not found (or ambiguous) in {df.columns}")
    return hits[0]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns (what ``dropna`` drops)."""
    c = q(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def computed_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df`` plus column ``name`` = ``expr``, evaluated exactly once per row.

    A filter on a computed column is normally pushed below the projection
    that defines it, with the expression copied into the filter: a regex
    over the review text then runs once per filter and once more for the
    output.  Producing the value through a one-element ``explode`` (a
    Generate node, which predicates cannot cross) pins it: later filters and
    projections read the generated column.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


# --- AGG-1 / AGG-2 -----------------------------------------------------------

def remove_duplicates(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def duplicate_stats(df: DataFrame) -> DataFrame:
    """``rows_before, rows_after, duplicates_removed`` in one pass over the data."""
    groups = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicates_removed"),
    )


# --- AGG-3 / FLT-1 / FLT-2 ----------------------------------------------------

def missing_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """``column_name, missing_count`` (nulls only) for every column, from one aggregate.

    Like the reference's report, columns without missing values are left out
    unless ``only_positive`` is False.
    """
    wide = df.agg(*[F.count_if(q(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    long = _missing_rows(wide, df.columns)
    return long.filter(F.col("missing_count") > 0) if only_positive else long


def _missing_rows(wide: DataFrame, columns: list[str]) -> DataFrame:
    pairs = [x for i, c in enumerate(columns) for x in (F.lit(c), F.col(f"c{i}"))]
    return wide.select(F.stack(F.lit(len(columns)), *pairs).alias("column_name", "missing_count"))


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows with null (or NaN) in any of ``subset`` (default: all columns) dropped."""
    return df.dropna(subset=subset)


# --- SCL-4 / FLT-3 / FLT-4 / FLT-5 --------------------------------------------

def add_clean_text(df: DataFrame, source: str = "review", target: str = "review_clean") -> DataFrame:
    """Lower-first normalised text in ``target`` (replacing a column of that name)."""
    base = df.drop(target) if target in df.columns else df
    return computed_once(base, target, text.clean_lower_first(q(source)))


def min_length(df: DataFrame, column: str = "review_clean", n: int | None = MIN_CLEAN_LENGTH) -> DataFrame:
    """Texts of at least ``n`` characters; None keeps all."""
    return df if n is None else df.filter(F.length(q(column)) >= n)


def clean_text(df: DataFrame, source: str = "review", target: str = "review_clean",
               n: int | None = MIN_CLEAN_LENGTH) -> DataFrame:
    """Lower-first normaliser, then drop texts shorter than ``n`` (five) characters."""
    return min_length(add_clean_text(df, source, target), target, n)


def validate_ratings(df: DataFrame, column: str = "rating") -> DataFrame:
    """Rating truncated to INT (unparsable -> null), kept when in 1..5."""
    return df.withColumn(column, ratings.int_rating(df, column)).filter(
        F.col(column).between(RATING_MIN, RATING_MAX)
    )


def remove_outliers(df: DataFrame, column: str = "review_clean",
                    max_length: int | None = MAX_CLEAN_LENGTH) -> DataFrame:
    """Texts of at most ``max_length`` characters; None keeps all."""
    return df if max_length is None else df.filter(F.length(q(column)) <= max_length)


def select_final_columns(df: DataFrame, distinct_rows: bool = False, id_type: str = "bigint") -> DataFrame:
    """Final review columns; surrogate ids when the input has no user/product ids.

    ``distinct_rows`` tells the id generator that no two input rows are
    identical (true inside :func:`clean_reviews`, which de-duplicates and
    keeps the original rating alongside the truncated one), so identical rows
    need not be folded first, which saves a shuffle of the whole table.
    """
    if "user_id" in df.columns and "product_id" in df.columns:
        return df.select(*[q(c) for c in FINAL_COLUMNS])
    from opinio.operators.rank import surrogate_ids

    # Both ids are regenerated when either is missing (an existing one is
    # replaced, matching names without case as withColumn does).  Order by
    # review; ties broken by the output columns first and then by every other
    # column, so the order is total on de-duplicated input and a frequent
    # review text can still be split across range partitions.
    dropped = [c for c in df.columns if c.lower() in ("user_id", "product_id")]
    df = df.drop(*dropped)
    rest = [c for c in df.columns if c not in ("review", "rating", "review_clean")]
    collapse = None if not (distinct_rows and not dropped) else False
    return surrogate_ids(df, tie_break=["rating", "review_clean", *rest],
                         collapse_copies=collapse, id_type=id_type).select(*FINAL_COLUMNS)


def clean_reviews(df: DataFrame, min_chars: int | None = MIN_CLEAN_LENGTH, max_chars: int | None = MAX_CLEAN_LENGTH,
                  id_type: str = "bigint") -> DataFrame:
    """JOB-1: the batch cleaner as one lazy plan (de-duplicate, then row filters).

    ``min_chars`` and ``max_chars`` are the two length filters of the batch
    cleaner; None turns one off (:func:`cleaning_funnel` reports what they drop).
    ``id_type`` is the type of generated user ids.

    The input rating is carried (as ``_rating_in``) next to its truncated
    form until the final projection, so rows stay distinct after the
    de-duplication; the id generator then needs no copy folding.
    """
    return (
        df.transform(remove_duplicates)
        .transform(lambda d: drop_missing(d, ["review", "rating"]))
        .transform(lambda d: clean_text(d, n=min_chars))
        .withColumn("_rating_in", q("rating"))
        .transform(validate_ratings)
        .transform(lambda d: remove_outliers(d, max_length=max_chars))
        .transform(lambda d: select_final_columns(d, distinct_rows=True, id_type=id_type))
    )


def cleaning_funnel(df: DataFrame, min_chars: int | None = MIN_CLEAN_LENGTH, max_chars: int | None = MAX_CLEAN_LENGTH) -> DataFrame:
    """AGG-16: records remaining after each batch cleaning step, in one pass.

    ``min_chars`` and ``max_chars`` as in :func:`clean_reviews` (None: no such filter).

    One aggregation groups identical rows (this is the de-duplication); the
    group sizes give the loaded count, the group count the de-duplicated one,
    and conditional counts over the groups give every later step.
    """
    groups = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    groups = computed_once(groups, "_len", F.length(text.clean_lower_first(q("review"))))
    clean_len = F.col("_len")
    rating_int = ratings.int_rating(df, "rating")
    present = ~is_missing(df, "review") & ~is_missing(df, "rating")
    long_enough = present if min_chars is None else present & (clean_len >= min_chars)
    valid = long_enough & rating_int.between(RATING_MIN, RATING_MAX)
    short_enough = valid if max_chars is None else valid & (clean_len <= max_chars)
    return _funnel_rows(groups.agg(
        F.sum("_n").alias("s0"),
        F.count(F.lit(1)).alias("s1"),
        F.count_if(present).alias("s2"),
        F.count_if(long_enough).alias("s3"),
        F.count_if(valid).alias("s4"),
        F.count_if(short_enough).alias("s5"),
    ))


def _funnel_rows(wide: DataFrame) -> DataFrame:
    return wide.selectExpr(
        "stack(6, 0, 'loaded', s0, 1, 'deduplicated', s1, 2, 'non_missing', s2, "
        "3, 'text_cleaned', s3, 4, 'valid_rating', s4, 5, 'outliers_removed', s5) "
        "AS (step_no, step, records)"
    )


@dataclass
class CleanedWithCounts:
    """The cleaned rows and the statistics that were counted while they were made."""
    cleaned: DataFrame
    funnel: DataFrame
    duplicates: DataFrame
    missing: DataFrame


def clean_with_counts(df: DataFrame, min_chars: int | None = MIN_CLEAN_LENGTH, max_chars: int | None = MAX_CLEAN_LENGTH,
                      id_type: str = "bigint") -> CleanedWithCounts:
    """JOB-1 with AGG-1..3 and AGG-16 from one read and one de-duplication of ``df``.

    The rows of :func:`clean_reviews` are written to the shared folder, and the
    counts are observed on that write: the sizes of the groups of identical
    rows give the loaded and the missing values, the groups the later steps.
    The written rows are then numbered, so no later job (the range sampler of
    the ids among them) reads or counts the input again.  The frames equal
    :func:`cleaning_funnel`, :func:`duplicate_stats` and :func:`missing_counts`;
    one row of counts comes to the driver.  An empty input gives no cleaned rows,
    steps of zero and no missing values; input columns named ``_n``, ``_len``
    or ``_rating_in`` are refused.
    """
    clash = {c.lower() for c in df.columns} & {"_n", "_len", "_rating_in"}
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    spark = df.sparkSession
    n = F.col("_n")
    groups = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    groups = add_clean_text(groups)
    size = F.length(q("review_clean"))
    present = ~is_missing(df, "review") & ~is_missing(df, "rating")
    long_enough = present if min_chars is None else present & (size >= min_chars)
    valid = long_enough & ratings.int_rating(df, "rating").between(RATING_MIN, RATING_MAX)
    short_enough = valid if max_chars is None else valid & (size <= max_chars)
    steps = [F.coalesce(F.sum(n), F.lit(0)), F.count(F.lit(1)), *[F.count_if(c) for c in (present, long_enough, valid, short_enough)]]
    lost = [F.coalesce(F.sum(F.when(q(c).isNull(), n)), F.lit(0)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    seen = Observation("cleaning")
    kept = groups.observe(seen, *[c.alias(f"s{i}") for i, c in enumerate(steps)], *lost).filter(short_enough).drop("_n")
    kept = materialize(kept.withColumn("_rating_in", q("rating")).withColumn("rating", ratings.int_rating(df, "rating")), "cleaned")
    counts = {k: int(v) for k, v in seen.get.items()}
    wide = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in counts.items()])
    rows = F.col("s0"), F.col("s1")
    return CleanedWithCounts(
        select_final_columns(kept, distinct_rows=True, id_type=id_type),
        _funnel_rows(wide),
        wide.select(rows[0].alias("rows_before"), rows[1].alias("rows_after"), (rows[0] - rows[1]).alias("duplicates_removed")),
        _missing_rows(wide, df.columns).filter(F.col("missing_count") > 0),
    )


def stage_totals(df: DataFrame, min_chars: int | None = MIN_CLEAN_LENGTH, max_chars: int | None = MAX_CLEAN_LENGTH) -> DataFrame:
    """AGG-17 for the chain's tables in one pass: ``table_name, records``.

    One grouping of identical rows counts the loaded rows, those the batch
    cleaner keeps (and labels), and those the universal cleaner keeps.
    ``min_chars`` and ``max_chars`` as in :func:`clean_reviews`.
    """
    funnel = cleaning_groups(df, min_chars, max_chars)
    wide = funnel.agg(
        F.sum("_n").alias("s0"), F.count_if("_cleaned").alias("s1"), F.count_if(~F.col("_no_text")).alias("s2")
    )
    return wide.selectExpr(
        "stack(4, 'reviews_raw', s0, 'cleaned_reviews', s1, 'sentiment_results', s1, 'universal_sentiment', s2) "
        "AS (table_name, records)"
    )


def cleaning_groups(df: DataFrame, min_chars: int | None = MIN_CLEAN_LENGTH, max_chars: int | None = MAX_CLEAN_LENGTH) -> DataFrame:
    """Distinct rows of ``df`` with their number ``_n`` and whether each cleaner keeps them."""
    groups = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    groups = computed_once(groups, "_len", F.length(text.clean_lower_first(q("review"))))
    present = ~is_missing(df, "review") & ~is_missing(df, "rating")
    kept = present if min_chars is None else present & (F.col("_len") >= min_chars)
    kept = kept if max_chars is None else kept & (F.col("_len") <= max_chars)
    valid = ratings.int_rating(df, "rating").between(RATING_MIN, RATING_MAX)
    return groups.select("_n", F.coalesce(kept & valid, F.lit(False)).alias("_cleaned"), q("review").isNull().alias("_no_text"))


# --- JOB-4: universal cleaning --------------------------------------------------

def universal_clean(df: DataFrame, review_col: str, rating_col: str, product_col: str) -> DataFrame:
    """De-duplicate, drop missing text, normalise (lower-last), parse ratings.

    Adds ``review_clean`` and ``Rating_Cleaned`` (FLOAT, default 3.0); writes
    ``Product_name`` (text of the product column) and ``Rating`` (copy of the
    cleaned rating).  Like ``withColumn``, an input column whose name equals
    either of these without case is replaced in place.
    """
    d = df.dropDuplicates().dropna(subset=[review_col])
    d = d.withColumn("review_clean", text.clean_lower_last(q(review_col)))
    d = d.withColumn("Rating_Cleaned", ratings.rating_or_default(q(rating_col)))
    return d.withColumns({"Product_name": q(product_col).cast("string"), "Rating": F.col("Rating_Cleaned")})
