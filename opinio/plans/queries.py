"""Registry of named queries: key -> (Spark builder, DuckDB oracle or None).

Every builder takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (through the review fixtures) and returns a lazy DataFrame over all
of their rows.  Builders that exercise a sink write into a fresh folder under
the shared checkpoint location and read the result back.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from opinio import fixtures
from opinio.functions import ratings as RT
from opinio.functions import recs as R
from opinio.functions import text as T
from opinio.functions.sentiment import NEGATIVE_WORDS, POSITIVE_WORDS
from opinio.operators import clean, columns, keyed, rank, recommend, recommend_checks, reports
from opinio.operators import sentiment as sent
from opinio.plans import jobs
from opinio.plans import oracle as O
from opinio.plans.oracle import with_ctes
from opinio.session import scratch_dir
from opinio.sources import collections as coll
from opinio.sources import csv_split, files, keyed_store

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    sql: str | None
    ids: str  # SURVEY operator ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(fn, sql, ids)
        return fn
    return deco


# --- shared inputs -----------------------------------------------------------

def raw(spark, sf):
    return fixtures.fixture(spark, sf, "reviews_raw")


def docs(spark, sf):
    return fixtures.fixture(spark, sf, "doc_reviews")


def cleaned(spark, sf):
    return jobs.clean_reviews(raw(spark, sf))


def sentiment_results(spark, sf):
    return sent.sentiment_table(cleaned(spark, sf))


def universal(spark, sf):
    return jobs.universal_clean(raw(spark, sf))[0]


def universal_sentiment(spark, sf):
    return sent.universal_sentiment(universal(spark, sf))


def sentiment_docs(spark, sf):
    return coll.with_record_id(universal_sentiment(spark, sf))


def recs_nested(spark, sf):
    return fixtures.fixture(spark, sf, "recs_nested")


def recs_json(spark, sf):
    return recs_nested(spark, sf).withColumn("recommendations", R.list_to_json(F.col("recommendations")))


def recs_flat(spark, sf):
    return fixtures.fixture(spark, sf, "recs_flat")


def kv_state(spark, sf):
    return keyed.apply_log(fixtures.fixture(spark, sf, "cell_log"))


def _write_collection_and_read(spark, df: DataFrame, name: str, key: str) -> DataFrame:
    path = scratch_dir(spark, name)
    coll.write_collection(df, path, key=key)
    return coll.read_collection(spark, path, df.schema)


# --- sources and sinks ---------------------------------------------------------

@register("csv_scan", "SRC-1", with_ctes("""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(product_id AS INTEGER) AS product_id,
  product_name, rating_raw, rating, review FROM reviews_raw""", "reviews_raw"))
def q_csv_scan(spark, sf):
    path = scratch_dir(spark, "csv")
    files.write_csv(raw(spark, sf), path)
    return files.read_csv(spark, path)


@register("csv_multiline_scan", "SRC-2", with_ctes("""
SELECT CAST(doc_id AS INTEGER) AS doc_id, review, lang, rating, quality, toxic FROM doc_reviews""",
                                                   "doc_reviews"))
def q_csv_multiline_scan(spark, sf):
    path = scratch_dir(spark, "csv-multiline")
    files.write_csv(docs(spark, sf), path, multiline=True)
    return files.read_csv_multiline(spark, path)


@register("csv_split_scan", "SRC-2", with_ctes("SELECT * FROM doc_reviews", "doc_reviews"))
def q_csv_split_scan(spark, sf):
    """The same rows, every file cut into byte ranges for several tasks."""
    path = scratch_dir(spark, "csv-split")
    reviews = docs(spark, sf)
    files.write_csv(reviews, path, multiline=True)
    return csv_split.read_csv_split(spark, path, reviews.schema)


@register("parquet_scan", "SRC-3", with_ctes("SELECT * FROM cleaned_reviews", "cleaned_reviews"))
def q_parquet_scan(spark, sf):
    path = scratch_dir(spark, "cleaned_data")
    files.write_parquet(cleaned(spark, sf), path)
    return files.read_parquet(spark, path)


SENTIMENT_TABLE_SCHEMA = StructType([
    StructField("user_id", IntegerType()), StructField("product_id", IntegerType()),
    StructField("rating", IntegerType()), StructField("review", StringType()),
    StructField("review_clean", StringType()), StructField("sentiment", StringType()),
])


@register("external_table_scan", "SRC-4", with_ctes("""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(product_id AS INTEGER) AS product_id, rating, review,
  review_clean, sentiment FROM sentiment_results""", "sentiment_results"))
def q_external_table_scan(spark, sf):
    path = scratch_dir(spark, "sentiment_results")
    table = sentiment_results(spark, sf).withColumns(
        {c: recommend.as_int_id(c) for c in ("user_id", "product_id")})
    files.write_parquet(table, path)
    # the declared layout names six columns; the files hold nine
    return files.read_table(spark, path, SENTIMENT_TABLE_SCHEMA)


@register("declared_tables", "SRC-4 (catalog), JOB-6", with_ctes("""
SELECT 'cleaned_reviews' AS table_name, count(*) AS records, count(*) AS analyzed, true AS kept, count(DISTINCT user_id) AS users FROM cleaned_reviews
UNION ALL SELECT 'sentiment_results', count(*), count(*), true, count(DISTINCT user_id) FROM sentiment_results""", "sentiment_results"))
def q_declared_tables(spark, sf):
    """Both tables of the SQL reports, declared, analysed and declared again over another folder (which changes nothing)."""
    root = scratch_dir(spark, "declared")
    tag = root.rsplit("-", 1)[1]
    ids = {c: recommend.as_int_id(c) for c in ("user_id", "product_id")}
    parts = []
    for name, df, schema in (("cleaned_reviews", cleaned(spark, sf), StructType(SENTIMENT_TABLE_SCHEMA.fields[:-1])),
                             ("sentiment_results", sentiment_results(spark, sf), SENTIMENT_TABLE_SCHEMA)):
        table, path = f"{name}_{tag}", f"{root}/{name}"
        files.write_parquet(df.withColumns(ids).select(*schema.names), path)
        files.declare_table(spark, table, path, schema)
        files.analyze_table(spark, table)
        declared = files.declare_table(spark, table, f"{root}/elsewhere", schema)
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        analyzed = int(described["Statistics"].split(",")[1].split()[0])
        kept = described["Location"].rstrip("/").endswith(path.split(":", 1)[-1].rstrip("/"))
        parts.append(declared.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("user_id").alias("users")).select(
            F.lit(name).alias("table_name"), "records", F.lit(analyzed).cast("long").alias("analyzed"), F.lit(kept).alias("kept"), "users"))
    return reduce(DataFrame.unionByName, parts)


@register("run_history_scan", "SRC-5, SNK-2 (history)", with_ctes("SELECT * FROM universal_sentiment", "universal_sentiment"))
def q_run_history_scan(spark, sf):
    """The newest of two published runs; a third one is written but not published."""
    base = scratch_dir(spark, "history")
    table = sent.universal_sentiment(universal(spark, sf))
    files.write_history(table.filter("sentiment = 'Positive'"), base, "sentiment_results", 1)
    files.publish_history(spark, base, 1)
    files.write_history(table, base, "sentiment_results", 2)
    files.publish_history(spark, base, 2)
    files.write_history(table.limit(3), base, "sentiment_results", 3)
    return files.latest_of_history(spark, base, "sentiment_results", table.schema)


@register("latest_run_scan", "SRC-5, SNK-2, SNK-3", with_ctes("SELECT * FROM universal_sentiment",
                                                               "universal_sentiment"))
def q_latest_run_scan(spark, sf):
    root = scratch_dir(spark, "runs")
    pointer = f"{root}/latest_run"
    run_base = f"{root}/run_1"
    uni = universal(spark, sf)
    files.write_run_table(uni, run_base, "cleaned_data")
    files.write_run_table(sent.universal_sentiment(uni), run_base, "sentiment_results")
    files.publish_run(spark, pointer, run_base)
    return files.read_run_table(spark, pointer, "sentiment_results")


@register("collection_preview", "SRC-6", with_ctes("""
SELECT review_clean, Rating, sentiment FROM sentiment_docs ORDER BY _id LIMIT 3""", "sentiment_docs"))
def q_collection_preview(spark, sf):
    stored = _write_collection_and_read(spark, sentiment_docs(spark, sf), "sentiment_analysis", coll.ID_FIELD)
    return coll.preview(stored, ["review_clean", "Rating", "sentiment"])


@register("kv_scan", "SRC-7", with_ctes("SELECT * FROM kv_state ORDER BY row_key, family, qualifier", "kv_state"))
def q_kv_scan(spark, sf):
    return keyed.scan(kv_state(spark, sf))


@register("parquet_roundtrip", "SNK-1", with_ctes("SELECT * FROM sentiment_results", "sentiment_results"))
def q_parquet_roundtrip(spark, sf):
    path = scratch_dir(spark, "sentiment_results")
    files.write_parquet(cleaned(spark, sf).limit(0), path)  # an earlier table at the same place
    files.write_parquet(sentiment_results(spark, sf), path)  # overwrite replaces it
    return files.read_parquet(spark, path)


@register("collection_replace", "SNK-4", with_ctes("SELECT * FROM sentiment_docs", "sentiment_docs"))
def q_collection_replace(spark, sf):
    path = scratch_dir(spark, "sentiment_analysis")
    d = sentiment_docs(spark, sf)
    coll.write_collection(d.filter(F.col("sentiment") == "Neutral"), path)  # previous contents
    coll.write_collection(d, path)
    return coll.read_collection(spark, path, d.schema)


# --- projections and filters -----------------------------------------------------

@register("detect_columns", "PRJ-1", with_ctes("""
SELECT review AS detected_review, rating AS detected_rating, product_name AS detected_product
FROM reviews_raw""", "reviews_raw"))
def q_detect_columns(spark, sf):
    return columns.detected_projection(raw(spark, sf))


_DOC_FINAL = """
SELECT CAST(rn AS BIGINT) AS user_id, CAST(rn % 1000 AS INTEGER) AS product_id, rating, review, review_clean
FROM (SELECT *, row_number() OVER (ORDER BY review NULLS FIRST, rating NULLS FIRST, review_clean NULLS FIRST) AS rn
      FROM (SELECT rating, review, review_clean FROM (
              SELECT TRY_CAST(trunc(rating) AS INTEGER) AS rating, review, {clean} AS review_clean
              FROM (SELECT DISTINCT * FROM {src}) d
              WHERE review IS NOT NULL AND rating IS NOT NULL{nan}) c
            WHERE length(review_clean) >= 5 AND rating BETWEEN 1 AND 5 AND length(review_clean) <= 5000) f) r
"""


@register("final_columns", "PRJ-2, JOB-1 (ids generated)", with_ctes(
    _DOC_FINAL.format(clean=O.clean_first("review"), src="doc_reviews", nan=""), "doc_reviews"))
def q_final_columns(spark, sf):
    return jobs.clean_reviews(docs(spark, sf))


@register("sentiment_table", "PRJ-3, JOB-2", with_ctes("SELECT * FROM sentiment_results", "sentiment_results"))
def q_sentiment_table(spark, sf):
    return sentiment_results(spark, sf)


@register("rating_triples", "PRJ-4, FLT-2, SCL-8", with_ctes("""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(product_id AS INTEGER) AS product_id,
  CAST(rating AS FLOAT) AS rating FROM cleaned_reviews
WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND rating IS NOT NULL""", "cleaned_reviews"))
def q_rating_triples(spark, sf):
    return recommend.rating_triples(cleaned(spark, sf))


@register("indexed_triples", "PRJ-4 (text and wide ids)", with_ctes("""
SELECT CAST(dense_rank() OVER (ORDER BY user_id) AS INTEGER) AS user_id,
  CAST(dense_rank() OVER (ORDER BY product_id) AS INTEGER) AS product_id, rating
FROM (SELECT 'U' || CAST(user_id AS VARCHAR) AS user_id, product_id + 3000000000 AS product_id,
        CAST(rating AS FLOAT) AS rating FROM cleaned_reviews) t
WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND rating IS NOT NULL""", "cleaned_reviews"))
def q_indexed_triples(spark, sf):
    wide = cleaned(spark, sf).withColumns({"user_id": F.concat(F.lit("U"), F.col("user_id").cast("string")),
                                           "product_id": F.col("product_id") + F.lit(3000000000)})
    return recommend.indexed_triples(wide).triples


@register("universal_clean", "PRJ-5, JOB-4, SCL-5, SCL-7, FLT-8", with_ctes("SELECT * FROM universal", "universal"))
def q_universal_clean(spark, sf):
    return universal(spark, sf)


@register("explode_recommendations", "PRJ-6, SCL-13", with_ctes("""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(product_id AS INTEGER) AS product_id,
  CAST(predicted_rating AS FLOAT) AS predicted_rating FROM recs_flat""", "recs_flat"))
def q_explode_recommendations(spark, sf):
    return recommend.explode_user_lists(recs_nested(spark, sf))


@register("drop_missing", "FLT-1", with_ctes("""
SELECT * FROM reviews_raw WHERE review IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating)""",
                                             "reviews_raw"))
def q_drop_missing(spark, sf):
    return clean.drop_missing(raw(spark, sf), ["review", "rating"])


@register("min_length", "FLT-3, SCL-6", with_ctes(f"""
SELECT * FROM (SELECT *, {O.clean_first('review')} AS review_clean FROM doc_reviews) t
WHERE length(review_clean) >= 5""", "doc_reviews"))
def q_min_length(spark, sf):
    return clean.clean_text(docs(spark, sf))


@register("remove_outliers", "FLT-4", with_ctes(f"""
SELECT * FROM (SELECT *, {O.clean_first('review')} AS review_clean FROM doc_reviews) t
WHERE length(review_clean) <= 5000""", "doc_reviews"))
def q_remove_outliers(spark, sf):
    return clean.remove_outliers(clean.add_clean_text(docs(spark, sf)))


@register("validate_ratings", "FLT-5", with_ctes("""
SELECT user_id, product_id, product_name, rating_raw, rating, review FROM (
  SELECT user_id, product_id, product_name, rating_raw, TRY_CAST(trunc(rating) AS INTEGER) AS rating, review
  FROM reviews_raw) t WHERE rating BETWEEN 1 AND 5""", "reviews_raw"))
def q_validate_ratings(spark, sf):
    return clean.validate_ratings(raw(spark, sf))


@register("lookup_user", "FLT-6", with_ctes("SELECT * FROM recs_json WHERE user_id = 100", "recs_json"))
def q_lookup_user(spark, sf):
    stored = _write_collection_and_read(spark, recs_json(spark, sf), "recommendations", "user_id")
    return coll.find_equal(stored, "user_id", 100)


@register("lookup_record", "FLT-7", with_ctes("""
SELECT * FROM sentiment_docs WHERE _id = (SELECT min(_id) FROM sentiment_docs)""", "sentiment_docs"))
def q_lookup_record(spark, sf):
    stored = _write_collection_and_read(spark, sentiment_docs(spark, sf), "sentiment_analysis", coll.ID_FIELD)
    wanted = stored.agg(F.min("_id")).first()[0]  # one id, as a user would paste it
    return coll.find_equal(stored, "_id", wanted)


@register("fill_rating", "FLT-8", with_ctes(f"""
SELECT user_id, product_id, rating_raw, coalesce({O.first_number('rating_raw')}, CAST(3.0 AS FLOAT)) AS Rating_Cleaned
FROM reviews_raw""", "reviews_raw"))
def q_fill_rating(spark, sf):
    r = raw(spark, sf).select("user_id", "product_id", "rating_raw",
                              RT.first_number(F.col("rating_raw")).alias("Rating_Cleaned"))
    return r.na.fill({"Rating_Cleaned": RT.DEFAULT_RATING})


# --- aggregates -------------------------------------------------------------------

@register("remove_duplicates", "AGG-1", with_ctes("SELECT DISTINCT * FROM reviews_raw", "reviews_raw"))
def q_remove_duplicates(spark, sf):
    return clean.remove_duplicates(raw(spark, sf))


@register("duplicate_stats", "AGG-2", with_ctes("""
SELECT (SELECT count(*) FROM reviews_raw) AS rows_before,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM reviews_raw) d) AS rows_after,
  (SELECT count(*) FROM reviews_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM reviews_raw) d)
    AS duplicates_removed""", "reviews_raw"))
def q_duplicate_stats(spark, sf):
    return clean.duplicate_stats(raw(spark, sf))


@register("missing_counts", "AGG-3, SCL-18", with_ctes("""
SELECT column_name, missing_count FROM (
  SELECT 'user_id' AS column_name, count(*) FILTER (WHERE user_id IS NULL) AS missing_count FROM reviews_raw
  UNION ALL SELECT 'product_id', count(*) FILTER (WHERE product_id IS NULL) FROM reviews_raw
  UNION ALL SELECT 'product_name', count(*) FILTER (WHERE product_name IS NULL) FROM reviews_raw
  UNION ALL SELECT 'rating_raw', count(*) FILTER (WHERE rating_raw IS NULL) FROM reviews_raw
  UNION ALL SELECT 'rating', count(*) FILTER (WHERE rating IS NULL) FROM reviews_raw
  UNION ALL SELECT 'review', count(*) FILTER (WHERE review IS NULL) FROM reviews_raw) t
WHERE missing_count > 0""", "reviews_raw"))
def q_missing_counts(spark, sf):
    return clean.missing_counts(raw(spark, sf))


@register("distinct_counts", "AGG-4", with_ctes("""
SELECT count(DISTINCT user_id) AS distinct_users, count(DISTINCT product_id) AS distinct_products
FROM cleaned_reviews""", "cleaned_reviews"))
def q_distinct_counts(spark, sf):
    return reports.distinct_counts(recommend.rating_triples(cleaned(spark, sf)))


@register("rating_counts", "AGG-5", with_ctes("""
SELECT rating, count(*) AS "count" FROM cleaned_reviews GROUP BY rating ORDER BY rating""", "cleaned_reviews"))
def q_rating_counts(spark, sf):
    return reports.rating_counts(cleaned(spark, sf))


@register("sentiment_counts", "AGG-6", with_ctes("""
SELECT sentiment, count(*) AS "count" FROM sentiment_results GROUP BY sentiment ORDER BY "count" DESC""",
                                                 "sentiment_results"))
def q_sentiment_counts(spark, sf):
    return reports.sentiment_counts(sentiment_results(spark, sf))


@register("sentiment_counts_labelled", "AGG-7, SCL-16", with_ctes("""
SELECT coalesce(nullif(sentiment, ''), 'Unknown') AS sentiment, count(*) AS "count"
FROM sentiment_docs GROUP BY 1""", "sentiment_docs"))
def q_sentiment_counts_labelled(spark, sf):
    return reports.sentiment_counts_labelled(sentiment_docs(spark, sf))


@register("sentiment_by_rating", "AGG-8", with_ctes("""
SELECT rating, sentiment, count(*) AS "count" FROM sentiment_results GROUP BY rating, sentiment""",
                                                    "sentiment_results"))
def q_sentiment_by_rating(spark, sf):
    return reports.sentiment_by_rating(sentiment_results(spark, sf))


@register("confidence_by_sentiment", "AGG-9", with_ctes("""
SELECT sentiment, round(avg(confidence), 6) AS avg_confidence FROM sentiment_results GROUP BY sentiment""",
                                                        "sentiment_results"))
def q_confidence_by_sentiment(spark, sf):
    return reports.confidence_by_sentiment(sentiment_results(spark, sf))


@register("avg_rating_by_sentiment", "AGG-10", with_ctes(f"""
SELECT sentiment, {O.round2_avg_halves('Rating')} AS Avg_Rating FROM universal_sentiment GROUP BY sentiment""",
                                                         "universal_sentiment"))
def q_avg_rating_by_sentiment(spark, sf):
    return reports.avg_rating_by_sentiment(universal_sentiment(spark, sf))


@register("sentiment_distribution", "AGG-11, WIN-4, SCL-11, SCL-12", with_ctes(f"""
SELECT sentiment, "count", {O.percent('"count"', 'total')} AS percentage FROM (
  SELECT sentiment, count(*) AS "count", sum(count(*)) OVER () AS total
  FROM sentiment_results GROUP BY sentiment) g""", "sentiment_results"))
def q_sentiment_distribution(spark, sf):
    return reports.sentiment_distribution(sentiment_results(spark, sf))


@register("rating_stats_by_sentiment", "AGG-12", with_ctes(f"""
SELECT sentiment, {O.round2_avg_int('rating')} AS avg_rating, min(rating) AS min_rating,
  max(rating) AS max_rating, count(*) AS review_count
FROM sentiment_results GROUP BY sentiment""", "sentiment_results"))
def q_rating_stats_by_sentiment(spark, sf):
    return reports.rating_stats_by_sentiment(sentiment_results(spark, sf))


@register("rating_distribution", "AGG-13, WIN-4", with_ctes(f"""
SELECT rating, "count", {O.percent('"count"', 'total')} AS percentage FROM (
  SELECT rating, count(*) AS "count", sum(count(*)) OVER () AS total
  FROM cleaned_reviews GROUP BY rating) g""", "cleaned_reviews"))
def q_rating_distribution(spark, sf):
    return reports.rating_distribution(cleaned(spark, sf))


@register("sentiment_top_products", "AGG-14, JOIN-1, TOP-3", with_ctes("""
SELECT product_id, sentiment, count(*) AS "count" FROM sentiment_results
WHERE product_id IN (SELECT product_id FROM cleaned_reviews GROUP BY product_id
                     ORDER BY count(*) DESC, product_id LIMIT 5)
GROUP BY product_id, sentiment""", "sentiment_results", "cleaned_reviews"))
def q_sentiment_top_products(spark, sf):
    return reports.sentiment_top_products(sentiment_results(spark, sf))


@register("sentiment_top_products_semi_join", "JOIN-1 (top ids from the cleaned table)",
          REGISTRY["sentiment_top_products"].sql)
def q_sentiment_top_products_semi_join(spark, sf):
    c = cleaned(spark, sf)
    return reports.sentiment_top_products(sent.sentiment_table(c), c)


@register("avg_predicted_by_user", "AGG-15", with_ctes("""
SELECT user_id, avg(predicted_rating) AS avg_predicted_rating FROM recs_flat GROUP BY user_id""", "recs_flat"))
def q_avg_predicted_by_user(spark, sf):
    return reports.avg_predicted_by_user(recs_flat(spark, sf))


@register("cleaning_funnel", "AGG-16", with_ctes("""
SELECT s.step_no, s.step, c.records
FROM (VALUES (0, 'loaded'), (1, 'deduplicated'), (2, 'non_missing'), (3, 'text_cleaned'),
             (4, 'valid_rating'), (5, 'outliers_removed')) s(step_no, step)
JOIN (
  SELECT 0 AS k, (SELECT count(*) FROM reviews_raw) AS records
  UNION ALL SELECT 1, count(*) FROM funnel_rows
  UNION ALL SELECT 2, count(*) FROM funnel_rows WHERE present
  UNION ALL SELECT 3, count(*) FROM funnel_rows WHERE present AND len >= 5
  UNION ALL SELECT 4, count(*) FROM funnel_rows WHERE present AND len >= 5 AND r BETWEEN 1 AND 5
  UNION ALL SELECT 5, count(*) FROM funnel_rows WHERE present AND len >= 5 AND r BETWEEN 1 AND 5 AND len <= 5000
) c ON c.k = s.step_no""", "reviews_raw", "funnel_rows"))
def q_cleaning_funnel(spark, sf):
    return clean.cleaning_funnel(raw(spark, sf))


@register("clean_with_counts", "JOB-1, AGG-1, AGG-2, AGG-3, AGG-16", with_ctes("""
SELECT 'cleaned' AS part, 'records' AS name, count(*) AS records FROM cleaned_reviews
UNION ALL SELECT 'cleaned', 'sum_user_id', CAST(sum(user_id) AS BIGINT) FROM cleaned_reviews
UNION ALL SELECT 'cleaned', 'sum_length', CAST(sum(length(review_clean)) AS BIGINT) FROM cleaned_reviews
UNION ALL SELECT 'duplicates', 'removed',
  (SELECT count(*) FROM reviews_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM reviews_raw) d)
UNION ALL SELECT 'missing', column_name, missing_count FROM (
  SELECT 'user_id' AS column_name, count(*) FILTER (WHERE user_id IS NULL) AS missing_count FROM reviews_raw
  UNION ALL SELECT 'product_id', count(*) FILTER (WHERE product_id IS NULL) FROM reviews_raw
  UNION ALL SELECT 'product_name', count(*) FILTER (WHERE product_name IS NULL) FROM reviews_raw
  UNION ALL SELECT 'rating_raw', count(*) FILTER (WHERE rating_raw IS NULL) FROM reviews_raw
  UNION ALL SELECT 'rating', count(*) FILTER (WHERE rating IS NULL) FROM reviews_raw
  UNION ALL SELECT 'review', count(*) FILTER (WHERE review IS NULL) FROM reviews_raw) t
WHERE missing_count > 0
UNION ALL SELECT 'steps', 'loaded', count(*) FROM reviews_raw
UNION ALL SELECT 'steps', 'deduplicated', count(*) FROM funnel_rows
UNION ALL SELECT 'steps', 'non_missing', count(*) FROM funnel_rows WHERE present
UNION ALL SELECT 'steps', 'text_cleaned', count(*) FROM funnel_rows WHERE present AND len >= 5
UNION ALL SELECT 'steps', 'valid_rating', count(*) FROM funnel_rows WHERE present AND len >= 5 AND r BETWEEN 1 AND 5
UNION ALL SELECT 'steps', 'outliers_removed', count(*) FROM funnel_rows
  WHERE present AND len >= 5 AND r BETWEEN 1 AND 5 AND len <= 5000""", "cleaned_reviews", "funnel_rows"))
def q_clean_with_counts(spark, sf):
    """The cleaner and its statistics from one read: sums over the cleaned rows beside the observed counts."""
    out = clean.clean_with_counts(raw(spark, sf))
    sums = out.cleaned.agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("u"), F.sum(F.length("review_clean")).alias("t"))
    parts = [
        sums.selectExpr("stack(3, 'records', n, 'sum_user_id', u, 'sum_length', t) AS (name, records)").withColumn("part", F.lit("cleaned")),
        out.duplicates.select(F.lit("removed").alias("name"), F.col("duplicates_removed").alias("records"), F.lit("duplicates").alias("part")),
        out.missing.select(F.col("column_name").alias("name"), F.col("missing_count").alias("records"), F.lit("missing").alias("part")),
        out.funnel.select(F.col("step").alias("name"), "records", F.lit("steps").alias("part")),
    ]
    return reduce(DataFrame.unionByName, parts).select("part", "name", "records")


@register("table_totals", "AGG-17", with_ctes("""
SELECT 'reviews_raw' AS table_name, count(*) AS records FROM reviews_raw
UNION ALL SELECT 'cleaned_reviews', count(*) FROM cleaned_reviews
UNION ALL SELECT 'sentiment_results', count(*) FROM sentiment_results
UNION ALL SELECT 'universal_sentiment', count(*) FROM universal_sentiment""",
                                              "sentiment_results", "universal_sentiment"))
def q_table_totals(spark, sf):
    return clean.stage_totals(raw(spark, sf))


@register("rmse", "AGG-18", with_ctes("""
SELECT sqrt(avg((rating - prediction) * (rating - prediction))) AS rmse FROM predictions""", "predictions"))
def q_rmse(spark, sf):
    return reports.rmse(fixtures.fixture(spark, sf, "predictions"))


# --- windows: global ids ------------------------------------------------------------

@register("surrogate_ids", "WIN-1, WIN-2", with_ctes(
    _DOC_FINAL.format(clean=O.clean_first("review"), src="raw_no_ids", nan=" AND NOT isnan(rating)"), "raw_no_ids"))
def q_surrogate_ids(spark, sf):
    return jobs.clean_reviews(raw(spark, sf).drop("user_id", "product_id"))


@register("dense_rank_ids", "WIN-3", with_ctes("""
SELECT CAST(dense_rank() OVER (ORDER BY review NULLS FIRST) AS INTEGER) AS user_id,
  CAST(dense_rank() OVER (ORDER BY Product_name NULLS FIRST) AS INTEGER) AS product_id,
  review, Product_name, Rating_Cleaned
FROM universal""", "universal"))
def q_dense_rank_ids(spark, sf):
    u, review_col, product_col = jobs.universal_clean(raw(spark, sf))
    narrow = u.select("review", "Product_name", "Rating_Cleaned")  # only these go through the sort
    return rank.dense_rank_ids(narrow, review_col, product_col).select(
        "user_id", "product_id", "review", "Product_name", "Rating_Cleaned")


# --- top-k ---------------------------------------------------------------------------

@register("top_products", "TOP-1, TOP-5", with_ctes(f"""
SELECT product_id, count(*) AS review_count, {O.round2_avg_int('rating')} AS avg_rating
FROM cleaned_reviews GROUP BY product_id ORDER BY review_count DESC, product_id LIMIT 10""", "cleaned_reviews"))
def q_top_products(spark, sf):
    return reports.top_products(cleaned(spark, sf))


@register("top_users", "TOP-2", with_ctes(f"""
SELECT user_id, count(*) AS review_count, {O.round2_avg_int('rating')} AS avg_rating
FROM cleaned_reviews GROUP BY user_id ORDER BY review_count DESC, user_id LIMIT 10""", "cleaned_reviews"))
def q_top_users(spark, sf):
    return reports.top_users(cleaned(spark, sf))


@register("top_recommended", "TOP-4", with_ctes("""
SELECT product_id, count(*) AS "count" FROM recs_flat GROUP BY product_id
ORDER BY "count" DESC, product_id LIMIT 10""", "recs_flat"))
def q_top_recommended(spark, sf):
    return reports.top_recommended(recs_flat(spark, sf))


@register("preview_rows", "TOP-6", with_ctes("""
SELECT * FROM cleaned_reviews ORDER BY user_id, product_id, rating, review LIMIT 5""", "cleaned_reviews"))
def q_preview_rows(spark, sf):
    return reports.preview_rows(cleaned(spark, sf), ["user_id", "product_id", "rating", "review"])


@register("top_n_per_user", "TOP-7", with_ctes("""
SELECT user_id, product_id, predicted_rating, rn FROM (
  SELECT user_id, product_id, predicted_rating,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY predicted_rating DESC, product_id) AS INTEGER) AS rn
  FROM recs_flat) t WHERE rn <= 3""", "recs_flat"))
def q_top_n_per_user(spark, sf):
    flat = recs_flat(spark, sf).drop("rn")
    return reports.top_n_per_group(flat, "user_id", "predicted_rating", "product_id", 3)


# --- scalar functions --------------------------------------------------------------

@register("clean_text", "SCL-1..4", with_ctes(f"""
SELECT doc_id, {O.clean_first('review')} AS review_clean FROM doc_reviews""", "doc_reviews"))
def q_clean_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean_lower_first(F.col("review")).alias("review_clean"))


@register("clean_text_universal", "SCL-5", with_ctes(f"""
SELECT doc_id, {O.clean_last('review')} AS review_clean FROM doc_reviews""", "doc_reviews"))
def q_clean_text_universal(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean_lower_last(F.col("review")).alias("review_clean"))


@register("extract_rating", "SCL-7", with_ctes(f"""
SELECT rating_raw, {O.first_number('rating_raw')} AS rating_number FROM reviews_raw""", "reviews_raw"))
def q_extract_rating(spark, sf):
    return raw(spark, sf).select("rating_raw", RT.first_number(F.col("rating_raw")).alias("rating_number"))


@register("sentiment_label", "SEN-1, SCL-9", with_ctes(f"""
SELECT *, {O.label('rating')} AS sentiment FROM cleaned_reviews""", "cleaned_reviews"))
def q_sentiment_label(spark, sf):
    return sent.add_label(cleaned(spark, sf))


def _flags_sql() -> str:
    cols = ", ".join(f"{O.flag('review_clean', w)} AS has_{w}" for w in POSITIVE_WORDS + NEGATIVE_WORDS)
    return f"SELECT *, {cols} FROM cleaned_reviews"


@register("lexicon_flags", "SEN-3, SCL-10", with_ctes(_flags_sql(), "cleaned_reviews"))
def q_lexicon_flags(spark, sf):
    return sent.add_lexicon_flags(cleaned(spark, sf))


@register("recs_to_json", "SCL-14", with_ctes("SELECT * FROM recs_json", "recs_json"))
def q_recs_to_json(spark, sf):
    return recs_json(spark, sf)


@register("recs_top3", "SCL-15, SCL-16", with_ctes("""
SELECT CAST(user_id AS INTEGER) AS user_id,
  CAST(to_json(list({'product_id': CAST(product_id AS INTEGER), 'rating': CAST(predicted_rating AS FLOAT)}
                     ORDER BY rn) FILTER (WHERE rn <= 3)) AS VARCHAR) AS top_recommendations
FROM recs_flat GROUP BY user_id""", "recs_flat"))
def q_recs_top3(spark, sf):
    stored = _write_collection_and_read(spark, recs_json(spark, sf), "recommendations", "user_id")
    return stored.select("user_id", R.json_head(F.col("recommendations")).alias("top_recommendations"))


@register("ascii_preview", "SCL-17", with_ctes("""
SELECT doc_id, regexp_replace(review, '[^\\x00-\\x7F]', '', 'g') AS review_ascii FROM doc_reviews""",
                                               "doc_reviews"))
def q_ascii_preview(spark, sf):
    return docs(spark, sf).select("doc_id", T.strip_non_ascii(F.col("review")).alias("review_ascii"))


@register("sentiment_label_universal", "SEN-2", with_ctes("SELECT * FROM universal_sentiment",
                                                          "universal_sentiment"))
def q_sentiment_label_universal(spark, sf):
    return universal_sentiment(spark, sf)


@register("lexicon_scores", "SEN-4", with_ctes(f"""
SELECT *, {O.score('review_clean', POSITIVE_WORDS)} AS positive_score,
  {O.score('review_clean', NEGATIVE_WORDS)} AS negative_score
FROM cleaned_reviews""", "cleaned_reviews"))
def q_lexicon_scores(spark, sf):
    return sent.add_lexicon_scores(cleaned(spark, sf))


@register("sentiment_confidence", "SEN-5", with_ctes(f"""
SELECT *, {O.confidence('rating')} AS confidence FROM cleaned_reviews""", "cleaned_reviews"))
def q_sentiment_confidence(spark, sf):
    return sent.add_confidence(cleaned(spark, sf))


# --- keyed tables ---------------------------------------------------------------------

@register("kv_latest_cells", "KV-1", with_ctes("""
SELECT row_key, family, qualifier, value, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY seq DESC) AS rn
  FROM cell_log WHERE op = 'put') t WHERE rn = 1""", "cell_log"))
def q_kv_latest_cells(spark, sf):
    return keyed.latest_cells(fixtures.fixture(spark, sf, "cell_log"))


KV_PROBE_ROW = "10"


@register("kv_get", "KV-2", with_ctes(f"""
SELECT family, qualifier, value FROM kv_state WHERE row_key = '{KV_PROBE_ROW}'""", "kv_state"))
def q_kv_get(spark, sf):
    return keyed.get_row(kv_state(spark, sf), KV_PROBE_ROW)


@register("kv_apply", "KV-3, KV-4, KV-5", with_ctes("SELECT * FROM kv_state", "kv_state"))
def q_kv_apply(spark, sf):
    return kv_state(spark, sf)


@register("kv_merge_segments", "KV-1, KV-3, KV-4, KV-5, SRC-7", with_ctes("SELECT * FROM kv_state", "kv_state"))
def q_kv_merge_segments(spark, sf):
    """The log in three segments whose operations interleave, merged one after the other into a stored table."""
    log = fixtures.fixture(spark, sf, "cell_log")
    base = scratch_dir(spark, "kv-store")
    keyed_store.create(log.filter(F.col("seq") % 3 == 1), base)
    for late in (0, 2):
        keyed_store.merge(log.filter(F.col("seq") % 3 == late), base)
    return keyed_store.state(spark, base)


# --- jobs -----------------------------------------------------------------------------

@register("clean_reviews", "JOB-1", with_ctes("SELECT * FROM cleaned_reviews", "cleaned_reviews"))
def q_clean_reviews(spark, sf):
    return cleaned(spark, sf)


_U = O.UNIVERSAL_COLUMNS
_RECORD = "concat('{', concat_ws(',', " + ", ".join(
    f"""'"{c}":' || CAST(to_json({c}) AS VARCHAR)""" for c in _U) + "), '}')"


@register("results_summary", "JOB-7, AGG-17, AGG-6, AGG-10", with_ctes(f"""
SELECT 'cleaned_data' AS section, 'total_records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM universal
UNION ALL SELECT 'columns', CAST(i AS VARCHAR), ({_U!r})[i] FROM range(1, {len(_U) + 1}) r(i)
UNION ALL SELECT 'sample_records', CAST(row_number() OVER (ORDER BY review, user_id, product_id, j) AS VARCHAR),
  regexp_replace(j, '[^\\x00-\\x7F]', '', 'g')
FROM (SELECT review, user_id, product_id, {_RECORD} AS j FROM universal
      ORDER BY review, user_id, product_id LIMIT 5) p
UNION ALL SELECT 'sentiment_results', 'total_records', CAST(count(*) AS VARCHAR) FROM universal_sentiment
UNION ALL SELECT 'sentiment_distribution', sentiment, CAST(count(*) AS VARCHAR) FROM universal_sentiment GROUP BY sentiment
UNION ALL SELECT 'avg_rating_by_sentiment', sentiment, printf('%.2f', {O.round2_avg_halves('Rating')})
  FROM universal_sentiment GROUP BY sentiment
UNION ALL SELECT 'recommendations', 'total_users', CAST(count(*) AS VARCHAR) FROM recs_json
UNION ALL SELECT 'sample_recommendations', CAST(user_id AS VARCHAR), recommendations
FROM (SELECT * FROM recs_json ORDER BY user_id LIMIT 5) r""", "universal_sentiment", "recs_json"))
def q_results_summary(spark, sf):
    root = scratch_dir(spark, "runs")
    pointer = f"{root}/latest_run"
    run_base = f"{root}/run_1"
    uni = universal(spark, sf)
    files.write_run_table(uni, run_base, "cleaned_data")
    files.write_run_table(sent.universal_sentiment(uni), run_base, "sentiment_results")
    files.write_run_table(recs_nested(spark, sf), run_base, "recommendations")
    files.publish_run(spark, pointer, run_base)
    return jobs.results_summary(spark, pointer)


@register("serving_summary", "JOB-8, AGG-7, SRC-6, SCL-15", with_ctes("""
SELECT 'sentiment_analysis' AS section, 'total_records' AS metric, CAST(count(*) AS VARCHAR) AS value
FROM sentiment_docs
UNION ALL SELECT 'sentiment_counts', coalesce(nullif(sentiment, ''), 'Unknown'), CAST(count(*) AS VARCHAR)
FROM sentiment_docs GROUP BY 2
UNION ALL SELECT 'sentiment_preview', CAST(row_number() OVER (ORDER BY _id) AS VARCHAR),
  concat_ws(' | ', review_clean, CAST(Rating AS VARCHAR), sentiment)
FROM (SELECT * FROM sentiment_docs ORDER BY _id LIMIT 3) p
UNION ALL SELECT 'recommendations', 'total_users', CAST(count(*) AS VARCHAR) FROM recs_json
UNION ALL SELECT 'recommendations_preview', coalesce(CAST(user_id AS VARCHAR), 'N/A'),
  CAST(to_json(from_json(recommendations, '[{"product_id":"INTEGER","rating":"FLOAT"}]')[1:3]) AS VARCHAR)
FROM (SELECT * FROM recs_json ORDER BY user_id LIMIT 3) r""", "sentiment_docs", "recs_json"))
def q_serving_summary(spark, sf):
    s_docs = _write_collection_and_read(spark, sentiment_docs(spark, sf), "sentiment_analysis", coll.ID_FIELD)
    r_docs = _write_collection_and_read(spark, recs_json(spark, sf), "recommendations", "user_id")
    return jobs.serving_summary(s_docs, r_docs)


# --- recommender (ALS factors have no SQL form; the split and the checks of a fit do) ----

def _split(spark, sf):
    return recommend.split(files.materialize(recommend.rating_triples(cleaned(spark, sf)), "triples"))


_SPLIT_CTES = ("cleaned_reviews",)
_PARTS = """
SELECT user_id, product_id, rating, CASE WHEN left(md5(user_id || '|' || product_id || '|' || rating), 4) < 'cccd'
  THEN 'train' ELSE 'test' END AS part
FROM (SELECT CAST(user_id AS INTEGER) AS user_id, CAST(product_id AS INTEGER) AS product_id,
        CAST(rating AS FLOAT) AS rating FROM cleaned_reviews) t
WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND rating IS NOT NULL"""


@register("train_test_split", "ML-1", with_ctes(_PARTS, *_SPLIT_CTES))
def q_train_test_split(spark, sf):
    train, test = _split(spark, sf)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@register("split_counts", "AGG-19", with_ctes(
    f"SELECT part, count(*) AS records FROM ({_PARTS}) p GROUP BY part", *_SPLIT_CTES))
def q_split_counts(spark, sf):
    return recommend.split_counts(*_split(spark, sf))


@register("als_invariants", "ML-2, ML-4", with_ctes(f"""
SELECT count(DISTINCT user_id) AS trained_users, count(DISTINCT user_id) AS users_with_list,
  CAST(least(5, count(DISTINCT product_id)) AS BIGINT) AS longest_list,
  CAST(0 AS BIGINT) AS order_violations, CAST(0 AS BIGINT) AS score_mismatches
FROM ({_PARTS}) p WHERE part = 'train'""", *_SPLIT_CTES))
def q_als_invariants(spark, sf):
    return recommend.invariants(_split(spark, sf)[0])


@register("universal_run", "JOB-5, SNK-3, SNK-4", with_ctes("""
SELECT 'cleaned_data' AS table_name, count(*) AS records, count(DISTINCT review_clean) AS keys FROM universal
UNION ALL SELECT 'sentiment_results', count(*), count(DISTINCT sentiment) FROM universal_sentiment
UNION ALL SELECT 'recommendations', count(DISTINCT review), count(DISTINCT review) FROM universal
UNION ALL SELECT 'served_sentiment', count(*), count(DISTINCT _id) FROM sentiment_docs
UNION ALL SELECT 'served_recommendations', count(DISTINCT review), count(DISTINCT review) FROM universal""",
                                                     "sentiment_docs"))
def q_universal_run(spark, sf):
    """Rows and distinct keys of every table that one universal run leaves."""
    root = scratch_dir(spark, "universal-run")
    jobs.universal_run(spark, raw(spark, sf), f"{root}/run_1", f"{root}/latest_run", f"{root}/db")
    tables = {n: (files.read_run_table(spark, f"{root}/latest_run", n), k) for n, k in (
        ("cleaned_data", "review_clean"), ("sentiment_results", "sentiment"), ("recommendations", "user_id"))}
    tables |= {"served_sentiment": (spark.read.parquet(f"{root}/db/sentiment_analysis"), "_id"),
               "served_recommendations": (spark.read.parquet(f"{root}/db/recommendations"), "user_id")}
    return _rows_and_keys(tables)


@register("batch_recommend", "JOB-3, SNK-6", with_ctes(f"""
SELECT 'user_recommendations' AS table_name, least(5, count(DISTINCT product_id)) * count(DISTINCT user_id) AS records,
  count(DISTINCT user_id) AS keys FROM ({_PARTS}) p WHERE part = 'train'
UNION ALL SELECT 'product_recommendations', least(5, count(DISTINCT user_id)) * count(DISTINCT product_id),
  count(DISTINCT product_id) FROM ({_PARTS}) p WHERE part = 'train'""", *_SPLIT_CTES))
def q_batch_recommend(spark, sf):
    """Rows and distinct keys of the two tables of a batch run."""
    base = scratch_dir(spark, "batch-run")
    jobs.save_batch_recommendations(jobs.batch_recommend(cleaned(spark, sf)), base)
    return _rows_and_keys({n: (spark.read.parquet(f"{base}/{n}"), k) for n, k in (
        ("user_recommendations", "user_id"), ("product_recommendations", "product_id"))})


def _rows_and_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("records"), F.count_distinct(key).alias("keys"))
             .select(F.lit(name).alias("table_name"), "records", "keys") for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@register("als_factors", "ML-2")
def q_als_factors(spark, sf):
    train, _ = _split(spark, sf)
    return recommend.factors(recommend.train(train))


@register("user_recommendations", "ML-4, JOB-3")
def q_user_recommendations(spark, sf):
    train, _ = _split(spark, sf)
    return recommend.user_recommendations(recommend.train(train))


@register("top_users_per_product", "ML-5")
def q_top_users_per_product(spark, sf):
    train, _ = _split(spark, sf)
    return recommend.top_users_per_product(recommend.train(train))


@register("als_predictions", "ML-6")
def q_als_predictions(spark, sf):
    train, test = _split(spark, sf)
    return recommend.predictions(recommend.train(train), test)


@register("als_universal", "ML-3, JOB-5, WIN-3")
def q_als_universal(spark, sf):
    u, review_col, product_col = jobs.universal_clean(raw(spark, sf))
    lists = recommend.universal_recommendations(rank.dense_rank_ids(u, review_col, product_col))
    if lists is None:
        return spark.createDataFrame([], "user_id int, recommendations array<struct<product_id:int,rating:float>>")
    return lists


@register("als_factors_checked", "ML-2", with_ctes(f"""
SELECT DISTINCT 'user' AS side, user_id AS id, true AS valid FROM ({_PARTS}) p WHERE part = 'train'
UNION ALL SELECT DISTINCT 'item', product_id, true FROM ({_PARTS}) p WHERE part = 'train'""", *_SPLIT_CTES))
def q_als_factors_checked(spark, sf):
    """Every factor row of a fit: is it the minimum of its own normal equations?"""
    train = files.materialize(_split(spark, sf)[0], "train")
    return recommend_checks.factor_check(train, recommend.train(train))


@register("als_predictions_checked", "ML-6", with_ctes(f"""
SELECT t.user_id, t.product_id, t.rating, true AS valid FROM ({_PARTS}) t
WHERE part = 'test' AND user_id IN (SELECT user_id FROM ({_PARTS}) u WHERE part = 'train')
  AND product_id IN (SELECT product_id FROM ({_PARTS}) i WHERE part = 'train')""", *_SPLIT_CTES))
def q_als_predictions_checked(spark, sf):
    """Every held-out pair that can be predicted: is the prediction the product of its factors?"""
    train, test = _split(spark, sf)
    fitted = recommend.train(files.materialize(train, "train"))
    return recommend_checks.prediction_check(recommend.predictions(fitted, test), fitted)


@register("als_universal_checked", "ML-3, ML-4", with_ctes("""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(least(5, items) AS INTEGER) AS entries, true AS valid
FROM (SELECT DISTINCT dense_rank() OVER (ORDER BY review) AS user_id FROM universal) u,
  (SELECT count(DISTINCT Product_name) + count(DISTINCT CASE WHEN Product_name IS NULL THEN 1 END) AS items FROM universal) i""", "universal"))
def q_als_universal_checked(spark, sf):
    """Every user of a universal run: an optimal factor row, and a falling list of right scores."""
    u, review_col, product_col = jobs.universal_clean(raw(spark, sf))
    triples = recommend.universal_triples(rank.dense_rank_ids(u, review_col, product_col))
    fitted = recommend.train(triples, "rating_float", recommend.UNIVERSAL_ALS)
    lists = recommend_checks.list_check(recommend.nested_user_lists(fitted), fitted)
    best = recommend_checks.user_optimality(triples, fitted).filter(F.col("residual") <= recommend_checks.TOLERANCE)
    return lists.join(best, "user_id", "left").select("user_id", "entries", (F.col("valid") & F.col("residual").isNotNull()).alias("valid"))
