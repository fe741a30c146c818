"""Composed jobs (JOB-1..8): what a user calls.

Each job is a chain of the operators with ``DataFrame.transform``; jobs that
write return the paths they wrote, report jobs return frames (nothing is
printed and nothing is collected).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.functions import recs as R
from opinio.functions import text as T
from opinio.operators import clean, columns, rank, recommend, reports
from opinio.operators import sentiment as sent
from opinio.sources import collections as coll
from opinio.sources import files

clean_reviews = clean.clean_reviews  # JOB-1
batch_sentiment = sent.sentiment_table  # JOB-2


@dataclass
class BatchRecommendations:
    """JOB-3 outputs: frames over one fitted model."""
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    rmse: DataFrame
    user_recs: DataFrame
    product_recs: DataFrame
    avg_predicted_by_user: DataFrame
    top_recommended: DataFrame


def batch_recommend(cleaned: DataFrame) -> BatchRecommendations:
    """JOB-3: triples -> split -> fit -> evaluate -> top-5 lists both ways -> statistics.

    The triples are written once before the split, and the user lists once
    before the statistics read them.  Ids that are no INT (wide or text) are
    trained on as indexes and come back in the lists.
    """
    ids = recommend.indexed_triples(cleaned) if recommend.needs_index(cleaned) else None
    triples = files.materialize(ids.triples if ids else recommend.rating_triples(cleaned), "triples")
    train, test = recommend.split(triples)
    fitted = recommend.train(train)
    preds = recommend.predictions(fitted, test)
    users, items = recommend.user_recommendations(fitted), recommend.top_users_per_product(fitted)
    if ids:
        users, items = recommend.with_original_ids(users, ids), recommend.with_original_ids(items, ids)
    users = files.materialize(users, "user-lists")
    avg_by_user, most = reports.recommendation_stats(users)
    return BatchRecommendations(train, test, preds, reports.rmse(preds), users, items, avg_by_user, most)


def save_batch_recommendations(out: BatchRecommendations, base: str) -> None:
    """SNK-6: the flat user and product lists under ``base``, overwrite."""
    files.save_pair(out.user_recs, out.product_recs, base)


def universal_clean(raw: DataFrame) -> tuple[DataFrame, str, str]:
    """JOB-4: detect the columns, then clean; returns (frame, review column, product column)."""
    review, rating, product = columns.detect_columns(raw.columns)
    return clean.universal_clean(raw, review, rating, product), review, product


def universal_run(spark: SparkSession, raw: DataFrame, run_base: str, pointer_path: str,
                  collections_base: str | None = None, real_ids: bool = False) -> dict[str, str]:
    """JOB-5: clean, label, rank ids, recommend; write a new run folder; publish it last.

    Tables are written with ``errorifexists`` (a run is never overwritten);
    the pointer is written after every table of the run exists.  By default
    (as in the reference) every distinct review text becomes a user and every
    product value an item, through dense ranks; ``real_ids=True`` trains on
    the input's own ``user_id`` / ``product_id`` instead, which keeps the
    user x item scoring proportional to real users.
    """
    cleaned, review_col, product_col = universal_clean(raw)
    written = {"cleaned_data": files.write_run_table(cleaned, run_base, "cleaned_data")}
    # later steps read the table just written instead of re-reading and
    # re-cleaning the (unsplittable, multi-line) CSV
    cleaned = spark.read.parquet(written["cleaned_data"])
    written["sentiment_results"] = files.write_run_table(sent.universal_sentiment(cleaned), run_base, "sentiment_results")
    if collections_base:
        # labelled once: the collection reads the table just written, for its ranges and for its rows
        labelled = spark.read.parquet(written["sentiment_results"])
        coll.write_collection(coll.with_record_id(labelled), f"{collections_base}/sentiment_analysis", key=coll.ID_FIELD)
    if real_ids:
        lists = recommend.universal_recommendations_by_id(cleaned)
    else:
        # only the columns that the fit needs go through the ranks
        needed = dict.fromkeys(clean.resolve(cleaned, c) for c in (review_col, product_col, "Rating_Cleaned"))
        rated = cleaned.select(*[clean.q(c) for c in needed])
        lists = recommend.universal_recommendations(rank.dense_rank_ids(rated, review_col, product_col))
    if lists is not None:
        written["recommendations"] = files.write_run_table(lists, run_base, "recommendations")
        if collections_base:
            # scored once: the copy reads the table just written
            as_json = spark.read.parquet(written["recommendations"]).withColumn("recommendations", R.list_to_json(F.col("recommendations")))
            coll.write_collection(as_json, f"{collections_base}/recommendations", key="user_id")
    files.publish_run(spark, pointer_path, run_base)
    return written


def report_pack(cleaned: DataFrame, sentiment: DataFrame) -> dict[str, DataFrame]:
    """JOB-6: the six SQL reports.

    Pass frames read from the written tables (``files.read_parquet`` /
    ``files.declare_table``), as the SQL pack reads its tables: each report
    is a separate job, and a lazy upstream would be recomputed by each.
    """
    return {
        "sentiment_distribution": reports.sentiment_distribution(sentiment),
        "rating_stats_by_sentiment": reports.rating_stats_by_sentiment(sentiment),
        "top_products": reports.top_products(cleaned),
        "rating_distribution": reports.rating_distribution(cleaned),
        "top_users": reports.top_users(cleaned),
        "sentiment_top_products": reports.sentiment_top_products(sentiment),
    }


def _metric_rows(df: DataFrame, section: str, metric, value) -> DataFrame:
    return df.select(F.lit(section).alias("section"), metric.alias("metric"), value.alias("value"))


def _numbered(df: DataFrame, section: str, order: list[str], value) -> DataFrame:
    """The first rows of ``df`` in an order, numbered, as text (a handful of rows)."""
    first = reports.preview_rows(df, order).select(*order, value.alias("_text"))
    place = F.row_number().over(Window.orderBy(*order, "_text")).cast("string")
    return _metric_rows(first, section, place, F.col("_text"))


def results_summary(spark: SparkSession, pointer_path: str) -> DataFrame | None:
    """JOB-7: ``section, metric, value`` (text) for the latest run; None when no run was published.

    Totals, the cleaned table's columns and first records (ASCII only, as
    JSON), the sentiment distribution and mean ratings, and the first
    recommendation lists.  A section whose table is missing is left out.
    """
    if files.latest_run(spark, pointer_path) is None:
        return None
    total = F.count(F.lit(1)).alias("n")
    parts: list[DataFrame] = []
    cleaned = files.read_run_table(spark, pointer_path, "cleaned_data")
    if cleaned is not None:
        parts.append(_metric_rows(cleaned.agg(total), "cleaned_data", F.lit("total_records"), F.col("n").cast("string")))
        names = F.posexplode(F.array(*map(F.lit, cleaned.columns)))
        listed = spark.range(1).select(names)
        parts.append(_metric_rows(listed, "columns", (F.col("pos") + 1).cast("string"), F.col("col")))
        record = T.strip_non_ascii(F.to_json(F.struct(*[clean.q(c) for c in cleaned.columns])))
        order = [c for c in ("review", "user_id", "product_id") if c in cleaned.columns] or cleaned.columns[:1]
        parts.append(_numbered(cleaned, "sample_records", order, record))
    labelled = files.read_run_table(spark, pointer_path, "sentiment_results")
    if labelled is not None:
        parts.append(_metric_rows(labelled.agg(total), "sentiment_results", F.lit("total_records"), F.col("n").cast("string")))
        parts.append(_metric_rows(reports.sentiment_counts(labelled), "sentiment_distribution",
                                  F.col("sentiment"), F.col("count").cast("string")))
        parts.append(_metric_rows(reports.avg_rating_by_sentiment(labelled), "avg_rating_by_sentiment",
                                  F.col("sentiment"), F.format_number("Avg_Rating", 2)))
    lists = files.read_run_table(spark, pointer_path, "recommendations")
    if lists is not None:
        parts.append(_metric_rows(lists.agg(total), "recommendations", F.lit("total_users"), F.col("n").cast("string")))
        first = reports.preview_rows(lists, ["user_id"])
        parts.append(_metric_rows(first, "sample_recommendations", F.col("user_id").cast("string"),
                                  R.list_to_json(F.col("recommendations"))))
    return reduce(DataFrame.unionByName, parts) if parts else None


def serving_summary(sentiment_docs: DataFrame | None, recommendation_docs: DataFrame | None) -> DataFrame | None:
    """JOB-8: totals, labelled counts and previews of the two serving collections.

    ``section, metric, value`` with text values; a missing collection is left out.
    """
    parts: list[DataFrame] = []
    if sentiment_docs is not None:
        parts.append(_metric_rows(sentiment_docs.agg(F.count(F.lit(1)).alias("n")), "sentiment_analysis",
                                  F.lit("total_records"), F.col("n").cast("string")))
        parts.append(_metric_rows(reports.sentiment_counts_labelled(sentiment_docs), "sentiment_counts",
                                  F.col("sentiment"), F.col("count").cast("string")))
        top = coll.preview(sentiment_docs, ["_id", "review_clean", "Rating", "sentiment"])
        pos = F.row_number().over(Window.orderBy("_id")).cast("string")  # over the 3 preview rows only
        text = F.concat_ws(" | ", F.col("review_clean"), F.col("Rating").cast("string"), F.col("sentiment"))
        parts.append(_metric_rows(top, "sentiment_preview", pos, text))
    if recommendation_docs is not None:
        parts.append(_metric_rows(recommendation_docs.agg(F.count(F.lit(1)).alias("n")), "recommendations",
                                  F.lit("total_users"), F.col("n").cast("string")))
        first = recommendation_docs.orderBy("user_id").limit(coll.PREVIEW_DOCUMENTS)
        who = F.coalesce(F.col("user_id").cast("string"), F.lit(R.MISSING_ID_TEXT))
        parts.append(_metric_rows(first, "recommendations_preview", who, R.json_head(F.col("recommendations"))))
    return reduce(DataFrame.unionByName, parts) if parts else None
