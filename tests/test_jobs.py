"""Composed jobs end to end on sf0.001: universal run, summaries, batch save."""

from pyspark.sql import functions as F

from opinio.operators import reports
from opinio.plans import jobs, queries
from opinio.session import scratch_dir
from opinio.sources import collections as coll
from tests.conftest import SF_SMALL


def test_universal_run_publishes_and_summaries_read_it(spark):
    root = scratch_dir(spark, "universal")
    pointer = f"{root}/latest_run"
    written = jobs.universal_run(spark, queries.raw(spark, SF_SMALL), f"{root}/run_1", pointer,
                                 collections_base=f"{root}/db")
    assert set(written) == {"cleaned_data", "sentiment_results", "recommendations"}
    summary = {(r.section, r.metric): r.value for r in jobs.results_summary(spark, pointer).collect()}
    n = queries.universal(spark, SF_SMALL).count()
    assert summary[("cleaned_data", "total_records")] == str(n)
    texts = queries.universal(spark, SF_SMALL).select("review").distinct().count()
    assert summary[("recommendations", "total_users")] == str(texts)
    assert {s for s, _ in summary} >= {"columns", "sample_records", "sample_recommendations"}
    s_docs = spark.read.parquet(f"{root}/db/sentiment_analysis")
    r_docs = spark.read.parquet(f"{root}/db/recommendations")
    serving = jobs.serving_summary(s_docs, r_docs).collect()
    sections = {r.section for r in serving}
    assert {"sentiment_analysis", "sentiment_counts", "sentiment_preview", "recommendations",
            "recommendations_preview"} <= sections
    assert s_docs.select(coll.ID_FIELD).distinct().count() == n


def test_report_pack_has_six_reports(spark):
    c = queries.cleaned(spark, SF_SMALL)
    pack = jobs.report_pack(c, jobs.batch_sentiment(c))
    assert len(pack) == 6
    counts = {name: df.count() for name, df in pack.items()}
    assert counts["top_products"] == counts["top_users"] == 10 and counts["sentiment_distribution"] == 3
    top = {r.product_id for r in pack["top_products"].limit(5).collect()}
    assert {r.product_id for r in pack["sentiment_top_products"].collect()} == top


def test_reports_are_ordered(spark):
    c = spark.read.parquet(_written(spark, queries.cleaned(spark, SF_SMALL)))
    s = spark.read.parquet(_written(spark, jobs.batch_sentiment(c)))
    pack = {name: [tuple(r) for r in df.collect()] for name, df in jobs.report_pack(c, s).items()}
    assert pack["top_products"] == sorted(pack["top_products"], key=lambda r: (-r[1], r[0]))
    assert pack["top_users"] == sorted(pack["top_users"], key=lambda r: (-r[1], r[0]))
    assert pack["sentiment_top_products"] == sorted(pack["sentiment_top_products"], key=lambda r: (r[0], -r[2], r[1]))
    assert pack["rating_distribution"] == sorted(pack["rating_distribution"], reverse=True)
    assert [r[1] for r in pack["sentiment_distribution"]] == sorted((r[1] for r in pack["sentiment_distribution"]), reverse=True)
    counted = [tuple(r) for r in reports.sentiment_counts(s).collect()]
    assert counted == sorted(counted, key=lambda r: (-r[1], r[0]))


def _written(spark, df):
    path = scratch_dir(spark, "test-table")
    df.write.parquet(path)
    return path


def test_save_batch_recommendations(spark):
    out = jobs.batch_recommend(queries.cleaned(spark, SF_SMALL))
    base = scratch_dir(spark, "recs")
    jobs.save_batch_recommendations(out, base)
    users = spark.read.parquet(f"{base}/user_recommendations")
    items = spark.read.parquet(f"{base}/product_recommendations")
    assert users.columns == ["user_id", "product_id", "predicted_rating"]
    assert items.columns == ["product_id", "user_id", "predicted_rating"]
    assert users.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5


def test_universal_run_with_real_ids(spark):
    root = scratch_dir(spark, "universal-real")
    written = jobs.universal_run(spark, queries.raw(spark, SF_SMALL), f"{root}/run_1", f"{root}/latest",
                                 real_ids=True)
    lists = spark.read.parquet(written["recommendations"])
    kept = queries.universal(spark, SF_SMALL)
    assert lists.count() == kept.select("user_id").distinct().count()
    assert lists.join(kept, "user_id", "left_anti").count() == 0


def test_declared_table_created_once(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType

    from opinio.sources import files

    path = scratch_dir(spark, "declared")
    spark.range(5).selectExpr("CAST(id AS INT) AS user_id", "id * 2 AS extra").write.parquet(path)
    schema = StructType([StructField("user_id", IntegerType())])
    t = files.declare_table(spark, "declared_reviews_test", path, schema)
    again = files.declare_table(spark, "declared_reviews_test", path, schema)
    assert t.columns == ["user_id"] and again.count() == 5
