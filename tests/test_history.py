"""Run history, declared tables and the funnel's own limits."""

import pytest
from pyspark.sql import functions as F

from opinio.operators import clean
from opinio.plans import queries
from opinio.sources import files
from tests.conftest import SF_SMALL


def test_history_shows_published_runs_only(spark, tmp_path):
    base = str(tmp_path / "history")
    tables = {r: spark.range(10 * r).select("id", F.lit(f"run {r}").alias("run")) for r in (1, 2, 3)}
    for r in (1, 2):
        files.write_history(tables[r], base, "t", r)
    files.publish_history(spark, base, 1)
    schema = tables[1].schema
    assert files.latest_of_history(spark, base, "t", schema).count() == 10
    files.publish_history(spark, base, 2)
    files.write_history(tables[3], base, "t", 3)
    latest = files.latest_of_history(spark, base, "t", schema)
    assert latest.columns == ["id", "run"] and latest.count() == 20 and {r.run for r in latest.collect()} == {"run 2"}
    # only the newest run's partition is read
    plan = latest._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:") :].split("\n")[0]
    assert "run_id" in filters and "subquery" in filters.lower()
    latest.write.format("noop").mode("overwrite").save()
    every = files.history(spark, base, "t", schema).groupBy("run_id").count().orderBy("run_id").collect()
    assert [tuple(r) for r in every] == [(1, 10), (2, 20)]
    for again in (lambda: files.write_history(tables[1], base, "t", 1), lambda: files.publish_history(spark, base, 2)):
        with pytest.raises(Exception, match="(?i)exist"):
            again()


def test_declared_table_is_kept_and_analysed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    files.write_parquet(df, f"{tmp_path}/it's a")
    files.write_parquet(df.limit(0), f"{tmp_path}/b")
    first = files.declare_table(spark, "kept_table", f"{tmp_path}/it's a", df.schema)
    assert files.declare_table(spark, "kept_table", f"{tmp_path}/b", df.schema).count() == first.count() == 2
    files.analyze_table(spark, "kept_table", ["n"])
    rows = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED kept_table").collect()}
    assert "2 rows" in rows["Statistics"]
    stats = {r["info_name"]: r["info_value"] for r in spark.sql("DESCRIBE TABLE EXTENDED kept_table n").collect()}
    assert stats["max"] == "2" and stats["distinct_count"] == "2"
    spark.sql("DROP TABLE kept_table")


@pytest.mark.parametrize("low, high", [(5, 5000), (60, 90), (None, 80), (70, None), (None, None)])
def test_funnel_ends_where_the_cleaner_does(spark, low, high):
    raw = queries.raw(spark, SF_SMALL)
    funnel = {r.step: r.records for r in clean.cleaning_funnel(raw, low, high).collect()}
    assert funnel["outliers_removed"] == clean.clean_reviews(raw, low, high).count()
