"""Distributed global ranks equal the single-partition window (nulls first, ties)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from opinio.operators import rank


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    words = [None, "apple", "banana", "cherry", "date", "elder", "fig"]
    rows = [(i, rnd.choice(words), rnd.choice(words[1:4]), rnd.randint(1, 5)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, review string, product string, rating int").repartition(5)


def test_row_number_equals_window(spark):
    df = _frame(spark)
    got = rank.row_number_global(df, ["review"], tie_break=["rating", "id"], out="rn")
    w = Window.orderBy(F.col("review").asc_nulls_first(), "rating", "id")
    want = df.withColumn("rn", F.row_number().over(w))
    assert sorted(got.collect()) == sorted(want.collect())


def test_dense_rank_equals_window_with_null_key(spark):
    df = _frame(spark)
    got = rank.dense_rank_global(df, "review", out="dr")
    want = df.withColumn("dr", F.dense_rank().over(Window.orderBy(F.col("review").asc_nulls_first())))
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.filter(F.col("review").isNull()).select(F.min("dr")).first()[0] == 1


def test_dense_rank_replaces_existing_column(spark):
    df = _frame(spark).withColumnRenamed("id", "user_id")
    got = rank.dense_rank_ids(df, "review", "product")
    assert got.columns.count("user_id") == 1 and "product_id" in got.columns
    assert got.select(F.max("user_id")).first()[0] == df.select("review").distinct().count()


def test_surrogate_product_is_modulo(spark):
    df = _frame(spark).drop("product")
    got = rank.surrogate_ids(df, tie_break=["rating", "id"])
    assert got.filter(F.col("product_id") != F.col("user_id") % 1000).count() == 0
    assert got.select(F.min("user_id"), F.max("user_id")).first() == (1, df.count())


def test_hot_identical_row_is_spread(spark):
    # one row repeated far beyond the chunk size, plus ordinary rows
    hot = spark.range(10000).select(F.lit("same").alias("review"), F.lit(3).alias("rating"))
    cold = spark.range(500).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("review"),
                                   (F.col("id") % 5).cast("int").alias("rating"))
    df = hot.unionByName(cold)
    spread = rank.spread_copies(df, chunk=512)
    assert spread.count() == df.count()
    assert spread.filter(F.col("review") == "same").select(F.countDistinct("_copy")).first()[0] == 10000
    got = rank.row_number_global(df, ["review"], out="rn")
    assert sorted(r.rn for r in got.collect()) == list(range(1, df.count() + 1))
    w = Window.orderBy(F.col("review").asc_nulls_first(), "rating")
    want = df.withColumn("rn", F.row_number().over(w))
    assert sorted(got.collect()) == sorted(want.collect())


def test_ranks_property_random_frames(spark):
    """Random small frames (nulls, ties, copies): distributed ranks equal the plain windows."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), st.integers(0, 3))

    def srt(rows):
        return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=60))
    def check(rows):
        df = spark.createDataFrame(rows, "k string, v int").repartition(3)
        got = rank.row_number_global(df, ["k"], out="rn")
        want = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first(), "v")))
        assert srt(got.collect()) == srt(want.collect())
        got_d = rank.dense_rank_global(df, "k", out="dr")
        want_d = df.withColumn("dr", F.dense_rank().over(Window.orderBy(F.col("k").asc_nulls_first())))
        assert srt(got_d.collect()) == srt(want_d.collect())

    check()


def test_hot_key_is_split_across_range_partitions(spark):
    """A review text holding a third of the rows does not land in one partition."""
    n = 30000
    # at this size AQE would coalesce everything into one task; measure the ranges themselves
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_hot_split(spark, n)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _check_hot_split(spark, n):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
        .alias("review"),
        (F.col("id") % 5).cast("int").alias("rating"),
        F.col("id").alias("row"))
    tagged = rank.tagged_positions(df, ["review"], ["rating", "row"], collapse_copies=False)
    sizes = [r["count"] for r in tagged.groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert sum(sizes) == n and len(sizes) > 2
    assert max(sizes) < n / 3  # the hot third is spread, not parked in one task
    # identical hot rows (no distinguishing column) are spread the same way after folding
    same = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("review"))
    tagged2 = rank.tagged_positions(same, ["review"], [], collapse_copies=True)
    sizes2 = [r["count"] for r in tagged2.groupBy(F.shiftright("_mid", 33)).count().collect()]
    assert sum(sizes2) == n and max(sizes2) < n / 3


def test_dense_rank_join_back_splits_a_hot_key(spark):
    """With the rank table too big to broadcast, AQE splits the hot key's join partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("t"), (F.col("id") % 5000).cast("string"))).alias("review"),
            F.col("id"))
        got = rank.dense_rank_global(df, "review", out="dr")
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        want = df.withColumn("dr", F.dense_rank().over(Window.orderBy("review")))
        assert sorted(rows) == sorted(want.collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _sort_check(spark, df, key="review"):
    got = rank.rank_by_sort(df, key, "dr")
    w = Window.orderBy(F.col(f"`{key}`").asc_nulls_first())
    want = df.withColumn("dr", F.dense_rank().over(w))
    assert got.columns == want.columns and got.schema["dr"].dataType == want.schema["dr"].dataType
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rank_by_sort_equals_window(spark):
    _sort_check(spark, _frame(spark))
    # empty text next to null, texts beyond ASCII, a long one, a header with a dot, clashing inner names
    words = [None, "", " ", "a", "A", "\u00e9", "\U0001f600", "\uffff", "z" * 200_000]
    rows = [(words[i % len(words)], i % 3, i) for i in range(200)]
    _sort_check(spark, spark.createDataFrame(rows, "`the.text` string, _pid int, _key long").repartition(7), "the.text")
    _sort_check(spark, spark.createDataFrame([], "review string, n int"))
    _sort_check(spark, spark.createDataFrame([(None, 1), (None, 2)], "review string, n int"))


def test_rank_by_sort_over_many_small_batches_and_partitions(spark):
    """A third of the rows share one text: it spans partitions and Arrow batches, and counts once."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "37",
            "spark.sql.shuffle.partitions": "23"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(6000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
            .otherwise((F.col("id") % 1500).cast("string")).alias("review"))
        _sort_check(spark, df)
        _sort_check(spark, spark.range(3000).select(F.lit("same").alias("review")))
        plan = rank.rank_by_sort(df, "review", "dr")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_dense_rank_ids_of_other_types(spark):
    """A review column that is no text goes by the join; ids are the same."""
    df = spark.range(60).select((F.col("id") % 7).alias("review"), (F.col("id") % 3).cast("string").alias("product"))
    got = rank.dense_rank_ids(df, "review", "product")
    want = df.select("*", F.dense_rank().over(Window.orderBy("review")).alias("user_id"), F.dense_rank().over(Window.orderBy("product")).alias("product_id"))
    assert sorted(got.collect()) == sorted(want.collect())
