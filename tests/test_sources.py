"""Sources and sinks: CSV records, run folders, pointer, summaries, collections."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from opinio.plans import jobs
from opinio.session import scratch_dir
from opinio.sources import collections as coll
from opinio.sources import files


def test_multiline_csv_keeps_one_record(spark):
    df = spark.createDataFrame([(1, 'He said ""hi""\nthen left', "x"), (2, "plain", "y")],
                               "id int, review string, other string")
    df = df.withColumn("review", F.regexp_replace("review", '""', '"'))
    path = scratch_dir(spark, "csvtest")
    files.write_csv(df, path, multiline=True)
    back = files.read_csv_multiline(spark, path)
    assert back.count() == 2
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_run_tables_are_never_overwritten(spark):
    base = scratch_dir(spark, "run")
    df = spark.range(3)
    files.write_run_table(df, base, "cleaned_data")
    with pytest.raises(AnalysisException):
        files.write_run_table(df, base, "cleaned_data")


def test_pointer_and_summary_with_missing_section(spark):
    root = scratch_dir(spark, "runs")
    pointer = f"{root}/latest"
    assert jobs.results_summary(spark, pointer) is None  # nothing published yet
    run = f"{root}/run_a"
    d = spark.createDataFrame([("Positive", 5.0), ("Negative", 1.0), ("Positive", 4.0)], "sentiment string, Rating float")
    files.write_run_table(d, run, "sentiment_results")
    files.publish_run(spark, pointer, run)
    assert files.latest_run(spark, pointer) == run
    out = {(r.section, r.metric): r.value for r in jobs.results_summary(spark, pointer).collect()}
    assert out[("sentiment_results", "total_records")] == "3"
    assert out[("avg_rating_by_sentiment", "Positive")] == "4.50"
    assert not any(s == "cleaned_data" for s, _ in out)  # missing table: section left out


def test_runs_published_twice_and_damaged_pointer(spark, tmp_path):
    pointer = str(tmp_path / "latest")
    files.publish_run(spark, pointer, "run_a")
    files.publish_run(spark, pointer, "run_b")
    assert files.latest_run(spark, pointer) == "run_b"
    assert len(list((tmp_path / "latest").iterdir())) == 2
    (tmp_path / "latest" / "99999999999999999999").mkdir()  # a write that was interrupted
    assert files.latest_run(spark, pointer) == "run_b"
    (tmp_path / "latest" / "99999999999999999999" / "part-0.json").write_text('{"latest_path": "run_c", "publ')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.latest_run(spark, pointer)


def test_shared_folder_is_required_off_local_masters(monkeypatch):
    from types import SimpleNamespace

    from opinio import session

    conf = SimpleNamespace(get=lambda *a: None)
    for master, fine in (("local[8]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://host:7077", False)):
        context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master=master, setCheckpointDir=lambda d: None)
        if fine:
            session.scratch_dir(SimpleNamespace(sparkContext=context))
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                session.scratch_dir(SimpleNamespace(sparkContext=context))


def test_collections_are_sorted_and_take_options(spark, tmp_path):
    df = coll.with_record_id(spark.range(2000).withColumn("v", F.col("id") * 2))
    path = str(tmp_path / "docs")
    coll.write_collection(df, path, key="_id", options={"compression": "gzip"})
    assert list((tmp_path / "docs").glob("*.gz.parquet"))
    back = coll.read_collection(spark, path, df.schema)
    wanted = df.filter("id = 77").first()
    assert [tuple(r) for r in coll.find_equal(back, "_id", wanted._id).collect()] == [tuple(wanted)]
    per_file = back.groupBy(F.input_file_name()).agg(F.min("_id").alias("a"), F.max("_id").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(per_file, per_file[1:]))


def test_record_ids_do_not_collide(spark):
    texts = [None, "", "N", "1:a", "\x1e", "\x1f", "a\x1f", "a", "0:"]
    df = spark.createDataFrame([(x, y) for x in texts for y in texts], "x string, y string")
    assert coll.with_record_id(df).select("_id").distinct().count() == len(texts) ** 2


def test_record_id_is_stable(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 1.5)], "x int, y string, z double")
    ids = [r._id for r in coll.with_record_id(df).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64


def test_json_head_bad_json_is_whole(spark):
    from opinio.functions.recs import json_head

    df = spark.createDataFrame([("[" + "x" * 100,), ('[{"product_id":1,"rating":2.0},{"product_id":2,"rating":1.0},'
                                '{"product_id":3,"rating":0.5},{"product_id":4,"rating":0.25}]',), (None,)], "r string")
    got = [r[0] for r in df.select(json_head(F.col("r"))).collect()]
    assert got[0] == "[" + "x" * 100
    assert got[1] == '[{"product_id":1,"rating":2.0},{"product_id":2,"rating":1.0},{"product_id":3,"rating":0.5}]'
    assert got[2] == "[]"


def test_record_ids_for_copies_are_distinct(spark):
    df = spark.createDataFrame([(1, "a")] * 5000 + [(2, "b")], "x int, y string")
    ids = coll.with_record_id(df, copies=True)
    assert ids.count() == 5001 and ids.select("_id").distinct().count() == 5001
    assert ids.columns == ["_id", "x", "y"]


def test_final_columns_regenerates_both_ids(spark):
    from opinio.operators import clean

    df = spark.createDataFrame([(7, 5, "good one", "good one"), (9, 4, "bad  one", "bad  one")],
                               "User_ID long, rating int, review string, review_clean string")
    out = clean.select_final_columns(df)
    assert out.columns == list(clean.FINAL_COLUMNS)
    assert sorted((r.user_id, r.product_id, r.review) for r in out.collect()) == [(1, 1, "bad  one"), (2, 2, "good one")]


def test_hand_written_multiline_csv(spark, tmp_path):
    text = 'id,review,rating\n1,"He said ""great""\nthen left",5\n2,plain,3\n'
    f = tmp_path / "reviews.csv"
    f.write_text(text)
    back = files.read_csv_multiline(spark, str(f)).orderBy("id").collect()
    assert len(back) == 2
    assert back[0].review == 'He said "great"\nthen left' and back[0].rating == 5
    # with default options the quoted newline splits the record
    assert files.read_csv(spark, str(f)).count() == 3
