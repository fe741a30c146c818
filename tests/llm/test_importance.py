import math

import numpy as np
import pytest
from llm_helpers import DOCS, LABELS, clashing
from pyspark.sql import functions as F

from opinio.llm import importance


def test_features_are_words_and_pairs():
    assert len(importance.features("a b c")) == 5
    assert sorted(importance.features("A B c")) == sorted(importance.features("a\tb\nC"))
    assert len(importance.features(None)) == len(importance.features(" ")) == 0


def test_ratios_by_hand(spark):
    docs = spark.createDataFrame([(1, "good words here", None, None, None), (2, "bad bad junk", None, None, None), (3, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(1, True, True), (2, False, True)], "id long, good boolean, fits boolean")
    raw, good = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for text, g in (("good words here", 1), ("bad bad junk", 0)):
        for f in importance.features(text):
            raw[f] += 1
            good[f] += g
    p = (raw + 1 / importance.BUCKETS) / (raw.sum() + 1)
    added = importance.ADDED * good.sum() + 1
    want = np.log((good + added * p) / (good.sum() + added)) - np.log(p)
    np.testing.assert_allclose(importance.fit(docs, labels), want)


@pytest.mark.parametrize("bins", [2, 2048])
def test_kth_largest(spark, monkeypatch, bins):
    monkeypatch.setattr(importance, "BINS", bins)
    values = [*np.random.default_rng(0).normal(0, 100, 300), 5.0, 5.0, 5.0, -1e9, 1e9]
    df = spark.createDataFrame([(float(v),) for v in values], "key double").repartition(3)
    for k in (1, 2, 7, 150, len(values)):
        assert importance.kth_largest(df, "key", k) == sorted(values, reverse=True)[k - 1]


def test_gumbel_draws(spark):
    draws = [r[0] for r in spark.range(20000).select(importance.gumbel(F.col("id"))).collect()]
    assert np.mean(draws) == pytest.approx(0.5772, abs=0.05) and np.std(draws) == pytest.approx(math.pi / math.sqrt(6), abs=0.05)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, None, None), (6, 0, 0), (7, 0, 1), (None, 1, 0), (99, 1, 0), (4, 1, None)], LABELS)
    for docs in (odd_docs, clashing(odd_docs)):
        got, _, _ = importance.classify(docs, labels)
        assert got.count() == docs.count()
        kept = importance.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == got.filter("kept").count()
    assert importance.classify(no_docs, labels)[0].count() == importance.keep_good(no_docs, labels).count() == 0
    # nothing to learn from: everything stays
    assert importance.keep_good(odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_held_out_documents(spark):
    """Labels that the models and the threshold never saw: good documents stay, bad ones go."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    kept, _, least = importance.classify(docs, labels.filter(~unseen))
    found = kept.join(labels.filter(unseen), F.col("id") == F.col("doc_id")).groupBy((F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).agg(F.avg(F.col("kept").cast("int"))).collect()
    share = {(r[0], r[1]): r[2] for r in found}
    assert share[True, False] > 0.99 and share[False, False] < 0.08
    # the cut is the k-th largest key, with k the number of weights at or above the threshold
    keys = sorted((r.key for r in kept.collect()), reverse=True)
    assert keys[sum(r.kept for r in kept.collect()) - 1] == least


def test_filter_and_scores_agree(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    ids = {r.doc_id for r in importance.op3(spark, sf).collect()}
    assert ids == {r.doc_id for r in importance.keep_good(docs, labels).collect()} and len(ids) < docs.count()


def test_held_out_toxic_documents(spark):
    """Few toxic words in a long text: most of such documents go, and good ones stay."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    kept, _, _ = importance.classify(docs, labels.filter(~unseen))
    held = kept.join(labels.filter(unseen).filter("quality = 1"), F.col("id") == F.col("doc_id"))
    share = {r[0]: r[1] for r in held.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.avg(F.col("kept").cast("int"))).collect()}
    # 37 % of the labelled ones have none of the ten most telling words
    assert share[True] < 0.5 and share[False] > 0.99


def test_without_toxic_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "good words here", None, None, None), (2, "bad idiot", None, None, None)], DOCS)
    labels = spark.createDataFrame([(1, True, False, True), (2, False, False, True)], "id long, good boolean, toxic boolean, fits boolean")
    assert not importance.models(docs, labels)[1].any()
    evidence = importance.models(docs, labels.withColumn("toxic", F.col("id") == 2))[1]
    assert (evidence > 0).sum() == 2 and importance.log_weights(["an idiot", "words", None], np.zeros(importance.BUCKETS), evidence)[1][0] > 0
