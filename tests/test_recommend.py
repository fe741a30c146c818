"""ALS invariants (rows-only keys): split, list shape, agreement with factor products, size gate."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.operators import recommend
from opinio.plans import jobs, queries
from tests.conftest import SF_SMALL


def test_split_disjoint_and_complete(spark):
    triples = recommend.rating_triples(queries.cleaned(spark, SF_SMALL))
    train, test = recommend.split(triples)
    n = triples.count()
    assert train.count() + test.count() == n
    assert train.intersect(test).count() == 0
    # the same on another layout
    again, _ = recommend.split(triples.repartition(7))
    assert again.exceptAll(train).count() == train.exceptAll(again).count() == 0
    assert 0.75 < train.count() / n < 0.85


def test_wide_and_text_ids_are_kept(spark):
    base = queries.cleaned(spark, SF_SMALL)
    wide = base.withColumns({"user_id": F.concat(F.lit("u-"), F.col("user_id")), "product_id": F.col("product_id") + 3_000_000_000})
    assert recommend.needs_index(wide) and not recommend.needs_index(base)
    with pytest.raises(Exception, match="index it first"):
        recommend.rating_triples(wide).collect()
    out = jobs.batch_recommend(wide)
    assert out.train.count() + out.test.count() == base.count()
    # lists carry the original ids, for exactly the users trained on
    assert out.user_recs.join(wide, "user_id", "left_anti").count() == 0
    assert out.user_recs.select("user_id").distinct().count() == out.train.select("user_id").distinct().count()
    assert out.user_recs.agg(F.min("product_id")).first()[0] >= 3_000_000_000


def test_user_lists_match_factor_products(spark):
    triples = recommend.rating_triples(queries.cleaned(spark, SF_SMALL))
    train, _ = recommend.split(triples)
    fitted = recommend.train(train)
    recs = recommend.user_recommendations(fitted).collect()
    users = {r.id: np.array(r.features) for r in fitted.model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in fitted.model.itemFactors.collect()}
    per_user = {}
    for r in recs:
        per_user.setdefault(r.user_id, []).append(r)
    assert len(per_user) == train.select("user_id").distinct().count()
    ids = np.array(sorted(items))
    mat = np.stack([items[i] for i in ids])
    for u, rows in list(per_user.items())[:50]:
        assert len(rows) <= 5
        scores = mat @ users[u]
        best = np.sort(scores)[::-1][: len(rows)]
        got = np.array(sorted((r.predicted_rating for r in rows), reverse=True))
        assert np.allclose(got, best, rtol=1e-4, atol=1e-4)


def test_predictions_have_no_nulls(spark):
    triples = recommend.rating_triples(queries.cleaned(spark, SF_SMALL))
    train, test = recommend.split(triples)
    preds = recommend.predictions(recommend.train(train), test)
    assert preds.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0


def test_size_gate(spark):
    one_user = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0)], "user_id int, product_id int, rating float")
    assert not recommend.has_enough_variety(one_user)
    ids = spark.createDataFrame([(1, 1, 4.0, "a", "x")],
                                "user_id int, product_id int, Rating_Cleaned float, review string, p string")
    assert recommend.universal_recommendations(ids) is None


def test_batch_job_outputs(spark):
    out = jobs.batch_recommend(queries.cleaned(spark, SF_SMALL))
    assert out.rmse.first()["rmse"] >= 0
    assert out.top_recommended.count() <= 10
    assert out.product_recs.groupBy("product_id").count().filter("count > 5").count() == 0


def test_subset_lists_equal_full_lists(spark):
    triples = recommend.rating_triples(queries.cleaned(spark, SF_SMALL))
    train, _ = recommend.split(triples)
    fitted = recommend.train(train)
    some = train.select("user_id").distinct().orderBy("user_id").limit(5)
    sub = recommend.recommendations_for(fitted, some)
    full = recommend.user_recommendations(fitted).join(some, "user_id", "left_semi")
    key = lambda r: (r.user_id, r.product_id)
    a = sorted(sub.collect(), key=key)
    b = sorted(full.collect(), key=key)
    assert [key(r) for r in a] == [key(r) for r in b]
    assert np.allclose([r.predicted_rating for r in a], [r.predicted_rating for r in b], atol=1e-5)


def test_split_counts_and_distinct_counts(spark):
    from opinio.operators import reports

    triples = recommend.rating_triples(queries.cleaned(spark, SF_SMALL))
    train, test = recommend.split(triples)
    counts = {r.part: r.records for r in recommend.split_counts(train, test).collect()}
    assert counts["train"] + counts["test"] == triples.count() and counts["train"] > counts["test"]
    exact = reports.distinct_counts(triples).first()
    approx = reports.approx_distinct_counts(triples).first()
    assert abs(approx.distinct_users - exact.distinct_users) <= 0.05 * exact.distinct_users + 1


def test_size_gate_min_max_equals_distinct(spark):
    cases = [
        [(1, 1, 4.0), (1, 2, 3.0)],               # one user
        [(1, 1, 4.0), (2, 1, 3.0)],               # one item
        [(1, 1, 4.0), (2, 2, 3.0)],               # enough
    ]
    for rows in cases:
        df = spark.createDataFrame(rows, "user_id int, product_id int, rating float")
        exact = df.agg(F.countDistinct("user_id"), F.countDistinct("product_id")).first()
        assert recommend.has_enough_variety(df) == (exact[0] >= 2 and exact[1] >= 2)
        assert recommend.has_enough_variety(df, 3) is False
    empty = spark.createDataFrame([], "user_id int, product_id int, rating float")
    assert recommend.has_enough_variety(empty) is False
