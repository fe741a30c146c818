"""Norm-bounded lists, the ALS grid and the value checks of a fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.operators import recommend, recommend_checks
from opinio.operators.top_lists import top_lists
from opinio.plans import queries
from tests.conftest import SF_SMALL

FIELDS = "id int, features array<float>"


def vectors(spark, ids, rows):
    return spark.createDataFrame([(int(i), None if r is None else [float(x) for x in r]) for i, r in zip(ids, rows)], FIELDS)


def brute(q_ids, q, ids, x, n):
    out = []
    for i, v in zip(q_ids, q):
        scores = x.astype(np.float64) @ v.astype(np.float64)
        for j in np.lexsort((ids, -scores))[:n]:
            out.append((int(i), int(ids[j]), float(scores[j])))
    return sorted(out)


def rows_of(lists):
    return sorted((r["query"], r["item"], r["score"]) for r in lists.rows.collect())


@pytest.mark.parametrize("case", ["spread", "signed", "ties", "zero"])
def test_lists_equal_all_pairs(spark, case):
    rng = np.random.default_rng(3)
    q, x = rng.random((90, 4)).astype(np.float32), rng.random((700, 4)).astype(np.float32)
    if case == "spread":  # norms that fall quickly
        x *= rng.pareto(1.5, (700, 1)).astype(np.float32)
    if case == "signed":
        q, x = q - 0.5, x - 0.5
    if case == "ties":
        x = np.round(x * 2).astype(np.float32)
        q = np.round(q * 2).astype(np.float32)
    if case == "zero":
        x[5:] = 0
        q[:3] = 0
    ids = rng.permutation(700) + 10
    lists = top_lists(vectors(spark, range(90), q).repartition(3), vectors(spark, ids, x), 5, block=50, pack=16)
    got, want = rows_of(lists), brute(range(90), q, ids, x, 5)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-12)
    assert lists.pairs == 90 * 700
    if case == "spread":
        assert lists.scored < 0.6 * lists.pairs


def test_a_query_stops_inside_a_block(spark):
    # norms that fall quickly: a small share of the first block is enough
    rng = np.random.default_rng(5)
    q, x = rng.random((60, 4)).astype(np.float32), rng.random((5000, 4)).astype(np.float32) * rng.pareto(1.5, (5000, 1)).astype(np.float32)
    ids = rng.permutation(5000)
    lists = top_lists(vectors(spark, range(60), q), vectors(spark, ids, x), 5)
    assert [r[:2] for r in rows_of(lists)] == [r[:2] for r in brute(range(60), q, ids, x, 5)]
    assert lists.scored < 0.3 * lists.pairs


def test_scores_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(6)
    q, x = rng.random((70, 10)).astype(np.float32), rng.random((900, 10)).astype(np.float32)
    one, two = (rows_of(top_lists(vectors(spark, range(70), q).repartition(p), vectors(spark, range(900), x).repartition(p), 5, block=b, pack=k))
                for p, b, k in ((1, 64, 7), (5, 1000, 512)))
    assert one == two


def test_lists_of_few_and_none(spark):
    q, x = vectors(spark, [1, 2], [[1, 2], None]), vectors(spark, [7, 8, 9], [[1, 0], [0, 1], None])
    assert rows_of(top_lists(q, x, 5)) == [(1, 7, 1.0), (1, 8, 2.0)]
    none = spark.createDataFrame([], FIELDS)
    assert rows_of(top_lists(none, x, 5)) == rows_of(top_lists(q, none, 5)) == []
    assert top_lists(q, none, 5).rows.columns == ["query", "item", "score"]


def test_lists_agree_with_spark(spark):
    train, _ = recommend.split(recommend.rating_triples(queries.cleaned(spark, SF_SMALL)))
    fitted = recommend.train(train)
    for ours, theirs in ((recommend.user_recommendations(fitted), recommend.explode_user_lists(fitted.model.recommendForAllUsers(5))),
                         (recommend.top_users_per_product(fitted), fitted.model.recommendForAllItems(5).select("product_id", F.explode("recommendations").alias("r")).select(
                             "product_id", F.col("r.user_id").alias("user_id"), F.col("r.rating").alias("predicted_rating")))):
        key = ours.columns[0]
        a, b = (d.groupBy(key).agg(F.sort_array(F.collect_list("predicted_rating"), False).alias("s")).orderBy(key).collect() for d in (ours, theirs))
        assert [r[key] for r in a] == [r[key] for r in b]
        assert all(np.allclose(r.s, t.s, rtol=1e-5, atol=1e-5) for r, t in zip(a, b))


def test_grid_follows_the_data_and_the_memory():
    small = recommend.als_grid(230_000, 15_000, 20_000, 10, 1 << 30, 8)
    assert small == (10, 10) == recommend.als_grid(230_000, 15_000, 20_000, 10, 1 << 30, 4000)
    medium = recommend.als_grid(10**9, 10**8, 10**6, 10, 1 << 30, 500)
    assert 500 <= medium[1] <= medium[0] < 2000
    more = recommend.als_grid(10**9, 10**8, 10**6, 10, 1 << 28, 500)
    assert more[0] > medium[0] or more[1] > medium[1]
    # the builders of all cells stay within half of a task's memory, however large the data
    large = recommend.als_grid(10**11, 10**9, 10**8, 10, 4 << 30, 4000)
    assert 1000 < large[1] <= large[0] and large[0] * large[1] * 256 <= 2 << 30
    assert recommend.als_grid(0, 0, 0, 10, 1 << 30, 8) == (10, 10)


def test_grid_does_not_follow_the_shuffle_width(spark):
    train, _ = recommend.split(recommend.rating_triples(queries.cleaned(spark, SF_SMALL)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    grids = []
    for width in ("8", "2000"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            grids.append(recommend.grid_for(train, 10))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert grids[0] == grids[1]


def test_checks_see_a_wrong_fit(spark):
    train, test = (d.cache() for d in recommend.split(recommend.rating_triples(queries.cleaned(spark, SF_SMALL))))
    fitted = recommend.train(train)
    assert recommend_checks.factor_check(train, fitted).filter("NOT valid").count() == 0
    predicted = recommend.predictions(fitted, test)
    assert recommend_checks.prediction_check(predicted, fitted).filter("NOT valid").count() == 0
    nested = recommend.nested_user_lists(fitted)
    assert recommend_checks.list_check(nested, fitted).filter("NOT valid").count() == 0
    # factors that belong to other ratings, scores of another model, lists in the wrong order
    other = train.withColumn("rating", (6 - F.col("rating")).cast("float"))
    assert recommend_checks.factor_check(other, fitted).filter("side = 'user' AND NOT valid").count() > 0.9 * train.select("user_id").distinct().count()
    moved = predicted.withColumn("prediction", F.col("prediction") + 0.01)
    assert recommend_checks.prediction_check(moved, fitted).filter("valid").count() == 0
    turned = nested.withColumn("recommendations", F.reverse("recommendations"))
    assert recommend_checks.list_check(turned, fitted).filter("valid").count() < 0.1 * nested.count()
    strict = recommend.Fitted(fitted.model, "rating", fitted.params | {"regParam": 1.0})
    assert recommend_checks.user_optimality(train, strict).filter(f"residual <= {recommend_checks.TOLERANCE}").count() == 0


def test_normal_equations_are_summed_without_a_sort(spark):
    train, _ = recommend.split(recommend.rating_triples(queries.cleaned(spark, SF_SMALL)))
    fitted = recommend.train(train)
    plan = recommend_checks.user_optimality(train, fitted)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_optimality_sums_need_one_shuffle_of_wide_rows(spark):
    train, _ = recommend.split(recommend.rating_triples(queries.cleaned(spark, SF_SMALL)))
    fitted = recommend.train(train)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = recommend_checks.user_optimality(train.localCheckpoint(), fitted)._jdf.queryExecution().executedPlan().toString()
        assert recommend_checks.user_optimality(train, fitted).filter(f"residual > {recommend_checks.TOLERANCE}").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # ratings by product, products, ratings with one factor row by user, users; the sums use what lies by user
    assert plan.count("Exchange hashpartitioning") == 4
