"""Checks of a fitted recommender by value (ML-2..6), as rows that SQL can state.

ALS solves the factors of one side while the other side stands still, the users
last.  So with the final product factors x, the row w of a user with ratings r has
to be the minimum of ``sum (x.w - r)^2 + reg * n * |w|^2``: its gradient
``sum x (x.w - r) + reg * n * w`` is zero, or, for a coordinate that is held at
zero by ``nonnegative``, not below zero.  Everything is joins and sums of the
ratings with the two factor tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.operators.recommend import DEFAULT_RANK, Fitted

# Factors are stored in single precision and solved iteratively where they must not be negative.
TOLERANCE = 1e-3


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def _sides(fitted: Fitted) -> tuple[DataFrame, DataFrame]:
    return fitted.model.userFactors.toDF("user_id", "w"), fitted.model.itemFactors.toDF("product_id", "x")


def user_optimality(triples: DataFrame, fitted: Fitted) -> DataFrame:
    """``(user_id, residual)`` for every user of ``triples``: the gradient's worst coordinate, relative to its terms.

    A user or product without a factor row has an infinite residual.  The products
    are joined first, so the rows are shuffled with one factor row only and already
    lie by user for the sums; these are plain numbers, for which Spark keeps a hash
    table (rows holding an array would be sorted as a whole).
    """
    users, items = _sides(fitted)
    rank = fitted.params.get("rank", DEFAULT_RANK)
    reg, held = fitted.params["regParam"], fitted.params.get("nonnegative", False)
    rating = F.col(fitted.rating_col).cast("double")
    rows = triples.join(items, "product_id", "left").join(users, "user_id", "left").withColumn("e", _dot("x", "w") - rating)
    x = [F.get("x", F.lit(k)).cast("double") for k in range(rank)]
    sums = [F.sum(x[k] * F.col("e")).alias(f"g{k}") for k in range(rank)]
    sizes = [F.sum(F.abs(x[k]) * (F.abs(F.col("e") + rating) + F.abs(rating))).alias(f"s{k}") for k in range(rank)]
    held_by = [F.any_value(F.get("w", F.lit(k))).alias(f"w{k}") for k in range(rank)]
    n = F.count(F.lit(1)).alias("n")
    one = rows.groupBy("user_id").agg(n, F.count_if(F.col("e").isNull()).alias("missing"), *held_by, *sums, *sizes)
    worst = []
    for k in range(rank):
        w = F.col(f"w{k}").cast("double")
        gradient = F.col(f"g{k}") + reg * F.col("n") * w
        off = F.when((w <= 0) & (gradient > 0), 0.0).otherwise(F.abs(gradient)) if held else F.abs(gradient)
        worst.append(off / (F.col(f"s{k}") + reg * F.col("n") * F.abs(w) + 1e-6))
    return one.select("user_id", F.when(F.col("missing") > 0, float("inf")).otherwise(F.greatest(*worst)).alias("residual"))


def factor_check(triples: DataFrame, fitted: Fitted) -> DataFrame:
    """ML-2 / ML-3: ``(side, id, valid)`` for every user and product trained on.

    A user's factors are the minimum above; a product's are there, of the right
    length, finite and, where asked, not negative.
    """
    rank, held = fitted.params.get("rank", DEFAULT_RANK), fitted.params.get("nonnegative", False)
    users = user_optimality(triples, fitted).select(F.lit("user").alias("side"), F.col("user_id").alias("id"),
                                                    (F.col("residual") <= TOLERANCE).alias("valid"))
    fine = F.forall("x", lambda v: ~F.isnan(v) & (F.abs(v) < float("inf")) & ((v >= 0) if held else F.lit(True)))
    items = triples.select("product_id").distinct().join(_sides(fitted)[1], "product_id", "left").select(
        F.lit("item").alias("side"), F.col("product_id").alias("id"), F.coalesce((F.size("x") == rank) & fine, F.lit(False)).alias("valid"))
    return users.unionByName(items)


def prediction_check(predicted: DataFrame, fitted: Fitted) -> DataFrame:
    """ML-6: every predicted row with ``valid``: the prediction is the product of the two factor rows."""
    users, items = _sides(fitted)
    rows = predicted.join(users, "user_id", "left").join(items, "product_id", "left").withColumn("d", _dot("x", "w"))
    valid = F.coalesce(F.abs(F.col("prediction") - F.col("d")) <= 1e-4 * (1 + F.abs("d")), F.lit(False))
    return rows.select("user_id", "product_id", fitted.rating_col, valid.alias("valid"))


def list_check(nested: DataFrame, fitted: Fitted) -> DataFrame:
    """ML-4: ``(user_id, entries, valid)``: each list falls, names no product twice, and its scores are factor products."""
    users, items = _sides(fitted)
    entry = nested.select("user_id", F.size("recommendations").alias("entries"), F.posexplode("recommendations").alias("pos", "rec"))
    entry = entry.select("user_id", "entries", "pos", F.col("rec.product_id").alias("product_id"), F.col("rec.rating").alias("score"))
    rows = entry.join(users, "user_id", "left").join(items, "product_id", "left").withColumn("d", _dot("x", "w"))
    right = F.coalesce(F.abs(F.col("score") - F.col("d")) <= 1e-4 * (1 + F.abs("d")), F.lit(False))
    lists = rows.groupBy("user_id").agg(
        F.any_value("entries").alias("entries"), F.count_if(~right).alias("_wrong"), F.count_distinct("product_id").alias("_products"),
        F.array_sort(F.collect_list(F.struct("pos", "score"))).alias("_l"))
    falls = F.forall(F.sequence(F.lit(1), F.size("_l")), lambda i: (i == 1) | (F.element_at("_l", i)["score"] <= F.element_at("_l", F.greatest(i - 1, F.lit(1)))["score"]))
    return lists.select("user_id", "entries", ((F.col("_wrong") == 0) & (F.col("_products") == F.col("entries")) & falls).alias("valid"))
